"""Loaders for the transactions table.

* ``read_transactions_csv``  — raw CSV (every column read as text, then typed
  with ``try_cast`` so that unparsable cells become NULL instead of failing
  the job under ANSI mode).
* ``read_transactions_parquet`` — a staged, already-typed table.
* ``transactions_from_tables`` — adapter from the TPC-H-style test tables
  (``lineitem ⋈ orders ⟕ part``); see FIXTURES.md §2 for the mapping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.sources.schema import MONEY, TRANSACTION_COLUMNS, TRANSACTION_SCHEMA

_RAW_SCHEMA = T.StructType([T.StructField(f.name, T.StringType()) for f in TRANSACTION_SCHEMA])


# Year-month-day spellings that are read as dates.
_DATE_FORMATS = ("yyyy-M-d", "yyyy/M/d", "yyyy.M.d", "yyyyMMdd")


def _parse_date(c: Column) -> Column:
    # Anything else becomes NULL (no exception under ANSI mode).
    return F.coalesce(*[F.try_to_date(F.trim(c), f) for f in _DATE_FORMATS])


def _parse_integral(c: Column, kind: T.DataType) -> Column:
    """Exact digits first, so large ids keep them; then numbers such as 7.0."""
    number = c.try_cast("double")
    return F.coalesce(c.try_cast(kind), F.when(number == F.floor(number), number).try_cast(kind))


def _typed_cell(col: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DateType):
        return _parse_date(col)
    if isinstance(kind, T.StringType):
        return col
    if isinstance(kind, (T.LongType, T.IntegerType)):
        return _parse_integral(col, kind)
    return col.try_cast(kind)


def clean_transactions(raw: DataFrame) -> DataFrame:
    """Type a text-typed transactions frame (one projection, no shuffle)."""
    exprs = []
    for field in TRANSACTION_SCHEMA.fields:
        if field.name not in raw.columns:
            raise ValueError(f"the transactions have no column {field.name!r}")
        col = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            src_type = raw.schema[field.name].dataType
            typed = col.cast("date") if not isinstance(src_type, T.StringType) else _parse_date(col)
        else:
            typed = _typed_cell(col, field.dataType)
        exprs.append(typed.alias(field.name))
    return raw.select(*exprs)


def read_transactions_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV scan with a header; blank and ``NA`` cells are missing values.

    Columns are matched by header name and read as text (no schema inference
    pass over the data), then typed by ``clean_transactions``; a column that
    the file lacks is an error.
    """
    raw = (spark.read
           .option("header", True)
           .option("nullValue", "NA")
           .option("mode", "PERMISSIVE")
           .csv(path))
    known = [c for c in raw.columns if c in _RAW_SCHEMA.fieldNames()]
    return clean_transactions(raw.select(*known))


def csv_rejects(spark: SparkSession, path: str) -> DataFrame:
    """file, column, value of every cell that ``read_transactions_csv`` turns
    into NULL although it holds something, and (column NULL) the text of every
    line with too few or too many cells.  One scan, no shuffle."""
    text = spark.read.option("header", True).option("nullValue", "NA")
    names = text.csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, "_line"]])
    raw = (text.option("mode", "PERMISSIVE").option("columnPruning", False).option("columnNameOfCorruptRecord", "_line").schema(schema).csv(path)
           .select("*", F.col("_metadata.file_path").alias("_file")))
    typed = [f.name for f in TRANSACTION_SCHEMA.fields if f.name in names and not isinstance(f.dataType, T.StringType)]
    cleaned = raw.select("_file", "_line", *[F.col(c).alias(f"_raw_{c}") for c in typed], *[c for c in names if c in _RAW_SCHEMA.fieldNames()])
    known = {e.name: e.dataType for e in TRANSACTION_SCHEMA.fields}
    cells = [F.when((F.trim(F.col(f"_raw_{c}")) != "") & _typed_cell(F.col(f"_raw_{c}"), known[c]).isNull(),
                    F.struct(F.lit(c).alias("column"), F.col(f"_raw_{c}").alias("value"))) for c in typed]
    line = F.when(F.col("_line").isNotNull(), F.struct(F.lit(None).cast("string").alias("column"), F.col("_line").alias("value")))
    return (cleaned.select("_file", F.explode(F.filter(F.array(line, *cells), lambda x: x.isNotNull())).alias("r"))
            .select(F.col("_file").alias("file"), "r.column", "r.value"))


def reject_counts(rejects: DataFrame) -> DataFrame:
    """file, column, rejected of ``csv_rejects``."""
    return rejects.groupBy("file", "column").agg(F.count(F.lit(1)).alias("rejected"))


def read_transactions_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(*TRANSACTION_COLUMNS)


# --- fixed values of the test-table adapter (FIXTURES.md §2) ------------------
# p_type -> category; any other type (or a missing part) -> "Home".
PART_TYPE_CATEGORY = {
    "ECONOMY": "Dresses",
    "LARGE": "Tops",
    "MEDIUM": "Shoes",
    "PROMO": "Bags",
    "SMALL": "Accessories",
}
OTHER_CATEGORY = "Home"
# o_orderstatus -> order_status
ORDER_STATUS = {"F": "Approved", "O": "Approved", "P": "Cancelled"}
# l_discount upper bounds -> sold_price_level (5 = full price ... 1 = deep discount)
PRICE_LEVEL_BOUNDS = [(0.025, 5), (0.045, 4), (0.065, 3), (0.085, 2)]
COST_SHARE = "0.6"  # unit cost as a share of the list price
# ------------------------------------------------------------------------------

PRODUCT_COLUMNS = {"category", "brand", "unit_cost", "total_cost", "gross_profit"}


def _case(col: Column, mapping: dict, default) -> Column:
    expr = None
    for key, value in mapping.items():
        expr = (F.when(col == key, F.lit(value)) if expr is None
                else expr.when(col == key, F.lit(value)))
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))


def transactions_from_tables(spark: SparkSession, sf_dir: str,
                             columns: list[str] | None = None) -> DataFrame:
    """Build the transactions table from ``lineitem``, ``orders`` and ``part``.

    ``columns`` selects the output columns; the ``part`` join is only planned
    when a product-derived column is asked for (it is a left join, so leaving
    it out never changes which lines exist).  Catalyst prunes every other
    unused input column down to the Parquet scans.

    At scale the two joins are sort-merge joins on ``orderkey``/``partkey``
    (AQE turns them into broadcasts when a side is small at runtime and
    splits skewed partitions); staging the result once, bucketed by
    ``customer_id`` (see ``sinks.stage_transactions``), removes them from every
    downstream customer-level job.
    """
    cols = list(columns) if columns else list(TRANSACTION_COLUMNS)
    need_part = bool(PRODUCT_COLUMNS.intersection(cols))

    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    df = li.join(orders, li.l_orderkey == orders.o_orderkey, "inner")
    if need_part:
        part = spark.read.parquet(f"{sf_dir}/part.parquet").select(
            "p_partkey", "p_type", "p_brand", "p_retailprice")
        df = df.join(part, df.l_partkey == part.p_partkey, "left")
    else:
        df = (df.withColumn("p_type", F.lit(None).cast("string"))
                .withColumn("p_brand", F.lit(None).cast("string"))
                .withColumn("p_retailprice", F.lit(None).cast("double")))

    returned = F.col("l_returnflag") == "R"
    gross = F.col("l_extendedprice").cast(MONEY)
    disc_rate = F.lit(1).cast("decimal(1,0)") - F.col("l_discount").cast("decimal(4,2)")
    discounted = F.round(gross * disc_rate, 2).cast(MONEY)
    refund = F.when(returned, discounted).otherwise(F.lit(0).cast(MONEY)).cast(MONEY)
    net = (discounted - refund).cast(MONEY)
    unit_cost = F.round(F.col("p_retailprice").cast(MONEY)
                        * F.lit(COST_SHARE).cast("decimal(2,1)"), 2).cast(MONEY)
    qty_dec = F.col("l_quantity").cast("decimal(18,0)")
    total_cost = (unit_cost * qty_dec).cast(MONEY)
    level = None
    for bound, lvl in PRICE_LEVEL_BOUNDS:
        cond = F.col("l_discount") <= bound
        level = F.when(cond, F.lit(lvl)) if level is None else level.when(cond, F.lit(lvl))
    level = level.otherwise(F.lit(1))

    out = {
        "transaction_date": F.col("o_orderdate").cast("date"),
        "transaction_id": F.col("o_orderkey"),
        "customer_id": F.col("o_custkey"),
        "product_id": F.col("l_partkey"),
        "quantity": F.col("l_quantity"),
        "unit_cost": unit_cost,
        "total_cost": total_cost,
        "sold_price": F.round(F.try_divide(gross, qty_dec), 2).cast(MONEY),
        "gross_revenue": gross,
        "refund_amount": refund,
        "net_revenue": net,
        "gross_profit": (net - total_cost).cast(MONEY),
        "line_revenue": gross,
        "returned_qty": F.when(returned, F.col("l_quantity")).otherwise(F.lit(0.0)),
        "sold_price_level": level.cast("int"),
        "order_status": _case(F.col("o_orderstatus"), ORDER_STATUS, F.lit(None).cast("string")),
        "category": _case(F.col("p_type"), PART_TYPE_CATEGORY, OTHER_CATEGORY),
        "brand": F.col("p_brand"),
    }
    return df.select(*[out[c].alias(c) for c in cols])


def transactions_sql_cte() -> str:
    """The same adapter as ANSI SQL (DuckDB dialect), used by the oracle."""
    cat = " ".join(f"WHEN p.p_type = '{k}' THEN '{v}'" for k, v in PART_TYPE_CATEGORY.items())
    status = " ".join(f"WHEN o.o_orderstatus = '{k}' THEN '{v}'" for k, v in ORDER_STATUS.items())
    level = " ".join(f"WHEN l.l_discount <= {b} THEN {lv}" for b, lv in PRICE_LEVEL_BOUNDS)
    return f"""
txn_base AS (
  SELECT
    CAST(o.o_orderdate AS DATE) AS transaction_date,
    o.o_orderkey AS transaction_id,
    o.o_custkey AS customer_id,
    l.l_partkey AS product_id,
    l.l_quantity AS quantity,
    CAST(l.l_extendedprice AS DECIMAL(18,2)) AS gross_revenue,
    CAST(ROUND(CAST(l.l_extendedprice AS DECIMAL(18,2))
               * (1 - CAST(l.l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(18,2)) AS disc,
    l.l_returnflag = 'R' AS is_returned,
    CAST(ROUND(CAST(p.p_retailprice AS DECIMAL(18,2)) * CAST({COST_SHARE} AS DECIMAL(2,1)), 2)
         AS DECIMAL(18,2)) AS unit_cost,
    CAST(l.l_extendedprice * 100 AS DECIMAL(18,0)) AS gross_cents,
    CASE {level} ELSE 1 END AS sold_price_level,
    CASE {status} ELSE NULL END AS order_status,
    CASE {cat} ELSE '{OTHER_CATEGORY}' END AS category,
    p.p_brand AS brand
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
),
txn AS (
  SELECT
    transaction_date, transaction_id, customer_id, product_id, quantity,
    unit_cost,
    CAST(unit_cost * CAST(quantity AS DECIMAL(18,0)) AS DECIMAL(18,2)) AS total_cost,
    CASE WHEN quantity = 0 THEN NULL ELSE
      CAST(CAST(CAST((2 * CAST(gross_cents AS BIGINT) + CAST(quantity AS BIGINT))
                     // (2 * CAST(quantity AS BIGINT)) AS BIGINT) AS DECIMAL(18,2))
           * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) END AS sold_price,
    gross_revenue,
    CASE WHEN is_returned THEN disc ELSE CAST(0 AS DECIMAL(18,2)) END AS refund_amount,
    CAST(CASE WHEN is_returned THEN 0 ELSE disc END AS DECIMAL(18,2)) AS net_revenue,
    CAST(CAST(CASE WHEN is_returned THEN 0 ELSE disc END AS DECIMAL(18,2))
         - CAST(unit_cost * CAST(quantity AS DECIMAL(18,0)) AS DECIMAL(18,2)) AS DECIMAL(18,2))
      AS gross_profit,
    gross_revenue AS line_revenue,
    CASE WHEN is_returned THEN quantity ELSE 0.0 END AS returned_qty,
    CAST(sold_price_level AS INTEGER) AS sold_price_level,
    order_status, category, brand
  FROM txn_base
)"""
