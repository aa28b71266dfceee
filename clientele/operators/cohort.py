"""Cohort retention (customers grouped by the month of their first approved
purchase, followed month by month).

Plan: approved lines are first reduced to distinct (customer, month) pairs —
a partial aggregate, so even a customer with a huge share of the lines leaves
each map task as at most one row per month.  The cohort month is then a
window minimum over those pairs (rows per customer are bounded by the number
of months), so no line-level join back to the customer table is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clientele.functions.dates import (
    month_start,
    months_apart,
    pct_from_tenths,
    pct_label_from_tenths,
    pct_tenths,
)
from clientele.operators.features import approved


def cohort_assignment(txn: DataFrame) -> DataFrame:
    """customer_id, first_purchase_date, cohort_month."""
    first = approved(txn).groupBy("customer_id").agg(
        F.min("transaction_date").alias("first_purchase_date"))
    return first.withColumn("cohort_month", month_start(F.col("first_purchase_date")))


def _customer_months(txn: DataFrame) -> DataFrame:
    months = (approved(txn)
              .select("customer_id", month_start(F.col("transaction_date")).alias("transaction_month"))
              .distinct())
    # min() skips NULL months, like min(na.rm=TRUE) over the dates
    first = F.min("transaction_month").over(Window.partitionBy("customer_id"))
    return months.withColumn("cohort_month", first)


def cohort_counts(txn: DataFrame) -> DataFrame:
    """Distinct customers per (cohort_month, cohort_index)."""
    cm = _customer_months(txn).withColumn(
        "cohort_index", months_apart(F.col("transaction_month"), F.col("cohort_month")))
    # each (customer, month) pair is one row, so a row count is a distinct count
    return cm.groupBy("cohort_month", "cohort_index").agg(F.count(F.lit(1)).alias("customers"))


def cohort_retention(counts: DataFrame) -> DataFrame:
    """Counts plus cohort size (customers at index 0), rate and label.

    The size comes from a window over the small counts table (one row per
    cohort and month offset), not from a join.
    """
    size = F.max(F.when(F.col("cohort_index") == 0, F.col("customers"))).over(
        Window.partitionBy("cohort_month"))
    ret = counts.withColumn("cohort_size", size)
    tenths = pct_tenths(F.col("customers"), F.col("cohort_size"))
    return ret.select(
        "cohort_month", "cohort_index", "customers", "cohort_size",
        (F.col("customers").cast("double") / F.col("cohort_size").cast("double")).alias("retention_rate"),
        pct_label_from_tenths(tenths).alias("retention_label"),
        pct_from_tenths(tenths).alias("retention_pct"),
    )


def _index_values(retention: DataFrame) -> list[int]:
    # month offsets: bounded by the number of months the data spans
    return sorted(r[0] for r in retention.select("cohort_index").distinct()
                  .filter(F.col("cohort_index").isNotNull()).collect())


def cohort_matrix(retention: DataFrame, value: str = "retention_rate") -> DataFrame:
    """Wide matrix: one row per cohort month, one column per month offset
    (named ``"0"``, ``"1"``, ...), NULL where a cohort has no customers."""
    values = _index_values(retention)
    return (retention.groupBy("cohort_month")
            .pivot("cohort_index", values)
            .agg(F.first(value)))


def cohort_cells(retention: DataFrame, value: str = "retention_rate") -> DataFrame:
    """The matrix with a fixed schema: one row per cohort month and month offset
    0 .. the largest, NULL where a cohort has no customers."""
    last = retention.agg(F.max("cohort_index")).first()[0]  # months the data spans
    known = retention.filter(F.col("cohort_index").isNotNull()).select("cohort_month", "cohort_index", value)
    grid = (retention.select("cohort_month").distinct()
            .withColumn("cohort_index", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(int(last or 0)).cast("long")))))
    return (grid.join(known.withColumnsRenamed({"cohort_month": "_m", "cohort_index": "_i"}),
                      F.col("cohort_month").eqNullSafe(F.col("_m")) & (F.col("cohort_index") == F.col("_i")), "left")
            .select("cohort_month", "cohort_index", value))


def cohort_matrix_pct(retention: DataFrame) -> DataFrame:
    return cohort_matrix(retention, "retention_pct")
