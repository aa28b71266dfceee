"""Customer-level feature tables.

All of them are one ``groupBy(customer_id)`` over the order lines: Spark
plans a partial (map-side) aggregate, so a customer holding a large share of
the lines collapses to one row per map task before the shuffle.  Orders are
counted by Catalyst's two-level aggregate on (customer, order), which is also
skew-safe; categories and brands by bit masks in the same aggregation, so no row
is copied for a second distinct count.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions.dates import days_between, is_weekend
from clientele.functions.nullsafe import (
    has_null,
    mean_of,
    n_distinct_na,
    ratio_or_zero,
    safe_div,
    sum0,
    with_distinct_mask,
)
from clientele.sources.schema import (
    ACCESSORY_CATEGORIES,
    APPROVED,
    CATEGORY_GROUPS,
    FASHION_CATEGORIES,
)

DateLike = _dt.date | str | Column | None


def approved(txn: DataFrame) -> DataFrame:
    """Lines of approved orders only."""
    return txn.filter(F.col("order_status") == APPROVED)


def _date_col(d: DateLike) -> Column | None:
    if d is None:
        return None
    if isinstance(d, Column):
        return d
    return F.lit(str(d)).cast("date")


def max_date(txn: DataFrame) -> Column:
    """Latest transaction date as a scalar subquery (evaluated once, lazily)."""
    return txn.select(F.max("transaction_date")).scalar()


def analysis_dates(txn: DataFrame) -> DataFrame:
    """The reference dates used by the analyses, as one row.

    * ``lrfmpv_date``  — day after the last approved line (LRFMPV, BTYD)
    * ``last_date``    — last line of any status (data mart, churn base)
    * ``last_approved``— last approved line
    """
    return txn.agg(
        F.date_add(F.max(F.when(F.col("order_status") == APPROVED, F.col("transaction_date"))), 1)
        .alias("lrfmpv_date"),
        F.max("transaction_date").alias("last_date"),
        F.max(F.when(F.col("order_status") == APPROVED, F.col("transaction_date")))
        .alias("last_approved"),
    )


def collect_date(txn: DataFrame, approved_only: bool = False) -> _dt.date | None:
    """Latest date as a Python literal (one-row aggregate).

    Use where the date feeds a filter that should reach the Parquet scan;
    elsewhere prefer the lazy ``max_date`` subquery.
    """
    src = approved(txn) if approved_only else txn
    return src.agg(F.max("transaction_date")).first()[0]


# --- C1: LRFMPV ---------------------------------------------------------------

def lrfmpv_base(txn: DataFrame, analysis_date: DateLike = None) -> DataFrame:
    """Length, Recency, Frequency, Monetary, Periodicity, Variety per customer.

    Approved lines only.  ``analysis_date`` defaults to the day after the last
    approved line.  P is NULL for single-order customers.
    """
    app = approved(txn)
    a = _date_col(analysis_date)
    if a is None:
        a = F.date_add(max_date(app), 1)
    app, variety = with_distinct_mask(app, "category")
    base = app.groupBy("customer_id").agg(
        F.min("transaction_date").alias("first_order"),
        F.max("transaction_date").alias("last_order"),
        n_distinct_na("transaction_id").alias("F"),
        sum0("net_revenue").cast("double").alias("M"),
        variety.alias("V"),
    )
    length = days_between(F.col("last_order"), F.col("first_order"))
    return base.select(
        "customer_id", "first_order", "last_order", "F", "M", "V",
        length.alias("L"),
        days_between(a, F.col("last_order")).alias("R"),
        F.when(F.col("F") > 1, length.cast("double") / (F.col("F") - 1).cast("double"))
        .alias("P"),
    )


def lrfmpv_features(base: DataFrame) -> DataFrame:
    return base.select("customer_id", "L", "R", "F", "M", "P", "V")


# --- P5 / C6 / C7: behavioural data mart ---------------------------------------

def category_group(category: Column) -> Column:
    return (F.when(category.isin(*FASHION_CATEGORIES), F.lit("fashion"))
            .when(category.isin(*ACCESSORY_CATEGORIES), F.lit("accessory"))
            .otherwise(F.lit("other")))


def with_category_group(txn: DataFrame) -> DataFrame:
    return txn.withColumn("category_group", category_group(F.col("category")))


def _group_counts() -> list[Column]:
    g = category_group(F.col("category"))
    return [F.count(F.when(g == name, F.lit(1))).alias(f"_n_{name}") for name in CATEGORY_GROUPS]


def category_ratio(txn: DataFrame) -> DataFrame:
    """Share of each customer's lines per category group, one column per
    group (``cat_ratio_fashion``, ``cat_ratio_accessory``, ``cat_ratio_other``),
    0 where the customer has none.  One conditional aggregation (a pivot with
    fixed values), no second shuffle."""
    agg = txn.groupBy("customer_id").agg(F.count(F.lit(1)).alias("_n"), *_group_counts())
    return agg.select(
        "customer_id",
        *[(F.col(f"_n_{g}").cast("double") / F.col("_n").cast("double")).alias(f"cat_ratio_{g}")
          for g in CATEGORY_GROUPS])


def customer_dm(txn: DataFrame, analysis_date: DateLike = None) -> DataFrame:
    """Behavioural data mart over lines of every status (19 measures plus the
    category-group ratios), from a single aggregation per customer.

    ``analysis_date`` defaults to the last line date (no +1 here).
    """
    a = _date_col(analysis_date)
    if a is None:
        a = max_date(txn)
    grp = category_group(F.col("category"))
    weekend = is_weekend(F.col("transaction_date"))
    qty, ret = F.sum("quantity"), F.sum("returned_qty")
    gross, refund = F.sum("gross_revenue"), F.sum("refund_amount")
    net, profit = F.sum("net_revenue"), F.sum("gross_profit")
    marked, brands = with_distinct_mask(txn, "brand")
    agg = marked.groupBy("customer_id").agg(
        F.min("transaction_date").alias("first_order"),
        F.max("transaction_date").alias("last_order"),
        n_distinct_na("transaction_id").alias("F"),
        F.coalesce(net, F.lit(0)).cast("double").alias("M"),
        F.coalesce(profit, F.lit(0)).cast("double").alias("profit"),
        safe_div(net, F.count("net_revenue")).alias("avg_basket"),
        brands.alias("brand_diversity"),
        mean_of(weekend).alias("weekend_ratio"),
        ratio_or_zero(F.coalesce(ret, F.lit(0.0)), F.coalesce(qty, F.lit(0.0))).alias("return_ratio"),
        ratio_or_zero(F.coalesce(refund, F.lit(0)), F.coalesce(gross, F.lit(0))).alias("refund_ratio"),
        ratio_or_zero(F.coalesce(profit, F.lit(0)), F.coalesce(net, F.lit(0))).alias("profit_margin"),
        mean_of(F.col("sold_price_level") <= 2).alias("bargain_ratio"),
        mean_of(F.col("sold_price_level") >= 4).alias("premium_ratio"),
        F.count(F.lit(1)).alias("_n"),
        *_group_counts(),
    )
    n = F.col("_n").cast("double")
    # category_group has three fixed values and is never missing: its distinct
    # count is the number of non-zero group counts (no extra distinct aggregate)
    variety = sum((F.col(f"_n_{g}") > 0).cast("long") for g in CATEGORY_GROUPS)
    return agg.withColumn("V", variety.cast("long")).select(
        "customer_id", "first_order", "last_order", "F", "M", "profit",
        days_between(a, F.col("last_order")).alias("R"),
        days_between(F.col("last_order"), F.col("first_order")).alias("L"),
        "V", "avg_basket",
        F.col("V").alias("category_diversity"),
        "brand_diversity", "weekend_ratio",
        (F.col("weekend_ratio") > 0.5).cast("double").alias("weekend_shopper"),
        "return_ratio", "refund_ratio", "profit_margin",
        (F.greatest(*[F.col(f"_n_{g}") for g in CATEGORY_GROUPS]).cast("double") / n)
        .alias("top_category_ratio"),
        "bargain_ratio", "premium_ratio",
        *[(F.col(f"_n_{g}").cast("double") / n).alias(f"cat_ratio_{g}") for g in CATEGORY_GROUPS],
    )


# --- C13: revenue / profit customer base ----------------------------------------

def customer_base(txn: DataFrame, as_of: DateLike = None) -> DataFrame:
    """Customer value table over lines of every status.

    ``as_of`` replaces the wall clock for recency (default: last line date),
    so results repeat.  first/last order are NULL when any line date is
    missing (plain min/max); ``return_rate`` is NULL when no quantity.
    """
    a = _date_col(as_of)
    if a is None:
        a = max_date(txn)
    date_null = has_null("transaction_date") == 1
    agg = txn.groupBy("customer_id").agg(
        sum0("net_revenue").alias("_rev"),
        sum0("gross_profit").cast("double").alias("total_profit"),
        n_distinct_na("transaction_id").alias("total_orders"),
        sum0("quantity").cast("double").alias("total_items"),
        F.when(date_null, F.lit(None)).otherwise(F.min("transaction_date")).alias("first_order"),
        F.when(date_null, F.lit(None)).otherwise(F.max("transaction_date")).alias("last_order"),
        safe_div(sum0("returned_qty"), sum0("quantity")).alias("return_rate"),
    )
    return agg.select(
        "customer_id",
        F.col("_rev").cast("double").alias("total_revenue"),
        "total_profit", "total_orders", "total_items", "first_order", "last_order",
        days_between(a, F.col("last_order")).alias("recency"),
        safe_div(F.col("_rev"), F.col("total_orders")).alias("avg_order_value"),
        "return_rate",
    )
