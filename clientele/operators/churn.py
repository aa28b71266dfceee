"""Churn: explainable risk score and two root-cause signals.

Flags are three-valued (``cond.cast("int")``): a missing input gives a
missing flag, and ``NULL AND false`` is still 0, exactly like the analysis
definitions.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clientele.functions.dates import days_between
from clientele.functions.lookup import lookup
from clientele.functions.nullsafe import flag, left_join_na, sum0
from clientele.functions.ranking import exact_quantiles, percent_ranks
from clientele.operators.features import _date_col, collect_date, max_date


# --- D1-D4: churn risk score ------------------------------------------------------

# fixed values: score bands (lower bound, segment, action), checked top-down
CHURN_BANDS = [
    (0.75, "Critical", "Immediate winback campaign"),
    (0.55, "High Risk", "Targeted retention campaign"),
    (0.35, "Medium Risk", "Engagement / reminder campaign"),
]
HEALTHY = ("Healthy", "Maintain / loyalty nurturing")
REVIEW_ACTION = "Review"


def churn_input(clv: DataFrame, lrfmpv: DataFrame) -> DataFrame:
    """CLV table plus the rhythm features L, R, P, V (1:1 left join)."""
    return left_join_na(clv, lrfmpv.select("customer_id", "L", "R", "P", "V"), ["customer_id"])


def churn_risk(df: DataFrame, w_p_alive: float = 0.60, w_recency: float = 0.25,
               w_frequency: float = 0.15) -> DataFrame:
    """Weighted churn score and its band.

    recency_ratio = R / P (NULL when P is missing or 0); recency_risk and
    frequency_risk are percent ranks over the whole table, from prefix sums over
    their distinct values (no single-task window, no sort of the customers).  A customer with one order
    has P = NULL, hence a NULL score, and lands in "Healthy".
    """
    ratio = F.when(F.col("P").isNull() | (F.col("P") == 0), F.lit(None)).otherwise(
        F.col("R").cast("double") / F.col("P"))
    x = df.withColumn("recency_ratio", ratio)
    x = percent_ranks(x, {"recency_ratio": "recency_risk", "F": "_f_rank"})
    score = (F.lit(w_p_alive) * F.col("p_alive_risk") + F.lit(w_recency) * F.col("recency_risk")
             + F.lit(w_frequency) * F.col("frequency_risk"))
    x = (x.withColumn("p_alive_risk", 1 - F.col("p_alive"))
         .withColumn("frequency_risk", 1 - F.col("_f_rank"))
         .drop("_f_rank")
         .withColumn("churn_score", score))
    seg = None
    act = None
    for lower, name, action in CHURN_BANDS:
        cond = F.col("churn_score") >= lower
        seg = F.when(cond, F.lit(name)) if seg is None else seg.when(cond, F.lit(name))
    seg = seg.otherwise(F.lit(HEALTHY[0]))
    x = x.withColumn("churn_segment", seg)
    for _, name, action in CHURN_BANDS + [(None, *HEALTHY)]:
        cond = F.col("churn_segment") == name
        act = F.when(cond, F.lit(action)) if act is None else act.when(cond, F.lit(action))
    return x.withColumn("churn_action", act.otherwise(F.lit(REVIEW_ACTION)))


def churn_segment_counts(scored: DataFrame) -> DataFrame:
    return scored.groupBy("churn_segment").agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), "churn_segment")


def score_summary(scored: DataFrame, col: str = "churn_score") -> DataFrame:
    """min, quartiles, median, mean, max and NA count of a score column."""
    q = exact_quantiles(scored, col, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    basic = scored.agg(
        F.min(col).alias("min"), F.avg(col).alias("mean"), F.max(col).alias("max"),
        F.count_if(F.col(col).isNull()).alias("na_count"))
    # both sides are single rows; zip them without a join
    return basic.select(
        "min", q.select("q1").scalar().alias("q1"), q.select("median").scalar().alias("median"),
        "mean", q.select("q3").scalar().alias("q3"), "max", "na_count")


# --- D5: churn base -------------------------------------------------------------------

def customer_churn_base(lrfmpv: DataFrame, txn: DataFrame, analysis_date=None,
                        churn_days: int = 180) -> DataFrame:
    """LRFMPV table plus recency from the last line of any status and a
    churn flag (recency > ``churn_days``)."""
    a = _date_col(analysis_date)
    if a is None:
        a = max_date(txn)
    rec = days_between(a, F.col("last_order"))
    return lrfmpv.withColumn("recency_days", rec).withColumn(
        "churn_flag", flag(F.col("recency_days") > churn_days))


# --- D6: dominant category ------------------------------------------------------------

def customer_category_dependency(txn: DataFrame) -> DataFrame:
    """Each customer's highest revenue-share category (first by name on ties).

    Aggregate to (customer, category) first; the share and the top-1 are
    windows over that small table (rows per customer = categories bought).
    """
    per = txn.groupBy("customer_id", "category").agg(sum0("net_revenue").alias("_rev"))
    by_cust = Window.partitionBy("customer_id")
    total = F.sum("_rev").over(by_cust)
    per = per.withColumn("category_revenue_share",
                         F.try_divide(F.col("_rev").cast("double"), total.cast("double")))
    order = Window.partitionBy("customer_id").orderBy(
        F.col("category_revenue_share").desc_nulls_last(), F.col("category").asc_nulls_last())
    top = per.withColumn("_rk", F.row_number().over(order)).filter(F.col("_rk") == 1)
    return top.select(
        "customer_id",
        F.col("category").alias("dominant_category"),
        F.col("_rev").cast("double").alias("category_revenue"),
        F.col("category_revenue_share").alias("dominant_category_share"))


# --- D7: category decline --------------------------------------------------------------

def category_decline(txn: DataFrame, analysis_date: _dt.date | str | None = None,
                     months: int = 3, threshold: float = 0.70) -> DataFrame:
    """Revenue per category in the last ``months`` vs the ``months`` before.

    The analysis date is resolved to a literal first, so the period filter is
    a constant range on the line date that Catalyst pushes towards the scan.
    A period with no rows gives 0 (pivot with fixed values).
    """
    a = analysis_date or collect_date(txn)
    a = F.lit(str(a)).cast("date")
    recent_from = F.add_months(a, -months)
    previous_from = F.add_months(a, -2 * months)
    d = F.col("transaction_date")
    window = txn.filter((d > previous_from) & d.isNotNull())
    is_recent = d > recent_from
    agg = window.groupBy("category").agg(
        sum0(F.when(is_recent, F.col("net_revenue"))).alias("_recent"),
        sum0(F.when(~is_recent, F.col("net_revenue"))).alias("_previous"),
        F.count(F.when(is_recent, 1)).alias("_n_recent"),
        F.count(F.when(~is_recent, 1)).alias("_n_previous"))
    recent = F.when(F.col("_n_recent") > 0, F.col("_recent")).otherwise(F.lit(0)).cast("double")
    previous = F.when(F.col("_n_previous") > 0, F.col("_previous")).otherwise(F.lit(0)).cast("double")
    out = agg.select("category", recent.alias("recent_3m"), previous.alias("previous_3m"))
    ratio = F.col("recent_3m") / F.greatest(F.col("previous_3m"), F.lit(1.0))
    return out.withColumn("category_decline_ratio", ratio).withColumn(
        "category_decline_flag", flag(F.col("category_decline_ratio") < threshold))


# --- D8/D9: dependency-failure signal ----------------------------------------------------

def dependency_failure_signal(churn_base: DataFrame, dependency: DataFrame,
                              decline: DataFrame, share_threshold: float = 0.60,
                              null_keys: bool = True) -> DataFrame:
    """``null_keys=False`` declares that customer_id is never NULL (plain
    equi-join, no re-shuffle of the customer tables)."""
    x = left_join_na(churn_base, dependency, ["customer_id"], null_safe=null_keys)
    # decline has one row per category, whose customers may be a third of all
    x = lookup(x, decline, "dominant_category", "category")
    x = x.withColumn("high_category_dependency",
                     flag(F.col("dominant_category_share") >= share_threshold))
    return x.withColumn("possible_dependency_failure", flag(
        (F.col("churn_flag") == 1) & (F.col("high_category_dependency") == 1)
        & (F.col("category_decline_flag") == 1)))


def signal_counts(signal: DataFrame, col: str) -> DataFrame:
    return signal.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def dependency_failure_customers(signal: DataFrame) -> DataFrame:
    return signal.filter(F.col("possible_dependency_failure") == 1).select(
        "customer_id", "dominant_category", "dominant_category_share", "recent_3m",
        "previous_3m", "category_decline_ratio", "churn_flag", "possible_dependency_failure")


# --- D10-D14: operational friction ------------------------------------------------------

def customer_recent_returns(txn: DataFrame, churn_base: DataFrame,
                            window_days: int = 180, null_keys: bool = True) -> DataFrame:
    """Quantity, returns and refunds in the ``window_days`` up to each
    customer's last approved order (both ends inclusive), lines of every status.

    Lines are pre-aggregated to (customer, day) before the join with the
    one-row-per-customer ``last_order``, so a hot customer is collapsed
    map-side instead of being shuffled line by line.
    """
    daily = txn.filter(F.col("transaction_date").isNotNull()).groupBy(
        "customer_id", "transaction_date").agg(
        F.sum("quantity").alias("_q"), F.sum("returned_qty").alias("_r"),
        F.sum("refund_amount").alias("_f"))
    last = churn_base.select("customer_id", "last_order").filter(F.col("last_order").isNotNull())
    j = left_join_na(daily, last, ["customer_id"], how="inner", null_safe=null_keys)
    j = j.filter((F.col("transaction_date") >= F.date_sub(F.col("last_order"), window_days))
                 & (F.col("transaction_date") <= F.col("last_order")))
    agg = j.groupBy("customer_id").agg(
        sum0("_q").cast("double").alias("recent_quantity"),
        sum0("_r").cast("double").alias("recent_returned_qty"),
        sum0("_f").cast("double").alias("recent_refund_amount"))
    return agg.withColumn("recent_return_ratio", F.col("recent_returned_qty")
                          / F.greatest(F.col("recent_quantity"), F.lit(1.0)))


# fixed values: reported quantiles of the recent return ratio
RETURN_RATIO_QUANTILES = {"p50": 0.50, "p75": 0.75, "p90": 0.90, "p95": 0.95, "p99": 0.99}


def return_ratio_distribution(recent: DataFrame) -> DataFrame:
    q = exact_quantiles(recent, "recent_return_ratio", RETURN_RATIO_QUANTILES)
    mx = recent.select(F.max("recent_return_ratio")).scalar()
    return q.select(*RETURN_RATIO_QUANTILES, mx.alias("max_return_ratio"))


def operational_friction_signal(churn_base: DataFrame, recent: DataFrame,
                                return_threshold: float = 0.25, null_keys: bool = True) -> DataFrame:
    x = left_join_na(churn_base, recent, ["customer_id"], null_safe=null_keys)
    x = x.withColumn("high_return_flag", flag(F.col("recent_return_ratio") >= return_threshold))
    return x.withColumn("possible_operational_friction", flag(
        (F.col("churn_flag") == 1) & (F.col("high_return_flag") == 1)))


def friction_top(signal: DataFrame, n: int = 25) -> DataFrame:
    """Top ``n`` flagged customers by recent return ratio (ties by customer)."""
    return (signal.filter(F.col("possible_operational_friction") == 1)
            .select("customer_id", "recent_quantity", "recent_returned_qty",
                    "recent_return_ratio", "churn_flag", "possible_operational_friction")
            .orderBy(F.col("recent_return_ratio").desc_nulls_last(),
                     F.col("customer_id").asc_nulls_last())
            .limit(n))


def churned_vs_active_returns(signal: DataFrame) -> DataFrame:
    """Mean and median recent return ratio and customer count per churn flag."""
    basic = signal.groupBy("churn_flag").agg(
        F.avg("recent_return_ratio").alias("avg_return_ratio"),
        F.count(F.lit(1)).alias("customer_count"))
    med = exact_quantiles(signal, "recent_return_ratio", {"median_return_ratio": 0.5},
                          group_cols=["churn_flag"])
    # churn_flag takes at most three values (0, 1, NULL): a proven broadcast bound
    return left_join_na(basic, F.broadcast(med), ["churn_flag"]).select(
        "churn_flag", "avg_return_ratio", "median_return_ratio", "customer_count")
