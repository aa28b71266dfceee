"""The query catalogue: name -> ``fn(spark, sf_dir) -> DataFrame``.

Each entry composes library operators over the transactions built from the
given tables (``lineitem``, ``orders``, ``part``), so its work grows with them.
Parameters are the analysis defaults unless the key says otherwise
(``*_wide`` keys use the second parameter set from FIXTURES.md, because the
default decline threshold flags no category on the uniform test data).
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.operators import churn, cohort, features, lifetime, segments
from clientele.session import cut_lineage, ensure_checkpoint_dir
from clientele.sources import sinks
from clientele.sources.transactions import transactions_from_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameter set used by the ``*_wide`` keys.
WIDE_DECLINE_THRESHOLD = 1.00
WIDE_SHARE_THRESHOLD = 0.30
WIDE_AUDIENCE = {"clv_quantile": 0.5, "max_p_alive": 0.999, "max_recency": 2000.0}


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


_STAGED: dict[tuple, tuple[str, bool, tuple]] = {}


def _source_stamp(spark: SparkSession, sf_dir: str) -> tuple:
    """Name, length and modification time of every file of the source tables, as
    the file system that Spark reads them from tells."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    stamp = []
    for t in ("lineitem", "orders", "part"):
        at = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{t}.parquet")
        fs = at.getFileSystem(conf)
        if fs.exists(at):
            files = fs.listFiles(at, True)
            while files.hasNext():
                f = files.next()
                stamp.append((str(f.getPath()), f.getLen(), f.getModificationTime()))
    return tuple(sorted(stamp))


def staged_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned transactions, built from the given tables once per session
    and written as Parquet into the session's checkpoint folder (the shared
    folder the cluster names).  Every query then reads only the columns it
    needs from that table instead of re-running the lineitem/orders/part
    joins; date filters become Parquet filters on the staged column."""
    return spark.read.parquet(_staged(spark, sf_dir)[0])


#: Bytes of the source files, and of a shuffle, that one task of the staging sorts.
SOURCE_BYTES, SHUFFLE_BYTES = 8 << 20, 16 << 20


@contextmanager
def _tasks_for(spark: SparkSession, length: int):
    """While staging, as many shuffle partitions as source files of ``length``
    bytes need, so that a task's sorts stay of one size; then what was set."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = [spark.conf.get(n, None) for n in names]  # None: Spark's own value
    try:
        spark.conf.set(names[0], str(max(int(spark.conf.get(names[0])), -(-length // SOURCE_BYTES))))
        spark.conf.set(names[1], str(SHUFFLE_BYTES))
        yield
    finally:
        for name, value in zip(names, before):
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _staged(spark: SparkSession, sf_dir: str) -> tuple[str, bool]:
    key = (spark.sparkContext.applicationId, sf_dir)
    stamp = _source_stamp(spark, sf_dir)
    if key not in _STAGED or _STAGED[key][2] != stamp:
        stale = _STAGED.pop(key, None)
        if stale:  # its sources have changed: nothing new reads it
            at = spark._jvm.org.apache.hadoop.fs.Path(stale[0])
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        base = ensure_checkpoint_dir(spark).rstrip("/")
        path = f"{base}/staged-transactions-{uuid.uuid4().hex}"
        with _tasks_for(spark, sum(length for _, length, _ in stamp)):
            sinks.stage_transactions(transactions_from_tables(spark, sf_dir), path)
        # IsNull is pushed to Parquet: row groups whose statistics show no
        # NULL are skipped, so this costs a footer read per file
        has_null = spark.read.parquet(path).filter(F.col("customer_id").isNull()).limit(1) \
            .count() > 0
        _STAGED[key] = (path, has_null, stamp)
    return _STAGED[key][:2]


def null_customer_keys(spark: SparkSession, sf_dir: str) -> bool:
    """Whether any staged line lacks a customer id (then customer joins must
    match NULL to NULL; otherwise plain equi-joins are exact)."""
    return _staged(spark, sf_dir)[1]


def txn(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    t = staged_transactions(spark, sf_dir)
    return t.select(*columns) if columns else t


# columns needed by the approved-only customer features
_LRFMPV_COLS = ["transaction_date", "transaction_id", "customer_id", "net_revenue",
                "order_status", "category"]


def _lrfmpv(spark, sf):
    return features.lrfmpv_base(txn(spark, sf, _LRFMPV_COLS))


# --- sources / features -------------------------------------------------------------

@query("txn_clean")
def q_txn_clean(spark, sf):
    # the adapter itself (not the staged copy), so the check covers the joins
    return transactions_from_tables(spark, sf)


@query("analysis_dates")
def q_analysis_dates(spark, sf):
    return features.analysis_dates(txn(spark, sf, ["transaction_date", "order_status"]))


@query("lrfmpv_base")
def q_lrfmpv_base(spark, sf):
    return _lrfmpv(spark, sf)


@query("lrfmpv_features")
def q_lrfmpv_features(spark, sf):
    return features.lrfmpv_features(_lrfmpv(spark, sf))


@query("category_group")
def q_category_group(spark, sf):
    t = features.with_category_group(txn(spark, sf, ["category"]))
    return t.groupBy("category", "category_group").agg(F.count(F.lit(1)).alias("lines"))


@query("customer_dm")
def q_customer_dm(spark, sf):
    return features.customer_dm(txn(spark, sf))


@query("category_ratio")
def q_category_ratio(spark, sf):
    return features.category_ratio(txn(spark, sf, ["customer_id", "category"]))


# --- cohorts ----------------------------------------------------------------------------

_COHORT_COLS = ["customer_id", "transaction_date", "order_status"]


def _retention(spark, sf):
    return cohort.cohort_retention(cohort.cohort_counts(txn(spark, sf, _COHORT_COLS)))


@query("cohort_assignment")
def q_cohort_assignment(spark, sf):
    return cohort.cohort_assignment(txn(spark, sf, _COHORT_COLS))


@query("cohort_counts")
def q_cohort_counts(spark, sf):
    return cohort.cohort_counts(txn(spark, sf, _COHORT_COLS))


@query("cohort_retention")
def q_cohort_retention(spark, sf):
    return _retention(spark, sf)


@query("cohort_matrix")
def q_cohort_matrix(spark, sf):
    return cohort.cohort_cells(_retention(spark, sf))


@query("cohort_matrix_pct")
def q_cohort_matrix_pct(spark, sf):
    return cohort.cohort_cells(_retention(spark, sf), "retention_pct")


# --- revenue / profit segments ---------------------------------------------------------

_BASE_COLS = ["customer_id", "transaction_id", "transaction_date", "net_revenue",
              "gross_profit", "quantity", "returned_qty"]


def _seg(spark, sf):
    return segments.customer_seg_5x5(features.customer_base(txn(spark, sf, _BASE_COLS)))


@query("customer_base")
def q_customer_base(spark, sf):
    return features.customer_base(txn(spark, sf, _BASE_COLS))


@query("customer_seg_5x5")
def q_customer_seg_5x5(spark, sf):
    return _seg(spark, sf)


@query("segment_summary")
def q_segment_summary(spark, sf):
    return segments.segment_summary(_seg(spark, sf)).select(
        "segment", "customers", F.round("avg_revenue", 6).alias("avg_revenue"),
        F.round("avg_profit", 6).alias("avg_profit"))


@query("segment_grid")
def q_segment_grid(spark, sf):
    return segments.segment_grid(_seg(spark, sf))


# --- churn root causes -------------------------------------------------------------------

def _churn_base(spark, sf):
    t = txn(spark, sf, _LRFMPV_COLS)
    return churn.customer_churn_base(features.lrfmpv_base(t), t)


def _dependency_signal(spark, sf, decline_threshold=0.70, share_threshold=0.60):
    t = txn(spark, sf, _LRFMPV_COLS)
    base = churn.customer_churn_base(features.lrfmpv_base(t), t)
    dep = churn.customer_category_dependency(t)
    dec = churn.category_decline(t, threshold=decline_threshold)
    return churn.dependency_failure_signal(base, dep, dec, share_threshold=share_threshold,
                                           null_keys=null_customer_keys(spark, sf))


def _wide_signal(spark, sf):
    return _dependency_signal(spark, sf, WIDE_DECLINE_THRESHOLD, WIDE_SHARE_THRESHOLD)


_FRICTION_COLS = ["customer_id", "transaction_id", "transaction_date", "net_revenue",
                  "order_status", "category", "quantity", "returned_qty", "refund_amount"]


def _recent_returns(spark, sf):
    t = txn(spark, sf, _FRICTION_COLS)
    base = churn.customer_churn_base(features.lrfmpv_base(t), t)
    return base, churn.customer_recent_returns(t, base,
                                               null_keys=null_customer_keys(spark, sf))


def _friction(spark, sf):
    base, recent = _recent_returns(spark, sf)
    return churn.operational_friction_signal(base, recent,
                                             null_keys=null_customer_keys(spark, sf))


@query("customer_churn_base")
def q_customer_churn_base(spark, sf):
    return _churn_base(spark, sf)


@query("customer_category_dependency")
def q_customer_category_dependency(spark, sf):
    return churn.customer_category_dependency(
        txn(spark, sf, ["customer_id", "category", "net_revenue"]))


@query("category_decline")
def q_category_decline(spark, sf):
    return churn.category_decline(txn(spark, sf, ["transaction_date", "category", "net_revenue"]))


@query("category_decline_wide")
def q_category_decline_wide(spark, sf):
    return churn.category_decline(txn(spark, sf, ["transaction_date", "category", "net_revenue"]),
                                  threshold=WIDE_DECLINE_THRESHOLD)


@query("dependency_failure_signal")
def q_dependency_failure_signal(spark, sf):
    return _dependency_signal(spark, sf)


@query("dependency_failure_counts")
def q_dependency_failure_counts(spark, sf):
    return churn.signal_counts(_dependency_signal(spark, sf), "possible_dependency_failure")


@query("dependency_failure_customers")
def q_dependency_failure_customers(spark, sf):
    return churn.dependency_failure_customers(_dependency_signal(spark, sf))


@query("dependency_failure_signal_wide")
def q_dependency_failure_signal_wide(spark, sf):
    return _wide_signal(spark, sf)


@query("dependency_failure_counts_wide")
def q_dependency_failure_counts_wide(spark, sf):
    return churn.signal_counts(_wide_signal(spark, sf), "possible_dependency_failure")


@query("dependency_failure_customers_wide")
def q_dependency_failure_customers_wide(spark, sf):
    return churn.dependency_failure_customers(_wide_signal(spark, sf))


@query("customer_recent_returns")
def q_customer_recent_returns(spark, sf):
    return _recent_returns(spark, sf)[1]


@query("return_ratio_distribution")
def q_return_ratio_distribution(spark, sf):
    d = churn.return_ratio_distribution(_recent_returns(spark, sf)[1])
    return d.select(*[F.round(c, 9).alias(c) for c in d.columns])


@query("operational_friction_signal")
def q_operational_friction_signal(spark, sf):
    return _friction(spark, sf)


@query("friction_counts")
def q_friction_counts(spark, sf):
    return churn.signal_counts(_friction(spark, sf), "possible_operational_friction")


@query("friction_top25")
def q_friction_top25(spark, sf):
    return churn.friction_top(_friction(spark, sf), 25)


@query("churned_vs_active_returns")
def q_churned_vs_active_returns(spark, sf):
    return churn.churned_vs_active_returns(_friction(spark, sf)).select(
        "churn_flag", F.round("avg_return_ratio", 6).alias("avg_return_ratio"),
        F.round("median_return_ratio", 9).alias("median_return_ratio"), "customer_count")


# --- lifetime value (BG/NBD + Gamma-Gamma) ------------------------------------------------
# Scores use the fixed published parameters so they are reproducible in SQL;
# the two *_fit keys estimate the parameters from the data (row-count check).

from clientele.operators import btyd  # noqa: E402


def _round(df: DataFrame, cols: list[str], digits: int = 9) -> DataFrame:
    """Round columns whose last bits depend on the engine's pow/summation
    order.  Money-scale values keep 4 decimals (9 decimals on a 1e5 value
    exceeds double precision)."""
    def r(c):
        return F.round(c, MONEY_DIGITS if c in MONEY_SCALE else digits).alias(c)
    return df.select(*[r(c) if c in cols else F.col(c) for c in df.columns])


MONEY_SCALE = {"clv_30d"}
MONEY_DIGITS = 4


def _clv_parts(spark, sf):
    lr = features.lrfmpv_base(txn(spark, sf, _LRFMPV_COLS))
    bg = btyd.bgnbd_score(btyd.bgnbd_inputs(lr), btyd.CDNOW_BGNBD)
    gg = btyd.gg_score(btyd.gg_inputs(lr), btyd.CDNOW_GAMMA_GAMMA)
    return lr, bg, gg


def _clv(spark, sf):
    lr = features.lrfmpv_base(txn(spark, sf, _LRFMPV_COLS))
    return lr, btyd.clv_from_lrfmpv(lr, btyd.CDNOW_BGNBD, btyd.CDNOW_GAMMA_GAMMA)


_CLV_ROUND = ["pred_30d", "p_alive", "clv_30d"]


@query("bgnbd_inputs")
def q_bgnbd_inputs(spark, sf):
    return btyd.bgnbd_inputs(_lrfmpv(spark, sf))


@query("bgnbd_score")
def q_bgnbd_score(spark, sf):
    return _round(_clv_parts(spark, sf)[1], ["pred_30d", "p_alive"])


@query("bgnbd_averages")
def q_bgnbd_averages(spark, sf):
    return _round(btyd.bgnbd_averages(_clv_parts(spark, sf)[1]), ["avg_pred", "avg_alive"])


@query("gg_inputs")
def q_gg_inputs(spark, sf):
    return btyd.gg_inputs(_lrfmpv(spark, sf))


@query("gg_score")
def q_gg_score(spark, sf):
    return _clv_parts(spark, sf)[2]


@query("clv_30d")
def q_clv_30d(spark, sf):
    return _round(_clv(spark, sf)[1], _CLV_ROUND)


@query("target_customers")
def q_target_customers(spark, sf):
    return _round(btyd.target_customers(_clv(spark, sf)[1]), _CLV_ROUND)


@query("target_customers_wide")
def q_target_customers_wide(spark, sf):
    """The audience by wider thresholds, which select customers here."""
    return _round(btyd.target_customers(_clv(spark, sf)[1], **WIDE_AUDIENCE), _CLV_ROUND)


@query("p_alive_summary")
def q_p_alive_summary(spark, sf):
    s = churn.score_summary(_clv(spark, sf)[1].select("p_alive"), "p_alive")
    return _round(s, ["min", "q1", "median", "mean", "q3", "max"])


@query("bgnbd_log_likelihood")
def q_bgnbd_log_likelihood(spark, sf):
    found = btyd.log_likelihood(btyd.bgnbd_inputs(_lrfmpv(spark, sf)), btyd.CDNOW_BGNBD)
    return found.withColumn("log_likelihood", F.round("log_likelihood", 4))


@query("gg_log_likelihood")
def q_gg_log_likelihood(spark, sf):
    found = btyd.log_likelihood(btyd.gg_inputs(_lrfmpv(spark, sf)), btyd.CDNOW_GAMMA_GAMMA)
    return found.withColumn("log_likelihood", F.round("log_likelihood", 4))


@query("fitted_scores")
def q_fitted_scores(spark, sf):
    """CLV and churn score of every customer by models fitted to them (on this
    uniform data the fit is degenerate and the audience empty)."""
    return lifetime.fit_to_audience(cut_lineage(_lrfmpv(spark, sf)))[1]


@query("clv_top10")
def q_clv_top10(spark, sf):
    return _round(btyd.clv_top(_clv(spark, sf)[1], 10), _CLV_ROUND)


@query("bgnbd_fit")
def q_bgnbd_fit(spark, sf):
    est, ll, it, ok = btyd.fit_bgnbd(btyd.bgnbd_inputs(_lrfmpv(spark, sf)))
    return btyd.fit_result_frame(spark, est, ll, it, ok)


@query("gg_fit")
def q_gg_fit(spark, sf):
    est, ll, it, ok = btyd.fit_gamma_gamma(btyd.gg_inputs(_lrfmpv(spark, sf)))
    return btyd.fit_result_frame(spark, est, ll, it, ok)


# --- churn risk score ----------------------------------------------------------------------

_CHURN_ROUND = _CLV_ROUND + ["p_alive_risk", "churn_score"]


def _churn_scored(spark, sf):
    lr = features.lrfmpv_base(txn(spark, sf, _LRFMPV_COLS))
    # churn input = CLV table + L, R, P, V: one projection of the same table
    clv = btyd.clv_from_lrfmpv(lr, btyd.CDNOW_BGNBD, btyd.CDNOW_GAMMA_GAMMA,
                               extra=("L", "R", "P", "V"))
    return churn.churn_risk(clv)


@query("churn_risk")
def q_churn_risk(spark, sf):
    return _round(_churn_scored(spark, sf), _CHURN_ROUND)


@query("churn_segment_counts")
def q_churn_segment_counts(spark, sf):
    return churn.churn_segment_counts(_churn_scored(spark, sf))


@query("score_summary")
def q_score_summary(spark, sf):
    s = churn.score_summary(_churn_scored(spark, sf))
    return _round(s, ["min", "q1", "median", "mean", "q3", "max"])


# --- baskets and association rules ---------------------------------------------------------

from clientele.operators import baskets  # noqa: E402

_BASKET_COLS = ["transaction_id", "order_status", "category"]


def _baskets(spark, sf):
    return baskets.basket_items(txn(spark, sf, _BASKET_COLS))


@query("basket_items")
def q_basket_items(spark, sf):
    return _baskets(spark, sf).select(
        "transaction_id", baskets.itemset_label(F.col("items")).alias("items"),
        F.size("items").cast("long").alias("n_items"))


@query("assoc_rules")
def q_assoc_rules(spark, sf):
    return baskets.association_rules(_baskets(spark, sf))


@query("assoc_rules_top20")
def q_assoc_rules_top20(spark, sf):
    return baskets.top_rules(baskets.association_rules(_baskets(spark, sf)), 20)


# --- k-means behavioural segments ------------------------------------------------------------

def _dm(spark, sf):
    return features.customer_dm(txn(spark, sf))


@query("kmeans_features")
def q_kmeans_features(spark, sf):
    """Clustering inputs in long form: customer_id, feature, z."""
    fe = segments.kmeans_features(_dm(spark, sf))
    cols = [c for c in fe.columns if c != "customer_id"]
    return fe.select("customer_id", F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.round(F.col(c), 6).alias("z")) for c in cols])).alias("f")
    ).select("customer_id", "f.feature", "f.z")


@query("customer_clusters")
def q_customer_clusters(spark, sf):
    """The customer data mart with its cluster."""
    return segments.customer_clusters(_dm(spark, sf), k=5)


@query("kmeans_lloyd_profile")
def q_kmeans_lloyd_profile(spark, sf):
    """Profile of the clusters after five steps from fixed starts."""
    x = segments.cluster_summary(segments.lloyd_clusters(_dm(spark, sf), k=5, steps=5))
    return x.select("cluster", "customers", *[F.round(c, 6).alias(c) for c in x.columns[2:]])


@query("kmeans_elbow")
def q_kmeans_elbow(spark, sf):
    return segments.kmeans_elbow(segments.kmeans_features(_dm(spark, sf)))


@query("kmeans_segments")
def q_kmeans_segments(spark, sf):
    return segments.kmeans_segments(segments.kmeans_features(_dm(spark, sf)), k=5)


def _cluster_summary(spark, sf):
    return segments.cluster_summary(segments.customer_clusters(_dm(spark, sf), k=5))


@query("cluster_summary")
def q_cluster_summary(spark, sf):
    return _cluster_summary(spark, sf)


@query("cluster_ranked")
def q_cluster_ranked(spark, sf):
    return segments.cluster_ranked(_cluster_summary(spark, sf))
