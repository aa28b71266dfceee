"""Segments: the 5x5 revenue/profit matrix and k-means behavioural clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions.ranking import ntile_global

# --- C14-C16: revenue x profit quintiles -----------------------------------------

# fixed values: (profit quintiles, revenue quintiles) -> segment; others are "Mass"
SEGMENT_RULES = [
    ((4, 5), (1, 2), "Profit Core"),
    ((4, 5), (3,), "Rising Stars"),
    ((4, 5), (4, 5), "MVC"),
]
DEFAULT_SEGMENT = "Mass"


def segment_of(revenue_q, profit_q):
    expr = None
    for profits, revenues, name in SEGMENT_RULES:
        cond = profit_q.isin(*profits) & revenue_q.isin(*revenues)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(DEFAULT_SEGMENT))


def customer_seg_5x5(base: DataFrame, buckets: int = 5) -> DataFrame:
    """Revenue and profit quintiles (ties broken by customer id, larger
    buckets first) and the matrix segment.  Both ntiles use the distributed
    global ranking — never a single-partition window."""
    x = ntile_global(base, buckets, ["total_revenue", F.col("customer_id").asc_nulls_last()],
                     "revenue_segment")
    x = ntile_global(x, buckets, ["total_profit", F.col("customer_id").asc_nulls_last()],
                     "profit_segment")
    return x.withColumn("segment", segment_of(F.col("revenue_segment"), F.col("profit_segment")))


def segment_summary(seg: DataFrame) -> DataFrame:
    return seg.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg("total_revenue").alias("avg_revenue"),
        F.avg("total_profit").alias("avg_profit"))


def segment_grid(seg: DataFrame, buckets: int = 5) -> DataFrame:
    """Customer count for every (revenue, profit) cell, 0 where empty.

    The grid is generated (buckets^2 rows, no cross join) and the observed
    counts — at most buckets^2 rows plus NULL cells — are joined onto it.
    """
    spark = seg.sparkSession
    counts = seg.groupBy("revenue_segment", "profit_segment").agg(F.count(F.lit(1)).alias("n"))
    grid = spark.range(buckets * buckets).select(
        (F.floor(F.col("id") / buckets) + 1).cast("int").alias("revenue_segment"),
        (F.col("id") % buckets + 1).cast("int").alias("profit_segment"))
    filled = grid.join(F.broadcast(counts), ["revenue_segment", "profit_segment"], "left").select(
        "revenue_segment", "profit_segment", F.coalesce(F.col("n"), F.lit(0)).alias("n"))
    stray = counts.filter(F.col("revenue_segment").isNull() | F.col("profit_segment").isNull())
    return filled.unionByName(stray)


# --- C8-C12: k-means behavioural segments -----------------------------------------------------

import numpy as np  # noqa: E402

from clientele.operators import kmeans  # noqa: E402
from clientele.session import cut_lineage  # noqa: E402

# fixed values: data-mart measures used as clustering inputs (plus cat_ratio_*)
KMEANS_INPUTS = [
    "F", "M", "profit", "R", "V", "avg_basket", "category_diversity", "brand_diversity",
    "weekend_ratio", "weekend_shopper", "return_ratio", "refund_ratio", "profit_margin",
    "top_category_ratio", "bargain_ratio", "premium_ratio",
]
CAT_RATIO_PREFIX = "cat_ratio_"
# fixed values: k sweep, restarts, iteration cap and seed of the analysis
ELBOW_KS = list(range(2, 9))
RESTARTS = 25
MAX_ITER = 100
SEED = 42


def kmeans_input_columns(dm: DataFrame) -> list[str]:
    return KMEANS_INPUTS + [c for c in dm.columns if c.startswith(CAT_RATIO_PREFIX)]


def _clean(c: str) -> Column:
    v = F.col(c).cast("double")
    inf = float("inf")
    return F.when(v.isNull() | F.isnan(v) | v.isin(inf, -inf), F.lit(0.0)).otherwise(v)


def scaled_columns(dm: DataFrame) -> dict[str, Column]:
    """The clustering inputs of a (materialised) mart, z-scored, as expressions.

    Missing and infinite values become 0; zero-variance columns are dropped;
    the rest are centred and divided by the sample standard deviation.  The
    means and deviations come from one global aggregate (a single row,
    2 numbers per column) and enter the projection as literals.
    """
    cols = kmeans_input_columns(dm)
    stats = dm.agg(*[F.avg(_clean(c)).alias(f"m_{c}") for c in cols],
                   *[F.stddev_samp(_clean(c)).alias(f"s_{c}") for c in cols]).first()
    keep = [c for c in cols if stats[f"s_{c}"] is not None and stats[f"s_{c}"] > 0
            and np.isfinite(stats[f"s_{c}"])]
    return {c: (_clean(c) - F.lit(float(stats[f"m_{c}"]))) / F.lit(float(stats[f"s_{c}"])) for c in keep}


def kmeans_features(dm: DataFrame) -> DataFrame:
    """customer_id plus z-scored clustering inputs (``scaled_columns``)."""
    # read twice (statistics, then the projection): materialise it once
    dm = cut_lineage(dm.select("customer_id", *kmeans_input_columns(dm)))
    return dm.select("customer_id", *[x.alias(c) for c, x in scaled_columns(dm).items()])


def _initial_centers(data: DataFrame, cols: list[str], ks: list[int], restarts: int,
                     seed: int) -> list[np.ndarray]:
    """Random distinct rows as starting centres, one set per (k, restart).

    The ``restarts * max(ks)`` distinct rows that come first in a seeded hash
    order (a distributed top-k) are the pool; fewer distinct rows than k is an
    error."""
    pool = np.array(data.select(*cols).distinct()
                    .orderBy(F.xxhash64(F.lit(seed), *cols), *cols)
                    .limit(restarts * max(ks)).collect(), dtype=float)
    if len(pool) < max(ks):
        raise ValueError(f"{max(ks)} clusters need as many distinct rows; there are {len(pool)}")
    rng = np.random.default_rng(seed)
    return [pool[rng.choice(len(pool), size=k, replace=False)] for k in ks for _ in range(restarts)]


def kmeans_multistart(features: DataFrame, ks: list[int], restarts: int = RESTARTS,
                      max_iter: int = MAX_ITER, seed: int = SEED):
    """k-means for every k in ``ks`` and ``restarts`` random starts, all
    advanced together (``operators/kmeans.py``): Lloyd's steps, then transfers.

    Returns ``{k: (best_centers, best_cost, per_restart_costs)}``.
    """
    cols = [c for c in features.columns if c != "customer_id"]
    starts = _initial_centers(features.select(*cols), cols, ks, restarts, seed)
    blocks = kmeans.packed(features, cols).persist()
    runs = kmeans.fit(blocks, starts, max_iter)
    blocks.unpersist()
    result = {}
    for i, k in enumerate(ks):
        group = runs[i * restarts:(i + 1) * restarts]
        best = min(group, key=lambda r: r.cost)
        result[k] = (best.centers, best.cost, [r.cost for r in group])
    return result


def kmeans_elbow(features: DataFrame, ks: list[int] = ELBOW_KS, restarts: int = RESTARTS,
                 seed: int = SEED) -> DataFrame:
    """k and the lowest total within-cluster sum of squares over the restarts."""
    fits = kmeans_multistart(features, ks, restarts, seed=seed)
    spark = features.sparkSession
    return spark.createDataFrame([(k, fits[k][1]) for k in ks], "k int, tot_withinss double")


def nearest_center(inputs: list[Column], centers: np.ndarray) -> Column:
    """1-based index of the nearest centre, as a native expression with the
    centres as literals."""
    dists = []
    for c in centers:
        d = None
        for x, v in zip(inputs, c):
            term = (x - F.lit(float(v))) ** 2
            d = term if d is None else d + term
        dists.append(d)
    arr = F.array(*dists)
    return F.array_position(arr, F.array_min(arr)).cast("int")


def assign_clusters(features: DataFrame, centers: np.ndarray) -> DataFrame:
    """customer_id, cluster of the z-scored inputs."""
    cols = [F.col(c) for c in features.columns if c != "customer_id"]
    return features.select("customer_id", nearest_center(cols, centers).alias("cluster"))


def customer_clusters(dm: DataFrame, k: int = 5, restarts: int = RESTARTS,
                      seed: int = SEED) -> DataFrame:
    """The data mart with its cluster: one materialisation, and no join."""
    dm = cut_lineage(dm)
    inputs = scaled_columns(dm)
    rows = dm.select("customer_id", *[x.alias(c) for c, x in inputs.items()])
    centers = kmeans_multistart(rows, [k], restarts, seed=seed)[k][0]
    return dm.withColumn("cluster", nearest_center(list(inputs.values()), centers))


def lloyd_clusters(dm: DataFrame, k: int = 5, steps: int = 5) -> DataFrame:
    """The data mart with its cluster after ``steps`` of Lloyd's steps that start
    from the k customers of the smallest ids, so the result is reproducible
    without a seed.  Fewer customers than k make fewer clusters; an empty mart
    has none."""
    dm = cut_lineage(dm)
    inputs = scaled_columns(dm)
    rows = dm.select("customer_id", *[x.alias(c) for c, x in inputs.items()])
    starts = [r[1:] for r in rows.orderBy(F.col("customer_id").asc_nulls_last()).limit(k).collect()]
    if not starts or not inputs:  # nothing tells rows apart
        return dm.withColumn("cluster", F.lit(1))
    blocks = kmeans.packed(rows, list(inputs)).persist()
    centers = kmeans.lloyd(blocks, np.array(starts, dtype=float), steps)
    blocks.unpersist()
    return dm.withColumn("cluster", nearest_center(list(inputs.values()), centers))


def kmeans_segments(features: DataFrame, k: int = 5, restarts: int = RESTARTS,
                    seed: int = SEED) -> DataFrame:
    centers = kmeans_multistart(features, [k], restarts, seed=seed)[k][0]
    return assign_clusters(features, centers)


def cluster_summary(x: DataFrame) -> DataFrame:
    """Size and mean profile per cluster of a mart with clusters, highest
    average M first."""
    # fixed values: the profile's measures
    means = [("avg_F", "F"), ("avg_M", "M"), ("avg_profit", "profit"), ("avg_R", "R"),
             ("avg_V", "V"), ("avg_basket", "avg_basket"), ("avg_weekend_ratio", "weekend_ratio"),
             ("avg_return_ratio", "return_ratio"), ("avg_refund_ratio", "refund_ratio"),
             ("avg_profit_margin", "profit_margin"),
             ("avg_top_category_ratio", "top_category_ratio"),
             ("avg_bargain_ratio", "bargain_ratio"), ("avg_premium_ratio", "premium_ratio")]
    cats = [c for c in x.columns if c.startswith(CAT_RATIO_PREFIX)]
    return (x.groupBy("cluster")
            .agg(F.count(F.lit(1)).alias("customers"), *[F.avg(src).alias(name) for name, src in means],
                 *[F.avg(c).alias(c) for c in cats])
            .orderBy(F.desc("avg_M")))


def cluster_ranked(summary: DataFrame) -> DataFrame:
    """Stable segment ranks (1 = highest average M); the summary has one row
    per cluster, so the ranking window is over k rows."""
    from pyspark.sql import Window
    return summary.withColumn("segment_rank", F.row_number().over(
        Window.orderBy(F.desc("avg_M"), "cluster"))).select(
        "segment_rank", "cluster", "customers", "avg_M", "avg_F", "avg_R", "avg_profit")
