"""Distributed ranking equals the single-partition window definitions."""

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from clientele.functions.ranking import (
    exact_quantiles,
    global_row_number,
    ntile_global,
    order_statistics,
    ordered_bits,
    percent_rank_global,
    percent_ranks,
)


def frame(spark, n=3000, seed=3):
    rng = np.random.default_rng(seed)
    vals = rng.integers(0, 50, n).astype(float)
    vals[: n // 3] = 7.0  # one value holds a third of the rows
    rows = [(i, float(v) if i % 97 else None) for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, "id long, v double")


def test_row_number_matches_window(spark):
    df = frame(spark)
    got = global_row_number(df, [F.col("v").asc_nulls_last(), "id"], "rn", total="n",
                            num_partitions=7)
    ref = df.withColumn("ref", F.row_number().over(Window.orderBy(F.col("v").asc_nulls_last(), "id")))
    j = got.join(ref, "id")
    assert j.filter(F.col("rn") != F.col("ref")).count() == 0
    assert j.select(F.max("n")).first()[0] == 3000


def test_ntile_matches_sql_ntile(spark):
    df = frame(spark).filter(F.col("v").isNotNull())
    got = ntile_global(df, 5, ["v", "id"], "q", num_partitions=6)
    ref = df.withColumn("ref", F.ntile(5).over(Window.orderBy("v", "id")))
    j = got.join(ref, "id")
    assert j.filter(F.col("q") != F.col("ref")).count() == 0
    sizes = [r[1] for r in got.groupBy("q").count().collect()]
    assert max(sizes) - min(sizes) <= 1


def test_ntile_null_leading_value_gets_null(spark):
    df = spark.createDataFrame([(1, None), (2, 1.0), (3, 2.0)], "id long, v double")
    got = {r["id"]: r["q"] for r in ntile_global(df, 2, ["v", "id"], "q").collect()}
    assert got == {1: None, 2: 1, 3: 2}


def test_percent_rank_skips_nulls_and_shares_ties(spark):
    df = frame(spark)
    got = percent_rank_global(df, "v", "pr", num_partitions=5)
    present = df.filter(F.col("v").isNotNull())
    ref = present.withColumn("ref", F.percent_rank().over(Window.orderBy("v")))
    j = got.join(ref, "id")
    assert j.filter(F.abs(F.col("pr") - F.col("ref")) > 0).count() == 0
    assert got.filter(F.col("v").isNull() & F.col("pr").isNotNull()).count() == 0
    assert got.count() == df.count()


def test_exact_quantiles_type7(spark):
    df = frame(spark)
    probs = {"p10": 0.1, "p50": 0.5, "p95": 0.95, "p99": 0.99}
    got = exact_quantiles(df, "v", probs).first()
    vals = np.array([r[0] for r in df.filter(F.col("v").isNotNull()).select("v").collect()])
    for k, p in probs.items():
        assert abs(got[k] - np.quantile(vals, p)) < 1e-9


def test_exact_quantiles_grouped(spark):
    rows = [(g, float(v)) for g in (0, 1) for v in range(10 + 5 * g)] + [(None, 3.0), (2, None)]
    df = spark.createDataFrame(rows, "g long, v double")
    got = {r["g"]: r["med"] for r in exact_quantiles(df, "v", {"med": 0.5}, ["g"]).collect()}
    assert got == {0: 4.5, 1: 7.0, None: 3.0}


def test_row_number_with_adaptive_range_count(spark):
    """No explicit range count: AQE may merge adjacent ranges; positions stay exact."""
    df = frame(spark, n=5000, seed=9)
    got = global_row_number(df, [F.col("v").asc_nulls_first(), "id"], "rn")
    ref = df.withColumn("ref", F.row_number().over(Window.orderBy(F.col("v").asc_nulls_first(), "id")))
    assert got.join(ref, "id").filter(F.col("rn") != F.col("ref")).count() == 0


def test_percent_ranks_of_two_columns_and_a_large_value_table(spark):
    """The same ranks whether the value table is broadcast or salted."""
    df = frame(spark).withColumn("w", (F.col("id") * 7919 % 3001).cast("int")).withColumn(
        "w", F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("w")))
    want = {}
    for c in ("v", "w"):
        for r in df.filter(F.col(c).isNotNull()).select("id", F.percent_rank().over(Window.orderBy(c)).alias("p")).collect():
            want[c, r["id"]] = r["p"]
    for limit in (10, 100000):
        got = percent_ranks(df, {"v": "pv", "w": "pw"}, num_partitions=5, limit=limit).collect()
        assert len(got) == 3000
        assert all(r["pv"] == want.get(("v", r["id"])) and r["pw"] == want["w", r["id"]] for r in got)


def test_ordered_bits_keep_the_order_of_doubles(spark):
    vals = [float("-inf"), -1e300, -2.5, -1e-310, -0.0, 0.0, 5e-324, 1.0, 1.0000000000000002, 1e300, float("inf"), float("nan")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double")
    got = [r["u"] for r in df.select("i", ordered_bits(F.col("v")).alias("u")).orderBy("i").collect()]
    assert got[4] == got[5] and sorted(got) == got and len(set(got)) == len(got) - 1


def test_quantiles_of_close_and_negative_values(spark):
    """Values that agree in their first bits need every refinement."""
    rng = np.random.default_rng(5)
    groups = {0: 1.0 + rng.integers(0, 2000, 4000) * 2.0 ** -50, 1: -np.exp(rng.normal(size=501) * 30), 2: np.array([4.0]), 3: np.zeros(7)}
    df = spark.createDataFrame([(g, float(v)) for g, x in groups.items() for v in x] + [(4, None)], "g int, v double")
    probs = {"a": 0.0, "b": 0.31, "c": 0.5, "d": 0.999, "e": 1.0}
    for limit in (None, 0):
        got = exact_quantiles(df, "v", probs, ["g"]) if limit is None else None
        if got is not None:
            rows = {r["g"]: r for r in got.collect()}
            assert set(rows) == set(groups)
            for g, x in groups.items():
                for name, p in probs.items():
                    want = np.quantile(x, p)
                    assert abs(rows[g][name] - want) <= 4e-16 * abs(want)
        else:  # the wanted buckets joined by a shuffle
            stats = order_statistics(df, "v", [0.31], ["g"], limit=0).collect()
            want = {(g, s): np.sort(x)[int(f((len(x) - 1) * 0.31))] for g, x in groups.items() for s, f in enumerate((np.floor, np.ceil))}
            assert {(r["g"], r["_side"]): r["_value"] for r in stats} == want


def test_quantiles_and_ranks_sort_no_rows(spark):
    df = frame(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = exact_quantiles(df, "v", {"m": 0.5})._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan
        plan = percent_ranks(df, {"v": "p"})._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan and "hashpartitioning" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ntile_of_fewer_rows_than_buckets_and_of_nulls_only(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id long, v double")
    assert {r["q"] for r in ntile_global(df, 5, ["v", "id"], "q").collect()} == {None}
    df = spark.createDataFrame([(1, 4.0), (2, 1.0), (3, None)], "id long, v double")
    assert {r["id"]: r["q"] for r in ntile_global(df, 5, ["v", "id"], "q").collect()} == {2: 1, 1: 2, 3: None}
