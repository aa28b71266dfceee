"""Samples that reach the driver are bounded when many rows share a text."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clientele.llm import language_centroid, pii_boost
from clientele.llm.common import least_hashes, prepare

HOT = "the same text in very many rows, call +1 (555) 123-4567 or 10.0.0.1"


@pytest.fixture(scope="module")
def rows(spark):
    """4000 copies of a text and 300 others of each language."""
    prepare(spark)
    other = spark.range(600).select(F.format_string("text number %s of words", F.col("id").cast("string")).alias("text"),
                                    F.when(F.col("id") < 300, "en").otherwise("de").alias("lang"))
    return spark.range(4000).select(F.lit(HOT).alias("text"), F.lit("en").alias("lang")).unionByName(other).repartition(8)


def test_least_hashes_are_exact(spark):
    table = spark.range(5000).select(F.col("id").bitwiseAND(F.lit(1)).alias("g"), F.xxhash64("id").alias("h"))
    got = {(r["g"], r["h"]) for r in least_hashes(table, "g", 40).collect()}
    want = set()
    for g in (0, 1):
        of = [r["h"] for r in table.filter(F.col("g") == g).collect()]
        want |= {(g, h) for h in sorted(of, key=lambda h: (h % (1 << 64)) >> 11)[:40]}
    assert got == want


@pytest.mark.parametrize("seed", range(4))
def test_language_sample(rows, seed):
    got = language_centroid.sampled(rows, 200, seed).collect()
    by = {lang: [r["weight"] for r in got if r["lang"] == lang] for lang in ("en", "de")}
    assert len(by["en"]) == len(by["de"]) == 200 and set(by["de"]) == {1} and set(by["en"]) <= {1, 4000}


def test_every_text_below_the_bound(rows):
    got = language_centroid.sampled(rows, 400, 1).collect()
    assert sorted(r["weight"] for r in got) == [1] * 600 + [4000]
    model = language_centroid.fit(rows, 400)
    assert model.languages == ["de", "en"] and np.isfinite(model.centroids).all()


def test_candidates(rows):
    found = pii_boost.labelled(rows.select("text"), 1000, 17).collect()
    strict = [r for r in found if r["y"]]
    assert len(strict) == 2 and len(found) == len({(r["kind"], tuple(r["x"])) for r in found})
    long = rows.select(F.concat_ws(" ", *[F.format_string("+1 555 %s %s;", F.lit(100 + i), F.lit(4000 + i)) for i in range(200)]).alias("text")).limit(1)
    assert long.count() == 1
    most = pii_boost.labelled(long, 1000, 17, 50).groupBy("kind").count().collect()
    assert [tuple(r) for r in most] == [(3, 50)]
