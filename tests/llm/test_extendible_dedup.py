"""The extendible-hash index against a plain grouping; its buckets decide."""

import hashlib
import random

from pyspark.sql import functions as F

from clientele.llm import extendible_dedup
from clientele.llm.common import prepare


def _rows(seed=2):
    rng = random.Random(seed)
    texts = [None, "", " \t\n", "a b", "ab", "a  b ", "é", "x" * 30000] + [f"text {i % 90} {'y' * (i % 7)}" for i in range(500)]
    rows = [(None if i % 37 == 5 else i // 2 if i % 11 == 0 else i, t, "n") for i, t in enumerate(texts)]
    rows += [rows[20]] * 4 + [(None, "a b", "n")] * 3 + [(1000 + i, rng.choice(["hot text", "hot  text"]), "n") for i in range(400)]
    rng.shuffle(rows)
    return rows


def _norm(t):
    return "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")


def _brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(_norm(r[1]), []).append(r)
    out = []
    for norm, rs in groups.items():
        best = min(rs, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [(r[0], best[0], len(rs), sha) for r in rs]
    return groups, sorted(out, key=str)


def test_rows_equal_a_plain_grouping(spark):
    prepare(spark)
    rows = _rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, h string")
    got = extendible_dedup.dedup(docs, capacity=8).collect()
    groups, want = _brute(rows)
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=str) == want
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in kept)
    assert len({r["bucket"] for r in got}) > 4
    assert extendible_dedup.dedup(docs.limit(0)).count() == 0
    one = extendible_dedup.keep_one(docs)
    assert one.columns == docs.columns
    best = sorted((min(rs, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0)) for rs in groups.values()), key=str)
    assert [(r[0], len(r[1] or "")) for r in sorted(map(tuple, one.collect()), key=str)] == [(r[0], len(r[1] or "")) for r in best]


def test_the_buckets_decide(spark):
    """A changed bucket changes the rows: nothing beside the index groups them."""
    prepare(spark)
    light = extendible_dedup.keyed(spark.createDataFrame(_rows(), "doc_id long, text string, h string"))
    index = extendible_dedup.build_index(light, capacity=8)
    sizes = [r[0] for r in index.groupBy("bucket").agg(F.count("*")).select("count(1)").collect()]
    assert max(sizes) <= 8
    some = index.select("bucket").first()[0]
    broken = index.withColumn("rows", F.when(F.col("bucket") == some, F.lit(77).cast("long")).otherwise(F.col("rows")))
    assert extendible_dedup.resolved(light, broken).filter("rows = 77").count() > 0
    lost = index.filter(F.col("bucket") != some)
    assert extendible_dedup.resolved(light, lost).count() < light.count()


def test_texts_of_one_key_are_chained(spark):
    prepare(spark)
    light = spark.createDataFrame([(i, 5, 7, bytes([i % 3]), i) for i in range(9)], "doc_id long, n long, h long, sha binary, row long")
    index = extendible_dedup.build_index(light, capacity=2)
    got = sorted((r["chain"], bytes(r["sha"]), r["rows"], r["keep"]["doc_id"]) for r in index.collect())
    assert got == [(1, b"\x00", 3, 0), (2, b"\x01", 3, 1), (3, b"\x02", 3, 2)]
