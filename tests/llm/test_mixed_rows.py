"""The mixed stage holds whole texts, in its shards' order."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from clientele.llm import mixing
from clientele.llm.common import prepare

ROWS = [(i, " ".join(f"w{i}x{j}" for j in range(5 + i * 7 % 40 + 900 * (i % 31 == 0))), "abc"[i % 3], i) for i in range(300)]
ROWS += [(None, "no id here", "a", 3), (None, "nor here", None, 3), (400, None, "b", 0), (7, *ROWS[7][1:])]


@pytest.fixture(scope="module")
def mixed(spark):
    prepare(spark)
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, source string, n_chars long")
    out = mixing.mixed_rows(docs)
    assert out.columns == docs.columns
    return docs, [tuple(r)[:4] for r in out.withColumn("at", F.monotonically_increasing_id()).orderBy("at").collect()]


def test_no_text_is_cut(mixed):
    drawn = Counter(mixed[1])
    assert set(drawn) <= set(ROWS)
    assert all(n <= 2 * ROWS.count(r) and n % ROWS.count(r) == 0 for r, n in drawn.items())


def test_words_come_near_the_targets(mixed):
    goal = {r["source"]: r["target"] for r in mixing.targets(mixing.sized(mixed[0], 1)).collect()}
    words: Counter = Counter()
    for _, text, source, _ in mixed[1]:
        words[source] += len(text.split())
    for source, target in goal.items():
        longest = max(len((r[1] or "").split()) * ROWS.count(r) for r in ROWS if r[2] == source)
        assert abs(words[source] - target) <= longest / 2 + 1


def test_shards_are_in_order(mixed):
    passes = {}
    for r in mixing.mix(mixed[0], whole=True).collect():
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        passes[r["key"]] = (r["doc_id"], r["source"], r["size"], [(p["shard"], p["order"]) for p in r["passes"]])
    want = sorted((at, d, s, n) for d, s, n, ps in passes.values() for at in ps)
    got = [(r[0], r[2], len(r[1].split())) for r in mixed[1]]
    assert [w[1:] for w in want for _ in range(2 if w[1] == 7 else 1)] == got
