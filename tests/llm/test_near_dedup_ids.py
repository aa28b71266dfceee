"""near_dedup keeps documents whose ids are null or reused."""

import pytest

from clientele.llm import jaccard_join
from clientele.llm.common import prepare

WORDS = " ".join(f"w{i}" for i in range(40))
ROWS = [(None, "alpha beta gamma"), (None, "delta epsilon zeta"), (None, WORDS + " end"), (None, "alpha beta gamma"),
        (1, "one text under an id"), (1, "quite another text under it"), (1, "One text  under an ID"),
        (5, WORDS), (4, WORDS + " more"), (6, None), (7, ""), (7, " "), (8, "alone here"), (8, "alone here")]


@pytest.mark.parametrize("kind", ["long", "string"])
def test_null_and_reused_ids(spark, kind):
    prepare(spark)
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr(f"cast(doc_id as {kind}) doc_id", "text")
    got = jaccard_join.keep_one(docs)
    assert got.columns == ["doc_id", "text"]
    kept = sorted((r["doc_id"] and int(r["doc_id"]), r["text"]) for r in got.collect() if r["doc_id"] is not None)
    none = sorted(r["text"] for r in got.collect() if r["doc_id"] is None)
    assert none == ["alpha beta gamma", "delta epsilon zeta"]
    ones = [t for i, t in kept if i == 1]
    assert len(ones) == 2 and "quite another text under it" in ones
    assert (4, WORDS + " more") in kept and not any(t == WORDS for _, t in kept)
    assert [i for i, _ in kept] == [1, 1, 4, 6, 7, 8]


def test_no_repeated_id(spark):
    """The same rows stay whether or not some other id occurs twice."""
    prepare(spark)
    docs = spark.createDataFrame(ROWS[:3] + ROWS[4:5] + ROWS[7:9], "doc_id long, text string")
    once = {tuple(r) for r in jaccard_join.keep_one(docs).collect()}
    more = docs.unionByName(spark.createDataFrame([(99, "some words"), (99, "some words")], docs.schema))
    assert {tuple(r) for r in jaccard_join.keep_one(more).collect()} == once | {(99, "some words")}
