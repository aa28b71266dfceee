"""Nearest neighbours against brute force: recall, ties, equal and unusable vectors."""

import numpy as np
import pytest

from clientele.llm import hilbert_ann
from clientele.llm.common import prepare

SCHEMA = "vec_id long, embedding array<double>, id string, score int"


def _brute(rows, k, every):
    """Of every query row, (score, vec_id) of its nearest, best first."""
    ok = [(i, np.array(v, dtype=float)) for i, v in rows
          if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v) and len(v) == 12]
    out = []
    for n, (i, v) in enumerate(ok):
        if i % every == 0:
            near = sorted((-sum(x * y for x, y in zip(v, w)), j) for m, (j, w) in enumerate(ok) if m != n)[:k]
            out.append((i, [(j, -s) for s, j in near]))
    return sorted(out, key=lambda r: (r[0], r[1][:1]))


def _found(spark, rows, k, every=20):
    df = spark.createDataFrame([(i, v, "clash", 1) for i, v in rows], SCHEMA)
    return [tuple(r) for r in hilbert_ann.search(df, k=k, every=every).collect()]


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(25, 12))
    x = centres[rng.integers(0, 25, 900)] + 0.3 * rng.normal(size=(900, 12))
    return [(i, [float(c) for c in v]) for i, v in enumerate(x)]


def test_recall_and_scores(spark, vectors):
    prepare(spark)
    k = 10
    got = _found(spark, vectors, k)
    want = {i: near for i, near in _brute(vectors, k, 20)}
    by_query = {}
    for q, rank, j, score in got:
        by_query.setdefault(q, []).append((rank, j, score))
    assert set(by_query) == set(want)
    hit = 0
    lookup = dict(vectors)
    for q, near in by_query.items():
        near.sort()
        assert [r for r, _, _ in near] == list(range(1, k + 1))
        assert [(-s, j) for _, j, s in near] == sorted((-s, j) for _, j, s in near)
        for _, j, s in near:
            assert j != q and abs(s - sum(a * b for a, b in zip(lookup[q], lookup[j]))) < 1e-12
        hit += len({j for _, j, _ in near} & {j for j, _ in want[q]})
    assert hit >= 0.9 * k * len(want)


def test_ties_equal_repeated_and_unusable_vectors(spark):
    """A table small enough to be searched whole: every row must be right."""
    prepare(spark)
    rng = np.random.default_rng(9)
    e = [[float(i == j) for i in range(12)] for j in range(12)]
    rows = [(i, e[i % 12]) for i in range(60)]  # equal vectors and ties
    rows += [(100 + i, [float(round(c, 1)) for c in rng.normal(size=12)]) for i in range(41)]
    rows += [(20, e[3]), (20, e[8]), (120, [2.0] * 12)]  # repeated ids
    rows += [(200, None), (220, [0.0] * 12), (240, [1.0] * 11), (260, [float("nan")] + [1.0] * 11),
             (280, [float("inf")] + [1.0] * 11), (300, [None] + [1.0] * 11), (None, [1.0] * 12)]
    got = {}
    for q, rank, j, score in _found(spark, rows, 7):
        got.setdefault(q, []).append((rank, j, round(score, 9)))
    want = {}
    for q, near in _brute(rows, 7, 20):
        want.setdefault(q, []).extend((r, j, round(s, 9)) for r, (j, s) in enumerate(near, 1))
    assert {q: sorted(x) for q, x in got.items()} == {q: sorted(x) for q, x in want.items()}


def test_few_and_no_vectors(spark):
    prepare(spark)
    assert _found(spark, [], 20) == []
    assert _found(spark, [(0, None)], 20) == []
    two = _found(spark, [(0, [1.0] * 12), (1, [0.5] * 12), (40, [2.0] * 12)], 20)
    assert sorted(two) == [(0, 1, 40, 24.0), (0, 2, 1, 6.0), (40, 1, 0, 24.0), (40, 2, 1, 12.0)]


def test_crowded_blocks_are_dealt(spark, vectors, monkeypatch):
    prepare(spark)
    whole = _found(spark, vectors, 10)
    monkeypatch.setattr(hilbert_ann, "MOST_QUERIES", 3)
    assert sorted(_found(spark, vectors, 10)) == sorted(whole)


def test_clustered_vectors_need_a_small_share(spark):
    prepare(spark)
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(150, 24))
    x = (centres[rng.integers(0, 150, 6000)] + 0.2 * rng.normal(size=(6000, 24))) * rng.uniform(0.9, 1.1, (6000, 1))
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    report = {}
    got = hilbert_ann.search(df, k=20, every=50, report=report).collect()
    m = x.astype(np.float32).astype(float)
    hits = 0
    for q in range(0, 6000, 50):
        score = m @ m[q]
        score[q] = -np.inf
        hits += len({r["vec_id"] for r in got if r["query_id"] == q} & set(np.argsort(-score)[:20].tolist()))
    assert report["points"] == 6000 and report["share"] < 0.3
    assert hits >= 0.9 * 20 * 120
