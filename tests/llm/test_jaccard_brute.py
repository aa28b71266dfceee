"""The Jaccard join against all pairs of a small table: near copies, chains of
edits, and documents that mostly consist of passages which many share."""

import random

import pytest

from clientele.llm import jaccard_join
from clientele.llm.common import prepare


def _texts(seed: int) -> list[str | None]:
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(5000)}"
    passages = [[word() for _ in range(n)] for n in (12, 60, 150)]
    texts: list[str | None] = [None, "", " \t", "one", "one", "One two", "one two three four five"]
    for passage in passages:
        for _ in range(25):  # a passage with a share of own words around it
            own = [word() for _ in range(rng.randrange(0, 1 + len(passage) // 3))]
            cut = rng.randrange(len(own) + 1)
            texts.append(" ".join(own[:cut] + passage + own[cut:]))
    for _ in range(6):  # chains, in which neighbours link and ends may not
        words = [word() for _ in range(rng.randrange(30, 120))]
        for _ in range(8):
            texts.append(" ".join(words))
            words = list(words)
            words[rng.randrange(len(words))] = word()
    return texts + [" ".join(word() for _ in range(rng.randrange(1, 80))) for _ in range(40)]


def _shingles(text: str | None) -> set:
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").split() if w]
    if not words:
        return set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def _brute(sets: list[set]) -> list[int]:
    comp = list(range(len(sets)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                comp[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(sets))]


@pytest.mark.parametrize("seed, stars", [(1, 2), (2, 0), (3, 1)])
def test_components_equal_brute_force(spark, seed, stars):
    prepare(spark)
    texts = _texts(seed)
    sets = [_shingles(t) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.cluster(docs, stars=stars).collect()}
    assert got == {i: (len(sets[i]), c) for i, c in enumerate(_brute(sets))}


def test_pairs_stay_few_when_all_share_a_passage(spark):
    """Sets with too much of their own before the shared passage make no pair."""
    rows = [(token, key, 100, 20 + i, 900 + key if i == 0 else token - 1, key)
            for key in range(50) for i, token in enumerate(range(10))]
    live = spark.createDataFrame(rows, "token long, key long, n int, at int, prev long, comp long")
    assert jaccard_join.closing_pairs(live).count() == 0
    near = spark.createDataFrame([(t, k, n, at - 10, p, c) for t, k, n, at, p, c in rows], live.schema)
    assert jaccard_join.closing_pairs(near).count() == 50 * 49 // 2


def test_bucket_counts_bound_what_sets_share():
    import numpy as np
    from clientele.llm import jaccard_join
    rng = np.random.default_rng(6)
    dropped = 0
    for n in (1, 2, 3, 30, 400, 3000):
        for share in (0.0, 0.5, 0.85, 0.95, 1.0):
            both = rng.integers(0, 1 << 63, int(n * share), dtype=np.uint64)
            a = np.unique(np.concatenate([both, rng.integers(0, 1 << 63, n - len(both), dtype=np.uint64)]))
            b = np.unique(np.concatenate([both, rng.integers(0, 1 << 63, max(1, n // 9) if share == 1 else n - len(both), dtype=np.uint64)]))
            if not len(b):
                continue
            common = len(np.intersect1d(a, b))
            links = 100 * common >= 80 * (len(a) + len(b) - common)
            may = jaccard_join.may_link(jaccard_join.bucket_counts(a), jaccard_join.bucket_counts(b), 80)
            assert may or not links
            dropped += not may
    assert dropped >= 8
    many = np.arange(600, dtype=np.uint64) << np.uint64(20)  # all in one bucket: counts end at 255
    assert jaccard_join.may_link(jaccard_join.bucket_counts(many), jaccard_join.bucket_counts(many[:500]), 80)


def _crowd() -> list[str]:
    """Copies of a passage, each with one to five words replaced, without the passage itself."""
    rng = random.Random(11)
    passage = [f"p{i}" for i in range(150)]
    texts = []
    for _ in range(160):
        words = list(passage)
        for at in rng.sample(range(150), rng.choice((1, 2, 3, 3, 4, 5))):
            words[at] = f"w{rng.randrange(5000)}"
        texts.append(" ".join(words))
    return texts


def test_a_crowd_meets_in_few_pairs_and_loses_no_link(spark, monkeypatch):
    prepare(spark)
    texts = _crowd() + _texts(4)[:60]
    sets = [_shingles(t) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made, closing = [], jaccard_join.closing_pairs

    def counted(*args):
        pairs = closing(*args)
        made.append(pairs.count())
        return pairs

    monkeypatch.setattr(jaccard_join, "closing_pairs", counted)
    for stars in (0, jaccard_join.STARS):
        made.clear()
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.cluster(docs, stars=stars).collect()}
        assert got == {i: (len(sets[i]), c) for i, c in enumerate(_brute(sets))}
    assert sum(made) < 2 * len(texts)  # after the rounds of pivots; 160 copies have 12,720 pairs


def test_sketches_bound_what_sets_differ_in(spark):
    import numpy as np
    from pyspark.sql import functions as F
    rng = np.random.default_rng(3)
    rows = []
    for n in (1, 40, 150, 600):
        for edits in (0, 1, n // 20, n // 9, n // 4, n):
            both = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            a, b = (np.unique(np.concatenate([both[edits:], rng.integers(0, 1 << 63, edits, dtype=np.uint64)])) for _ in "ab")
            common = len(np.intersect1d(a, b))
            rows.append((len(a), len(b), jaccard_join.parities(a).tolist(), jaccard_join.parities(b).tolist(),
                         100 * common >= 80 * (len(a) + len(b) - common)))
    pairs = spark.createDataFrame(rows, "n_a int, n_b int, sketch_a array<long>, sketch_b array<long>, links boolean")
    got = pairs.groupBy("links").agg(F.min(jaccard_join._near(80)).alias("all"), F.max(jaccard_join._near(80)).alias("any"),
                                     F.sum((~jaccard_join._near(80)).cast("int")).alias("dropped")).collect()
    assert {r["links"]: r["all"] for r in got}[True]
    assert {r["links"]: r["dropped"] for r in got}[False] >= 6


def _exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_sets_stay_where_they_are_made_and_only_needed_ones_are_sent(spark):
    prepare(spark)
    texts = [f"a{i} b{i} c{i} d{i} e{i} f{i}" for i in range(200)]
    docs = spark.createDataFrame([(t,) for t in texts * 2], "text string").repartition(4)
    key = [jaccard_join.set_key(jaccard_join.shingles(t)) for t in texts]
    all_keys = spark.createDataFrame([(k,) for k in key], "key long")
    made = jaccard_join.sets_of(docs, all_keys)
    # the docs' own exchange, and no second one for the sets
    assert _exchanges(made) == _exchanges(docs.select("text"))
    assert {r["key"] for r in made.select("key").collect()} == set(key)
    values = made.selectExpr("key", "tokens as value")
    got = jaccard_join.among(values, all_keys.filter(all_keys.key.isin(key[:5]))).collect()
    assert len(got) == len({r["key"] for r in got}) < 20  # once each; the filter may let a few others through
    assert {r["key"]: bytes(r["value"]) for r in got if r["key"] in key[:5]} == \
        {k: jaccard_join.shingles(t).tobytes() for k, t in zip(key[:5], texts[:5])}


def test_the_token_before_is_found_among_what_met(spark):
    """Postings carry no token before; one that no other set holds is null and differs from all."""
    import numpy as np
    prepare(spark)
    none = jaccard_join.Orders(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    assert "prev" not in jaccard_join.postings(spark.createDataFrame([("a b",)], "text string"), none).columns
    rows = [(100 + at, 0, 1, 60, at) for at in (0, 1, 2, 5, 6)] + [(105, 0, 2, 60, 3)]
    met = spark.createDataFrame(rows, "token long, salt int, key long, n int, at int")
    got = {(r["key"], r["at"]): r["prev"] for r in jaccard_join.sharing(met).collect()}
    # set 2 shares one token, and sets of 60 need four
    assert got == {(1, 0): 100, (1, 1): 100, (1, 2): 101, (1, 5): None, (1, 6): 105}
    live = spark.createDataFrame([(105, 1, 60, 5, None, 1), (105, 2, 60, 3, None, 2), (105, 3, 60, 3, 7, 3), (105, 4, 60, 3, 7, 4)],
                                 "token long, key long, n int, at int, prev long, comp long")
    pairs = {(r["a"], r["b"]) for r in jaccard_join.closing_pairs(live).collect()}
    assert pairs == {(1, 2), (1, 3), (1, 4), (2, 3), (2, 4)}
