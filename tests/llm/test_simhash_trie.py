"""SimHash components against all pairs of a small table."""

import random

import numpy as np
import xxhash

from clientele.llm import simhash_trie
from clientele.llm.common import prepare


def _brute_fp(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ")
             .replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _brute(ids, fps):
    comp = list(range(len(fps)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = root(i), root(j)
                comp[max(a, b)] = min(a, b)
    least = {}
    for i, d in enumerate(ids):
        r = root(i)
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return [least.get(root(i)) for i in range(len(fps))]


def test_documents(spark):
    prepare(spark)
    rng = random.Random(3)
    word = lambda: rng.choice(["the", "Of", "and"]) + str(rng.randrange(400))
    texts = [None, "", " \t\n", "one", "One", "one two", "a b c", "a b c", "caf\u00e9 \u00c9t\u00e9 x", "w " * 20000 + "end"]
    for _ in range(12):  # chains of edits and copies
        words = [word() for _ in range(rng.randrange(40, 400))]
        for _ in range(8):
            texts.append(" ".join(words))
            words = list(words)
            words[rng.randrange(len(words))] = word()
    rows = [(i if i % 17 else None, t, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted((r["doc_id"] or -1, r["fingerprint"], r["component_id"] or -1) for r in simhash_trie.near_duplicates(docs).collect())
    fps = [_brute_fp(t) for t in texts]
    comp = _brute([r[0] for r in rows], fps)
    assert got == sorted((r[0] or -1, f"{f:016x}", -1 if c is None else c or -1) for r, f, c in zip(rows, fps, comp))
    assert simhash_trie.near_duplicates(docs.limit(0)).count() == 0


def test_trie_walk_equals_all_pairs(spark, monkeypatch):
    """Dense groups, walked in Spark first (limit 8) or in tasks only, in small pieces."""
    prepare(spark)
    monkeypatch.setattr(simhash_trie, "FRONTIER", 64)
    rng = random.Random(7)
    fps = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(60):
            x = centre
            for _ in range(rng.randrange(0, 5)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps = sorted(fps | {rng.getrandbits(64) for _ in range(100)} | {0, (1 << 64) - 1, 7, 1 << 63})
    nodes = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    want = _brute(fps, fps)
    for limit in (8, simhash_trie.LIMIT):
        from pyspark.sql import functions as F
        items = simhash_trie.node_pairs(nodes, limit).groupBy(*simhash_trie.PAIR).agg(
            F.collect_list(F.when(F.col("side") == 0, F.col("v"))).alias("left"),
            F.collect_list(F.when(F.col("side") == 1, F.col("v"))).alias("right"))
        if limit == 8:
            sizes = items.select((F.size("left") + F.size("right")).alias("n"), "depth").collect()
            assert max(r["n"] for r in sizes if r["depth"] < 64) <= 8 and max(r["depth"] for r in sizes) > 26
        index = {f: i for i, f in enumerate(fps)}
        comp = list(range(len(fps)))

        def root(i):
            while comp[i] != i:
                i = comp[i]
            return i

        for r in simhash_trie.trie_links(items).collect():
            a, b = (root(index[x & (1 << 64) - 1]) for x in (r["a"], r["b"]))
            comp[max(a, b)] = min(a, b)
        assert [fps[root(i)] for i in range(len(fps))] == want
