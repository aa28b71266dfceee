"""Words without an id of their own are scored as words, not as their bucket."""

import math

import numpy as np
import pytest

from clientele.llm import pseudo_likelihood as pl
from clientele.llm.common import prepare, staged, word_hashes


@pytest.fixture(scope="module")
def scored(spark):
    prepare(spark)
    common = " ".join(f"c{i}" for i in range(pl.WORDS))
    rare = [f"r{i}" for i in range(400)]
    rows = [(i, common) for i in range(3)] + [(None, " ".join(rare)), (11, "r1 r1 c5"), (11, "r1 r1 c5"), (12, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts = staged(pl.word_counts(docs))
    words, weights = pl.vocabulary(counts), pl.first_weights()
    return docs, counts, words, weights, rows


def twin(rows, texts, weights, words):
    """log_prob of each text by plain Python; words counted over ``rows``."""
    count: dict = {}
    for _, t in rows:
        for h in word_hashes(t).tolist():
            count[h] = count.get(h, 0) + 1
    own = set(words.tolist())
    total = [0] * pl.HASHED
    for h, n in count.items():
        if h not in own:
            total[h % pl.HASHED] += n
    coder, out = pl.Coder(words), []
    for t in texts:
        ids, _ = coder.encode([t])
        p = float(pl.log_probs(pl.unpack(weights), ids).sum())
        p += sum(math.log(count.get(h, 1) / (total[h % pl.HASHED] + 1)) for h in word_hashes(t).tolist() if h not in own)
        out.append(p)
    return out


def test_every_word_is_scored_inside_its_id(scored):
    docs, counts, words, weights, rows = scored
    got = sorted((r["n_words"], r["log_prob"]) for r in pl.score(docs, counts, words, weights).collect())
    want = sorted((len(word_hashes(t)), p) for (_, t), p in zip(rows, twin(rows, [t for _, t in rows], weights, words)))
    assert [g[0] for g in got] == [w[0] for w in want]
    assert np.allclose([g[1] for g in got], [w[1] for w in want], rtol=1e-5)


def test_words_never_counted(spark, scored):
    _, counts, words, weights, rows = scored
    new = spark.createDataFrame([(1, "never seen r1 c1")], "doc_id long, text string")
    row = pl.score(new, counts, words, weights).first()
    assert math.isclose(row["log_prob"], twin(rows, ["never seen r1 c1"], weights, words)[0], rel_tol=1e-5)


def test_word_shares_sum_to_one(scored):
    _, counts, words, _, rows = scored
    share, unseen = pl.shares(counts, words)
    by_id = [math.exp(u) for u in unseen]
    for r in share.collect():
        by_id[r["word"] % pl.HASHED] += math.exp(r["share"])
    assert share.count() == counts.count() - pl.WORDS and np.allclose(by_id, 1)
