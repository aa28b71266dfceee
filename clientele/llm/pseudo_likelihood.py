"""Masked pseudo-likelihood scores from a bidirectional window network.

Method.  Each word of a document is predicted from the two words on either
side; the sum of the log-probabilities is the document's pseudo-likelihood.
The network is trained here with numpy: one embedding table per position of
the window, a tanh layer, and an output factored into a class and a member of
it, so that a prediction costs two small softmaxes and still sums to one.

The most frequent words of all documents, counted in Spark, have network ids
of their own; other words share hashed ids.  The counts of all words are kept
in Spark, where they grow with the input: a word that shares its id is scored
as P(id | both sides) times the word's part of its id's count, by a join of
each document's distinct words with the counts.  One spare count of every id
stands for words that were not counted.  Training runs over every document exactly once:
documents are dealt into ``rounds`` parts by a hash, and in each round every
task trains its own copy from the round's weights on the rows it holds; the
copies are averaged by the words they saw (parallel SGD with averaging) and
start the next round.  Only the fixed-size weights reach the driver, as at
most 16 partial sums.

Defined cases: null or wordless text has 0 words, log-probability 0 and a null
mean; repeated rows are all reported and all train; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import counted, staged, sum_arrays, word_hashes

#: Words with an id of their own, hashed ids for all others, and output classes.
WORDS, HASHED, CLASSES = 896, 128, 32
VOCABULARY = WORDS + HASHED
MEMBERS = VOCABULARY // CLASSES
#: Id that stands outside the text.
EDGE = VOCABULARY
#: Words seen on each side, and width of the hidden layer.
SIDE, WIDTH = 2, 16
#: Words of one gradient step, and its first learning rate.
STEP, RATE = 4096, 1.0
ROUNDS = 2
#: Words a task counts before it hands partial counts on.
HELD = 1 << 22

SHAPES = {"e": (2 * SIDE, VOCABULARY + 1, WIDTH), "b": (WIDTH,), "wc": (WIDTH, CLASSES), "bc": (CLASSES,),
          "wm": (WIDTH, MEMBERS), "bm": (CLASSES, MEMBERS)}


def unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[name] = flat[at:at + n].reshape(shape).astype(np.float32)
        at += n
    return out


def flatten(w: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in SHAPES]).astype(np.float64)


def first_weights(seed: int = 5) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return np.concatenate([(rng.normal(0, 0.1, int(np.prod(s))) if k in ("e", "wc", "wm") else np.zeros(int(np.prod(s))))
                           for k, s in SHAPES.items()])


def word_counts(docs: DataFrame) -> DataFrame:
    """word (its hash), n over all documents; tasks hand on partial counts."""
    def local(batches: Iterator) -> Iterator:
        import pyarrow as pa
        held: list[np.ndarray] = []

        def flush():
            words, n = counted(np.concatenate(held))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))], ["word", "n"])

        for batch in batches:
            held += [word_hashes(t) for t in batch.column(0).to_pylist()]
            if sum(map(len, held)) > HELD:
                yield flush()
        if held:
            yield flush()

    return docs.select("text").mapInArrow(local, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Coder:
    """Word ids: a vocabulary word's place, else a hashed id shared by others."""

    def __init__(self, vocabulary: np.ndarray) -> None:
        self.order = np.argsort(vocabulary)
        self.words = vocabulary[self.order]

    def ids_of(self, h: np.ndarray) -> np.ndarray:
        """Ids of words given by their hashes."""
        out = np.uint64(WORDS) + h % np.uint64(HASHED)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
            out = np.where(self.words[at] == h, self.order[at], out)
        return out.astype(np.uint16)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each between ``SIDE`` edges on either side, and
        where each text's first word is."""
        return self.joined([self.ids_of(word_hashes(t)) for t in texts])

    def joined(self, rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """``encode`` of texts whose ids are known."""
        lengths = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
        ids = np.full(int(lengths.sum()) + 2 * SIDE * len(rows), EDGE, dtype=np.uint16)
        begin = np.cumsum(lengths + 2 * SIDE) - lengths - SIDE
        for b, r in zip(begin, rows):
            ids[b:b + len(r)] = r
        return ids, begin


OFFSETS = [o for o in range(-SIDE, SIDE + 1) if o]


def _softmax(z: np.ndarray) -> np.ndarray:
    """Over the first axis, in place.  The hidden layer is within -1..1, so
    logits stay small; the bound only guards against overflow."""
    np.exp(np.minimum(z, 60, out=z), out=z)
    z /= z.sum(axis=0)
    return z


def forward(w: dict, ids: np.ndarray, a: int, b: int):
    """For places a..b-1 of ``ids`` (SIDE <= a, b <= len - SIDE): the hidden
    layer, both softmaxes (class x place, member x place), and each word's
    class and member (edges: 0)."""
    z = w["e"][0].take(ids[a + OFFSETS[0]:b + OFFSETS[0]], axis=0)
    for k, o in enumerate(OFFSETS[1:], 1):
        z += w["e"][k].take(ids[a + o:b + o], axis=0)
    z += w["b"]
    h = np.tanh(z, out=z)
    own = ids[a:b]
    c, m = np.divmod(np.where(own == EDGE, 0, own).astype(np.intp), MEMBERS)
    pc = _softmax(w["wc"].T @ h.T + w["bc"][:, None])
    pm = _softmax(w["wm"].T @ h.T + w["bm"].T.take(c, axis=1))
    return h, pc, pm, c, m


def log_probs(w: dict, ids: np.ndarray) -> np.ndarray:
    """log P(word | both sides) at every place; 0 at edges."""
    out = np.zeros(len(ids))
    for a in range(SIDE, len(ids) - SIDE, STEP):
        b = min(a + STEP, len(ids) - SIDE)
        _, pc, pm, c, m = forward(w, ids, a, b)
        cols = np.arange(b - a)
        p = np.log(np.maximum(pc[c, cols] * pm[m, cols], 1e-30))
        out[a:b] = np.where(ids[a:b] == EDGE, 0.0, p)
    return out


def train_step(w: dict, ids: np.ndarray, a: int, b: int, rate: float) -> None:
    """One gradient step on the words at places a..b-1."""
    h, gc, gm, c, m = forward(w, ids, a, b)
    cols = np.arange(b - a)
    gc[c, cols] -= 1
    gm[m, cols] -= 1
    edge = ids[a:b] == EDGE
    gc[:, edge] = 0
    gm[:, edge] = 0
    scale = np.float32(rate / (b - a))
    gh = ((w["wc"] @ gc + w["wm"] @ gm).T) * (1 - h * h)
    w["wc"] -= scale * (gc @ h).T
    w["bc"] -= scale * gc.sum(axis=1)
    w["wm"] -= scale * (gm @ h).T
    by_class = np.argsort(c.astype(np.uint16), kind="stable")
    first = np.flatnonzero(np.diff(c[by_class], prepend=-1))
    w["bm"][c[by_class[first]]] -= scale * np.add.reduceat(gm.take(by_class, axis=1), first, axis=1).T
    w["b"] -= scale * gh.sum(axis=0)
    # An embedding sees few words of a step: its rate is not divided as far.
    # One order of the block serves all offsets: the word at place p is the
    # context of place p - o.
    push = np.zeros((b - a + 4 * SIDE, WIDTH), dtype=np.float32)
    push[2 * SIDE:2 * SIDE + b - a] = np.float32(rate / np.sqrt(8 * (b - a))) * gh
    block = ids[a - SIDE:b + SIDE]
    order = np.argsort(block, kind="stable")
    ranked = block[order]
    first = np.flatnonzero(np.diff(ranked.astype(np.int32), prepend=-1))
    word = ranked[first]
    for k, o in enumerate(OFFSETS):
        w["e"][k][word] -= np.add.reduceat(push.take(order + (SIDE - o), axis=0), first, axis=0)


def vocabulary(counts: DataFrame) -> np.ndarray:
    top = counts.orderBy(F.col("n").desc(), "word").limit(WORDS).collect()
    return np.array([r[0] for r in top], dtype=np.int64).view(np.uint64)


def _shared_id(word: Column) -> Column:
    """Which of the shared ids a word has (its hash modulo HASHED, a power of 2)."""
    return word.bitwiseAND(F.lit(HASHED - 1))


def shares(counts: DataFrame, words: np.ndarray) -> tuple[DataFrame, list[float]]:
    """word, share: log P(word | its shared id) of every counted word without
    an id of its own; and, of each shared id, that of a word never counted."""
    own = counts.sparkSession.createDataFrame([(int(w),) for w in words.view(np.int64)], "word long")
    rare = counts.join(F.broadcast(own), "word", "left_anti")  # at most WORDS words
    total = [0] * HASHED
    for at, n in rare.groupBy(_shared_id(F.col("word"))).agg(F.sum("n")).collect():  # at most HASHED rows
        total[at] = n
    unseen = [float(-np.log(n + 1)) for n in total]
    of_id = F.element_at(F.array(*[F.lit(x) for x in unseen]), (_shared_id(F.col("word")) + 1).cast("int"))
    return rare.select("word", (F.log(F.col("n").cast("double")) + of_id).alias("share")), unseen


def train(docs: DataFrame, words: np.ndarray, rounds: int = ROUNDS, rate: float = RATE) -> np.ndarray:
    """Weights after one pass over all documents in ``rounds`` averaged parts."""
    sc = docs.sparkSession.sparkContext
    flat = first_weights()
    part = F.pmod(F.xxhash64("text"), F.lit(rounds))
    for r in range(rounds):
        shared = sc.broadcast((flat, words))  # fixed size: weights and WORDS words

        def local(batches: Iterator, shared=shared) -> Iterator:
            import pyarrow as pa
            start, vocab = shared.value
            w, coder, seen = unpack(start), Coder(vocab), 0
            for batch in batches:
                ids, _ = coder.encode(batch.column(0).to_pylist())
                for a in range(SIDE, len(ids) - SIDE, STEP):
                    b = min(a + STEP, len(ids) - SIDE)
                    train_step(w, ids, a, b, rate / np.sqrt(1 + seen / 1e6))
                    seen += b - a
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([(flatten(w) * seen).tolist()], pa.list_(pa.float64())),
                                                  pa.array([float(seen)], pa.float64())], ["vec", "weight"])

        rows = docs.filter(part == r).select("text")
        sums = sum_arrays(rows.mapInArrow(local, "vec array<double>, weight double")).collect()
        weight = sum(s[1] for s in sums)
        if weight:
            flat = np.sum([np.asarray(s[0]) for s in sums], axis=0) / weight
    return flat


def score(docs: DataFrame, counts: DataFrame, words: np.ndarray, weights: np.ndarray) -> DataFrame:
    """doc_id, n_words, log_prob, mean_log_prob; ``counts`` as ``word_counts``."""
    share, unseen = shares(counts, words)
    shared = docs.sparkSession.sparkContext.broadcast((weights, words))

    def local(batches: Iterator) -> Iterator:
        import pyarrow as pa
        flat, vocab = shared.value
        w, coder = unpack(flat), Coder(vocab)
        for batch in batches:
            hashes = [word_hashes(t) for t in batch.column(1).to_pylist()]
            rows = [coder.ids_of(h) for h in hashes]
            ids, begin = coder.joined(rows)
            if len(begin):
                size = np.diff(np.append(begin, len(ids) + SIDE)) - 2 * SIDE
                total = np.add.reduceat(log_probs(w, ids), begin - SIDE)
            else:
                size, total = np.zeros(0, dtype=np.int64), np.zeros(0)
            rare = [counted(h[r >= WORDS]) for h, r in zip(hashes, rows)]
            ends = np.cumsum([0, *[len(r[0]) for r in rare]]).astype(np.int32)
            word = np.concatenate([np.empty(0, np.uint64), *[r[0] for r in rare]]).view(np.int64)
            times = np.concatenate([np.empty(0, np.int64), *[r[1] for r in rare]]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(total, pa.float64()),
                 pa.ListArray.from_arrays(ends, pa.array(word)), pa.ListArray.from_arrays(ends, pa.array(times))],
                ["doc_id", "n_words", "net", "words", "times"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    # Written once, so that a row's number stays; repeated rows have their own.
    scored = staged(docs.select("doc_id", "text").mapInArrow(
        local, f"doc_id {kind}, n_words long, net double, words array<bigint>, times array<int>")
        .withColumn("row", F.monotonically_increasing_id()))
    rare = (scored.select("row", F.explode(F.arrays_zip("words", "times")).alias("w"))
            .select("row", F.col("w.words").alias("word"), F.col("w.times").alias("times")))
    none = F.element_at(F.array(*[F.lit(x) for x in unseen]), (_shared_id(F.col("word")) + 1).cast("int"))
    inside = (rare.join(share, "word", "left")
              .groupBy("row").agg(F.sum(F.col("times") * F.coalesce("share", none)).alias("inside")))
    total = F.col("net") + F.coalesce("inside", F.lit(0.0))
    return (scored.select("row", "doc_id", "n_words", "net").join(inside, "row", "left")
            .select("doc_id", "n_words", total.alias("log_prob"),
                    F.when(F.col("n_words") > 0, total / F.col("n_words")).alias("mean_log_prob")))


def score_documents(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Count all words, train, and score every document."""
    counts = staged(word_counts(docs))
    words = vocabulary(counts)
    return score(docs, counts, words, train(docs, words, rounds))
