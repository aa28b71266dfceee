"""Language identification by nearest centroid.

Method.  A text becomes a TF-IDF vector of hashed character n-grams (pairs and
triples of letters, with word edges), normalised to length one.  Each
language's training vectors are clustered (spherical k-means) into several
centroids; a text takes the language of the centroid with the largest cosine.
Per length class, a text whose cosine lies under a part of what the training
texts of that class reach is rejected.

Document frequencies cover every training row.  Centroids are fitted on at
most ``sample_per_language`` different texts of each language, those of the
least hashes, each weighted by its rows; that bound is a parameter.  Vectors are made in Arrow batches, so a
task holds one batch of texts.

Defined cases: null text, or text without a letter, is ``und`` with score 0
and rejected; ties go to the language first in order; without training rows
every text is ``und``; an empty table gives an empty result; repeated rows are
all reported; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import least_hashes, staged, sum_arrays

#: Buckets that character n-grams are hashed into.
BUCKETS = 4096
#: Centroids of a language, and different texts of it that fit them.
CENTROIDS, SAMPLE = 6, 500
#: A text is rejected under this part of its length class's 1 % quantile.
REJECT_PART = 0.5

UNKNOWN = "und"
_LETTERS: dict = {}
#: Texts whose dense vectors a task holds at once.
SLICE = 256


def held_out(doc_id: Column) -> Column:
    """Whether the document is kept out of training: crc32 mod 3 is 1."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1


def _is_letter() -> np.ndarray:
    if "table" not in _LETTERS:
        _LETTERS["table"] = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    return _LETTERS["table"]


def counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """n-gram counts (texts x BUCKETS, float32) and whether a letter is there."""
    codes = [np.frombuffer((" " + (t or "").lower() + " ").encode("utf-32-le", "replace"), dtype=np.uint32) for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(c) for c in codes])
    flat = np.concatenate(codes).astype(np.int64) if codes else np.empty(0, np.int64)
    letter = _is_letter()[flat]
    flat = np.where(letter, flat, 32)
    # one space between words: drop a space that follows a space of the same text
    keep = np.ones(len(flat), dtype=bool)
    keep[1:] = letter[1:] | letter[:-1] | (owner[1:] != owner[:-1])
    flat, owner = flat[keep], owner[keep]
    out = np.zeros(len(texts) * BUCKETS, dtype=np.float32)
    mask = BUCKETS - 1
    for n in (2, 3):
        if len(flat) < n:
            continue
        key = np.zeros(len(flat) - n + 1, dtype=np.uint64)
        for k in range(n):
            key = key * np.uint64(0x9E3779B1) + flat[k:len(flat) - n + 1 + k].astype(np.uint64)
        key = (key * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(40)
        same = owner[:len(key)] == owner[n - 1:]
        at = owner[:len(key)] * BUCKETS + (key & np.uint64(mask)).astype(np.int64)
        out += np.bincount(at[same], minlength=len(out)).astype(np.float32)
    has = np.zeros(len(texts), dtype=bool)
    has[owner[flat != 32]] = True
    return out.reshape(len(texts), BUCKETS), has


def sliced(batches: Iterator) -> Iterator:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def unit_rows(m: np.ndarray) -> np.ndarray:
    norm = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return m / np.where(norm > 0, norm, 1)


@dataclass
class Model:
    """idf, centroids and their languages, and the least cosine per length class."""

    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    least: dict[int, float] = field(default_factory=dict)

    def vectors(self, found: np.ndarray) -> np.ndarray:
        return unit_rows(np.log1p(found) * self.idf)

    def similarities(self, vectors: np.ndarray) -> np.ndarray:
        """Best cosine of each language: texts x languages."""
        cos = vectors @ self.centroids.T
        return np.stack([cos[:, self.owner == k].max(axis=1) for k in range(len(self.languages))], axis=1)

    def threshold(self, sizes: np.ndarray) -> np.ndarray:
        known = sorted(self.least)
        if not known:
            return np.zeros(len(sizes))
        classes = np.floor(np.log2(np.maximum(sizes, 1))).astype(int)
        near = [min(known, key=lambda k, c=c: abs(k - c)) for c in classes]
        return np.array([self.least[k] for k in near])


def _cluster(x: np.ndarray, weight: np.ndarray, k: int, rng: np.random.Generator, steps: int = 15) -> np.ndarray:
    """Spherical k-means of weighted rows; starts from distinct random rows."""
    centres = x[rng.permutation(len(x))[:k]].copy()
    heavy = x * weight[:, None]
    for _ in range(steps):
        near = (x @ centres.T).argmax(axis=1)
        new = unit_rows(np.stack([heavy[near == j].sum(axis=0) if (near == j).any() else centres[j]
                                  for j in range(len(centres))]))
        if np.allclose(new, centres, atol=1e-5):
            break
        centres = new
    return centres


def document_frequencies(train: DataFrame) -> tuple[np.ndarray, float]:
    """How many training texts hold each bucket, and how many texts there are."""
    def local(batches: Iterator) -> Iterator:
        import pyarrow as pa
        total, rows = np.zeros(BUCKETS), 0
        for batch in sliced(batches):
            found, has = counts(batch.column(0).to_pylist())
            total += (found[has] > 0).sum(axis=0)
            rows += int(has.sum())
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64())),
                                          pa.array([float(rows)], pa.float64())], ["vec", "weight"])

    parts = sum_arrays(train.select("text").mapInArrow(local, "vec array<double>, weight double")).collect()
    if not parts:
        return np.zeros(BUCKETS), 0.0
    return np.sum([np.asarray(r[0]) for r in parts], axis=0), float(sum(r[1] for r in parts))


def sampled(train: DataFrame, n: int, seed: int) -> DataFrame:
    """lang, h, weight, ix, val: at most ``n`` different texts of each language,
    their rows, and their n-gram counts; texts without a letter have none."""
    hashed = train.select("text", "lang", F.xxhash64(F.lit(seed), "text").alias("h"))
    texts = staged(hashed.groupBy("lang", "h").agg(F.count("*").alias("weight")))
    drawn = hashed.join(F.broadcast(staged(least_hashes(texts, "lang", n))), ["lang", "h"])  # n a language

    def sparse(batches: Iterator) -> Iterator:
        import pyarrow as pa
        done: set = set()  # a task makes each text's counts once
        for batch in sliced(batches):
            rows = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[1:3] not in done:
                    done.add(row[1:3])
                    rows.append(row)
            found, has = counts([r[0] for r in rows])
            out = []
            for (_, lang, h, weight), row, ok in zip(rows, found, has):
                if ok:
                    ix = np.flatnonzero(row)
                    out.append((lang, h, weight, ix.astype("<u2").tobytes(), row[ix].astype("<f4").tobytes()))
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)],
                                             ["lang", "h", "weight", "ix", "val"])

    return (drawn.select("text", "lang", "h", "weight")
            .mapInArrow(sparse, "lang string, h long, weight long, ix binary, val binary").dropDuplicates(["lang", "h"]))


def fit(train: DataFrame, sample_per_language: int = SAMPLE, centroids: int = CENTROIDS,
        seed: int = 11) -> Model | None:
    """Fit on rows (text, lang); ``lang`` must not be null."""
    df, rows = document_frequencies(train)
    if not rows:
        return None
    idf = (np.log((1 + rows) / (1 + df)) + 1).astype(np.float32)
    got = sampled(train, sample_per_language, seed).select("lang", "ix", "val", "weight").collect()
    got.sort(key=lambda r: (r[0], bytes(r[1]), bytes(r[2]), r[3]))
    langs = sorted({r[0] for r in got})
    if not langs:
        return None
    x = np.zeros((len(got), BUCKETS), dtype=np.float32)
    for i, r in enumerate(got):
        x[i, np.frombuffer(r[1], "<u2")] = np.frombuffer(r[2], "<f4")
    sizes = x.sum(axis=1)
    y = np.array([langs.index(r[0]) for r in got])
    weight = np.array([r[3] for r in got], dtype=np.float32)
    model = Model(langs, idf, np.empty((0, BUCKETS), np.float32), np.empty(0, int))
    v = model.vectors(x)
    rng = np.random.default_rng(seed)
    groups = [_cluster(v[y == k], weight[y == k], min(centroids, int((y == k).sum())), rng) for k in range(len(langs))]
    model.centroids = np.concatenate(groups).astype(np.float32)
    model.owner = np.repeat(np.arange(len(langs)), [len(g) for g in groups])
    own = model.similarities(v)[np.arange(len(y)), y]
    classes = np.floor(np.log2(np.maximum(sizes, 1))).astype(int)
    model.least = {int(c): float(REJECT_PART * np.quantile(own[classes == c], 0.01, method="inverted_cdf", weights=weight[classes == c]))
                   for c in np.unique(classes)}
    return model


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score, rejected for every row of (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred KB a language

    def predict(batches: Iterator) -> Iterator:
        import pyarrow as pa
        m = shared.value
        for batch in sliced(batches):
            texts = batch.column(1).to_pylist()
            found, has = counts(texts)
            lang, score, reject = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
            if m is not None and len(texts):
                sims = m.similarities(m.vectors(found))
                best = sims.argmax(axis=1)
                top = np.clip(sims[np.arange(len(best)), best].astype(np.float64), 0, 1)
                lang = [m.languages[b] if ok else UNKNOWN for b, ok in zip(best, has)]
                score = np.where(has, top, 0.0)
                reject = ~has | (top < m.threshold(found.sum(axis=1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(reject)],
                ["doc_id", "lang_pred", "score", "rejected"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        predict, f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.filter(F.col("lang").isNotNull() & ~F.coalesce(held_out(F.col("doc_id")), F.lit(False))).select("text", "lang")


def language_id(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every document."""
    return (identify(docs, fit(training_rows(docs)))
            .withColumn("held_out", F.coalesce(held_out(F.col("doc_id")), F.lit(False)))
            .select("doc_id", "held_out", "lang_pred", "score", "rejected"))


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text is rejected; columns unchanged."""
    marked = docs.withColumn("__row", F.xxhash64("doc_id", "text"))
    judged = staged(identify(marked.select(F.col("__row").alias("doc_id"), "text"), fit(training_rows(docs)))
                    .filter("rejected").select(F.col("doc_id").alias("__row")).distinct())
    return marked.join(judged, "__row", "left_anti").select(*docs.columns)
