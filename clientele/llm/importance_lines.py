"""Importance resampling to a target distribution, with lines counted once.

Method.  Documents are resampled towards a target corpus by hashed n-gram
features: a bucket's gain is the log ratio of its share in the target and in
the documents, a document's weight is the sum of gains over its features, and
Gumbel noise added to the weight makes a draw without replacement out of a
plain sort by score.

Newlines, which are never part of a word, cut texts into lines.  Lines repeat,
within documents and across them, so Spark first collapses them: a line's
features are hashed once and multiplied by its occurrences, and later its gain
is summed once and looked up by the documents that hold it.  n-grams that reach
over the end of a line depend on the document; they are hashed for each
document from the two words on either side of its line ends and added
separately.

n-grams are hashed without cutting them out of the text: the CRC of a
concatenation is a linear function of the first part's CRC, so the CRCs of all
words of a batch give those of all its n-grams.

Defined cases: null, empty or wordless text has no features, weight 0; texts of
any length are read whole; a null doc_id hashes as the empty string and comes
last among ties; repeated rows are drawn as rows of their own, rows equal in
score and doc_id in arbitrary order; an empty table of documents gives an empty
result, an empty target counts no feature; extra columns are ignored.  Lines
are told apart by their MD5.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.functions.ranking import global_row_number
from clientele.llm.common import discard, looked_up, staged

#: Longest n-grams, buckets they are hashed to, percent of documents drawn, the
#: least words of a document that can be drawn, and the seed of the noise.
GRAMS, BUCKETS, PERCENT, WORDS, SEED = 3, 10000, 5, 20, 42
#: Words of more bytes than this are hashed one by one.
LONG = 64

_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _crc_table() -> np.ndarray:
    """Bytewise table of the CRC-32 of polynomial 0xEDB88320 (reflected)."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = (t >> np.uint32(1)) ^ np.where(t & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return t


_CRC = _crc_table()


def _shift_tables() -> np.ndarray:
    """[n, k, v]: what v in byte k of a CRC becomes when n zero bytes follow."""
    out = np.empty((LONG + 2, 4, 256), dtype=np.uint32)
    out[0] = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * np.uint32(8))[:, None]
    for n in range(1, LONG + 2):
        out[n] = (out[n - 1] >> np.uint32(8)) ^ _CRC[out[n - 1] & np.uint32(255)]
    return out


_SHIFT = _shift_tables()


def _shifted(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """CRCs of which n further bytes, all zero, change the linear part."""
    crc, n = crc.copy(), n.copy()
    while len(far := np.flatnonzero(n > LONG + 1)):
        crc[far] = _shifted(crc[far], np.full(len(far), LONG + 1))
        n[far] -= LONG + 1
    out = _SHIFT[n, 0, crc & np.uint32(255)]
    for k in (1, 2, 3):
        out ^= _SHIFT[n, k, (crc >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of texts that lie end to end in ``data``."""
    is_word = _WORD[data]
    begins = is_word.copy()
    begins[1:] &= ~is_word[:-1]
    ends = is_word.copy()
    ends[:-1] &= ~is_word[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    begins[inner] = is_word[inner]
    ends[inner - 1] = is_word[inner - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def crcs(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of the words, A-Z lower-cased."""
    import zlib
    size = end - start
    state = np.full(len(start), 0xFFFFFFFF, dtype=np.uint32)
    by = np.argsort(size, kind="stable")
    by = by[:np.searchsorted(size[by], LONG, "right")]
    sizes = size[by]
    for k in range(int(sizes[-1]) if len(sizes) else 0):
        on = by[np.searchsorted(sizes, k, "right"):]
        b = _LOWER[data[start[on] + k]]
        state[on] = (state[on] >> np.uint32(8)) ^ _CRC[(state[on] ^ b) & np.uint32(255)]
    out = state ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > LONG):
        out[i] = zlib.crc32(_LOWER[data[start[i]:end[i]]].tobytes())
    return out


def grams(crc: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """CRC-32 of the runs of 1 to GRAMS words, joined by one space, that start
    at each word (the last ones of a length have none)."""
    import zlib
    after = _shifted(np.full(len(crc), zlib.crc32(b" "), dtype=np.uint32), size) ^ crc  # " " and the word
    out = [crc]
    for n in range(1, GRAMS):
        out.append(_shifted(out[-1][:len(crc) - n], size[n:] + 1) ^ after[n:] if len(crc) > n else crc[:0])
    return out


def _texts(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without nulls, and the places between rows."""
    rows = len(column)
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64 if str(column.type) == "large_string" else np.int32)
    bounds = bounds[column.offset:column.offset + rows + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[bounds[0]:bounds[-1]]
    return data, bounds - bounds[0]


def line_features(lines: DataFrame) -> DataFrame:
    """key (MD5), n, words, buckets (two bytes each) of the lines (line, n) with
    a word."""
    def local(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            data, bounds = _texts(batch.column(0))
            start, end = words(data, bounds)
            line = np.searchsorted(bounds, start, "right") - 1
            runs = grams(crcs(data, start, end), end - start)
            owner, bucket = [], []
            for n, crc in enumerate(runs):
                inside = line[:len(crc)] == line[n:n + len(crc)]
                owner.append(line[:len(crc)][inside])
                bucket.append((crc[inside] % np.uint32(BUCKETS)).astype("<u2"))
            owner, bucket = np.concatenate(owner), np.concatenate(bucket)
            bucket = bucket[np.argsort(owner, kind="stable")]
            rows = np.flatnonzero(held := np.bincount(line, minlength=batch.num_rows))
            cut = np.cumsum(np.r_[0, np.bincount(owner, minlength=batch.num_rows)])
            raw = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([hashlib.md5(raw[i].encode()).digest() for i in rows], pa.binary()), batch.column(1).take(pa.array(rows)),
                 pa.array(held[rows].astype(np.int64)), pa.array([bucket[cut[i]:cut[i + 1]].tobytes() for i in rows], pa.binary())],
                ["key", "n", "words", "buckets"])

    return lines.mapInArrow(local, "key binary, n long, words long, buckets binary")


def document_features(docs: DataFrame) -> DataFrame:
    """doc_id, keys (MD5 of its lines with a word), across (buckets of the
    n-grams over line ends, two bytes each) of every row."""
    def local(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            data, bounds = _texts(batch.column(1))
            breaks = np.flatnonzero(data == 10)
            start, end = words(data, bounds)
            doc = np.searchsorted(bounds, start, "right") - 1
            line = np.searchsorted(np.union1d(breaks, bounds), start, "right")
            # the two words on either side of every line end
            count = len(line)
            first = np.searchsorted(line, line, "left")
            last = np.searchsorted(line, line, "right")
            place = np.arange(count)
            near = (place - first < GRAMS - 1) | (last - place < GRAMS)
            start, end, doc, line = (x[near] for x in (start, end, doc, line))
            runs = grams(crcs(data, start, end), end - start)
            owner, bucket = [], []
            for n, crc in enumerate(runs[1:], 1):
                size = len(crc)
                over = (line[:size] != line[n:n + size]) & (doc[:size] == doc[n:n + size])
                owner.append(doc[:size][over])
                bucket.append((crc[over] % np.uint32(BUCKETS)).astype("<u2"))
            owner, bucket = np.concatenate(owner), np.concatenate(bucket)
            bucket = bucket[np.argsort(owner, kind="stable")]
            cut = np.cumsum(np.r_[0, np.bincount(owner, minlength=batch.num_rows)])
            keys = []
            for text in batch.column(1).to_pylist():
                raw = text.encode()
                keys.append([hashlib.md5(x).digest() for x in raw.split(b"\n") if _any_word(x)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.list_(pa.binary())),
                 pa.array([bucket[cut[i]:cut[i + 1]].tobytes() for i in range(batch.num_rows)], pa.binary())],
                ["doc_id", "keys", "across"])

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        local, "doc_id long, keys array<binary>, across binary")


def _any_word(line: bytes) -> bool:
    return bool(_WORD[np.frombuffer(line, dtype=np.uint8)].any())


def bucket_counts(lines: DataFrame, docs: DataFrame) -> np.ndarray:
    """Occurrences of every bucket: BUCKETS numbers, whatever the input."""
    def local(batches: Iterator) -> Iterator:
        import pyarrow as pa
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            raw = batch.column(0).to_pylist()
            times = np.repeat(batch.column(1).to_numpy(), [len(b) // 2 for b in raw])
            found = np.frombuffer(b"".join(raw), dtype="<u2")
            # halves, so that sums in doubles are exact
            for part, scale in ((times & 0xFFFFFFFF, 1), (times >> 32, 1 << 32)):
                total += np.bincount(found, weights=part, minlength=BUCKETS).astype(np.int64) * scale
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    rows = lines.select("buckets", "n").unionByName(docs.select(F.col("across").alias("buckets"), F.lit(1).cast("long").alias("n")))
    found = rows.mapInArrow(local, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS, dtype=np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def features(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The written tables of distinct lines and of documents (with a row number)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = (docs.select(F.explode(F.split(text, "\n", -1)).alias("line")).groupBy("line").agg(F.count("*").alias("n")))
    numbered = document_features(docs).withColumn("row", F.monotonically_increasing_id())
    return staged(line_features(lines)), staged(numbered)


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + BUCKETS) / ((s + 1)(T + BUCKETS)))) of every bucket."""
    s_all, t_all = float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + BUCKETS) / ((s + 1) * (t_all + BUCKETS))))
                     for s, t in zip(source.astype(float), target.astype(float))], dtype=np.int64)


def summed(rows: DataFrame, buckets: str, gain: np.ndarray) -> DataFrame:
    """``rows`` with ``weight``, the gains of its buckets, in place of them."""
    shared = rows.sparkSession.sparkContext.broadcast(gain)  # BUCKETS numbers
    kept = [c for c in rows.columns if c != buckets]

    def local(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            raw = batch.column(batch.num_columns - 1).to_pylist()
            part = np.r_[0, np.cumsum(shared.value[np.frombuffer(b"".join(raw), dtype="<u2")])]
            cut = np.cumsum([0, *[len(b) // 2 for b in raw]])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(part[cut[1:]] - part[cut[:-1]])], [*kept, "weight"])

    types = dict(rows.dtypes)
    return rows.select(*kept, buckets).mapInArrow(local, ", ".join(f"{c} {types[c]}" for c in kept) + ", weight long")


def weights(docs: DataFrame, target: DataFrame) -> DataFrame:
    """row, doc_id, words, weight of every document, written."""
    aim_lines, aim_docs = features(target)
    aim = bucket_counts(aim_lines, aim_docs)
    discard(aim_lines, aim_docs)
    lines, found = features(docs)
    gain = gains(bucket_counts(lines, found), aim)
    of_line = staged(summed(lines, "buckets", gain))
    of_doc = staged(summed(found.select("row", "doc_id", "across"), "across", gain))
    held = found.select("row", F.explode("keys").alias("key"))
    inside = looked_up(held, of_line, "key", "n").select(
        "row", F.lit(None).cast("long").alias("doc_id"), "words", "weight")
    own = of_doc.select("row", "doc_id", F.lit(0).cast("long").alias("words"), "weight")
    out = staged(own.unionByName(inside).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.sum("words").alias("words"), F.sum("weight").alias("weight")))
    discard(lines, found, of_line, of_doc)
    return out


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document."""
    m = F.col("words")
    n_features = sum((F.greatest(m - n, F.lit(0).cast("long")) for n in range(1, GRAMS)), m)
    id_text = F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(id_text, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")
    scored = weights(docs, target).select("row", "doc_id", "words", n_features.cast("long").alias("n_features"),
                                          "weight", (F.col("weight") + noise).alias("score"))
    able = scored.filter(m >= WORDS)
    drawn = able.count() * percent // 100
    ranked = global_row_number(able, [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")], out="place")
    rank = F.when(F.col("place") <= drawn, F.col("place"))
    columns = ["doc_id", "n_features", "weight", "score"]
    return (ranked.select(*columns, rank.alias("rank"))
            .unionByName(scored.filter(m < WORDS).select(*columns, F.lit(None).cast("long").alias("rank"))))
