"""Best-fit packing with large-item matching.

Method.  Documents are tokenised once, in tasks; only piece lengths decide the
packing, so the plan is made from their histogram, which has at most
``capacity`` rows whatever the input.  Pieces above one third of the capacity
meet at most twice in a bin: greedy matching takes the longest and gives it
the longest partner that fits.  Smaller pieces, longest first, go to the
tightest remaining gap that takes them, else to a new bin.  Bins of one kind
are kept as runs (pattern, count), so the driver's work is bounded by the
number of lengths, not of documents.  Every piece then finds its bin from its
rank within its length: ranks come from per-(length, slice) counts, so a
length that a third of all pieces share is numbered by many tasks.

Defined cases: a null text is empty and gives the one id 0; repeated rows are
separate documents; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from clientele.llm.common import staged

#: Tokens of a sequence.
CAPACITY = 2048
#: Id after each document.
END_ID = 0
#: Distinct chunks whose ids a Python worker remembers.
REMEMBERED = 300_000
#: Slices into which the pieces of one length are dealt for numbering.
SLICES = 64

PIECE = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"


def _chunks(text: str) -> list[str]:
    """The text cut before single spaces, where the tokenizer always cuts too.

    A space between two characters that are not white space starts a token of
    its own pre-tokenisation, so the ids of the chunks join to those of the text.
    """
    parts = text.split(" ")
    out = [parts[0]]
    for p in parts[1:]:
        last = out[-1]
        if p and last and not p[0].isspace() and not last[-1].isspace():
            out.append(" " + p)
        else:
            out[-1] = last + " " + p
    return out


_MEMORY: dict = {}

#: Longest run of a text's characters with or without white space that goes to
#: the ranks, whose time grows with the square of a run.
LONGEST_RUN = 400
# Characters beyond Latin, whose classes may differ between Unicode versions,
# and long white space.
_NOT_PLAIN = re.compile(r"[^\x00-\u024f]|\s{%d}" % LONGEST_RUN)
#: The one special token of the default tokenizer.
SPECIAL = "<|endoftext|>"


def _tokenizer(path: str):
    if _MEMORY.get("path") != path:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        _MEMORY.update(path=path, tokenizer=Tokenizer.from_file(path), ids={})
    return _MEMORY["tokenizer"], _MEMORY["ids"]


def _ranks():
    """The default tokenizer's vocabulary as tiktoken reads it."""
    if "ranks" not in _MEMORY:
        import base64

        import public_tokenizers
        import tiktoken
        with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        _MEMORY["ranks"] = tiktoken.Encoding(
            "byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _MEMORY["ranks"]


def _plain(text: str) -> bool:
    """Whether the ranks surely give the tokenizer's ids, in short time."""
    return (SPECIAL not in text and _NOT_PLAIN.search(text) is None
            and max(map(len, text.split()), default=0) <= LONGEST_RUN)


def encode(texts: list[str], path: str | None = None) -> list[bytes]:
    """Each text's ids as little-endian unsigned 32-bit values.

    Without a path the default tokenizer is meant.  Its vocabulary exists as
    ranks too, which give the same ids for plain texts several times faster;
    all other texts, and all texts of a path, go through the tokenizer itself.
    """
    if path is not None:
        return _by_tokenizer(texts, path)
    import public_tokenizers
    plain = [_plain(t) for t in texts]
    rest = iter(_by_tokenizer([t for t, p in zip(texts, plain) if not p], public_tokenizers.path("byte_bpe_50k.json"))
                if not all(plain) else ())
    return [_ranks().encode_to_numpy(t).astype("<u4", copy=False).tobytes() if p else next(rest)
            for t, p in zip(texts, plain)]


def _by_tokenizer(texts: list[str], path: str) -> list[bytes]:
    import numpy as np
    tokenizer, known = _tokenizer(path)
    if len(known) > REMEMBERED:
        known.clear()
    cut = [_chunks(t) for t in texts]
    new = list({c for chunks in cut for c in chunks if c not in known})
    fast = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)
    for at in range(0, len(new), 4096):
        part = new[at:at + 4096]
        for c, e in zip(part, fast(part, add_special_tokens=False)):
            known[c] = np.asarray(e.ids, dtype="<u4").tobytes()
    return [b"".join([known[c] for c in chunks]) for chunks in cut]


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY,
           end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: PIECE, and the ids themselves if asked for.

    ``row`` tells repeated rows of a document apart.  A document longer than
    the capacity is cut so that only its first piece is short.
    """
    schema = PIECE + (", ids array<long>" if with_ids else "")

    def cut(batches: Iterator) -> Iterator:
        import zlib

        import numpy as np
        import pyarrow as pa
        tail = np.asarray([end_id], dtype="<u4").tobytes()
        for batch in batches:
            cols: list[list] = [[] for _ in range(7)]
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc, row, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), encode(texts, path)):
                ids += tail
                n = len(ids) // 4
                first = n % capacity or capacity
                at, k = 0, 0
                while at < n:
                    size = first if k == 0 else capacity
                    body = ids[4 * at:4 * (at + size)]
                    for c, v in zip(cols, (doc, row, k, at, size, zlib.crc32(body))):
                        c.append(v)
                    if with_ids:
                        cols[6].append(np.frombuffer(body, dtype="<u4").astype(np.int64))
                    at, k = at + size, k + 1
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(cols, types)]
            names = ["doc_id", "row", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array(cols[6], pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    return rows.mapInArrow(cut, schema)


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Runs (bins, ((length, times), ...)) that pack the histogram.

    Work and result are bounded by the number of distinct lengths.
    """
    left = {n: c for n, c in histogram.items() if c > 0}
    third = capacity / 3
    runs: dict[int, list[list]] = {}  # gap -> runs [bins, contents]
    gaps: list[int] = []  # the gaps that have runs, ascending

    def put(gap: int, bins: int, contents: tuple) -> None:
        if gap not in runs:
            runs[gap] = []
            bisect.insort(gaps, gap)
        runs[gap].append([bins, contents])

    large = sorted(n for n in left if n > third)
    while large:
        big = large[-1]
        at = bisect.bisect_right(large, capacity - big) - 1  # its longest partner
        if at < 0:
            put(capacity - big, left[big], ((big, 1),))
            large.pop()
            continue
        mate = large[at]
        if mate == big:
            bins, odd = divmod(left[big], 2)
            if bins:
                put(capacity - 2 * big, bins, ((big, 2),))
            left[big] = odd
            if not odd:
                large.pop()
            elif at > 0:
                mate = large[at - 1]
                put(capacity - big - mate, 1, ((big, 1), (mate, 1)))
                left[mate] -= 1
                large.pop()
                if not left[mate]:
                    large.remove(mate)
            else:
                put(capacity - big, 1, ((big, 1),))
                large.pop()
            continue
        bins = min(left[big], left[mate])
        put(capacity - big - mate, bins, ((big, 1), (mate, 1)))
        left[big] -= bins
        left[mate] -= bins
        if not left[mate]:
            large.pop(at)
        if not left[big]:
            large.pop()

    for n in sorted((n for n in left if n <= third), reverse=True):
        count = left[n]
        while count:
            at = bisect.bisect_left(gaps, n)
            if at == len(gaps):
                put(capacity, -(-count // (capacity // n)), ())
                continue
            gap = gaps[at]
            bins, contents = runs[gap].pop()
            if not runs[gap]:
                del runs[gap]
                gaps.pop(at)
            each = gap // n
            full = min(bins, count // each)
            if full:
                put(gap - each * n, full, contents + ((n, each),))
                count -= full * each
                bins -= full
            if bins and count and count < each:
                put(gap - count * n, 1, contents + ((n, count),))
                bins -= 1
                count = 0
            if bins:
                put(gap, bins, contents)
    return [(bins, contents) for gap in sorted(runs) for bins, contents in runs[gap] if contents]


def _places(runs: list[tuple[int, tuple[tuple[int, int], ...]]]) -> dict[int, list[tuple[int, int, int, int, int]]]:
    """Per length the intervals (first rank, times, first bin, offset, ranks)."""
    places: dict[int, list] = {}
    used: dict[int, int] = {}
    first_bin = 0
    for bins, contents in runs:
        offset = 0
        for n, times in contents:
            rank = used.get(n, 0)
            places.setdefault(n, []).append((rank, times, first_bin, offset, bins * times))
            used[n] = rank + bins * times
            offset += n * times
        first_bin += bins
    return places


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY,
         end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """The pieces with sequence_id and offset."""
    cut = staged(pieces(docs, path, capacity, end_id, with_ids)
                 .withColumn("slice", F.pmod(F.xxhash64("row", "piece"), F.lit(SLICES))))
    counts = cut.groupBy("length", "slice").agg(F.count("*").alias("held"))  # <= capacity * SLICES rows
    order = W.partitionBy("length").orderBy("slice").rowsBetween(W.unboundedPreceding, W.currentRow)
    starts = staged(counts.withColumn("first", F.sum("held").over(order) - F.col("held")))
    histogram = {r[0]: r[1] for r in starts.groupBy("length").agg(F.sum("held")).collect()}
    places = [(n, *p) for n, found in _places(plan_bins(histogram, capacity)).items() for p in found]
    spark = docs.sparkSession
    intervals = spark.createDataFrame(
        places or [(0, 0, 0, 0, 0, 0)],
        "length long, rank0 long, times long, bin0 long, offset0 long, ranks long")
    # one row a (length, slice) start and one an interval: both bounded by the capacity
    ranked = (cut.join(F.broadcast(starts.select("length", "slice", "first")), ["length", "slice"])
              .withColumn("rank", F.col("first") + F.row_number().over(
                  W.partitionBy("length", "slice").orderBy("row", "piece")) - 1))
    grouped = intervals.groupBy("length").agg(F.array_sort(F.collect_list(
        F.struct("rank0", "times", "bin0", "offset0", "ranks"))).alias("places"))
    found = ranked.join(F.broadcast(grouped), "length").withColumn(
        "p", F.filter("places", lambda p: (F.col("rank") >= p["rank0"])
                      & (F.col("rank") < p["rank0"] + p["ranks"]))[0])
    inside = F.col("rank") - F.col("p.rank0")
    times = F.col("p.times")
    return found.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("p.bin0") + F.floor(inside / times)).cast("long").alias("sequence_id"),
        (F.col("p.offset0") + (inside % times) * F.col("length")).cast("long").alias("offset"),
        *(["ids"] if with_ids else []))
