"""Exact deduplication with an extendible-hash index on shared files.

Method.  The key of a text is the 64-bit hash of its characters without white
space; its bytes are told by their SHA-256, which the result reports anyway, so
no text is moved.  The directory of the index maps the first bits of a key to a
bucket: a bucket is a prefix of the key's bits, an overfull one splits on its
next bit, and the directory doubles while any bucket is above capacity.  It is
built from a histogram of the distinct keys.

Rows are then combined where they lie: tasks add up the rows of one key and
digest, in ``PARTS`` parts each, so that a hot group moves a row a task.  The
combined rows are routed by the directory to the task that owns their bucket.
There entries are chained in the order of key and digest; entries of one key are
compared by their bytes (the digests), equal ones become one entry with the
number of rows and the row that stays, and different ones stay in the chain.
These buckets, written to the shared folder, decide every row of the result.

Only DataFrame functions run on the data path.

Defined cases: null text counts as empty; empty and all-space texts are equal
to each other; null doc_ids come last among ties; rows that tie in everything
(repeated rows) keep the first one in the order of the written table, so one
row of a group stays in any case; very long texts are hashed whole; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from clientele.functions.lookup import lookup
from clientele.llm.common import discard, looked_up, staged, without_spaces

#: Index entries that a bucket holds before it splits.
BUCKET_CAPACITY = 4096
#: Bits beyond log2(entries / capacity) that the directory may still double;
#: hash prefixes of so many more bits are empty or nearly so.
EXTRA_DEPTH = 4
#: Parts in which the rows of one text are combined before they are routed.
PARTS = 16


def keyed(docs: DataFrame) -> DataFrame:
    """row, doc_id, n (code points of the original), h (64-bit key), sha (bytes)
    of every row, written, which fixes the row numbers."""
    text = F.coalesce(F.col("text"), F.lit(""))
    light = (docs.select("doc_id", F.length(text).cast("long").alias("n"), without_spaces(text).alias("norm"))
             .select("doc_id", "n", F.xxhash64("norm").alias("h"), F.unhex(F.sha2("norm", 256)).alias("sha")))
    return staged(light.withColumn("row", F.monotonically_increasing_id()))


def _slot(h, depth: int):
    """The first ``depth`` bits of the hash, as a number (0 bits: 0)."""
    return F.shiftrightunsigned(h, 64 - depth).cast("long") if depth else F.lit(0).cast("long")


def directory(light: DataFrame, capacity: int = BUCKET_CAPACITY) -> tuple[DataFrame, int]:
    """The extendible-hash directory: slot, bucket, local_depth, of the slots in
    use; and its depth.

    The histogram of the deepest prefixes is summed for each shallower depth; a
    slot's bucket is its shallowest prefix that is not overfull (or its deepest,
    which then chains).  Its depth follows the number of keys.
    """
    held = staged(light.groupBy("h").agg(F.count("*").alias("n")).select("h"))
    total = held.count()
    depth = min(63, max(0, math.ceil(math.log2(max(1, total / capacity)))) + EXTRA_DEPTH)
    leaves = held.groupBy(_slot(F.col("h"), depth).alias("slot")).agg(F.count("*").alias("held"))
    levels = (leaves.select("slot", "held", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("level"))
              .withColumn("prefix", F.expr(f"shiftrightunsigned(slot, {depth} - level)")))
    full = levels.groupBy("level", "prefix").agg(F.sum("held").alias("held"))
    fits = full.filter((F.col("held") <= capacity) | (F.col("level") == depth)).select("level", "prefix")
    slots = (levels.select("slot", "level", "prefix").join(fits, ["level", "prefix"])
             .groupBy("slot").agg(F.min("level").alias("local_depth")))
    slots = staged(slots.withColumn("bucket", F.expr(
        f"shiftleft(shiftrightunsigned(slot, {depth} - local_depth), {depth} - local_depth)")))
    discard(held)
    return slots, depth


def build_index(light: DataFrame, capacity: int = BUCKET_CAPACITY) -> DataFrame:
    """The index as files on the shared folder: bucket, local_depth, chain, h,
    sha, rows, keep (n, doc_id and row of the row that stays)."""
    slots, depth = directory(light, capacity)
    best = F.struct((-F.col("n")).alias("n"), F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    # at most PARTS rows of each text, combined on the map side
    combined = (light.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(PARTS)))
                .groupBy("h", "sha", "part").agg(F.count("*").alias("rows"), F.min(best).alias("keep")))
    routed = lookup(combined.withColumn("slot", _slot(F.col("h"), depth)), slots, "slot").repartition("bucket")
    # a bucket's rows are together now: what follows moves nothing
    chained = routed.groupBy("bucket", "h", "sha").agg(
        F.first("local_depth").alias("local_depth"), F.sum("rows").alias("rows"), F.min("keep").alias("keep"))
    chain = F.row_number().over(W.partitionBy("bucket", "h").orderBy("sha"))
    index = staged(chained.withColumn("chain", chain).sortWithinPartitions("bucket", "h", "chain"))
    discard(slots)
    return index


def resolved(light: DataFrame, index: DataFrame) -> DataFrame:
    """Every row of ``keyed`` with what the index says of its text."""
    entry = index.select(F.struct("h", "sha").alias("entry"), "bucket", "chain", "rows",
                         F.col("keep.doc_id").alias("keep_id"), F.col("keep.row").alias("keep_row"), F.col("rows").alias("held"))
    found = looked_up(light.withColumn("entry", F.struct("h", "sha")), entry, "entry", "held")
    return found.withColumn("kept", F.col("row") == F.col("keep_row"))


def dedup(docs: DataFrame, capacity: int = BUCKET_CAPACITY) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, bucket, chain per row.

    Of equal texts the row with the most original code points stays, then the
    smallest doc_id.
    """
    light = keyed(docs)
    return resolved(light, build_index(light, capacity)).select(
        "doc_id", "keep_id", F.col("rows").alias("group_size"), "kept",
        F.lower(F.hex("sha")).alias("text_sha256"), "bucket", "chain")


def keep_one(docs: DataFrame, capacity: int = BUCKET_CAPACITY) -> DataFrame:
    """``docs`` with the row that stays of each group of equal texts; columns
    unchanged.  Of rows that are equal in doc_id and text one stays."""
    light = keyed(docs)
    keep = staged(resolved(light, build_index(light, capacity)).filter("kept").select("doc_id", "sha", "n"))
    discard(light)
    text = F.coalesce(F.col("doc.text"), F.lit(""))
    # the row that stays is told by its id, its text without spaces and its length
    rows = docs.select(F.struct(*docs.columns).alias("doc")).select(
        "doc", F.unhex(F.sha2(without_spaces(text), 256)).alias("_sha"), F.length(text).cast("long").alias("_n"))
    same = F.col("doc.doc_id").eqNullSafe(keep["doc_id"]) & (F.col("_sha") == keep["sha"]) & (F.col("_n") == keep["n"])
    found = rows.join(keep, same, "left_semi")
    twice = F.row_number().over(W.partitionBy("doc.doc_id", "_sha", "_n").orderBy(F.xxhash64("doc")))
    repeated = docs.groupBy("doc_id").count().filter("count > 1").limit(1).count()
    if repeated:
        found = found.withColumn("_turn", twice).filter("_turn = 1")
    return found.select("doc.*")
