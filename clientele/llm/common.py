"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import TYPE_CHECKING

import numpy as np
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from clientele.session import ensure_checkpoint_dir, ship_package

if TYPE_CHECKING:
    import pyarrow as pa

#: Bounds of one Arrow batch, and with it of a Python worker's memory when
#: texts are very long.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20

#: Characters of the contract's white space class ``[\x20\x09-\x0D]``.
SPACES = ("\x20", "\x09", "\x0a", "\x0b", "\x0c", "\x0d")
#: The same class as a regular expression.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Ship the package, name the checkpoint folder, bound Arrow batches."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def staged(df: DataFrame, by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    The result has no lineage, survives the loss of executors, and later
    reads prune columns.  The files go when the checkpoint folder does.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/staged-{uuid.uuid4().hex}"
    writer = df.write
    if by is not None:
        writer = writer.partitionBy(by)
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def staged_with(df: DataFrame, *measures: Column) -> tuple[DataFrame, dict]:
    """``staged``, and named aggregates of the rows, gathered while they are
    written (no job of their own)."""
    seen = Observation()
    out = staged(df.observe(seen, *measures))
    return out, seen.get


def discard(*tables: DataFrame | None) -> None:
    """Delete the files of staged tables that nothing will read again.

    Only tables that ``staged`` itself returned are deleted; what was computed
    from them must have been written before.
    """
    for t in tables:
        path = getattr(t, "_staged_path", None)
        if path is not None:
            spark = t.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


#: Bound of the hot keys that ``looked_up`` sends to every task, and rows of one
#: key that a task may get without that.
HOT_KEYS, KEY_ROWS = 4096, 100_000


def looked_up(rows: DataFrame, lookup: DataFrame, key: str, held: str,
              sizes: tuple[int, int] | None = None) -> DataFrame:
    """``rows`` with the columns of the written table ``lookup`` (one row a key,
    none missing).

    ``held`` names the lookup's count of ``rows`` with the key; it is dropped.
    ``sizes``: its sum and its largest value, if known.
    If a key has many rows, keys with more than one in HOT_KEYS of all rows,
    which are fewer than HOT_KEYS, are broadcast, and no task of the shuffled
    join gets more than that share of one key; both tables are then read twice.
    """
    total, most = sizes or lookup.agg(F.sum(held), F.max(held)).first()
    if (most or 0) <= KEY_ROWS:
        return rows.join(lookup.drop(held), key)
    hot = lookup.filter(F.col(held) > total // HOT_KEYS).drop(held)
    cold = lookup.filter(F.col(held) <= total // HOT_KEYS).drop(held)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return rows.join(F.broadcast(hot), key).unionByName(rest)


def components(links: DataFrame) -> DataFrame:
    """key, comp: the smallest key that links (a, b) reach, for linked keys.

    Large-star and small-star steps in turn (Kiveris et al. 2014) until the
    links no longer change.  A node with very many links is looked up by
    broadcast, and each round deletes the tables of the one before.
    """
    mark = (F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum"))

    def least(e: DataFrame, with_self: bool) -> tuple[DataFrame, tuple[int, int]]:
        m = F.least("u", F.min("v")) if with_self else F.min("v")
        found, size = staged_with(e.groupBy("u").agg(m.alias("m"), F.count("*").alias("held")),
                                  F.sum("held").alias("total"), F.max("held").alias("most"))
        return found, (size["total"], size["most"])

    edges, before = staged_with(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                                .filter("u != v").distinct(), *mark)
    while before["n"]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low, sizes = least(both, True)
        large = staged(looked_up(both, low, "u", "held", sizes).filter("v > u")
                       .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct())
        discard(edges, low)
        low, sizes = least(large, False)
        small = looked_up(large, low, "u", "held", sizes)
        edges, after = staged_with(small.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
                                   .unionByName(small.select("u", F.col("m").alias("v"))).filter("u != v").distinct(), *mark)
        discard(large, low)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("key")).distinct().select("key", F.col("key").alias("comp"))
    out = staged(edges.groupBy(F.col("u").alias("key")).agg(F.min("v").alias("comp")).unionByName(roots)
                 .groupBy("key").agg(F.min("comp").alias("comp")))
    discard(edges)
    return out


def lower_ascii(col: Column) -> Column:
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def without_spaces(col: Column) -> Column:
    """``col`` with every character of ``[\\x20\\x09-\\x0D]`` deleted."""
    for c in SPACES:
        col = F.replace(col, F.lit(c), F.lit(""))
    return col


def sum_arrays(partials: DataFrame, fan_in: int = 16) -> DataFrame:
    """Add rows of (vec array<double>, weight double) down to ``fan_in`` rows.

    Every task adds the rows it streams, so no task holds more than two
    vectors; the caller collects at most ``fan_in`` rows.
    """
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa
        total, weight = None, 0.0
        for batch in batches:
            vecs, weights = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                v = np.asarray(vecs[i].values, dtype=np.float64)
                total = v.copy() if total is None else total + v
                weight += weights[i].as_py()
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([total.tolist()], pa.list_(pa.float64())),
                 pa.array([weight], pa.float64())], ["vec", "weight"])

    return partials.select("vec", "weight").repartition(fan_in).mapInArrow(
        add, "vec array<double>, weight double")


def least_hashes(rows: DataFrame, by: str, n: int) -> DataFrame:
    """The ``n`` rows of each value of ``by`` with the least ``h``, taken as
    53 bits; ``h`` is a hash, all ``h`` of a value differ, and ``rows`` is read
    twice.

    A first cut by the hash leaves about twice as many rows of each value, so
    that no task orders more.  ``by`` has few values and no null.
    """
    found = {r[0]: r[1] for r in rows.groupBy(by).count().collect()}  # one row a value
    if not found:
        return rows.limit(0)
    place = F.shiftrightunsigned("h", 11)
    part = F.create_map(*[F.lit(x) for v, have in found.items() for x in (v, min(1.0, (2 * n + 50) / have))])
    rank = F.row_number().over(W.partitionBy(by).orderBy(place, "h"))
    return (rows.filter(place / F.lit(float(1 << 53)) < part[F.col(by)])
            .withColumn("__rank", rank).filter(F.col("__rank") <= n).drop("__rank"))


# Word hashes.  A word's hash is a polynomial of its bytes over 64-bit numbers,
# each byte replaced by a random value (A-Z by that of a-z), then scrambled.
# Prefix sums give it for all words of a text at once.
_BYTE = np.random.default_rng(0x5EED).integers(0, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[ord(c) for c in SPACES]] = True
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, up to the n-th."""
    if not _POWERS or len(_POWERS[0]) <= n:
        size = max(1 << 16, 2 * n)
        _POWERS[:] = [np.multiply.accumulate(np.r_[np.uint64(1), np.full(size, b, dtype=np.uint64)])
                      for b in (_BASE, pow(_BASE, -1, 1 << 64))]
    return _POWERS[0], _POWERS[1]


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words ``[^\x20\x09-\x0D]+`` of a text in order,
    A-Z lower-cased."""
    b = np.frombuffer((text or "").encode("utf-8", "replace"), dtype=np.uint8)
    word = np.zeros(len(b) + 2, dtype=bool)
    np.logical_not(_IS_SPACE[b], out=word[1:-1])
    edge = np.flatnonzero(word[1:] != word[:-1])
    start, end = edge[::2], edge[1::2]
    power, inverse = _powers(len(b))
    total = np.zeros(len(b) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[b] * power[:len(b)], out=total[1:])
    return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))


def counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, ascending, and how often each occurs."""
    values = np.sort(values)
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.empty(0, np.int64)
    return values[first], np.diff(np.r_[first, len(values)])
