"""Approximate nearest neighbours by shifted Hilbert orderings.

Method.  Vectors are centred, augmented so that the largest inner product is
the nearest point, and projected to a few dimensions, for each of several
curves by random directions that follow the covariance of all points and a shift
of its own.  A point's place on a curve is its Hilbert key; Spark
range-partitions each curve and numbers the points in key order.  A query is
merged into every curve at its own key, the ranks around it are scored with
packed vectors of 16-bit integers, the curves' best are merged, and the best of
these are scored again with the original vectors.  The half width of the window
is measured, not assumed: for a hashed sample of queries the true neighbours are
found by brute force over all rows, and the width is the one that reaches
``recall`` on them.

Equal vectors are one point of the index that keeps its smallest ids, as many
as a result can need, so a vector that a third of the rows share costs one.

Blocks of a curve have a fixed number of points, and the queries of a crowded
block are dealt to several tasks, so a task's memory does not grow with the
input; a wide window spans several blocks.

Defined cases: vectors that are null, of another length than most, zero, or
hold null or non-finite components take no part; repeated ids are separate
rows, each asked and found by itself, so a query_id may come twice and find its
other row; ties go to the smaller vec_id (of more than k + 1 + SPARE different
vectors of one score any are found); fewer candidates than ``k`` are all returned; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from clientele.llm.common import discard, staged, staged_with, sum_arrays

#: Curves, dimensions of a curve and bits of a dimension (their product < 64).
CURVES, DIMS, BITS = 4, 8, 7
#: Spreads of a projected dimension that the grid covers, and the largest code of
#: a packed component.
REACH, CODE = 8.0, 32767
#: Survivors that a query scores again beside the k + 1 that can be returned.
SPARE = 4
#: Sampled queries that measure the window, and the recall it must reach there.
SAMPLE, RECALL = 200, 0.95
#: Points of a block of a curve.
LEAST_BLOCK, MOST_BLOCK = 64, 4096
#: Queries of a block that one task scores, and of one product.
MOST_QUERIES, SLICE = 8192, 512


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of integer points (n x dims) on a grid of 2^bits a side.

    Skilling, "Programming the Hilbert curve" (2004), over whole columns.
    """
    x = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(len(x)):
            high = (x[i] & q) > 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[i]
        q >>= 1
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where(x[-1] & q, flip ^ (q - 1), flip)
        q >>= 1
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for c in x:
            key = (key << 1) | (((c ^ flip) >> b) & 1)
    return key


def usable(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """row, vec_id, v: rows whose vector takes part, written, which numbers them."""
    kind = "array<float>" if vectors.schema[column].dataType.simpleString() == "array<float>" else "array<double>"
    v = F.col(column).cast(kind)
    fine = (v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
            & F.exists(v, lambda x: x != 0))
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), v.alias("v")).filter(fine & F.col("vec_id").isNotNull())
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.col("count").desc(), "n").limit(1).collect()
    fit = rows.filter(F.size("v") == (lengths[0][0] if lengths else 0))
    return staged(fit.withColumn("row", F.monotonically_increasing_id()))


def _matrix(column) -> np.ndarray:
    """An Arrow column of equal-length lists as a matrix of doubles."""
    if hasattr(column, "combine_chunks"):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _augmented(m: np.ndarray, largest: float) -> np.ndarray:
    """Points with the extra coordinate sqrt(largest - |v|^2)."""
    extra = np.sqrt(np.maximum(largest - (m * m).sum(axis=1), 0))
    return np.concatenate([m, extra[:, None]], axis=1)


def _moments(points: DataFrame) -> tuple[np.ndarray, float, np.ndarray] | None:
    """Mean, largest squared norm and covariance of all augmented points."""
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    largest = points.agg(F.max(square)).first()[0]
    if largest is None:
        return None

    def local(batches: Iterator) -> Iterator:
        import pyarrow as pa
        total = None
        rows = 0
        for batch in batches:
            if batch.num_rows:
                x = _augmented(_matrix(batch.column(0)), largest)
                s = np.concatenate([x.sum(axis=0), (x.T @ x).ravel()])
                total = s if total is None else total + s
                rows += len(x)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64())),
                                              pa.array([float(rows)], pa.float64())], ["vec", "weight"])

    parts = sum_arrays(points.select("v").mapInArrow(local, "vec array<double>, weight double")).collect()
    total, n = np.sum([np.asarray(p[0]) for p in parts], axis=0), sum(p[1] for p in parts)
    d = int(math.isqrt(len(total)))  # d + d * d numbers
    mean = total[:d] / n
    return mean, float(largest), total[d:].reshape(d, d) / n - np.outer(mean, mean)


def curve_keys(points: DataFrame, moments, curves: int, seed: int) -> DataFrame:
    """curve, key, id, query for rows (id, v, query).

    The extra coordinate turns the largest inner product into the nearest point
    for any multiple of a query and any extra coordinate of it; a query gets the
    points' mean square norm and mean extra coordinate, which puts it among them.
    """
    mean, largest, covariance = moments
    d = len(mean)
    dims = min(DIMS, d)
    rng = np.random.default_rng(seed)
    planes = []
    for _ in range(curves):
        plane = np.linalg.qr(covariance @ rng.normal(size=(d, dims)))[0]
        spread = math.sqrt(max(float(np.mean(np.diag(plane.T @ covariance @ plane))), 0.0)) or 1.0
        planes.append((plane / spread, rng.uniform(-0.5, 0.5, dims)))
    radius = math.sqrt(max(float((np.diag(covariance) + mean ** 2)[:-1].sum()), 0.0))

    def local(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            ids, m, query = batch.column(0), _matrix(batch.column(1)), batch.column(2).to_numpy(zero_copy_only=False)
            if not len(ids):
                continue
            x = _augmented(m, largest)
            norms = np.sqrt((m * m).sum(axis=1))
            asked = np.concatenate([m * (radius / norms)[:, None], np.full((len(m), 1), mean[-1])], axis=1)
            x = np.where(query[:, None], asked, x) - mean
            for c, (plane, shift) in enumerate(planes):
                y = (x @ plane + shift) / REACH + 0.5
                key = hilbert_keys(np.clip(y * (1 << BITS), 0, (1 << BITS) - 1), BITS)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), c, np.int32)), pa.array(key), ids, batch.column(2)],
                                                 ["curve", "key", "id", "query"])

    return points.select("id", "v", "query").mapInArrow(local, "curve int, key long, id long, query boolean")


def coded(points: DataFrame) -> DataFrame:
    """id, code, scale: each vector as 16-bit integers, its largest component
    being CODE, and what one step of it is worth."""
    def pack(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            m = _matrix(batch.column(1))
            if not len(m):
                continue
            scale = np.abs(m).max(axis=1) / CODE
            scale = np.where(scale > 0, scale, 1.0)  # components too small to divide
            codes = np.clip(np.rint(m / scale[:, None]), -CODE, CODE).astype("<i2")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(scale)],
                                             ["id", "code", "scale"])

    return points.select("id", "v").mapInArrow(pack, "id long, code binary, scale double")


def _codes(column) -> np.ndarray:
    """A column of codes as a matrix of doubles."""
    flat = np.frombuffer(b"".join(column.to_pylist()), dtype="<i2")
    return flat.reshape(len(column), -1).astype(np.float64)


def ranked(keys: DataFrame) -> DataFrame:
    """curve, id, query, rank: places among the data points of each curve.

    Rows are range-partitioned by (curve, key); each task numbers what it
    streams and the counts of (task, curve) give the offsets.
    """
    def number(batches: Iterator) -> Iterator:
        import pyarrow as pa
        seen: dict[int, int] = {}
        for batch in batches:
            curve = batch.column(0).to_numpy()
            data = ~batch.column(3).to_numpy(zero_copy_only=False)
            rank = np.empty(len(curve), dtype=np.int64)
            for c in np.unique(curve):
                own = curve == c
                upto = np.cumsum(data[own])
                rank[own] = seen.get(int(c), 0) + upto - data[own]
                seen[int(c)] = seen.get(int(c), 0) + int(upto[-1])
            yield pa.RecordBatch.from_arrays([batch.column(4), batch.column(0), batch.column(2), batch.column(3), pa.array(rank)],
                                             ["part", "curve", "id", "query", "local"])

    local = staged(keys.repartitionByRange("curve", "key", "query", "id").sortWithinPartitions("curve", "key", "query", "id")
                   .select("curve", "key", "id", "query", F.spark_partition_id().alias("part"))
                   .mapInArrow(number, "part int, curve int, id long, query boolean, local long"))
    counts = local.filter(~F.col("query")).groupBy("curve", "part").agg(F.count("*").alias("n"))
    parts = local.select("curve", "part").distinct()
    before = W.partitionBy("curve").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (parts.join(counts, ["curve", "part"], "left")
               .withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))).select("curve", "part", "first"))
    # one row a (curve, task): bounded by curves x shuffle partitions
    return (local.join(F.broadcast(offsets), ["curve", "part"])
            .select("curve", "id", "query", (F.col("first") + F.col("local")).alias("rank")))


def exact(queries: DataFrame, points: DataFrame, k: int) -> DataFrame:
    """Brute force: id, near, score for a bounded set of queries (collected)."""
    rows = queries.collect()
    ids = np.array([r[0] for r in rows], dtype=np.int64)
    q = np.array([r[1] for r in rows], dtype=np.float64)

    def local(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            own, m = batch.column(0).to_numpy(), _matrix(batch.column(1))
            if not len(own) or not len(ids):
                continue
            s = q @ m.T
            s[ids[:, None] == own[None, :]] = -np.inf
            top = np.argsort(-s, axis=1, kind="stable")[:, :k]
            keep = np.take_along_axis(s, top, axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids, top.shape[1])), pa.array(own[top].ravel()), pa.array(keep.ravel())],
                ["id", "near", "score"])

    best = W.partitionBy("id").orderBy(F.col("score").desc(), "near")
    return (points.select("id", "v").mapInArrow(local, "id long, near long, score double")
            .filter(F.col("score") > float("-inf"))
            .withColumn("rk", F.row_number().over(best)).filter(F.col("rk") <= k).drop("rk"))


def window_width(ranks: DataFrame, truth: DataFrame, recall: float) -> int:
    """The half width at which the sampled queries' true neighbours are found
    on some curve with the given recall."""
    near = ranks.filter(~F.col("query")).select("curve", F.col("id").alias("near"), F.col("rank").alias("at"))
    mine = ranks.filter("query").select("curve", "id", "rank")
    gaps = (truth.join(mine, "id").join(near, ["curve", "near"])
            .groupBy("id", "near").agg(F.min(F.abs(F.col("rank") - F.col("at"))).alias("gap")))
    found = sorted(r[0] for r in gaps.select("gap").collect())  # SAMPLE * k numbers
    return int(found[min(len(found) - 1, math.ceil(recall * len(found)))]) + 1 if found else 1


def block_of(width: int) -> tuple[int, int]:
    """Points of a block, and blocks that a window reaches on either side."""
    block = max(LEAST_BLOCK, min(MOST_BLOCK, math.ceil(width / 2)))
    return block, math.ceil(width / block)


def search(vectors: DataFrame, k: int = 20, every: int = 20, curves: int = CURVES, sample: int = SAMPLE,
           recall: float = RECALL, seed: int = 23, report: dict | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query row
    (vec_id divisible by ``every``).  ``report`` is given the points, the window's
    half width and the share of the points that a query's windows add up to."""
    rows = usable(vectors)
    order = W.partitionBy("v").orderBy("vec_id", "row")
    # the group limit runs before the shuffle: a hot vector moves k + 1 rows a task
    smallest = rows.withColumn("rk", F.row_number().over(order)).filter(F.col("rk") <= k + 1)
    points, counted = staged_with(
        smallest.groupBy("v").agg(F.array_sort(F.collect_list(F.struct("vec_id", "row"))).alias("ids"))
        .select(F.get("ids", F.lit(0))["row"].alias("id"), "ids", "v"), F.count("*").alias("n"))
    asked = staged(rows.filter(F.col("vec_id") % every == 0).join(points.select("v", "id"), "v").select("vec_id", "row", "id"))
    discard(rows)
    vectors_asked = staged(points.join(asked.select("id").distinct(), "id", "left_semi").select("id", "v"))
    moments = _moments(points)
    if moments is None:
        return asked.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    both = (points.select("id", "v", F.lit(False).alias("query"))
            .unionByName(vectors_asked.withColumn("query", F.lit(True))))
    ranks = staged(ranked(curve_keys(both, moments, curves, seed)))
    truth = exact(vectors_asked.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(sample), points, k)
    width = window_width(ranks, truth, recall)
    block, span = block_of(width)
    if report is not None:
        report.update(points=counted["n"], width=width, share=curves * (2 * width + 1) / max(counted["n"], 1))

    placed = ranks.withColumn("block", F.floor(F.col("rank") / block))
    reached = placed.filter("query").withColumn("block", F.explode(F.sequence(F.col("block") - span, F.col("block") + span)))
    # empty on most data; written, so Spark knows its size when it plans the joins
    crowded = staged(reached.groupBy("curve", "block").count().filter(F.col("count") > MOST_QUERIES)
                     .select("curve", "block", F.ceil(F.col("count") / MOST_QUERIES).alias("parts")))
    parts = F.coalesce("parts", F.lit(1).cast("long"))
    data = (placed.filter(~F.col("query")).join(crowded, ["curve", "block"], "left")
            .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
            .join(coded(points), "id").select("curve", "block", "part", "id", "rank", "code", "scale"))
    wanted = (reached.join(crowded, ["curve", "block"], "left")
              .withColumn("part", F.pmod(F.xxhash64("id"), parts)).join(coded(vectors_asked), "id")
              .select(*[F.col(c).alias(f"q_{c}") for c in ("curve", "block", "part", "id", "rank", "code")]))

    def rerank(key, left, right):
        import pyarrow as pa
        schema = pa.schema([("id", pa.int64()), ("near", pa.list_(pa.int64())), ("score", pa.list_(pa.float64()))])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        ids, near = left.column("q_id").to_numpy(), right.column("id").to_numpy()
        at_q, at = left.column("q_rank").to_numpy(), right.column("rank").to_numpy()
        asked_codes, codes, scale = _codes(left.column("q_code")), _codes(right.column("code")), right.column("scale").to_numpy()
        take = min(k + 1 + SPARE, len(near))
        out_ids, out_scores = [], []
        for lo in range(0, len(ids), SLICE):
            # products of codes are whole numbers below 2^53: the same in every block
            s = asked_codes[lo:lo + SLICE] @ codes.T * scale[None, :]
            s[np.abs(at_q[lo:lo + SLICE, None] - at[None, :]) > width] = -np.inf
            top = np.argpartition(-s, take - 1, axis=1)[:, :take]
            # a tie at the edge keeps the smallest ids
            edge = np.take_along_axis(s, top, axis=1).min(axis=1)
            for row, least in zip(s, edge):
                found = np.flatnonzero((row >= least) & (row > -np.inf))
                found = found[np.lexsort((near[found], -row[found]))][:take]
                out_ids.append(near[found])
                out_scores.append(row[found])
        return pa.table([pa.array(ids), pa.array(out_ids, pa.list_(pa.int64())), pa.array(out_scores, pa.list_(pa.float64()))], schema=schema)

    hits = (wanted.groupBy("q_curve", "q_block", "q_part").cogroup(data.groupBy("curve", "block", "part"))
            .applyInArrow(rerank, "id long, near array<long>, score array<double>"))
    pairs = (hits.select("id", F.explode(F.arrays_zip("near", "score")).alias("p"))
             .groupBy("id", F.col("p.near").alias("near")).agg(F.max("p.score").alias("score")))
    few = W.partitionBy("id").orderBy(F.col("score").desc(), "near")
    best = pairs.withColumn("rk", F.row_number().over(few)).filter(F.col("rk") <= k + 1 + SPARE)
    copies = points.select(F.col("id").alias("near"), "ids", F.col("v").alias("near_v"))
    # the score that is returned: products added in the order of the components
    found = (best.select("id", "near").join(copies, "near").join(vectors_asked, "id")
             .withColumn("score", F.aggregate(F.zip_with("v", "near_v", lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda t, x: t + x)))
    wide = found.select("id", "score", F.explode("ids").alias("one")).select("id", "score", "one.vec_id", "one.row")
    first = W.partitionBy("id").orderBy(F.col("score").desc(), "vec_id", "row")
    top = wide.withColumn("rk", F.row_number().over(first)).filter(F.col("rk") <= k + 1)
    lists = top.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("rk", "vec_id", "row", "score"))).alias("near"))
    own = asked.select(F.col("vec_id").alias("query_id"), "row", "id").join(lists, "id")
    kept = F.slice(F.filter("near", lambda n: n["row"] != F.col("row")), 1, k)
    return (own.select("query_id", F.posexplode(kept).alias("pos", "n"))
            .select("query_id", (F.col("pos") + 1).alias("rank"), F.col("n.vec_id").alias("vec_id"),
                    F.col("n.score").alias("score")))
