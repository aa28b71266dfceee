"""SimHash near-dedup by a self-join of binary tries.

Method.  A document's fingerprint has 64 bits; its path in a binary trie is its
bits from the first to the last.  The self-join walks pairs of nodes of one
depth together, starting with the root and itself: a pair's children are the
pairs of its nodes' children, each differing bit uses up one of ``ERRORS``, and
a pair above that budget is dropped with everything below it.

To deal the walk out, the bits are cut into five blocks.  Fingerprints that
differ in three bits or fewer agree in two whole blocks at least, so each of
the ten pairs of blocks gives a trie whose bits start with these two, and its
walk may start at depth 25 or 26 with the nodes paired with themselves.  Spark
brings the fingerprints of a node together.  A node pair that holds too many is
walked six levels deeper in Spark, by sending each fingerprint to the child
pairs within the budget, until every pair is small; tasks walk the rest, many
node pairs at once, in pieces of bounded size.  A task returns each fingerprint
with the first one it reaches inside its node pair, so never all pairs of a
group, and Spark's components join these links.  Equal fingerprints are one
node throughout.  All fingerprints of a node pair are distinct, so one of them
has at most 9,178 partners there, however large the group.

Defined cases: null, empty or wordless text has fingerprint 0 and is linked
like any other; fewer than three words are one shingle; repeated rows have
equal fingerprints; a null doc_id names no component unless it is alone in it
(then component_id is null); an empty table gives an empty result; extra
columns are ignored.  Very long texts are hashed in runs of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations, islice

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import components, discard, looked_up, staged

#: Words of a shingle, seed of its hash, and differing bits that still link.
SHINGLE, SEED, ERRORS = 3, 42, 3
#: Bits of the blocks; ERRORS differing bits leave two of the five alone.
BLOCKS = (13, 13, 13, 13, 12)
#: The tries: each is an order of the blocks, starting with the two that agree.
TRIES = tuple((i, j, *[k for k in range(len(BLOCKS)) if k not in (i, j)])
              for i, j in combinations(range(len(BLOCKS)), len(BLOCKS) - ERRORS))
#: Fingerprints of a node pair that one task walks, or this share of all of them
#: if that is more (so the larger pairs, which tasks are told, are few).
LIMIT, SHARE = 4096, 65536
#: Levels by which a large node pair is walked in Spark.
STEP = 6
#: Node pairs walked at once, and shingle hashes counted at once.
FRONTIER, RUN = 1 << 17, 1 << 16


def fingerprint(text: str | None) -> int:
    """The text's fingerprint; bit i is set if over half the shingles' hashes have it."""
    import xxhash
    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: ASCII only
    if not words:
        return 0
    whole = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words), initial=0))
    k = min(SHINGLE, len(words))
    hashes = (xxhash.xxh64_intdigest(whole[s:e - 1], SEED) for s, e in zip(ends, ends[k:]))
    votes = np.zeros(64, dtype=np.int64)
    n = 0
    while len(run := np.fromiter(islice(hashes, RUN), dtype="<u8")):
        votes += np.unpackbits(run.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(run)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the 64 bits as a long) of every row."""
    def local(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            fp = np.array([fingerprint(t.as_py()) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(local, "doc_id long, fp long")


def _shift(block: int) -> int:
    return 64 - sum(BLOCKS[:block + 1])


def path(fp: Column, trie: int) -> Column:
    """The fingerprint's bits in the order of a trie."""
    out, at = F.lit(0).cast("long"), 64
    for block in TRIES[trie]:
        at -= BLOCKS[block]
        bits = F.shiftrightunsigned(fp, _shift(block)).bitwiseAND(F.lit((1 << BLOCKS[block]) - 1).cast("long"))
        out = out.bitwiseOR(F.shiftleft(bits, at))
    return out


def unpath(v: np.ndarray, trie: np.ndarray) -> np.ndarray:
    """Fingerprints of paths, the inverse of ``path``."""
    out = np.zeros_like(v)
    for t, order in enumerate(TRIES):
        of, at = trie == t, 64
        part = v[of]
        fp = np.zeros_like(part)
        for block in order:
            at -= BLOCKS[block]
            bits = (part >> np.uint64(at)) & np.uint64((1 << BLOCKS[block]) - 1)
            fp |= bits << np.uint64(_shift(block))
        out[of] = fp
    return out


def start(nodes: DataFrame) -> DataFrame:
    """trie, depth, a, b, side, v: every fingerprint at its first node of each
    trie, paired with itself.  ``a`` and ``b`` are the pair's prefixes, ``side``
    tells which of them ``v`` is below (0 where they are the same)."""
    items = []
    for t, order in enumerate(TRIES):
        depth = BLOCKS[order[0]] + BLOCKS[order[1]]
        v = path(F.col("fp"), t)
        node = F.shiftrightunsigned(v, 64 - depth)
        items.append(F.struct(F.lit(t).alias("trie"), F.lit(depth).alias("depth"), node.alias("a"), node.alias("b"),
                              F.lit(0).alias("side"), v.alias("v")))
    return nodes.select(F.explode(F.array(*items)).alias("i")).select("i.*")


PAIR = ["trie", "depth", "a", "b"]


def deeper(items: DataFrame) -> DataFrame:
    """The items of node pairs, dealt to the pairs STEP levels below that are
    within the budget."""
    step = F.least(F.lit(STEP), 64 - F.col("depth"))
    down = F.expr(f"shiftrightunsigned(v, 64 - depth - least({STEP}, 64 - depth))")
    own = down.bitwiseAND(F.expr(f"shiftleft(1L, least({STEP}, 64 - depth)) - 1"))
    spent = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    others = F.sequence(F.lit(0).cast("long"), F.expr(f"shiftleft(1L, least({STEP}, 64 - depth)) - 1"))
    rows = (items.withColumns({"own": own, "step": step, "spent": spent})
            .withColumn("other", F.explode(F.filter(others, lambda y: F.bit_count(F.col("own").bitwiseXOR(y)) + F.col("spent") <= ERRORS))))
    same = F.col("a") == F.col("b")
    first = F.when(same, F.least("own", "other")).when(F.col("side") == 0, F.col("own")).otherwise(F.col("other"))
    second = F.when(same, F.greatest("own", "other")).when(F.col("side") == 0, F.col("other")).otherwise(F.col("own"))
    side = F.when(same, (F.col("own") > F.col("other")).cast("int")).otherwise(F.col("side"))
    below = lambda node, bits: F.expr(f"shiftleft({node}, step)").bitwiseOR(bits)
    return rows.select("trie", (F.col("depth") + F.col("step")).alias("depth"), below("a", first).alias("a"),
                       below("b", second).alias("b"), side.alias("side"), "v")


def node_pairs(nodes: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The items of all node pairs, none of which holds more than the limit."""
    live, done = start(nodes), None
    while True:
        sizes = staged(live.groupBy(*PAIR).agg(F.count("*").alias("n"), F.sum("side").alias("right"))
                       .filter(((F.col("a") == F.col("b")) & (F.col("n") > 1)) | ((F.col("right") > 0) & (F.col("right") < F.col("n")))))
        total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        most = max(limit, total // SHARE)
        # fewer than SHARE pairs hold more than total / SHARE
        large = staged(sizes.filter((F.col("n") > most) & (F.col("depth") < 64)).select(*PAIR))
        some = large.limit(1).count() > 0
        rest = live.join(sizes.filter((F.col("n") <= most) | (F.col("depth") >= 64)).select(*PAIR), PAIR, "left_semi")
        done = rest if done is None else done.unionByName(rest)
        if not some:
            return done
        live = staged(deeper(live.join(F.broadcast(large), PAIR, "left_semi")))


def _split(v: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """For each sorted run v[lo:hi] of one prefix, where the bit becomes 1."""
    lo, hi = lo.copy(), hi.copy()
    one = np.uint64(1)
    while len(todo := np.flatnonzero(lo < hi)):
        mid = (lo[todo] + hi[todo]) // 2
        set_ = ((v[mid] >> bit[todo]) & one).astype(bool)
        hi[todo[set_]] = mid[set_]
        lo[todo[~set_]] = mid[~set_] + 1
    return lo


def _pairs(v: np.ndarray, frontier: tuple[np.ndarray, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indexes of the linked pairs below node pairs (a run, b run, depth, errors).

    A node is a run of the sorted paths ``v``; a node paired with itself has
    equal runs.  The walk goes down one level at a time, in pieces of at most
    FRONTIER node pairs, the rest waiting on a stack.
    """
    stack = [frontier]
    while stack:
        a0, a1, b0, b1, depth, err = stack.pop()
        if len(a0) > FRONTIER:
            half = len(a0) // 2
            stack += [tuple(x[half:] for x in (a0, a1, b0, b1, depth, err)), tuple(x[:half] for x in (a0, a1, b0, b1, depth, err))]
            continue
        same = a0 == b0
        leaf = ~same & (a1 - a0 == 1) & (b1 - b0 == 1)
        if leaf.any():
            i, j = a0[leaf], b0[leaf]
            near = np.bitwise_count(v[i] ^ v[j]) <= ERRORS
            yield i[near], j[near]
        walk = ~leaf & ~(same & (a1 - a0 == 1))
        if not walk.any():
            continue
        a0, a1, b0, b1, depth, err, same = (x[walk] for x in (a0, a1, b0, b1, depth, err, same))
        bit = (63 - depth).astype(np.uint64)
        am = _split(v, a0, a1, bit)
        bm = np.where(same, am, 0)
        bm[~same] = _split(v, b0[~same], b1[~same], bit[~same])
        # children: both 0, both 1, 0 and 1; and 1 and 0, which a node with itself has already
        p0 = np.concatenate([a0, am, a0, am[~same]])
        p1 = np.concatenate([am, a1, am, a1[~same]])
        q0 = np.concatenate([b0, bm, bm, b0[~same]])
        q1 = np.concatenate([bm, b1, b1, bm[~same]])
        e = np.concatenate([err, err, err + 1, err[~same] + 1])
        d = np.concatenate([depth, depth, depth, depth[~same]]) + 1
        live = (p0 < p1) & (q0 < q1) & (e <= ERRORS)
        if live.any():
            stack.append((p0[live], p1[live], q0[live], q1[live], d[live], e[live]))


def _join(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Merge the classes of i and j; a label is the least index of its class."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label[:] = label[label]


def trie_links(pairs: DataFrame) -> DataFrame:
    """a, b: fingerprints that reach each other inside a node pair, each with
    the first of its class.  ``pairs`` has trie, depth, left and right (paths;
    right is empty where a node is paired with itself)."""
    def local(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            depth = batch.column(1).to_numpy()
            sides, runs = [], []
            for c in (2, 3):
                col = batch.column(c)
                runs.append(np.diff(col.offsets.to_numpy()))
                sides.append(col.flatten().to_numpy().view(np.uint64))
            # a row's left paths, then its right ones, each run sorted
            rows = batch.num_rows
            order = np.concatenate([np.repeat(np.arange(rows) * 2, runs[0]), np.repeat(np.arange(rows) * 2 + 1, runs[1])])
            v = np.concatenate(sides)
            by = np.lexsort((v, order))
            v, run = v[by], order[by]
            at = np.searchsorted(run, np.arange(2 * rows + 1))
            a0, a1, b0, b1 = at[0:-1:2], at[1::2], at[1::2], at[2::2]
            alone = b0 == b1
            spent = np.zeros(rows, dtype=np.int64)
            cross = ~alone
            up = (64 - depth[cross]).astype(np.uint64)
            spent[cross] = np.bitwise_count((v[a0[cross]] ^ v[b0[cross]]) >> np.minimum(up, np.uint64(63))) * (up < 64)
            label = np.arange(len(v))
            for i, j in _pairs(v, (a0, a1, np.where(alone, a0, b0), np.where(alone, a1, b1), depth.astype(np.int64), spent)):
                _join(label, i, j)
            moved = np.flatnonzero(label != np.arange(len(v)))
            trie = batch.column(0).to_numpy()[run // 2]
            a, b = unpath(v[moved], trie[moved]), unpath(v[label[moved]], trie[moved])
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return pairs.select("trie", "depth", "left", "right").mapInArrow(local, "a long, b long")


def near_duplicates(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, fingerprint, component_id of every row."""
    marked = staged(fingerprints(docs))
    nodes = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("held")))
    found = (node_pairs(nodes.select("fp"), limit).groupBy(*PAIR)
             .agg(F.collect_list(F.when(F.col("side") == 0, F.col("v"))).alias("left"),
                  F.collect_list(F.when(F.col("side") == 1, F.col("v"))).alias("right")))
    links = staged(trie_links(found).distinct())
    comp = components(links)
    discard(links)
    of_node = nodes.join(comp, nodes["fp"] == comp["key"], "left").withColumn("comp", F.coalesce("comp", "fp"))
    names = of_node.groupBy("comp").agg(F.min("least").alias("component_id"))
    named = staged(of_node.select("fp", "held", "comp").join(names, "comp").select("fp", "held", "component_id"))
    return (looked_up(marked, named, "fp", "held")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))
