"""Mixing sources to target weights by a hypergeometric splitting tree.

Method.  Each source's documents are dealt into permuted blocks by a seeded
hash.  Whole passes over a source and a prefix of its permuted blocks make up
its exact quota of block units.  A binary tree splits the vector of quotas
over the output shards: at each node the left half receives a multivariate
hypergeometric draw (units drawn one by one without replacement, with hash
uniforms, so reruns agree) and the right half keeps the rest, so the quotas of
the leaves add up exactly.  Each leaf then takes its own disjoint run of the
source's permuted units, and rows are shuffled inside the shard only.  The mix
itself (``mixed_rows``) cuts no text: a document at the edge of a quota is taken
whole or not at all, whichever is nearer to the target.

Only DataFrame functions run on the data path.  The tables of sources, blocks
and tree nodes are small by construction: at most ``max_blocks`` blocks plus
one a source, whatever the input.

Defined cases: null text has size 0; a null source is a source of its own and
sorts last; documents of size 0 take 0; repeated rows are separate documents;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from clientele.functions.lookup import lookup
from clientele.llm.common import staged

#: Weights given in turn to the sources in code-point order.
WEIGHTS = (3, 1, 2)
#: Words to share out, as a part of all words.
SHARE = 1.5
#: Largest multiple of its own size that a source's target may reach.
MOST = 2.0
#: Blocks into which all sources together are dealt.
MAX_BLOCKS = 8192
#: Levels of the splitting tree: 2^5 output shards.
LEVELS = 5


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def sized(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, source, size, key (the row's place in the permutation)."""
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                       F.xxhash64(F.lit(seed), "doc_id", "source", "text").alias("key"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
            most: float = MOST) -> DataFrame:
    """source, idx, source_size, weight, target: one row a source.

    Water filling: with sources ordered by cap / weight, a source is capped if
    the level that would serve it and all later ones reaches its cap.  The
    windows run over one row a source, never over documents.
    """
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    src = (src.withColumn("idx", F.row_number().over(order) - 1)
           .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                              (F.col("idx") % len(weights) + 1).cast("int")))
           .withColumn("cap", F.col("source_size") * F.lit(most)))
    every = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = W.orderBy(F.col("cap") / F.col("weight"), "idx")
    before = level.rowsBetween(W.unboundedPreceding, -1)
    onward = level.rowsBetween(W.currentRow, W.unboundedFollowing)
    src = (src.withColumn("total", F.sum("source_size").over(every) * F.lit(share))
           .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
           .withColumn("lambda", F.col("left") / F.sum("weight").over(onward))
           .withColumn("capped", F.col("lambda") * F.col("weight") >= F.col("cap")))
    fill = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), "idx", "lambda"))).over(every)
    return (src.withColumn("fill", fill["lambda"])
            .withColumn("target", F.when(F.col("fill").isNull(), F.col("cap"))
                        .otherwise(F.least("cap", F.col("fill") * F.col("weight"))))
            .select("source", "idx", "source_size", "weight", "target"))


def _uniform(*parts: Column | str) -> Column:
    """A hash of the parts as a double in [0, 1)."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(1 << 53))


def split_tree(quotas: DataFrame, levels: int, seed: int) -> DataFrame:
    """idx, shard, units: the quotas (idx, units) split over 2^levels shards."""
    node = quotas.filter(F.col("units") > 0).agg(
        F.array_sort(F.collect_list(F.struct("idx", "units"))).alias("q")).withColumn("node", F.lit(1).cast("long"))
    for _ in range(levels):
        size = F.aggregate("q", F.lit(0).cast("long"), lambda a, s: a + s["units"])
        start = F.struct((F.floor((size + 1) / 2)).cast("long").alias("n"), size.alias("all"),
                         F.array().cast("array<bigint>").alias("out"))

        def draw(acc: Column, s: Column) -> Column:
            # units of this source, one by one: in with probability n / all
            one = F.struct(acc["n"].alias("n"), acc["all"].alias("all"), F.lit(0).cast("long").alias("x"))

            def unit(a: Column, j: Column) -> Column:
                u = _uniform(F.lit(seed), F.col("node"), s["idx"], j)
                take = (u * a["all"] < a["n"]).cast("long")
                return F.struct((a["n"] - take).alias("n"), (a["all"] - 1).alias("all"), (a["x"] + take).alias("x"))

            got = F.when(s["units"] > 0, F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(s["units"], F.lit(1))), one, unit)).otherwise(one)
            return F.struct(got["n"].alias("n"), got["all"].alias("all"),
                            F.concat(acc["out"], F.array(got["x"])).alias("out"))

        node = node.withColumn("l", F.aggregate("q", start, draw, lambda a: a["out"]))
        left = F.zip_with("q", "l", lambda s, x: F.struct(s["idx"].alias("idx"), x.alias("units")))
        right = F.zip_with("q", "l", lambda s, x: F.struct(s["idx"].alias("idx"), (s["units"] - x).alias("units")))
        node = node.select(F.explode(F.array(
            F.struct((F.col("node") * 2).alias("node"), left.alias("q")),
            F.struct((F.col("node") * 2 + 1).alias("node"), right.alias("q")))).alias("c")).select("c.node", "c.q")
    return (node.select((F.col("node") - (1 << levels)).cast("int").alias("shard"), F.explode("q").alias("s"))
            .select(F.col("s.idx").alias("idx"), "shard", F.col("s.units").alias("units")))


def block_plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST,
               max_blocks: int = MAX_BLOCKS, levels: int = LEVELS, seed: int = 20240607
               ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sized rows; the sources with their targets and numbers of blocks; and
    for every block with words what the mix takes of it.

    The plan's turns (turn, shard) are one for each time the block is drawn.
    """
    base = staged(sized(docs, seed))
    src = staged(targets(base, weights, share, most).withColumn("quota", F.round("target").cast("long")))
    total = src.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    block_words = max(1, -(-total // max_blocks))
    src = src.withColumn("blocks", F.greatest(F.lit(1).cast("long"), F.ceil(F.col("source_size") / F.lit(block_words)).cast("long")))
    rows = placed(base, src, seed)
    blocks = (rows.filter(F.col("size") > 0).groupBy("idx", "block")
              .agg(F.sum("size").alias("words"), F.first("quota").alias("quota"),
                   F.first("source_size").alias("source_size"))
              .withColumn("full", F.least(F.lit(int(most)), F.floor(F.col("quota") / F.col("source_size"))).cast("long"))
              .withColumn("rest", F.col("quota") - F.col("full") * F.col("source_size")))
    permuted = W.partitionBy("idx").orderBy(F.xxhash64(F.lit(seed + 2), "idx", "block"), "block")
    upto = permuted.rowsBetween(W.unboundedPreceding, W.currentRow)
    blocks = staged(blocks.withColumn("place", F.row_number().over(permuted).cast("long"))
                    .withColumn("before", F.sum("words").over(upto) - F.col("words"))
                    .withColumn("extra", (F.col("before") < F.col("rest")).cast("long"))
                    .withColumn("units", F.col("full") + F.col("extra")))
    # Units of a source in permuted order: pass by pass, block by block.
    units = (blocks.filter(F.col("units") > 0)
             .select("idx", "block", "place", F.explode(F.sequence(F.lit(1).cast("long"), F.col("units"))).alias("turn"))
             .withColumn("rank", F.row_number().over(W.partitionBy("idx").orderBy(
                 F.xxhash64(F.lit(seed + 3), "idx", "block", "turn"), "block", "turn")).cast("long")))
    quotas = blocks.groupBy("idx").agg(F.sum("units").alias("units"))
    leaves = split_tree(quotas, levels, seed + 4).filter(F.col("units") > 0)
    last = F.sum("units").over(W.partitionBy("idx").orderBy("shard").rowsBetween(W.unboundedPreceding, W.currentRow))
    runs = (leaves.withColumn("end", last)
            .select("idx", "shard", F.explode(F.sequence(F.col("end") - F.col("units") + 1, F.col("end"))).alias("rank")))
    dealt = (units.join(runs, ["idx", "rank"]).groupBy("idx", "block")
             .agg(F.array_sort(F.collect_list(F.struct("turn", "shard"))).alias("turns")))  # at most MOST + 1 a block
    return base, src, blocks.select("idx", "block", "full", "rest", "before", "words", "extra").join(dealt, ["idx", "block"], "left")


def placed(base: DataFrame, src: DataFrame, seed: int) -> DataFrame:
    """Sized rows with their source's columns and their block.  ``src`` has one
    row a source: AQE broadcasts it when small and splits hot sources when not."""
    return (base.join(src, base["source"].eqNullSafe(src["source"]))
            .select("doc_id", base["source"], "key", "size", "idx", "source_size", "target", "quota",
                    F.pmod(F.xxhash64(F.lit(seed + 1), "key"), F.col("blocks")).alias("block")))


def _at_edge() -> Column:
    """Whether the quota of the source ends inside the block."""
    return (F.col("extra") == 1) & (F.col("before") + F.col("words") > F.col("rest")) & (F.col("size") > 0)


def mix(docs: DataFrame, seed: int = 20240607, whole: bool = False, **options) -> DataFrame:
    """doc_id, source, key, size, source_size, target, taken, passes per row.

    ``taken``: words the mix takes, repeats counted; a document at the edge of
    its source's quota is taken in part, or with ``whole`` either whole or not
    (repeated rows as one), as is nearer to the quota.  ``passes``: array of (shard, order,
    words), one for each time the document is drawn.
    """
    base, src, plan = block_plan(docs, seed=seed, **options)
    rows = placed(base, src, seed)
    out = rows.join(plan, ["idx", "block"], "left")
    # Only a quota's edge block needs its documents in order: one block a source.
    edge = _at_edge()
    left = F.col("rest") - F.col("before") - F.col("prior")
    in_order = W.partitionBy("idx", "block")
    if whole:
        same = F.sum("size").over(W.partitionBy("idx", "block", "key"))
        prior = F.sum("size").over(in_order.orderBy("key").rangeBetween(W.unboundedPreceding, W.currentRow)) - same
        part = F.when(2 * left >= same, F.col("size")).otherwise(F.lit(0).cast("long"))
    else:
        prior = F.sum("size").over(in_order.orderBy("key", "doc_id").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("size")
        part = F.greatest(F.lit(0).cast("long"), F.least("size", left))
    inside = out.filter(edge).withColumn("prior", prior).withColumn("part", part)
    others = (out.filter(~F.coalesce(edge, F.lit(False)))
              .withColumn("prior", F.lit(0).cast("long"))
              .withColumn("part", F.when((F.col("extra") == 1) & (F.col("size") > 0), F.col("size")).otherwise(F.lit(0).cast("long"))))
    out = others.unionByName(inside)
    words = lambda t: F.when(t["turn"] <= F.col("full"), F.col("size")).otherwise(F.col("part"))
    passes = F.filter(F.transform(F.coalesce("turns", F.array().cast("array<struct<turn:bigint,shard:int>>")), lambda t: F.struct(
        t["shard"].alias("shard"), F.xxhash64(F.lit(seed + 5), t["shard"], t["turn"], F.col("key")).alias("order"),
        words(t).alias("words"))), lambda p: p["words"] > 0)
    return (out.withColumn("passes", F.when(F.col("size") > 0, passes).otherwise(F.array().cast("array<struct<shard:int,order:bigint,words:bigint>>")))
            .withColumn("taken", F.aggregate("passes", F.lit(0).cast("long"), lambda a, p: a + p["words"]))
            .select("doc_id", "source", "key", "size", "source_size", "target", "taken", "passes"))


def mixed_rows(docs: DataFrame, seed: int = 20240607, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, unchanged, once for each time they
    are drawn, in ranges of the output shards and shuffled inside each shard.

    A document at the edge of a quota is drawn whole or not (repeated rows as
    one), as is nearer to the quota.  As what is left falls in the order of the
    keys, the drawn ones of an edge block are those up to one key, so a row's
    block and key decide, and the texts move once, into the ranges.
    """
    base, src, plan = block_plan(docs, seed=seed, **options)
    edges = plan.filter((F.col("extra") == 1) & (F.col("before") + F.col("words") > F.col("rest")))
    keys = (placed(base, src, seed).filter("size > 0").groupBy("idx", "block", "key").agg(F.sum("size").alias("same"))
            .join(edges.select("idx", "block", "rest", "before"), ["idx", "block"]))  # one block a source
    prior = F.sum("same").over(W.partitionBy("idx", "block").orderBy("key").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("same")
    last = (keys.withColumn("prior", prior).filter(2 * (F.col("rest") - F.col("before") - F.col("prior")) >= F.col("same"))
            .groupBy("idx", "block").agg(F.max("key").alias("last")))
    none = F.array().cast("array<struct<turn:bigint,shard:int>>")
    at_edge = (F.col("before") + F.col("words") > F.col("rest")) & (F.col("extra") == 1)
    plan = plan.join(last, ["idx", "block"], "left").select(
        _place(F.col("idx"), F.col("block")).alias("place"), "full", at_edge.alias("edge"), "last", F.coalesce("turns", none).alias("turns"))

    size = word_count(F.col("doc.text"))
    key = F.xxhash64(F.lit(seed), "doc.doc_id", "doc.source", "doc.text")
    rows = docs.select(F.struct(*docs.columns).alias("doc")).select(
        "doc", size.alias("size"), key.alias("key"), F.col("doc.source").alias("source")).filter("size > 0")
    rows = lookup(rows, src.select("source", "idx", "blocks"), "source")
    block = F.pmod(F.xxhash64(F.lit(seed + 1), "key"), F.col("blocks"))
    rows = lookup(rows.withColumn("place", _place(F.col("idx"), block)), plan, "place")
    drawn = F.filter("turns", lambda t: (t["turn"] <= F.col("full")) | ~F.col("edge") | (F.col("key") <= F.col("last")))
    rows = rows.select("doc", "key", F.explode(drawn).alias("t")).select(
        "doc", F.col("t.shard").alias("shard"), F.xxhash64(F.lit(seed + 5), "t.shard", "t.turn", "key").alias("order"))
    # a shard is as many ranges of its order as its size needs
    return rows.repartitionByRange("shard", "order").sortWithinPartitions("shard", "order").select("doc.*")


def _place(idx: Column, block: Column) -> Column:
    """One number of a source's block."""
    return F.shiftleft(idx.cast("long"), 32).bitwiseOR(block.cast("long"))
