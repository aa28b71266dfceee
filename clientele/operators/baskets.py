"""Category baskets and association rules.

Baskets are collapsed once to distinct itemsets with counts, and frequent
itemsets are then mined level by level over that table: a row holds a frequent
set, the items after it in the basket that may extend it, and the number of
baskets.  One aggregation a level counts all extensions; those below the support
are dropped, and what is left of each row extends the sets that stay.  An
extension is a candidate only if its sibling sets (the same set with either of
its last two items) are frequent, and rows that have become equal are added up.
Rules with a single-item consequent are derived from the itemset counts with
plain DataFrame joins: each frequent itemset is exploded into one row per item
(linear in its size), never into pairs of baskets.
"""

from __future__ import annotations

from collections.abc import Iterator

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.operators.features import approved
from clientele.session import cut_lineage

# fixed values: mining thresholds of the analysis
MIN_SUPPORT = 0.001
MIN_CONFIDENCE = 0.10
MIN_LEN = 2
MAX_LEN = 10


def basket_items(txn: DataFrame) -> DataFrame:
    """One row per approved transaction: the set of categories bought
    (duplicates removed, sorted).  Lines without a transaction id or a
    category carry no item."""
    lines = approved(txn).filter(F.col("transaction_id").isNotNull() & F.col("category").isNotNull())
    # collect_set merges map-side; its size is bounded by the category domain
    return lines.groupBy("transaction_id").agg(F.array_sort(F.collect_set("category")).alias("items"))


def itemset_label(items: Column) -> Column:
    return F.concat(F.lit("{"), F.array_join(F.array_sort(items), ","), F.lit("}"))


def collapsed(baskets: DataFrame) -> DataFrame:
    """items, c: the distinct itemsets and how many baskets equal them.

    A partial aggregate: with a small item domain every map task ships at most
    a few hundred rows, however many baskets it read.  Written once, because
    the basket count, the item counts and the mining all read it.
    """
    return cut_lineage(baskets.groupBy("items").agg(F.count(F.lit(1)).alias("c")))


def _encoded(distinct: DataFrame, names: list[str]) -> DataFrame:
    """rest (numbers of the frequent items, ascending), c; equal rows added."""
    shared = distinct.sparkSession.sparkContext.broadcast(names)

    def encode(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        known = pa.array(shared.value, pa.string())
        for batch in batches:
            items = batch.column(0)
            row = np.repeat(np.arange(batch.num_rows), np.diff(items.offsets.to_numpy()))
            number = pc.fill_null(pc.index_in(items.flatten(), value_set=known), -1).to_numpy()
            row, number = row[number >= 0], number[number >= 0]
            order = np.lexsort((number, row))
            ends = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array(ends), pa.array(number[order].astype(np.int32))), batch.column(1)], ["rest", "c"])

    return (distinct.select("items", "c").mapInArrow(encode, "rest array<int>, c long")
            .filter(F.size("rest") > 0).groupBy("rest").agg(F.sum("c").alias("c")))


def _decoded(found: DataFrame, names: list[str]) -> DataFrame:
    shared = found.sparkSession.sparkContext.broadcast(names)

    def decode(batches: Iterator) -> Iterator:
        import pyarrow as pa
        known = pa.array(shared.value, pa.string())
        for batch in batches:
            sets = batch.column(0)
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(sets.offsets, known.take(sets.values)), batch.column(1)], ["items", "freq"])

    return found.mapInArrow(decode, "items array<string>, freq long")


def frequent_itemsets(distinct: DataFrame, n: int, min_support: float = MIN_SUPPORT,
                      max_len: int = MAX_LEN) -> DataFrame:
    """items (sorted array), freq (baskets containing all of them), of
    ``collapsed`` baskets; ``n`` is the number of baskets."""
    min_count = max(1, math.ceil(min_support * n))
    # frequent items: at most (total items) / min_count of them, a bound set by
    # the support threshold, not by the number of baskets
    items = (distinct.select(F.explode("items").alias("item"), "c").groupBy("item")
             .agg(F.sum("c").alias("c")).filter(F.col("c") >= min_count))
    names = sorted(r["item"] for r in items.select("item").collect())
    if not names:
        return distinct.sparkSession.createDataFrame([], "items array<string>, freq long")
    rows = cut_lineage(_encoded(distinct, names).select(F.array().cast("array<int>").alias("set"), "rest", "c"))
    found: DataFrame | None = None
    for level in range(1, max_len + 1):
        counted = (rows.select("set", F.explode("rest").alias("item"), "c").groupBy("set", "item")
                   .agg(F.sum("c").alias("freq")).filter(F.col("freq") >= min_count))
        counted = cut_lineage(counted)
        sets = counted.select(F.concat("set", F.array("item")).alias("items"), "freq")
        found = sets if found is None else found.unionByName(sets)
        # the extensions of each set that stay; without two of a set there is no next level
        stay = counted.groupBy("set").agg(F.array_sort(F.collect_list("item")).alias("stay")).filter(F.size("stay") > 1)
        if level == max_len or stay.limit(1).count() == 0:
            break
        left = (rows.join(stay, "set").select("set", F.array_intersect("rest", "stay").alias("rest"), "c")
                .filter(F.size("rest") > 1))
        at = F.posexplode(F.slice("rest", F.lit(1), F.size("rest") - 1)).alias("at", "item")
        rows = cut_lineage(left.select("set", "rest", "c", at)
                           .select(F.concat("set", F.array("item")).alias("set"),
                                   F.expr("slice(rest, at + 2, size(rest))").alias("rest"), "c")
                           .groupBy("set", "rest").agg(F.sum("c").alias("c")))
    return _decoded(found, names)


def association_rules(baskets: DataFrame, min_support: float = MIN_SUPPORT,
                      min_confidence: float = MIN_CONFIDENCE, min_len: int = MIN_LEN,
                      max_len: int = MAX_LEN) -> DataFrame:
    """lhs, rhs, support, confidence, coverage, lift, count.

    support = count(lhs ∪ rhs)/n, confidence = count(lhs ∪ rhs)/count(lhs),
    coverage = count(lhs)/n, lift = confidence / (count(rhs)/n).
    """
    distinct = collapsed(baskets)
    total = distinct.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    n = F.lit(float(total))
    # mined once, read three times below: materialise it
    fi = cut_lineage(frequent_itemsets(distinct, total, min_support, max_len))
    whole = (fi.filter(F.size("items") >= max(min_len, 2))
             .select(F.col("items").alias("s_items"), F.col("freq").alias("s_freq"),
                     F.explode("items").alias("rhs_item"))
             .withColumn("lhs_items", F.array_sort(F.array_except("s_items", F.array("rhs_item")))))
    lhs = fi.select(F.col("items").alias("lhs_items"), F.col("freq").alias("lhs_freq"))
    single = fi.filter(F.size("items") == 1).select(
        F.col("items")[0].alias("rhs_item"), F.col("freq").alias("rhs_freq"))
    # every subset of a frequent itemset is frequent, so both joins always match
    rules = whole.join(lhs, "lhs_items").join(single, "rhs_item")
    conf = F.col("s_freq").cast("double") / F.col("lhs_freq").cast("double")
    rules = rules.select(
        itemset_label(F.col("lhs_items")).alias("lhs"),
        itemset_label(F.array("rhs_item")).alias("rhs"),
        (F.col("s_freq").cast("double") / n).alias("support"),
        conf.alias("confidence"),
        (F.col("lhs_freq").cast("double") / n).alias("coverage"),
        (conf / (F.col("rhs_freq").cast("double") / n)).alias("lift"),
        F.col("s_freq").alias("count"))
    return rules.filter(F.col("confidence") >= min_confidence)


def top_rules(rules: DataFrame, n: int = 20) -> DataFrame:
    """Highest-lift rules (ties by rule text)."""
    return rules.orderBy(F.col("lift").desc(), "lhs", "rhs").limit(n)
