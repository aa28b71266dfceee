"""Distributed global ranking: row numbers, ntile, percent rank, exact quantiles.

A window with ``orderBy`` but no ``partitionBy`` moves every row into one
task.  These helpers compute the same results with bounded per-task work:

1. range-partition on the full sort key (a unique tie-breaker is appended, so
   even a value shared by a third of all rows is split across partitions),
   sort within partitions and tag each row with ``monotonically_increasing_id``
   (partition index in the high bits, position in the low bits);
2. checkpoint that frame, so the tags are fixed once and both branches below
   read the same bytes (and an executor loss does not re-sample the ranges);
3. count rows per range partition (at most ``spark.sql.shuffle.partitions``
   rows), turn the counts into offsets with a window over that tiny table, and
   broadcast-join the offsets back: global position = offset + local position.

Where only values count, not rows, nothing is sorted row by row: ranks come
from prefix sums over the distinct (value, count) table, in which a hot value is
one row, and quantiles from histograms of the values' bits, refined 16 bits at a
time around the order statistics that are needed.

Everything is native Catalyst; no row passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele.functions.lookup import LOOKUP_ROWS, lookup
from clientele.session import cut_lineage

_LOW_BITS = 33
_LOW_MASK = (1 << _LOW_BITS) - 1


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def global_row_number(df: DataFrame, order: list, out: str = "row_number",
                      total: str | None = None, num_partitions: int | None = None,
                      unique: bool = True, counted: Column | None = None) -> DataFrame:
    """Add ``out`` = 1-based position of each row in the total order ``order``.

    ``order`` items are column names or sort expressions (``F.col(x).desc()``).
    With ``unique=False`` a per-row tie-breaker is appended (rows with equal
    keys then get consecutive, arbitrary positions).  ``total`` names an
    optional column holding the row count (of the rows where ``counted`` holds,
    if given).
    """
    keys = [_as_col(c) for c in order]
    base = df
    if not unique:
        base = base.withColumn("_tb", F.monotonically_increasing_id())
        keys = keys + [F.col("_tb")]
    # without an explicit count AQE may merge adjacent ranges at runtime;
    # merged ranges stay contiguous and each partition is sorted below
    ranged = (base.repartitionByRange(num_partitions, *keys) if num_partitions
              else base.repartitionByRange(*keys))
    tagged = (ranged.sortWithinPartitions(*keys)
              .withColumn("_mid", F.monotonically_increasing_id()))
    tagged = cut_lineage(tagged)

    part = F.shiftright(F.col("_mid"), _LOW_BITS)
    local = F.col("_mid").bitwiseAND(F.lit(_LOW_MASK))
    kept = F.count(F.lit(1)) if counted is None else F.count_if(counted)
    counts = tagged.groupBy(part.alias("_pid")).agg(F.count(F.lit(1)).alias("_cnt"), kept.alias("_kept"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
        F.sum("_kept").over(everything).alias("_all"))
    # offsets has one row per range partition: a proven bound for broadcast.
    res = (tagged.withColumn("_pid", part)
           .join(F.broadcast(offsets), "_pid")
           .withColumn(out, (F.col("_off") + local + 1).cast("long")))
    if total:
        res = res.withColumn(total, F.col("_all").cast("long"))
    return res.drop("_mid", "_pid", "_off", "_all", "_tb")


def ntile_global(df: DataFrame, buckets: int, order: list, out: str,
                 num_partitions: int | None = None) -> DataFrame:
    """SQL/dplyr ``ntile``: sizes differ by at most one, larger buckets first.

    ``order`` must be a total order (end it with a key).  Rows whose first
    order column (a name) is NULL get a NULL bucket; they sort last, so the
    input is read once.
    """
    lead = F.col(order[0])
    ranked = global_row_number(df, [lead.asc_nulls_last(), *order[1:]], out="_rn", total="_n",
                               num_partitions=num_partitions, counted=lead.isNotNull())
    nb = F.lit(buckets).cast("long")
    n = F.col("_n")
    larger = F.ceil(n / nb).cast("long")
    smaller = F.floor(n / nb).cast("long")
    n_larger = (n % nb).cast("long")
    threshold = larger * n_larger
    rn = F.col("_rn")
    bucket = F.when(rn <= threshold, F.ceil(F.try_divide(rn, larger))).otherwise(
        F.ceil(F.try_divide(rn - threshold, smaller)) + n_larger)
    return ranked.withColumn(out, F.when(lead.isNotNull(), bucket.cast("int"))).drop("_rn", "_n")


def value_ranks(df: DataFrame, cols: list[str], num_partitions: int | None = None) -> DataFrame:
    """_which (index of the column), _value, _before (rows of a smaller value),
    _n (rows with a value): one row a distinct non-NULL value, as doubles.

    One aggregation and one range sort serve all columns.  Both see a value
    once, however many rows have it.
    """
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("_which"), F.col(c).cast("double").alias("_value"))
                               for i, c in enumerate(cols)])).alias("e")
    counted = (df.select(each).select("e.*").filter(F.col("_value").isNotNull())
               .groupBy("_which", "_value").agg(F.count(F.lit(1)).alias("_c")))
    ranged = (counted.repartitionByRange(num_partitions, "_which", "_value") if num_partitions
              else counted.repartitionByRange("_which", "_value"))
    tagged = cut_lineage(ranged.withColumn("_pid", F.spark_partition_id()))
    totals = tagged.groupBy("_pid", "_which").agg(F.sum("_c").alias("_sum"))  # ranges, and one more a column
    earlier = Window.partitionBy("_which").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_which")
    offsets = totals.select("_pid", "_which", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_off"),
                            F.sum("_sum").over(whole).alias("_n"))
    inside = Window.partitionBy("_pid", "_which").orderBy("_value").rowsBetween(Window.unboundedPreceding, -1)
    return (tagged.withColumn("_local", F.coalesce(F.sum("_c").over(inside), F.lit(0)))
            .join(F.broadcast(offsets), ["_pid", "_which"])
            .select("_which", "_value", (F.col("_off") + F.col("_local")).alias("_before"), "_n"))


def percent_ranks(df: DataFrame, cols: dict[str, str], num_partitions: int | None = None,
                  limit: int = LOOKUP_ROWS) -> DataFrame:
    """Add, for each ``column: name``, ``(rank - 1) / (n - 1)`` over the
    non-NULL values of the column.

    NULLs are neither ranked nor counted and get NULL.  Tied values share the
    rank of their first row.  A single non-NULL row gets 0.0.  ``df`` is
    materialised once, for the ranks and the lookup of its values.
    """
    rows = cut_lineage(df)
    ranks = cut_lineage(value_ranks(rows, list(cols), num_partitions))
    for i, (col, name) in enumerate(cols.items()):
        n = F.col("_n")
        pr = F.when(n > 1, F.col("_before").cast("double") / (n - 1).cast("double")).otherwise(F.lit(0.0))
        table = ranks.filter(F.col("_which") == i).select("_value", pr.alias(name))
        found = lookup(rows.withColumn("_own", F.col(col).cast("double")), table, "_own", "_value", limit)
        rows = found.drop("_own")
    return rows


def percent_rank_global(df: DataFrame, col: str, out: str, num_partitions: int | None = None) -> DataFrame:
    """``percent_ranks`` of one column."""
    return percent_ranks(df, {col: out}, num_partitions)


#: Bits of a value by which a quantile's histograms are refined each time.
BITS = 16


def ordered_bits(value: Column) -> Column:
    """The bits of a double as a long of the same order (-0.0 as 0.0, NaN last)."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value.cast("double") + F.lit(0.0)).cast("long")
    return F.when(bits < 0, F.bitwise_not(bits).bitwiseXOR(F.lit(-(1 << 63)))).otherwise(bits)


def _value_of(bits: Column) -> Column:
    """The double of ``ordered_bits``."""
    raw = F.when(bits < 0, F.bitwise_not(bits.bitwiseXOR(F.lit(-(1 << 63))))).otherwise(bits)
    return F.java_method(F.lit("java.lang.Double"), F.lit("longBitsToDouble"), raw).cast("double")


def order_statistics(df: DataFrame, col: str, probs: list[float], group_cols: list[str],
                     limit: int = LOOKUP_ROWS) -> DataFrame:
    """groups, _p (index), _n, _side, _value: the values at places
    floor((n - 1) p) and ceil((n - 1) p), from 0, of every group.

    Values are first collapsed to (group, value, count).  A histogram of their
    first 16 bits tells which bucket holds each place; only rows of such buckets
    go on to the next 16 bits, four times at most.  A bucket of one value ends
    the search early.  Histograms combine on the map side, and nothing is sorted
    or moved by group but buckets, of which a group has at most 2^16 a bucket.
    """
    groups = [f"_g{i}" for i in range(len(group_cols))]
    live = cut_lineage(df.filter(F.col(col).isNotNull())
                       .select(*[F.col(c).alias(g) for c, g in zip(group_cols, groups)], ordered_bits(F.col(col)).alias("_u"))
                       .groupBy(*groups, "_u").agg(F.count(F.lit(1)).alias("_c")))
    wanted: DataFrame | None = None
    found: DataFrame | None = None
    rows = live.withColumn("_of", F.lit(0).cast("long"))
    for step in range(64 // BITS):
        bucket = F.shiftright("_u", 64 - BITS * (step + 1))
        hist = rows.groupBy(*groups, "_of", bucket.alias("_b")).agg(
            F.sum("_c").alias("_c"), F.min("_u").alias("_lo"), F.max("_u").alias("_hi"))
        upto = Window.partitionBy(*groups, "_of").orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        hist = hist.withColumn("_end", F.sum("_c").over(upto))
        if wanted is None:
            whole = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
            hist = hist.withColumn("_n", F.sum("_c").over(whole))
            h = lambda i: (F.col("_n") - 1).cast("double") * F.lit(float(probs[i]))
            places = F.explode(F.array(*[F.struct(F.lit(i).alias("_p"), F.lit(s).alias("_side"), f(h(i)).cast("long").alias("_k"))
                                         for i in range(len(probs)) for s, f in enumerate((F.floor, F.ceil))])).alias("w")
            hits = hist.select(*groups, "_b", "_c", "_lo", "_hi", "_end", "_n", places).select(
                *groups, "_b", "_c", "_lo", "_hi", "_end", "_n", "w.*")
        else:
            w = wanted.select(*[F.col(c).alias(f"_w{c}") for c in (*groups, "_b")], "_n", "_p", "_side", "_k")
            same = F.col("_of") == F.col("_w_b")
            for g in groups:
                same = same & F.col(g).eqNullSafe(F.col(f"_w{g}"))
            hits = hist.join(F.broadcast(w) if few else w, same)
        hits = hits.filter((F.col("_k") < F.col("_end")) & (F.col("_k") >= F.col("_end") - F.col("_c")))
        hits = cut_lineage(hits.select(*groups, "_b", "_lo", "_hi", "_n", "_p", "_side",
                                       (F.col("_k") - F.col("_end") + F.col("_c")).alias("_k")))
        ended = hits.filter(F.col("_lo") == F.col("_hi")).select(*groups, "_n", "_p", "_side", _value_of(F.col("_lo")).alias("_value"))
        found = ended if found is None else found.unionByName(ended)
        wanted = hits.filter(F.col("_lo") != F.col("_hi"))
        left = wanted.count()  # at most two a group and probability
        if not left:
            break
        few = left <= limit
        keep = wanted.select(*groups, F.col("_b").alias("_kb")).distinct()
        keep = keep.select(*[F.col(g).alias(f"_k{g}") for g in groups], "_kb")
        same = F.shiftright("_u", 64 - BITS * (step + 1)) == F.col("_kb")
        for g in groups:
            same = same & F.col(g).eqNullSafe(F.col(f"_k{g}"))
        rows = live.join(F.broadcast(keep) if few else keep, same, "left_semi").withColumn("_of", bucket)
    return found.select(*[F.col(g).alias(c) for g, c in zip(groups, group_cols)], "_n", "_p", "_side", "_value")


def exact_quantiles(df: DataFrame, col: str, probs: dict[str, float],
                    group_cols: list[str] | None = None) -> DataFrame:
    """Exact sample quantiles with linear interpolation (Hyndman-Fan type 7).

    ``probs`` maps output column name -> probability.  Returns one row (or one
    row per group) with those columns; NULL where there are no values.
    """
    groups = list(group_cols or [])
    stats = order_statistics(df, col, list(probs.values()), groups)
    aggs = []
    for i, (name, p) in enumerate(probs.items()):
        at = lambda side: F.max(F.when((F.col("_p") == i) & (F.col("_side") == side), F.col("_value")))  # noqa: B023, E731
        h = (F.max("_n") - 1).cast("double") * F.lit(float(p))
        lo, hi = at(0), at(1)
        aggs.append((lo + (h - F.floor(h)) * (hi - lo)).alias(name))
    # groups without any non-NULL value are absent; callers left-join
    return stats.groupBy(*groups).agg(*aggs)
