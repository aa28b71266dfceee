"""Null handling that matches the analysis definitions.

Spark and the definitions disagree on missing values in a few places; each
helper below states the rule it implements.  All are native Catalyst
expressions (whole-stage codegen, partial aggregation).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Distinct values of a column that a group's bit masks may stand for (16 longs).
MASK_VALUES = 1024


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sum0(x) -> Column:
    """NA-skipping sum where an all-missing group sums to 0 (not NULL)."""
    return F.coalesce(F.sum(_c(x)), F.lit(0))


def has_null(x) -> Column:
    """1 if any value in the group is NULL, else 0."""
    return F.max(F.when(_c(x).isNull(), F.lit(1)).otherwise(F.lit(0)))


def n_distinct_na(x) -> Column:
    """Distinct count where a missing value counts as one more value.

    Planned by Catalyst as a two-level aggregate (first on (group, value),
    then on group), which is skew-safe: a hot group is spread over its
    values.  Two of these in one aggregation make Catalyst copy every row
    (``Expand``); ``with_distinct_mask`` counts a column of few values without.
    """
    return (F.count_distinct(_c(x)) + has_null(x)).cast("long")


def with_distinct_mask(rows: DataFrame, column: str, limit: int = MASK_VALUES) -> tuple[DataFrame, Column]:
    """``rows`` with a bit a value of ``column``, and the aggregate that counts its
    distinct values as ``n_distinct_na`` does.

    The distinct values are read first.  Up to ``limit`` of them, each row gets its
    value's word and bit from a broadcast table, and a group's bits are combined by
    ``bit_or``, map-side too, so no row is copied or sorted.  With more values the
    rows stay as they are and the count is ``n_distinct_na``.
    """
    values = [r[0] for r in rows.select(column).filter(F.col(column).isNotNull())
              .distinct().limit(limit + 1).collect()]
    if len(values) > limit:
        return rows, n_distinct_na(column)
    value, word, bit = f"_value_{column}", f"_word_{column}", f"_bit_{column}"
    schema = T.StructType([T.StructField(value, rows.schema[column].dataType),
                           T.StructField(word, T.IntegerType()), T.StructField(bit, T.LongType())])
    # the 64th bit of a long is its sign
    bits = [(v, i // 64, 1 << i % 64 if i % 64 < 63 else -(1 << 63)) for i, v in enumerate(values)]
    table = rows.sparkSession.createDataFrame(bits, schema)
    marked = rows.join(F.broadcast(table), F.col(column) == F.col(value), "left").drop(value)
    count = has_null(column)
    for w in range(math.ceil(len(values) / 64)):
        held = F.bit_or(F.when(F.col(word) == w, F.col(bit)))
        count = count + F.coalesce(F.bit_count(held), F.lit(0))
    return marked, count.cast("long")


def ratio_or_zero(num: Column, den: Column) -> Column:
    """``num / den`` if ``den > 0`` else 0 (a NULL denominator also gives 0)."""
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def safe_div(num: Column, den: Column) -> Column:
    """Division that yields NULL (instead of failing) on a zero denominator."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def flag(cond: Column) -> Column:
    """Three-valued 0/1 flag: NULL condition stays NULL."""
    return cond.cast("int")


def mean_of(cond: Column) -> Column:
    """Share of non-missing rows where ``cond`` holds (NULL if none)."""
    return F.avg(cond.cast("double"))


def null_safe_on(left_alias: str, right_alias: str, on: list[str]) -> Column:
    cond = None
    for k in on:
        c = F.col(f"{left_alias}.`{k}`").eqNullSafe(F.col(f"{right_alias}.`{k}`"))
        cond = c if cond is None else cond & c
    return cond


def left_join_na(left: DataFrame, right: DataFrame, on: list[str], how: str = "left",
                 null_safe: bool = True) -> DataFrame:
    """Left (or inner) join where a missing key matches a missing key.

    ``<=>`` is planned as an equi-join (hash on the key plus a null marker),
    never a nested loop, but its join keys are expressions, so inputs already
    hash-partitioned by the plain key are shuffled once more.  When the
    caller knows the key column holds no NULL (``null_safe=False``, e.g. after
    checking the source table), a plain equi-join gives the same rows and
    keeps the co-partitioning of two customer aggregates.  Both sides are
    aliased, so joining two frames derived from the same source is
    unambiguous.
    """
    lft, rgt = left.alias("_jl"), right.alias("_jr")
    right_cols = [c for c in right.columns if c not in on]
    if null_safe:
        cond = null_safe_on("_jl", "_jr", on)
    else:
        cond = None
        for k in on:
            c = F.col(f"_jl.`{k}`") == F.col(f"_jr.`{k}`")
            cond = c if cond is None else cond & c
    return lft.join(rgt, cond, how).select(
        *[F.col(f"_jl.`{c}`") for c in left.columns],
        *[F.col(f"_jr.`{c}`") for c in right_cols])
