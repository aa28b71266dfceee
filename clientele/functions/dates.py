"""Date and percentage helpers (all native expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(d: Column) -> Column:
    return F.trunc(d, "month")


def month_number(d: Column) -> Column:
    """Months since year 0; differences give whole-month offsets."""
    return F.year(d) * 12 + F.month(d)


def months_apart(later: Column, earlier: Column) -> Column:
    """Whole calendar months from ``earlier``'s month to ``later``'s month."""
    return (month_number(later) - month_number(earlier)).cast("long")


def is_weekend(d: Column) -> Column:
    """Saturday or Sunday (weeks start on Monday)."""
    return F.weekday(d) >= 5


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier).cast("long")


def pct_tenths(num: Column, den: Column) -> Column:
    """``100 * num / den`` in tenths of a percent, rounded half-to-even.

    Integer arithmetic only, so every engine gets the same digits (a decimal
    or double detour rounds ``x.x5`` ties differently from engine to engine).
    """
    n = num.cast("long") * 1000
    d = den.cast("long")
    q = F.floor(n / d).cast("long")  # num, den >= 0
    r = n - q * d
    up = (2 * r > d) | ((2 * r == d) & (q % 2 == 1))
    return F.when(d > 0, q + F.when(up, 1).otherwise(0))


def pct_from_tenths(tenths: Column) -> Column:
    return tenths / F.lit(10.0)


def pct_label_from_tenths(tenths: Column) -> Column:
    """``33.3%``, ``100%`` (a whole percentage prints without a decimal)."""
    whole = F.floor(tenths / 10).cast("long").cast("string")
    frac = (tenths % 10).cast("string")
    return F.when(tenths.isNull(), F.lit(None)).when(
        tenths % 10 == 0, F.concat(whole, F.lit("%"))).otherwise(
        F.concat(whole, F.lit("."), frac, F.lit("%")))
