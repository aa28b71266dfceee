"""Left lookup of a one-row-a-key table that survives hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.session import cut_lineage

#: Rows of a lookup table that are sent to every task; beyond, the key is salted.
LOOKUP_ROWS = 200_000
#: Parts into which a key's rows are dealt when the table is larger than that.
SALTS = 32


def lookup(rows: DataFrame, table: DataFrame, key: str, table_key: str | None = None,
           limit: int = LOOKUP_ROWS) -> DataFrame:
    """``rows`` with the other columns of ``table``, NULL where it has no row;
    a NULL key finds the table's NULL key.

    ``table`` has one row a key and is materialised and counted first.  Up to
    ``limit`` rows it is broadcast, so the rows stay where they are however
    many share a key.  A larger table is joined by (key, salt), each of its rows
    once for each salt, so a key's rows go to SALTS tasks.
    """
    table_key = table_key or key
    table = cut_lineage(table)
    values = [c for c in table.columns if c != table_key]
    right = table.select(F.col(table_key).alias("_key"), *[F.col(c).alias(f"_v_{c}") for c in values])
    same = F.col(key).eqNullSafe(F.col("_key"))
    if right.count() <= limit:
        joined = rows.join(F.broadcast(right), same, "left")
    else:
        salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))
        right = right.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = salted.join(right, same & (F.col("_salt") == F.col("_part")), "left")
    return joined.select(*rows.columns, *[F.col(f"_v_{c}").alias(c) for c in values])
