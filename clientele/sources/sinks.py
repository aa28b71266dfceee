"""Sinks: report tables, CSV exports, audience files and a staged
transactions table.

All writes are distributed (one file per task); nothing is funnelled through
the driver or a single partition.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.session import cut_lineage


def write_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Report table as Parquet (replaces the spreadsheet outputs)."""
    df.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header line and no row names."""
    df.write.mode(mode).option("header", True).csv(path)


def export_audiences(df: DataFrame, path: str, segment_col: str = "segment",
                     fmt: str = "csv", replace_all: bool = False) -> str:
    """One folder per segment value (``segment=<value>/part-*.csv``), ready
    for a CRM import; returns the run's id in the manifest.

    Only the folders of segments that ``df`` holds are replaced (dynamic
    partition overwrite), so a run for one segment leaves the others as they
    are; ``replace_all`` deletes those as well.  A rebalance by segment keeps
    small segments in one file and lets adaptive execution split a large one
    over several tasks.  ``read_manifest`` tells what every run wrote.
    """
    df = cut_lineage(df)  # written and counted: the same rows
    run = uuid.uuid4().hex
    writer = (df.hint("rebalance", segment_col).write.mode("overwrite").partitionBy(segment_col)
              .option("partitionOverwriteMode", "static" if replace_all else "dynamic"))
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)
    (df.groupBy(F.col(segment_col).cast("string").alias("segment")).agg(F.count(F.lit(1)).alias("customers"))
     .select(F.lit(run).alias("run"), F.current_timestamp().alias("written_at"), F.lit(replace_all).alias("replaced_all"),
             "segment", "customers")
     .write.mode("append").parquet(_manifest(path)))
    return run


def _manifest(path: str) -> str:
    return f"{path.rstrip('/')}/_manifest"  # readers of the audiences skip names with an underscore


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """run, written_at, replaced_all, segment, customers of every export."""
    return spark.read.parquet(_manifest(path))


def stage_transactions(df: DataFrame, path: str, mode: str = "overwrite",
                       table: str | None = None, buckets: int | None = None) -> None:
    """Stage the cleaned transactions once as Parquet, sorted by date within
    each file (row-group min/max then prune date-range filters).

    ``buckets`` optionally buckets by ``customer_id`` (needs ``table``), which
    removes the customer shuffle from later aggregations and joins.  Leave it
    off when one customer may hold a large share of the lines: a bucketed
    scan reads each bucket in one task.
    """
    writer = df.sortWithinPartitions("transaction_date").write.mode(mode).format("parquet")
    if buckets:
        if not table:
            raise ValueError("bucketing needs a table name")
        writer.bucketBy(buckets, "customer_id").sortBy("customer_id").option(
            "path", path).saveAsTable(table)
    elif table:
        writer.option("path", path).saveAsTable(table)
    else:
        writer.save(path)
