"""The training-data pipeline over ``documents``.

Language identification, exact dedup, near-duplicate join, mixing and packing,
each by its operator in ``clientele.llm``.  Every stage but the last returns
the columns of the documents it was given.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clientele.llm import best_fit_packing, extendible_dedup, jaccard_join, language_centroid, mixing
from clientele.llm.common import prepare, staged, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the centroids accept."""
    prepare(spark)
    return language_centroid.keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal normalised texts."""
    prepare(spark)
    return extendible_dedup.keep_one(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of 5-word Jaccard 0.8 or more."""
    prepare(spark)
    return jaccard_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix draws, once for each time."""
    prepare(spark)
    return mixing.mixed_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the drawn documents and their places in sequences."""
    prepare(spark)
    return best_fit_packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

#: A trained model, a mix by hash and a tokenizer have no SQL form.  near_dedup and
#: mix_sources are tested on small tables (tests/llm); the other stages only through
#: their operators, and run() as a whole is not compared with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
