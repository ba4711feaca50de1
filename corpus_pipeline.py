"""A training corpus from `documents`: language ID, near-duplicates, repeated strings, mixing, packing.

Each stage is written as Parquet and read again as the next one's documents, and removed when that is written. All but
the last return the columns of `documents`; the last returns the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from seqtally.llm import stages
from seqtally.session import cut_lineage, discard


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a determined language go."""
    return stages.identified(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return stages.one_of_each_group(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings that repeat are cut from the texts."""
    return stages.without_repeats(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights."""
    return stages.weighted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents become sequences of tokens."""
    return stages.packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id), ("jaccard_join", jaccard_join), ("suffix_array_dedup", suffix_array_dedup),
    ("mixing", mixing), ("packing", packing),
]

#: Language ID, connected groups and suffix arrays are not SQL; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
        discard(*before)  # the stage has read it and is written
        before = [docs]
    return docs
