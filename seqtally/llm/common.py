"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtally.session import cut_lineage


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """`df` computed once into the shared checkpoint folder: survives lost executors, and its size is known."""
    return cut_lineage(df)


def utf8(text: Column) -> Column:
    """The text as bytes; null counts as empty."""
    return F.coalesce(text, F.lit("")).cast("binary")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z so that words made of ASCII letters only compare right; other letters may change case too.

    The Kelvin sign, the one other letter whose lower case is ASCII, becomes another letter first.
    """
    return F.lower(F.replace(text, F.lit("\u212a"), F.lit("\u00ff")))
