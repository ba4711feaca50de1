"""Text scans that keep the order of the input.

Every row carries `ord = struct(file, block, row)`: file, start of the input split, and a number that rises
within the split. It is unique and follows the file, and it comes without a sort or a window. How a file is split
depends on the session when the scan runs, so lines whose order is compared between scans are written once first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqtally.operators.common import checked_broadcast
from seqtally.session import cut_lineage


def read_lines(spark: SparkSession, path: str | list[str], separator: str | None = None,
               land: bool = False) -> DataFrame:
    """`value, ord` for each line, or for each record when `separator` is given.

    With `land` the lines are written as a table in the checkpoint folder, which fixes `ord` for all later reads.
    """
    reader = spark.read.option("recursiveFileLookup", "false")
    if separator is not None:
        reader = reader.option("lineSep", separator)
    lines = reader.text(path).select("value", F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row")).alias("ord"))
    return cut_lineage(lines) if land else lines


def read_numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """`value, file, line, ord` with the 0-based line number in the file.

    The lines are written once, and counts and lines come from that table: both see the same splits. A split's
    offset is the sum over the splits before it, one row per split, so big files stay divided and the lines are
    not shuffled. This runs jobs.
    """
    lines = read_lines(spark, path, land=True).withColumn("file", F.col("ord.file")).withColumn("_block", F.col("ord.block"))
    sizes = lines.groupBy("file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("ord.row").alias("_first"))
    before = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("file", "_block", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (lines.join(checked_broadcast(cut_lineage(offsets)), ["file", "_block"])
            .select("value", "file", (F.col("_before") + F.col("ord.row") - F.col("_first")).alias("line"), "ord"))


def without_comments(lines: DataFrame) -> DataFrame:
    return lines.where(~F.col("value").startswith("#") & (F.trim("value") != ""))
