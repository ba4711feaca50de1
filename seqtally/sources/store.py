"""A sequence store for records that are fetched by id: files sorted by id, with a manifest of their id ranges.

The ids of a request are placed among the files by a binary search over the ranges, and only files with a placed id are
opened. Within a file Parquet's statistics and Bloom filters pass over row groups when ids are few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtally.operators.common import keep_or_drop


def write_store(seq: DataFrame, path: str, key: str = "seq_id", files: int | None = None,
                row_group_bytes: int = 16 << 20) -> None:
    """Write records sorted by `key` in files of separate id ranges, and the manifest `file, first, last, rows`.

    Files are range partitions, of a size that the number of shuffle partitions or `files` sets; an id that many
    records share fills one file.
    """
    spark = seq.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (seq.repartitionByRange(files, key).sortWithinPartitions(key).write.mode("overwrite")
     .option("parquet.block.size", row_group_bytes).option(f"parquet.bloom.filter.enabled#{key}", "true")
     .parquet(f"{path}/data"))
    stored = spark.read.parquet(f"{path}/data").select(F.col(key).cast("string").alias("_id"),
                                                       F.col("_metadata.file_name").alias("file"))
    (stored.where("_id is not null").groupBy("file").agg(F.min("_id").alias("first"), F.max("_id").alias("last"),
                                                         F.count(F.lit(1)).alias("rows"))
     .coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest"))


def _last_at_most(bounds: Column, value: Column, steps: int) -> Column:
    """Place of the last of the sorted bounds that is not above the value, by halving; null if all are above."""
    found = F.aggregate(
        F.transform(F.sequence(F.lit(0), F.lit(steps - 1)), lambda i: F.pow(F.lit(2), F.lit(steps - 1) - i).cast("int")),
        F.lit(-1), lambda at, step: F.when(F.get(bounds, at + step) <= value, at + step).otherwise(at))
    return F.when(found >= 0, found)


def files_for(spark: SparkSession, path: str, ids: DataFrame, id_col: str = "id") -> list[str]:
    """The store's files that may hold one of the ids. The driver gets one row per such file, never the ids."""
    manifest = spark.read.parquet(f"{path}/manifest")
    n = manifest.count()
    if not n:
        return []
    entries = manifest.agg(F.sort_array(F.collect_list(F.struct("first", "last", "file"))).alias("_m"))  # one per file
    firsts = F.transform("_m", lambda m: m["first"])
    bounds = entries.select(F.struct(firsts.alias("firsts"), F.col("_m").alias("entries")).alias("_s")).scalar()
    placed = ids.select(F.col(id_col).cast("string").alias("_id")).distinct().withColumn("_s", bounds)
    place = _last_at_most(F.col("_s.firsts"), F.col("_id"), max(1, n.bit_length()))
    held = placed.select("_id", F.get(F.col("_s.entries"), place).alias("_e")).where(F.col("_id") <= F.col("_e.last"))
    return sorted(f"{path}/data/{r.file}" for r in held.select("_e.file").distinct().collect())


def fetch_from_store(spark: SparkSession, path: str, ids: DataFrame, id_col: str = "id", key: str = "seq_id",
                     few: int = 1000) -> DataFrame:
    """Records of a store whose id is listed. Up to `few` ids also go to the scan as a filter on row groups."""
    wanted = ids.select(F.col(id_col).cast("string").alias("_id")).where("_id is not null").distinct()
    files = files_for(spark, path, wanted, "_id")
    whole = spark.read.parquet(f"{path}/data")
    if not files:
        return whole.limit(0)
    store = spark.read.schema(whole.schema).parquet(*files)
    some = [r[0] for r in wanted.limit(few + 1).collect()]
    if len(some) <= few:
        return store.where(F.col(key).cast("string").isin(some) if dict(store.dtypes)[key] != "string" else F.col(key).isin(some))
    kept = keep_or_drop(store.withColumn("_id", F.col(key).cast("string")), wanted, ["_id"], "left_semi")
    return kept.select(*store.columns)
