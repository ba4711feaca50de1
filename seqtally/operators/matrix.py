"""Sample by feature tables: merging, statistics, concatenation, pooling, and rescaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqtally.functions.expr import EXACT, index_quartiles
from seqtally.operators.common import names, spread_join, with_group_total

STATS = ["max", "min", "med", "mean", "range", "low_quartile", "high_quartile"]


def merge_samples(long: DataFrame, samples: Sequence[str], ids: Sequence[str] = ("feature",), value: str = "value",
                  ann: Sequence[str] = (), cutoff: float | None = 0, cutoff_col: str | None = None,
                  missing: float = 0, stats: bool = False, sort: bool = True, order: str = "ord") -> DataFrame:
    """One row per feature and one column per sample.

    Rows of `long(sample, <ids>, <ann>, <value>, <order>)` below the cutoff are ignored, the last value of a
    repeated (feature, sample) counts, annotations come from the first sample and row that show the feature.
    Statistics take a missing sample as 0. The sample list is given, so no job runs to find it.
    """
    rows = long if cutoff is None else long.where(F.col(cutoff_col or value) >= cutoff)
    position = F.array_position(F.array(*[F.lit(s) for s in samples]), F.col("sample"))
    rows = rows.where(F.col("sample").isin(list(samples))).withColumn("_at", position)
    cells = rows.groupBy(*ids, "sample").agg(
        F.max_by(value, F.col(order)).alias("_v"),
        *([F.min(F.struct("_at", F.col(order).alias("_o"), F.struct(*ann).alias("a"))).alias("_a")] if ann else []))
    wide = cells.groupBy(*ids).pivot("sample", list(samples)).agg(F.max("_v"))
    if ann:  # narrow: a row per feature
        wide = wide.join(cells.groupBy(*ids).agg(F.min("_a").alias("_a")), list(ids))
    columns = [F.coalesce(F.col(f"`{s}`"), F.lit(missing)).alias(s) for s in samples]
    described = [F.col("_a.a")[c].alias(c) for c in ann]
    if not stats:
        return wide.select(*ids, *described, *columns).orderBy(*ids)
    filled = F.sort_array(F.array(*[F.coalesce(F.col(f"`{s}`").cast("double"), F.lit(0.0)) for s in samples]))
    total = F.aggregate("_f", F.lit(0.0), lambda a, x: a + x)
    out = (wide.withColumn("_f", filled).withColumn("_q", index_quartiles(F.col("_f")))
           .select(*ids, *described, *columns,
                   F.element_at("_f", -1).alias("max"), F.element_at("_f", 1).alias("min"),
                   F.col("_q.med").alias("med"), (total / len(samples)).alias("mean"),
                   (F.element_at("_f", -1) - F.element_at("_f", 1)).alias("range"),
                   F.col("_q.low_quartile").alias("low_quartile"), F.col("_q.high_quartile").alias("high_quartile")))
    return out.orderBy(F.desc("max"), *ids) if sort else out.orderBy(*ids)


def concat_samples(tables: DataFrame, columns: Sequence[str], sample_col: str = "sample_id") -> DataFrame:
    """Chosen columns of all samples' rows under each other, led by the sample."""
    return tables.select(F.col(sample_col).alias("sample_id"), *columns)


def sample_dictionary(tables: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows of the annotation columns, sorted."""
    return tables.select(*columns).distinct().orderBy(*columns)


def pool_groups(df: DataFrame, samples: DataFrame, group_col: int = 1, group: str | None = None) -> DataFrame:
    """Give each sample's rows the group it belongs to; samples that are not in the sheet are left out.

    `samples(sample_id, data)` is the sheet, `group_col` counts its data columns from 1; `group` puts all
    samples into one group. White space in a group name becomes `_`. Samples without rows are skipped; see
    `missing_sources`.
    """
    name = F.lit(group) if group is not None else F.get("data", F.lit(group_col - 1))
    sheet = samples.select("sample_id", F.regexp_replace(name, r"\s", "_").alias("group"))
    return spread_join(df, sheet, ["sample_id"])


def missing_sources(df: DataFrame, samples: DataFrame) -> DataFrame:
    """Samples of the sheet that have no rows."""
    return samples.select("sample_id").join(df.select("sample_id").distinct(), "sample_id", "left_anti")


def renorm_cpm(df: DataFrame, value: str = "value", by: Sequence[str] = ("sample",)) -> DataFrame:
    """Scale the values of each sample to a sum of one million."""
    total = F.sum(F.col(value).cast(EXACT)).cast("double")
    return (with_group_total(df, total, "_total", by)
            .withColumn(value, F.when(F.col("_total") != 0, F.col(value) * 1e6 / F.col("_total")).otherwise(0.0))
            .select(*df.columns))


def regroup_table(df: DataFrame, mapping: DataFrame, value: str = "value", by: Sequence[str] = ("sample",),
                  ungrouped: str | None = "UNGROUPED") -> DataFrame:
    """Sum features into groups by `mapping(feature, target)`; a feature of several groups counts in each.

    Features are summed before the join. Those without a group are added up under `ungrouped`, if given.
    """
    per = df.groupBy(*names(by, "feature")).agg(F.sum(F.col(value).cast(EXACT)).alias("_v"))
    mapped = mapping.select("feature", "target").distinct()
    joined = per.join(mapped, "feature", "inner" if ungrouped is None else "left")
    if ungrouped is not None:
        joined = joined.withColumn("target", F.coalesce("target", F.lit(ungrouped)))
    return (joined.groupBy(*names(by, "target")).agg(F.sum("_v").cast("double").alias(value))
            .withColumnRenamed("target", "feature"))


def rename_features(df: DataFrame, labels: DataFrame, unnamed: str = "NO_NAME") -> DataFrame:
    """Append the name of each feature as `feature: name`."""
    named = df.join(labels.select("feature", "name"), "feature", "left")
    text = F.concat(F.col("feature"), F.lit(": "), F.coalesce("name", F.lit(unnamed)))
    return named.withColumn("feature", text).select(*df.columns)


def otu_table(clusters: DataFrame, min_frac: float = 1e-4, sample: str = "sample", cluster: str = "cluster",
              size: Column | None = None) -> DataFrame:
    """Counts per (cluster, sample) of the clusters that hold at least `min_frac` of all rows.

    Returned long; `merge_samples` turns it into the table of one column per sample.
    """
    cells = clusters.groupBy(cluster, sample).agg(
        (F.count(F.lit(1)) if size is None else F.sum(size)).alias("value"))
    per = cells.groupBy(cluster).agg(F.sum("value").alias("_size"))
    kept = (with_group_total(per, F.sum("_size"), "_all", ())
            .where(F.col("_size") >= F.col("_all") * F.lit(min_frac)).select(cluster))
    return cells.join(kept, cluster, "left_semi")
