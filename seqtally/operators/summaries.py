"""Job cost, resistance and assembly summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqtally.functions.expr import EXACT
from seqtally.operators.common import names

HOUR = 1 / 3600


def job_cost(log: DataFrame) -> DataFrame:
    """Core-seconds per (sample, job)."""
    return log.groupBy("sample", "job").agg(F.sum(F.col("cores") * F.col("time_spent")).alias("core_seconds"))


def job_cost_matrix(log: DataFrame, jobs: Sequence[str], factor: float = 1) -> DataFrame:
    """Core-seconds as a sample x job table with a row total; null where a job did not run.

    A `factor` other than 1 (1/3600 for hours, or a price per core-second) is applied and the result
    rounded to two places.
    """
    def shown(c):
        return c if factor == 1 else F.round(c * F.lit(factor), 2)

    cost = job_cost(log)
    wide = cost.groupBy("sample").agg(
        *[F.max(F.when(F.col("job") == j, F.col("core_seconds"))).alias(j) for j in jobs],
        F.sum(F.when(F.col("job").isin(list(jobs)), F.col("core_seconds")).otherwise(0)).alias("total"))
    return wide.select("sample", *[shown(F.col(f"`{j}`")).alias(j) for j in jobs],
                       shown(F.col("total")).alias("total")).orderBy("sample")


RESISTANCE_LEVELS = ["aro", "gene_family", "drug_class", "mechanism"]


def resistance_rollup(rgi: DataFrame, depth: DataFrame, bins: DataFrame | None = None,
                      by: Sequence[str] = ()) -> DataFrame:
    """Summed gene depth per ARO, gene family, drug class and mechanism; with `bins`, also per taxid.

    `rgi(orf_id, scaffold, aro, gene_family, drug_class, mechanism)`; the last three may list several values
    separated by `; `, and a gene counts under each. All levels come from one pass: a gene is unpivoted to
    (level, value), summed per (level, value, bin), and the totals over bins are taken from that. Only the
    output columns of this step are documented; the weights are this library's choice.
    """
    rows = (rgi.join(depth.select(*names(by, "orf_id"), "depth"), names(by, "orf_id"), "left")
            .withColumn("depth", F.coalesce("depth", F.lit(1.0))))
    if bins is not None:
        rows = rows.join(bins.select(*names(by), F.col("contig").alias("scaffold"), F.col("taxid").alias("bin")),
                         names(by, "scaffold"), "left").withColumn("bin", F.coalesce("bin", F.lit("Unknown")))
    else:
        rows = rows.withColumn("bin", F.lit("Unknown"))
    def listed(level: str) -> Column:
        parts = F.array_distinct(F.split(F.col(level).cast("string"), r";\s*"))
        return F.transform(parts, lambda v: F.struct(F.lit(level).alias("level"), v.alias("value")))

    values = F.concat(*[listed(c) for c in RESISTANCE_LEVELS])
    per_bin = (rows.select(*names(by), "bin", "depth", F.explode(values).alias("_v"))
               .where(F.col("_v.value") != "")
               .groupBy(*names(by), F.col("_v.level").alias("level"), F.col("_v.value").alias("value"), "bin")
               .agg(F.count(F.lit(1)).alias("genes"), F.sum(F.col("depth").cast(EXACT)).alias("_d")))
    key = names(by, "level", "value")
    total = per_bin.groupBy(*key).agg(F.sum("genes").alias("genes"), F.sum("_d").alias("_d"))
    out = total.withColumn("bin", F.lit("all"))
    if bins is not None:
        out = out.unionByName(per_bin)
    return out.select(*key, "bin", "genes", F.col("_d").cast("double").alias("depth"))


def assembly_summary(scaffolds: DataFrame, ref_len: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Scaffolds, length, coverage, depth and genes per genome, per species and in total.

    `scaffolds(scaffold, taxid, species_ti, length, depth, n_genes)` and `ref_len(taxid, length)`. Coverage is
    assembled length over genome length (a species takes its longest genome); depth is weighted by length.
    Scaffolds are summed per genome once and the upper levels are built from that. Only the output columns
    of this step are documented.
    """
    genome = scaffolds.groupBy(*names(by, "species_ti", "taxid")).agg(
        F.count(F.lit(1)).alias("scaffolds"), F.sum("length").alias("length"), F.sum("n_genes").alias("genes"),
        F.sum((F.col("length") * F.col("depth")).cast(EXACT)).alias("_ld"))
    genome = genome.join(ref_len.select(F.col("taxid").cast("string").alias("taxid"),
                                        F.col("length").alias("ref_length")), "taxid", "left")

    def level(label: str, group: list[str], key) -> DataFrame:
        return (genome.groupBy(*names(by), *group)
                .agg(F.sum("scaffolds").alias("scaffolds"), F.sum("length").alias("length"),
                     F.sum("genes").alias("genes"), F.sum("_ld").alias("_ld"), F.max("ref_length").alias("_ref"))
                .select(*names(by), F.lit(label).alias("level"), key.alias("key"), "scaffolds", "length",
                        (F.col("length") / F.col("_ref") if group else F.lit(None).cast("double")).alias("coverage"),
                        (F.col("_ld").cast("double") / F.col("length")).alias("depth"), "genes"))

    return (level("genome", ["taxid"], F.col("taxid"))
            .unionByName(level("species", ["species_ti"], F.col("species_ti")))
            .unionByName(level("sample", [], F.lit("all"))))
