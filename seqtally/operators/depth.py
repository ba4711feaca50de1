"""Positional depth: window averages, genome breadth, and variants from pileups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqtally.functions.expr import extract_tag, trunc_to
from seqtally.operators.common import checked_broadcast, dealt, names, spread_join
from seqtally.session import cut_lineage


def windowed_depth(depth: DataFrame, columns: Sequence[str], step: int = 20, by: Sequence[str] = ()) -> DataFrame:
    """Mean depth around a node every `step` positions, over the positions present within one step of it.

    Each position adds to the node before and the node after it, so two rows per position are summed by
    (sequence, node) and a long sequence is spread over all its nodes. Nodes at 0 or past the last position
    are dropped.
    """
    key = names(by, "seq_id")
    before = F.col("pos") - F.pmod("pos", F.lit(step))
    nodes = depth.select(*key, F.explode(F.array(before, before + step)).alias("node"), *columns)
    per = (nodes.where(F.col("node") > 0).groupBy(*key, "node")
           .agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(c) for c in columns]))
    last = depth.groupBy(*key).agg(F.max("pos").alias("_last"))
    return (spread_join(per, last, key, counted=depth).where(F.col("node") <= F.col("_last"))
            .select(*key, "node", *[trunc_to(F.col(c) / F.col("_n"), 1).alias(c) for c in columns]))


def breadth(pileup: DataFrame, index: DataFrame, min_depth: int = 2, min_breadth: float = 0.75,
            by: Sequence[str] = ()) -> DataFrame:
    """Share of each genome covered at `min_depth` or more, for the genomes above `min_breadth`.

    `pileup(seq_id, pos, depth)` and `index(seq_id, length)` carry `taxid|N` in the id. The step's arguments
    are documented but not its code; a position listed once is taken to be one covered base.
    """
    taxid = extract_tag("seq_id", "taxid").cast("long").alias("taxid")
    covered = (pileup.where(F.col("depth") >= min_depth).groupBy(*names(by), taxid)
               .agg(F.count(F.lit(1)).alias("covered")))
    length = index.groupBy(taxid).agg(F.sum("length").alias("length"))
    return (covered.join(length, "taxid").withColumn("breadth", F.col("covered") / F.col("length"))
            .where(F.col("breadth") > min_breadth).select(*names(by, "taxid"), "covered", "length", "breadth"))


def keep_passing(pileup: DataFrame, taxa: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Pileup rows of the listed taxids, matched on the taxid in the id rather than by text search.

    With `by`, a sample's list opens the rows of that sample only.
    """
    keyed = pileup.withColumn("_t", extract_tag("seq_id", "taxid").cast("long"))
    listed = taxa.select(*by, F.col("taxid").cast("long").alias("_t")).distinct()
    return keyed.join(checked_broadcast(cut_lineage(listed)), names(by, "_t"), "left_semi").drop("_t")


def pileup_alleles(pileup: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """`seq_id, pos, ref, allele, n` from the base column of a pileup, for each `by` group.

    `.` and `,` are the reference, `^x` and `$` mark read ends, `+2AG` / `-2AG` are an insertion or deletion
    (written `+AG` / `-AG`) that belongs to the base before it, `*` is a gap.
    """
    bases = F.regexp_replace(F.regexp_replace(F.upper("bases"), r"\^.", ""), r"\$", "")
    indels = F.filter(F.regexp_extract_all(bases, F.lit(r"([+-]\d+[ACGTN]+)"), 1), lambda x: x != "")
    # The digits say how many letters belong to the indel; letters behind those are plain bases.
    cut = F.transform(indels, lambda x: F.concat(
        F.substring(x, 1, 1),
        x.substr(F.length(F.regexp_extract(x, r"^([+-]\d+)", 1)) + 1,
                 F.regexp_extract(x, r"(\d+)", 1).cast("int"))))
    extra = F.transform(indels, lambda x: x.substr(
        F.length(F.regexp_extract(x, r"^([+-]\d+)", 1)) + F.regexp_extract(x, r"(\d+)", 1).cast("int") + 1,
        F.length(x)))
    plain = F.concat(F.regexp_replace(bases, r"[+-]\d+[ACGTN]+", ""), F.array_join(extra, ""))
    letters = F.filter(F.split(plain, ""), lambda x: x.rlike("[ACGTN.,]"))
    named = F.transform(letters, lambda x: F.when(x.isin(".", ","), F.upper("ref")).otherwise(x))
    return (pileup.select(*names(by, "seq_id", "pos"), F.upper("ref").alias("_ref"),
                          F.explode(F.concat(named, cut)).alias("allele"))
            .groupBy(*names(by, "seq_id", "pos"), F.col("_ref").alias("ref"), "allele").agg(F.count(F.lit(1)).alias("n")))


def call_variants(alleles: DataFrame, min_cov: int = 3, min_reads2: int = 2, min_freq: float = 0.66,
                  kind: str = "snp", by: Sequence[str] = ()) -> DataFrame:
    """Best non-reference allele of each site that passes coverage, support and frequency.

    `alleles(seq_id, pos, ref, allele, n)`. `kind` is `snp` (one letter) or `indel` (`+`/`-`). Coverage counts
    reads, so indels, which ride on a base, do not add to it. The thresholds are those of the caller the
    workflow runs; its internals are not reproduced.
    """
    is_indel = F.col("allele").rlike("^[+-]")
    wanted: Column = is_indel if kind == "indel" else ~is_indel & (F.col("allele") != F.col("ref"))
    candidate = F.when(wanted, F.struct((-F.col("n")).alias("_n"), F.col("allele")))
    return (alleles.groupBy(*names(by, "seq_id", "pos", "ref"))
            .agg(F.sum(F.when(is_indel, 0).otherwise(F.col("n"))).alias("coverage"), F.min(candidate).alias("_v"))
            .withColumn("reads2", -F.col("_v._n")).withColumn("freq", F.col("reads2") / F.col("coverage"))
            .where((F.col("coverage") >= min_cov) & (F.col("reads2") >= min_reads2) & (F.col("freq") >= min_freq))
            .select(*names(by, "seq_id", "pos", "ref"), F.col("_v.allele").alias("var"), "coverage", "reads2", "freq"))


# ---- variant tables ------------------------------------------------------------------------------


def variant_loc(variants: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """`taxid, loc, val` with the site written `acc|position|ref`."""
    return variants.select(*names(by, "taxid"),
                           F.concat_ws("|", F.col("acc"), F.col("position").cast("string"), F.col("ref")).alias("loc"),
                           F.col("var").alias("val"))


def variant_presence(variants: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """`taxid, loc|val, 1`: one row per variant seen."""
    placed = variant_loc(variants, by)
    return placed.select(*names(by, "taxid"), F.concat_ws("|", "loc", "val").alias("variant"), F.lit(1).alias("present"))


def variant_matrix(variants: DataFrame, samples: Sequence[str], sample: str = "sample") -> DataFrame:
    """Presence (0/1) of every variant of every taxid across the samples.

    Calls are dealt by variant and meet in one grouping, as few of them repeat. Variants seen only in samples that are
    not listed have a row of zeros.
    """
    key = ["taxid", "variant"]
    seen = dealt(variant_presence(variants, [sample]), key)
    return seen.groupBy(*key).agg(*[
        F.max(F.when(F.col(sample) == F.lit(s), F.col("present")).otherwise(0)).alias(s) for s in samples])

