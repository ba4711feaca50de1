"""Assigning contigs to taxa by the reads they share with reference genomes, or by long alignments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqtally.functions.expr import EXACT, FIRST_IN_PAIR, flag_is
from seqtally.operators.common import dealt, names, spread_join

UNKNOWN = "Unknown"


def _contig_reads(aln: DataFrame, first_only: bool, by: Sequence[str]) -> DataFrame:
    """Rows per (contig, read). Neither a big contig nor a repeated read stays a long run of rows."""
    rows = aln.where(flag_is("flag", FIRST_IN_PAIR)) if first_only else aln
    rows = dealt(rows.select(*names(by, "contig", "read_id")), names(by, "read_id"))
    return rows.groupBy(*names(by, "contig", "read_id")).agg(F.count(F.lit(1)).alias("_rows"))


def _read_taxa(aln: DataFrame, max_taxa: int, first_only: bool, by: Sequence[str]) -> DataFrame:
    rows = aln.where(flag_is("flag", FIRST_IN_PAIR)) if first_only else aln
    rows = dealt(rows.where(F.col("taxid").isNotNull()).select(*names(by, "read_id", "taxid")), names(by, "read_id"))
    of_read = Window.partitionBy(*names(by, "read_id"))
    return (rows.distinct()
            .withColumn("_n", F.count(F.lit(1)).over(of_read)).where(F.col("_n") <= max_taxa))


def _contig_taxa(contig_aln: DataFrame, ref_aln: DataFrame, max_taxa: int, first_only: bool,
                 by: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(reads per contig, support per (contig, taxid)); support is summed exactly over counts per 1/n."""
    reads = _contig_reads(contig_aln, first_only, by)
    totals = reads.groupBy(*names(by, "contig")).agg(F.sum("_rows").alias("n_reads"))
    support = (reads.join(_read_taxa(ref_aln, max_taxa, first_only, by), names(by, "read_id"))
               .groupBy(*names(by, "contig", "taxid"), "_n").agg(F.sum("_rows").alias("_rows"))
               .groupBy(*names(by, "contig", "taxid"))
               .agg(F.sum((F.col("_rows") / F.col("_n")).cast(EXACT)).alias("_support")))
    return totals, support


def _best(support: DataFrame, group: Sequence[str], label: str, by_value: str = "_support") -> DataFrame:
    """Best label of each group; the smaller label on a tie."""
    return support.groupBy(*group).agg(
        F.min(F.struct((-F.col(by_value)).alias("_neg"), F.col(label).alias("_label"))).alias("_b")
    ).select(*group, F.col("_b._label").alias(label), (-F.col("_b._neg")).alias(by_value))


def _share(support: Column, reads: Column) -> Column:
    return support.cast("double") / reads


def bin_contigs(contig_aln: DataFrame, ref_aln: DataFrame, contigs: DataFrame, max_taxa: int = 10,
                min_share: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    """Taxid of each contig by the first mates it shares with genomes.

    A read with more than `max_taxa` taxids says nothing; another gives each of its n taxids 1/n. The best
    taxid is taken when its share of the contig's reads is at least `min_share`.
    """
    totals, support = _contig_taxa(contig_aln, ref_aln, max_taxa, True, by)
    best = _best(support, names(by, "contig"), "taxid")
    share = _share(F.col("_support"), F.col("n_reads"))
    return (contigs.join(totals, names(by, "contig"), "left").join(best, names(by, "contig"), "left")
            .withColumn("_p", share)
            .withColumn("_ok", F.coalesce(F.col("_p") >= min_share, F.lit(False)))
            .select(*names(by, "contig"),
                    F.when(F.col("_ok"), F.col("taxid").cast("string")).otherwise(UNKNOWN).alias("taxid"),
                    F.when(F.col("_ok"), F.col("_p")).otherwise(1.0).alias("p"),
                    F.coalesce("n_reads", F.lit(0)).alias("n_reads"), "length"))


def bin_contigs_species(contig_aln: DataFrame, ref_aln: DataFrame, contigs: DataFrame, lineage: DataFrame,
                        contaminants: DataFrame | None = None, max_taxa: int = 10, min_share: float = 0.5,
                        by: Sequence[str] = ()) -> DataFrame:
    """As `bin_contigs` with both mates, but the species decides and its best taxid is reported.

    Contigs whose taxid is listed in `contaminants(taxid)` are relabelled.
    """
    totals, support = _contig_taxa(contig_aln, ref_aln, max_taxa, False, by)
    taxa = lineage.select("taxid", "species_ti", "species", F.col("toprank").alias("strain"))
    per_species = (spread_join(support, taxa.select("taxid", "species_ti"), ["taxid"], computed=True)
                   .groupBy(*names(by, "contig", "species_ti"))
                   .agg(F.sum("_support").alias("_sp"),
                        F.min(F.struct((-F.col("_support")).alias("neg"), F.col("taxid"))).alias("_best")))
    # Species that have no id count as one, as they share the same (null) key.
    chosen = spread_join(per_species.groupBy(*names(by, "contig"))
              .agg(F.min(F.struct((-F.col("_sp")).alias("neg"), F.col("species_ti"), F.col("_best.taxid").alias("taxid")))
                   .alias("_w"))
              .select(*names(by, "contig"), (-F.col("_w.neg")).alias("_sp"), "_w.species_ti", "_w.taxid"),
              taxa.drop("species_ti"), ["taxid"], computed=True)
    listed = (contaminants.select("taxid", F.lit(True).alias("_bad")).distinct() if contaminants is not None
              else taxa.select("taxid", F.lit(False).alias("_bad")))
    out = (contigs.join(totals, names(by, "contig"), "left")
           .join(spread_join(chosen, listed, ["taxid"], "left", computed=True), names(by, "contig"), "left")
           .withColumn("_p", _share(F.col("_sp"), F.col("n_reads")))
           .withColumn("_ok", F.coalesce(F.col("_p") >= min_share, F.lit(False))))
    bad = F.col("_ok") & F.coalesce("_bad", F.lit(False))

    def cell(value: Column, when_bad: Column) -> Column:
        return F.when(bad, when_bad).when(F.col("_ok"), value).otherwise(UNKNOWN)

    sp, tx = F.col("species_ti").cast("string"), F.col("taxid").cast("string")
    return out.select(
        *names(by, "contig"),
        cell(sp, F.lit("contaminant")).alias("species_taxid"),
        cell(F.col("species"), F.concat(F.lit("sptid:"), sp)).alias("species"),
        cell(tx, F.lit("contaminant")).alias("taxid"),
        cell(F.col("strain"), F.concat(F.lit("taxid:"), tx)).alias("strain"),
        F.when(F.col("_ok"), F.col("_p")).otherwise(1.0).alias("p"),
        F.coalesce("n_reads", F.lit(0)).alias("n_reads"), "length")


def bin_host(bins: DataFrame, contig_aln: DataFrame, host_aln: DataFrame, min_score: int = 75,
             min_share: float = 0.8, by: Sequence[str] = ()) -> DataFrame:
    """Relabel the still unbinned contigs most of whose first mates align well to the host."""
    binned = (F.col("species_taxid").rlike(r"\d") | F.col("taxid").rlike(r"\d")
              | F.lower("species_taxid").contains("contaminant"))
    open_bins = bins.where(~binned)
    host = (host_aln.where((F.col("score") >= min_score) & flag_is("flag", FIRST_IN_PAIR))
            .select(*names(by, "read_id")).distinct().withColumn("_host", F.lit(1)))
    # Reads meet the host where they lie; only a row per contig is shuffled to the open bins.
    reads = (_contig_reads(contig_aln, True, by).join(host, names(by, "read_id"), "left")
             .groupBy(*names(by, "contig")).agg(
                 F.sum("_rows").alias("_all"),
                 F.sum(F.when(F.col("_host") == 1, F.col("_rows")).otherwise(0)).alias("_from_host"))
             .join(open_bins.select(*names(by, "contig")), names(by, "contig"), "left_semi")
             .withColumn("_share", F.col("_from_host") / F.col("_all")))
    is_host = F.coalesce(F.col("_share") >= min_share, F.lit(False))
    text = ["species_taxid", "species", "taxid", "strain"]
    return (bins.join(reads, names(by, "contig"), "left")
            .select(*names(by, "contig"),
                    *[F.when(is_host, "Host").otherwise(F.col(c)).alias(c) for c in text],
                    F.when(is_host, F.col("_share")).otherwise(F.col("p")).alias("p"),
                    F.when(is_host, F.col("_all")).otherwise(F.col("n_reads")).alias("n_reads"), "length"))


def bin_contigs_paf(paf: DataFrame, contigs: DataFrame, lineage: DataFrame, min_share: float = 0.5,
                    by: Sequence[str] = ()) -> DataFrame:
    """Bin contigs from long alignments `paf(contig, taxid, matches)`: the taxid with most matched bases.

    Only arguments and output of this step are documented; taking it when it holds `min_share` of the matched
    bases is this library's choice.
    """
    per = paf.groupBy(*names(by, "contig", "taxid")).agg(F.sum("matches").alias("_support"))
    total = per.groupBy(*names(by, "contig")).agg(F.sum("_support").alias("_all"))
    best = _best(per, names(by, "contig"), "taxid").join(
        lineage.select("taxid", "species_ti", "species", F.col("toprank").alias("strain")), "taxid", "left")
    out = (contigs.join(total, names(by, "contig"), "left").join(best, names(by, "contig"), "left")
           .withColumn("_p", F.col("_support") / F.col("_all"))
           .withColumn("_ok", F.coalesce(F.col("_p") >= min_share, F.lit(False))))

    def cell(value: Column) -> Column:
        return F.when(F.col("_ok"), value).otherwise(UNKNOWN)

    return out.select(*names(by, "contig"), cell(F.col("species_ti").cast("string")).alias("species_taxid"),
                      cell(F.col("species")).alias("species"), cell(F.col("taxid").cast("string")).alias("taxid"),
                      cell(F.col("strain")).alias("strain"),
                      F.when(F.col("_ok"), F.col("_p")).otherwise(1.0).alias("p"),
                      F.coalesce("_all", F.lit(0)).alias("matched_bases"), "length")
