"""Whole analyses composed from the operators.

The counts per taxid are written once, as several small steps read them: the reads are passed over only to
make them, and everything after is a plan over at most as many rows as there are taxa.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtally.operators.alignments import classifier_counts, fractional_counts
from seqtally.operators.common import checked_broadcast
from seqtally.operators.taxonomy import (evenness_filter, exclude_taxa, rank_rollup_all, superkingdom_reads,
                                         taxon_abundance)
from seqtally.session import cut_lineage


def alignment_profile(aln: DataFrame, lengths: DataFrame, lineage: DataFrame, read_len: int = 300,
                      cutoff: float = 1e-9, by: Sequence[str] = ()) -> DataFrame:
    """Taxonomic profile at all ranks from alignments with a `taxid` column; `by` profiles samples side by side."""
    counts = cut_lineage(fractional_counts(aln, "taxid", by))
    return rank_rollup_all(taxon_abundance(counts, lengths, lineage, read_len, cutoff, by=by), lineage, by=by)


def usable_classified(cls: DataFrame, lineage: DataFrame, lengths: DataFrame, report: DataFrame | None = None,
                      exclude: str | None = None, excluded: DataFrame | None = None, min_hit_len: int = 60) -> DataFrame:
    """Classifier rows that count: long enough, and of a reported taxid with lineage and length, not excluded.

    The taxid conditions are joined to each other first, so the reads meet one short list, and are not
    shuffled by taxid when its size allows a broadcast.
    """
    taxa = lineage.select("taxid").join(lengths.select("taxid"), "taxid", "left_semi")
    if report is not None:
        taxa = taxa.join(report.select("taxid"), "taxid", "left_semi")
    taxa = exclude_taxa(taxa, excluded, exclude)
    return (cls.where((F.col("hit_len") >= min_hit_len) & (F.col("taxid") != 0))
            .join(checked_broadcast(taxa.distinct()), "taxid", "left_semi"))


def classifier_profile(cls: DataFrame, accessions: DataFrame, lineage: DataFrame, report: DataFrame | None = None,
                       exclude: str | None = None, excluded: DataFrame | None = None, read_len: int = 300,
                       cutoff: float = 1e-6, min_hit_len: int = 60, min_ratio: float = 0.1,
                       total: int | DataFrame | None = None, by: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Profile from a per-read classifier: usable rows, counts, evenness, superkingdoms and rank tables.

    `accessions(acc, taxid, length)` gives both accession and genome lengths. With `by`, all samples are
    profiled at once.
    """
    lengths = accessions.groupBy("taxid").agg(F.sum("length").alias("length"))
    usable = usable_classified(cls, lineage, lengths, report, exclude, excluded, min_hit_len)
    counts = cut_lineage(classifier_counts(usable, by))
    failed = cut_lineage(evenness_filter(usable, accessions, counts, read_len, min_ratio, by))
    kept = counts.join(failed.select(*by, "taxid"), [*by, "taxid"], "left_anti")
    # Mapped reads are counted before the evenness filter.
    abundance = taxon_abundance(kept, lengths, lineage, read_len, cutoff, counts, by)
    return {
        "usable": usable,
        "counts": counts,
        "failed": failed,
        "superkingdoms": superkingdom_reads(kept, lineage, total, counts, by),
        "ranks": rank_rollup_all(abundance, lineage, by=by),
    }
