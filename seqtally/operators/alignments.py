"""Choosing alignments per read, sharing multi-mapped reads, and depth of coverage.

Alignment rows have at least `read_id, flag, ref_id, mate_ref, score, ord`; `ord` is any orderable
column (a struct is fine) that is unique within a read and follows the input order. `by` names extra
grouping columns, for instance the sample.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqtally.functions.expr import (EXACT, FIRST_IN_PAIR, MATE_UNMAPPED, PAIRED, PROPER_PAIR, SECOND_IN_PAIR,
                                     UNMAPPED, flag_is, trunc_to)
from seqtally.operators.common import keep_or_drop, names, with_group_total

UNPLACED = "*"


def _placed(aln: DataFrame) -> DataFrame:
    return aln.where(F.col("ref_id").cast("string") != UNPLACED)


def _mate(number: int) -> Column:
    first = flag_is("flag", FIRST_IN_PAIR)
    return first if number == 1 else flag_is("flag", SECOND_IN_PAIR) & ~first


def _concordant() -> Column:
    return ((F.col("r1.ref_id") == F.col("r2.ref_id")) & (F.col("r1.mate_ref") == "=")
            & (F.col("r2.mate_ref") == "="))


def _first_of_each_mate(kept: DataFrame, by: Sequence[str]) -> DataFrame:
    """Order, reference and mate reference of the first row of each mate: no sequence or quality is moved."""
    row = F.struct("ord", "ref_id", "mate_ref")
    return kept.groupBy(*names(by, "read_id")).agg(
        F.min(F.when(_mate(1), row)).alias("r1"), F.min(F.when(_mate(2), row)).alias("r2"))


def _fetch(kept: DataFrame, pairs: DataFrame, by: Sequence[str]) -> DataFrame:
    """The whole rows of the chosen mates, met on read and order."""
    key = names(by, "read_id")
    chosen = (pairs.select(*key, F.explode(F.array(F.col("r1.ord"), F.col("r2.ord"))).alias("ord"))
              .where(F.col("ord").isNotNull()))
    return kept.join(chosen, [*key, "ord"], "left_semi").select(*kept.columns)


def _good_pairs(aln: DataFrame, min_score: int) -> DataFrame:
    return _placed(aln).where(
        (F.col("score") >= min_score) & flag_is("flag", PAIRED) & flag_is("flag", PROPER_PAIR)
        & ~flag_is("flag", UNMAPPED) & ~flag_is("flag", MATE_UNMAPPED))


def top_pair(aln: DataFrame, min_score: int, by: Sequence[str] = ()) -> DataFrame:
    """First alignment of each mate, when both exist, are proper pairs and agree on the reference."""
    kept = _good_pairs(aln, min_score)
    return _fetch(kept, _first_of_each_mate(kept, by).where(_concordant()), by)


def _any_or_single(aln: DataFrame, min_score: int, proper: bool) -> DataFrame:
    kept = _placed(aln).where(F.col("score") >= min_score)
    return kept.where(~flag_is("flag", PAIRED) | flag_is("flag", PROPER_PAIR)) if proper else kept


def _pair_or_single(kept: DataFrame, proper: bool, by: Sequence[str]) -> DataFrame:
    pairs = _first_of_each_mate(kept, by)
    both = F.col("r1").isNotNull() & F.col("r2").isNotNull()
    any_mate = F.col("r1").isNotNull() | F.col("r2").isNotNull()
    if proper:
        return pairs.where(any_mate & (~both | _concordant()))
    return pairs.where(any_mate).withColumn(
        "r2", F.when(~both | F.coalesce(_concordant(), F.lit(False)), F.col("r2")))


def top_pair_or_single(aln: DataFrame, min_score: int, proper: bool = True, by: Sequence[str] = ()) -> DataFrame:
    """Like `top_pair`, but a read with one placed mate is kept.

    With `proper` a discordant pair is dropped; without it the first mate of such a pair is kept. Rows that
    are neither first nor second in a pair never count.
    """
    kept = _any_or_single(aln, min_score, proper)
    return _fetch(kept, _pair_or_single(kept, proper, by), by)


def kept_read_ids(aln: DataFrame, min_score: int, proper: bool = True, by: Sequence[str] = ()) -> DataFrame:
    """Ids of the reads `top_pair_or_single` keeps, one row per read."""
    return _pair_or_single(_any_or_single(aln, min_score, proper), proper, by).select(*names(by, "read_id"))


def top_scored(aln: DataFrame, min_score: int = 75, by: Sequence[str] = ()) -> DataFrame:
    """All alignments tied at the best score of their read.

    Single-end reads keep every row at the read's best score. For paired reads the best row of each mate is
    taken per (read, reference); a concordant couple scores the sum, otherwise the better mate counts (the
    second on a tie), and all references tied at the read's best score are kept. A read is paired when its
    last row is.

    Rows are chosen on narrow columns: the first aggregation is per (read, reference) and combines before the
    shuffle, so the window that follows sees one row per reference of a read, whatever the number of
    alignment rows. The whole rows are then fetched by (read, order), a key no read can make hot.
    """
    key = names(by, "read_id")
    kept = _placed(aln).where(F.col("score") >= min_score).withColumn("_paired", flag_is("flag", PAIRED))
    in_second = F.col("_paired") & flag_is("flag", SECOND_IN_PAIR)
    narrow = kept.select(*key, "ref_id", "score", "ord", "mate_ref", "_paired", in_second.alias("_second"))
    best_first = F.struct((-F.col("score")).alias("neg"), F.col("ord"), F.col("mate_ref"))
    per_ref = narrow.groupBy(*key, "ref_id").agg(
        F.min(F.when(~F.col("_second"), best_first)).alias("r1"),
        F.min(F.when(F.col("_second"), best_first)).alias("r2"),
        F.max(F.struct("ord", "_paired")).alias("_last"))

    r1, r2 = F.coalesce(-F.col("r1.neg"), F.lit(0)), F.coalesce(-F.col("r2.neg"), F.lit(0))
    mate_ref = F.when(F.col("r2").isNotNull(), F.col("r2.mate_ref")).otherwise(F.col("r1.mate_ref"))
    couple = F.coalesce((mate_ref == "=") & (r1 > 0) & (r2 > 0), F.lit(False))
    of_read = Window.partitionBy(*key)
    chosen = (per_ref
              .withColumn("_score", F.when(couple, r1 + r2).otherwise(F.greatest(r1, r2)))
              .withColumn("_source", F.when(couple, "R12").when(r1 > r2, "R1").otherwise("R2"))
              .withColumn("_read_paired", F.max("_last").over(of_read)["_paired"])
              .withColumn("_best", F.max("_score").over(of_read))
              .where(F.col("_read_paired") & (F.col("_score") == F.col("_best")))
              .select(*key, F.explode(F.array(F.when(F.col("_source") != "R2", F.col("r1.ord")),
                                              F.when(F.col("_source") != "R1", F.col("r2.ord")))).alias("ord"))
              .where(F.col("ord").isNotNull()))
    paired = kept.join(chosen, [*key, "ord"], "left_semi").select(*aln.columns)

    # Single-end reads need just their best score; its rows are then met on read and score, so that a read with
    # very many rows is not one key.
    single_best = (narrow.groupBy(*key).agg(F.max(F.struct("ord", "_paired")).alias("_last"),
                                            F.max(F.when(~F.col("_second"), F.col("score"))).alias("score"))
                   .where(~F.col("_last._paired")).select(*key, "score"))
    single = kept.where(~in_second).join(single_best, [*key, "score"], "left_semi").select(*aln.columns)
    return paired.unionByName(single)


def drop_host_groups(aln: DataFrame, min_score: int, by: Sequence[str] = ()) -> DataFrame:
    """Paired rows of the reads none of whose paired rows scores `min_score` or more."""
    paired = aln.where(flag_is("flag", PAIRED))
    offending = paired.where(F.col("score") >= min_score)
    return keep_or_drop(paired, offending, names(by, "read_id"), "left_anti")


# ---- sharing multi-mapped reads ------------------------------------------------------------------


def _share(per_target: DataFrame, target: str, by: Sequence[str], weights: Sequence[str] = ()) -> DataFrame:
    """Give 1/n of each read to its n targets and add up per target.

    Reads are first counted per (target, n) in integers; only those few rows are divided, which keeps the sum
    exact and independent of the partitioning.
    """
    counted = per_target.groupBy(*names(by, target), "_n").agg(
        F.count(F.lit(1)).alias("_reads"), *[F.sum(w).alias(w) for w in weights])

    def divided(value: str) -> Column:
        return F.sum((F.col(value) / F.col("_n")).cast(EXACT)).cast("double")

    return counted.groupBy(*names(by, target)).agg(
        divided("_reads").alias("reads"), *[divided(w).alias(w) for w in weights])


def fractional_counts(aln: DataFrame, target: str = "ref_id", by: Sequence[str] = ()) -> DataFrame:
    """Reads per target; a read is shared equally by the targets with most of its properly paired rows.

    Rows are counted per (read, target) before anything else, so a read never contributes more rows to the
    window than there are targets.
    """
    kept = aln.where(flag_is("flag", PAIRED) & flag_is("flag", PROPER_PAIR) & F.col(target).isNotNull()
                     & (F.col(target).cast("string") != UNPLACED))
    of_read = Window.partitionBy(*names(by, "read_id"))
    per_target = (kept.groupBy(*names(by, "read_id", target)).agg(F.count(F.lit(1)).alias("_rows"))
                  .withColumn("_most", F.max("_rows").over(of_read))
                  .where(F.col("_rows") == F.col("_most"))
                  .withColumn("_n", F.count(F.lit(1)).over(of_read)))
    return _share(per_target, target, by)


def classified_targets(cls: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per (read, taxid) of a classifier table, with the read's number of taxids and its length."""
    of_read = Window.partitionBy(*names(by, "read_id"))
    return (cls.groupBy(*names(by, "read_id", "taxid"))
            .agg(F.min(F.struct("ord", "query_len")).alias("_first"))
            .withColumn("_n", F.count(F.lit(1)).over(of_read))
            .withColumn("bases", F.min("_first").over(of_read)["query_len"]))


def classifier_counts(cls: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Reads and bases per taxid; a read is shared equally by all its distinct taxids."""
    return _share(classified_targets(cls, by), "taxid", by, weights=["bases"])


# ---- depth and abundance -------------------------------------------------------------------------


def reference_depth(counts: DataFrame, ref: DataFrame, read_len: int = 300, by: Sequence[str] = ()) -> DataFrame:
    """Reads, depth and length of every reference that got reads, deepest first."""
    return (counts.join(ref.select("ref_id", "length", "descr"), "ref_id")
            .withColumn("depth", read_len * F.col("reads") / F.col("length"))
            .select(*names(by, "ref_id", "reads", "depth", "length", "descr"))
            .orderBy(*by, F.desc("depth"), "ref_id"))


def reference_abundance(counts: DataFrame, ref: DataFrame, read_len: int = 300, cutoff: float = 1e-4,
                        covered: DataFrame | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Relative abundance of the references with at least `cutoff`, most abundant first.

    `covered(ref_id, covered_bp)` adds the covered fraction, cut after five decimals.
    """
    depth = (counts.join(ref.select("ref_id", "length", "descr"), "ref_id")
             .withColumn("depth", read_len * F.col("reads") / F.col("length")))
    out = (with_group_total(depth, F.sum(F.col("depth").cast(EXACT)).cast("double"), "_total", by)
           .withColumn("abundance", F.col("depth") / F.col("_total"))
           .where(F.col("abundance") >= cutoff))
    if covered is None:
        out = out.withColumn("fraction", F.lit(0.0))
    else:
        out = out.join(covered, names(by, "ref_id"), "left").withColumn(
            "fraction", F.coalesce(trunc_to(F.col("covered_bp") / F.col("length"), 5), F.lit(0.0)))
    return (out.select(*names(by, "ref_id", "length", "descr", "reads", "depth", "abundance", "fraction"))
            .orderBy(*by, F.desc("abundance"), "ref_id"))


def contig_depth(aln: DataFrame, contigs: DataFrame, read_len: int = 150, default: float = 1.0,
                 by: Sequence[str] = ()) -> DataFrame:
    """Depth of every contig from its alignment rows; `default` where there are none."""
    rows = (_placed(aln).groupBy(*names(by, "ref_id")).agg(F.count(F.lit(1)).alias("_rows"))
            .withColumnRenamed("ref_id", "contig"))
    depth = F.col("_rows") * read_len / F.col("length")
    return (contigs.join(rows, names(by, "contig"), "left")
            .select(*names(by, "contig"),
                    F.when((F.col("length") > 0) & F.col("_rows").isNotNull(), depth)
                    .otherwise(F.lit(float(default))).alias("depth")))
