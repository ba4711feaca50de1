"""Assigning scaffolds to taxa by their genes, and the gene, scaffold and taxon tables built on that.

Inputs: `orf(orf_id, header, scaffold)`; `best(query, subject, pct_iden, aln_len, ref_len)` with one hit per
gene; `clusters(ref_id, taxids, ko, descr)`; `bins` as made by the species binning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqtally.functions.expr import EXACT, contig_of, extract_tag, orf_info, trunc_to
from seqtally.operators.common import dealt, keep_or_drop, names, spread_join
from seqtally.operators.sequences import numbered
from seqtally.operators.taxonomy import RANKS
from seqtally.session import cut_lineage

UNKNOWN = "Unknown"


def genes(orf: DataFrame) -> DataFrame:
    """Add the scaffold of each gene, read off the gene id."""
    return orf.withColumn("scaffold", contig_of("orf_id"))


def with_ref_len(hits: DataFrame) -> DataFrame:
    """Add the reference length stamped into the subject id (`len|N`), or the aligned length without one."""
    return hits.withColumn("ref_len", F.coalesce(extract_tag("subject", "len").cast("long"),
                                                 F.col("aln_len").cast("long")))


def _gene_counts(orf: DataFrame, by: Sequence[str]) -> DataFrame:
    return orf.groupBy(*names(by, "scaffold")).agg(F.count(F.lit(1)).alias("n_genes"))


def _seeds(bins: DataFrame, by: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(scaffolds already binned to a taxid, scaffolds that belong to a host or contaminant)."""
    seeded = (bins.where(F.col("taxid").rlike(r"\d"))
              .select(*names(by), F.col("contig").alias("scaffold"), F.col("taxid").cast("long").alias("taxid")))
    barred = (bins.where(F.col("taxid").isin("Host", "contaminant"))
              .select(*names(by), F.col("contig").alias("scaffold")))
    return seeded, barred


def _per_ref(orf: DataFrame, best: DataFrame, by: Sequence[str]) -> DataFrame:
    """`_w`, identity x aligned length, of each reference on each scaffold."""
    weight = (F.col("pct_iden") * F.col("aln_len")).cast(EXACT)
    return (orf.select(*names(by, "orf_id", "scaffold"))
            .join(best.withColumnRenamed("query", "orf_id"), names(by, "orf_id"))
            .groupBy(*names(by, "scaffold", "subject")).agg(F.sum(weight).alias("_w")))


def _shared_scores(per_ref: DataFrame, best: DataFrame, clusters: DataFrame, by: Sequence[str]) -> DataFrame:
    shared = clusters.where(F.size("taxids") > 0).select(
        F.col("ref_id").alias("subject"), F.size("taxids").alias("_n"), "taxids")
    shares = (spread_join(per_ref, shared, ["subject"], counted=best)
              .select(*names(by, "scaffold"), F.explode("taxids").alias("taxid"),
                      (F.col("_w").cast("double") / F.col("_n")).cast(EXACT).alias("_s")))
    # By scaffold, as what follows needs it; a scaffold has a row per reference and taxid at most.
    return dealt(shares, names(by, "scaffold")).groupBy(*names(by, "scaffold", "taxid")).agg(F.sum("_s").alias("score"))


def scaffold_scores(orf: DataFrame, best: DataFrame, clusters: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Score of each taxid on each scaffold: identity x aligned length, shared by the taxids of the hit."""
    return _shared_scores(_per_ref(orf, best, by), best, clusters, by)


def assign_scaffolds(orf: DataFrame, best: DataFrame, clusters: DataFrame, bins: DataFrame | None = None,
                     rule: str = "unique", lineage: DataFrame | None = None, min_share: float = 0.5,
                     by: Sequence[str] = (), ties: str = "together") -> DataFrame:
    """`scaffold, taxid, evidence, n_genes` for every scaffold that can be assigned.

    Binned scaffolds keep their taxid (`mapping`); those of a host or contaminant are left out. The others
    are scored by their genes (`kegg`): with `rule="unique"` the best taxid wins, and where several tie the
    one with most genes on the scaffolds assigned so far, then the smaller id. With `ties="together"` all ties are
    settled on the genes of the scaffolds without a tie; with `ties="in_order"` one after another, those with most genes
    first and then by id, each on what the ones before have added. With `rule="species"` a
    scaffold needs a single taxid, a single species, or a species with more than `min_share` of the score.
    """
    counts = cut_lineage(_gene_counts(orf, by))  # a row per scaffold, read three times
    per_ref = _per_ref(orf, best, by)
    if rule == "species":  # summed again for the scaffold's total
        per_ref = cut_lineage(per_ref)
    scored = _shared_scores(per_ref, best, clusters, by)
    seeded = None
    if bins is not None:
        seeded, barred = _seeds(bins, by)
        taken = seeded.select(*names(by, "scaffold")).unionByName(barred)
        scored = scored.join(taken, names(by, "scaffold"), "left_anti")
    seeds = None if seeded is None else (
        seeded.join(counts, names(by, "scaffold"), "left")
        .withColumn("n_genes", F.coalesce("n_genes", F.lit(0))).withColumn("evidence", F.lit("mapping")))

    if rule == "species":
        if lineage is None:
            raise ValueError("the species rule needs a lineage table")
        chosen = _by_species(per_ref, scored, lineage, min_share, by)
    else:
        chosen = _by_score(scored, counts, seeds, by, ties)
    out = chosen.join(counts, names(by, "scaffold")).withColumn("evidence", F.lit("kegg"))
    columns = names(by, "scaffold", "taxid", "evidence", "n_genes")
    out = out.select(*columns)
    return out if seeds is None else seeds.select(*columns).unionByName(out)


def _by_score(scored: DataFrame, counts: DataFrame, seeds: DataFrame | None, by: Sequence[str], ties: str) -> DataFrame:
    of_scaffold = Window.partitionBy(*names(by, "scaffold"))  # one row per taxid of a scaffold
    tops = (scored.withColumn("_top", F.max("score").over(of_scaffold)).where(F.col("score") == F.col("_top"))
            .withColumn("_ties", F.count(F.lit(1)).over(of_scaffold)))
    tops = cut_lineage(tops)  # read for the clear ones, for the tied ones and for what stands before the ties
    clear = tops.where(F.col("_ties") == 1).select(*names(by, "scaffold", "taxid"))
    standing = clear.join(counts, names(by, "scaffold")).select(*names(by, "taxid", "n_genes"))
    if seeds is not None:
        standing = standing.unionByName(seeds.select(*names(by, "taxid", "n_genes")))
    standing = standing.groupBy(*names(by, "taxid")).agg(F.sum("n_genes").alias("_genes"))
    tied = tops.where(F.col("_ties") > 1)
    if ties == "in_order":
        return clear.unionByName(settled_in_order(
            tied.join(counts, names(by, "scaffold")).select(*names(by, "scaffold", "taxid", "n_genes")), standing, by))
    tied = (spread_join(tied, standing, names(by, "taxid"), "left")
            .groupBy(*names(by, "scaffold"))
            .agg(F.min(F.struct((-F.coalesce("_genes", F.lit(0))).alias("_g"), F.col("taxid"))).alias("_w"))
            .select(*names(by, "scaffold"), F.col("_w.taxid").alias("taxid")))
    return clear.unionByName(tied)


def settled_in_order(tied: DataFrame, standing: DataFrame, by: Sequence[str] = (), block: int = 1 << 16) -> DataFrame:
    """`scaffold, taxid`: what settling the ties one after another would give, in rounds over all of them at once.

    `tied(<by>, scaffold, taxid, n_genes)` has a row for each taxid of a tie, `standing(<by>, taxid, _genes)` the genes
    before. A scaffold takes the taxid with most genes so far, then the smaller id; its own genes count from then on.

    For each open scaffold a taxid's genes at its turn are at least what earlier scaffolds are known to have added, and
    at most that and all genes of earlier open scaffolds that may still choose it. Once one taxid's least is enough
    against the others' most, the scaffold is settled. The first open scaffold always is, and what a round settles
    narrows the bounds of the rest, so few rounds do, also where one taxid is in most ties. Sums over earlier scaffolds
    go by blocks of the order, so that a taxid in very many ties isn't one task's work.
    """
    scaffold, at = names(by, "scaffold"), names(by, "taxid", "_block")
    turns = tied.groupBy(*scaffold).agg(F.first("n_genes").alias("n_genes")).withColumn(
        "ord", F.struct((-F.col("n_genes")).alias("genes"), F.col("scaffold").alias("scaffold")))
    turns = numbered(turns, by=by).select(*scaffold, F.col("number").alias("_turn"))
    start = standing.select(*names(by, "taxid"), F.col("_genes").alias("_start"))
    rows = cut_lineage(tied.join(turns, scaffold).join(start, names(by, "taxid"), "left").select(
        *names(by, "scaffold", "taxid", "n_genes", "_turn"), F.coalesce("_start", F.lit(0)).alias("_start"),
        F.floor(F.col("_turn") / block).alias("_block"), F.lit(False).alias("_done")))
    while True:
        known = F.when(F.col("_done"), F.col("n_genes")).otherwise(0)
        open_ = F.when(~F.col("_done"), F.col("n_genes")).otherwise(0)
        earlier = Window.partitionBy(*names(by, "taxid")).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        sums = (rows.groupBy(*at).agg(F.sum(known).alias("_k"), F.sum(open_).alias("_o"))
                .select(*at, F.coalesce(F.sum("_k").over(earlier), F.lit(0)).alias("_k"),
                        F.coalesce(F.sum("_o").over(earlier), F.lit(0)).alias("_o")))
        within = Window.partitionBy(*at).orderBy("_turn").rowsBetween(Window.unboundedPreceding, -1)
        bounds = (rows.withColumn("_kin", F.coalesce(F.sum(known).over(within), F.lit(0)))
                  .withColumn("_oin", F.coalesce(F.sum(open_).over(within), F.lit(0)))
                  .join(sums, at).where(~F.col("_done"))
                  .withColumn("_least", F.col("_start") + F.col("_k") + F.col("_kin"))
                  .withColumn("_most", F.col("_least") + F.col("_o") + F.col("_oin")))
        chosen = bounds.groupBy(*scaffold).agg(
            F.min(F.struct((-F.col("_least")).alias("least"), F.col("taxid").alias("taxid"))).alias("_w"),
            F.collect_list(F.struct("taxid", "_most")).alias("_all"))  # the taxids of one scaffold's hits
        beats = F.forall("_all", lambda u: (u["taxid"] == F.col("_w.taxid")) | (-F.col("_w.least") > u["_most"])
                         | ((-F.col("_w.least") == u["_most"]) & (F.col("_w.taxid") < u["taxid"])))
        chosen = chosen.where(beats).select(*scaffold, F.col("_w.taxid").alias("_taxid"))
        rows = cut_lineage(rows.join(chosen, scaffold, "left").where(F.col("_taxid").isNull() | (F.col("_taxid") == F.col("taxid")))
                           .withColumn("_done", F.col("_done") | F.col("_taxid").isNotNull()).select(*rows.columns))
        if rows.where(~F.col("_done")).isEmpty():
            return rows.select(*names(by, "scaffold", "taxid"))


def _by_species(per_ref: DataFrame, scored: DataFrame, lineage: DataFrame, min_share: float,
                by: Sequence[str]) -> DataFrame:
    total = per_ref.groupBy(*names(by, "scaffold")).agg(F.sum("_w").alias("_total"))
    per_taxid = spread_join(scored, lineage.select("taxid", "species_ti"), ["taxid"], "left", computed=True)
    per_species = (per_taxid.groupBy(*names(by, "scaffold", "species_ti"))
                   .agg(F.sum("score").alias("_sp"), F.count(F.lit(1)).alias("_taxids"),
                        F.min(F.struct((-F.col("score")).alias("_s"), F.col("taxid"))).alias("_best")))
    summary = per_species.groupBy(*names(by, "scaffold")).agg(
        F.count(F.lit(1)).alias("_species"), F.sum("_taxids").alias("_taxids"),
        F.min(F.struct((-F.col("_sp")).alias("_sp"), F.col("species_ti"), F.col("_best.taxid").alias("taxid")))
        .alias("_w"))
    return (summary.join(total, names(by, "scaffold"))
            .where((F.col("_species") == 1) | (-F.col("_w._sp") > F.col("_total") * F.lit(min_share)))
            .select(*names(by, "scaffold"), F.col("_w.taxid").alias("taxid")))


def _taxon_columns(lineage: DataFrame) -> tuple[DataFrame, list[str]]:
    shown = ["species_ti", *RANKS[:-1], "genome"]
    table = lineage.select("taxid", "species_ti", *RANKS[:-1], F.col("toprank").alias("genome"))
    return table, shown


def _with_taxon(df: DataFrame, lineage: DataFrame) -> tuple[DataFrame, list[str]]:
    """Add species id, taxid and lineage names as text; `Unknown` throughout when there is no taxid."""
    table, shown = _taxon_columns(lineage)
    known = F.col("taxid").isNotNull()
    out = spread_join(df, table, ["taxid"], "left")  # scaffolds without a taxid are spread like a hot one
    for c in shown:
        out = out.withColumn(c, F.when(known, F.col(c).cast("string")).otherwise(UNKNOWN))
    return out.withColumn("taxid", F.when(known, F.col("taxid").cast("string")).otherwise(UNKNOWN)), [
        "species_ti", "taxid", *RANKS[:-1], "genome"]


def orf_annotation(orf: DataFrame, best: DataFrame, clusters: DataFrame, assigned: DataFrame, lineage: DataFrame,
                   depth: DataFrame | None = None, bins: DataFrame | None = None,
                   contaminants: DataFrame | None = None, by: Sequence[str] = ()) -> DataFrame:
    """One row per gene: taxon, scaffold, position, identity, aligned fraction, family and description.

    Genes on the host and contaminant scaffolds of `bins`, and on scaffolds of the taxids in `contaminants`,
    are left out. `frac` is null where the text form shows `-` (a gene without a hit on a scaffold without a taxon).
    """
    about = clusters.select(F.col("ref_id").alias("subject"), "ko", "descr")
    hit = (best.withColumnRenamed("query", "orf_id")
           .withColumn("_frac", trunc_to(F.col("aln_len") / F.col("ref_len"), 4))
           .select(*names(by, "orf_id", "subject", "pct_iden", "_frac")))
    hit = spread_join(hit, about, ["subject"], "left", counted=best)
    # Taxon, evidence and depth are put together per scaffold, so genes meet one scaffold table.
    scaffold, taxon = _with_taxon(assigned.select(*names(by, "scaffold", "taxid", "evidence"))
                                  .withColumn("_placed", F.col("taxid").isNotNull()), lineage)
    if depth is not None:
        known = depth.select(*names(by), F.col("contig").alias("scaffold"), "depth")
        scaffold = scaffold.join(known, names(by, "scaffold"), "full")
    else:
        scaffold = scaffold.withColumn("depth", F.lit(None).cast("double"))
    barred = None if bins is None else _seeds(bins, by)[1]
    if contaminants is not None:
        listed = (assigned.join(contaminants.select("taxid"), "taxid", "left_semi").select(*names(by, "scaffold")))
        barred = listed if barred is None else barred.unionByName(listed)
    rows = orf.select(*names(by, "orf_id", "scaffold", "header"))
    if barred is not None:
        rows = keep_or_drop(rows, barred, names(by, "scaffold"), "left_anti")
    rows = rows.join(hit, names(by, "orf_id"), "left")
    rows = spread_join(rows, scaffold, names(by, "scaffold"), "left", counted=orf)
    found, placed = F.col("pct_iden").isNotNull(), F.coalesce("_placed", F.lit(False))
    return rows.select(
        *names(by), *[F.coalesce(c, F.when(~placed, UNKNOWN)).alias(c) for c in taxon], "scaffold", "orf_id",
        *[orf_info("header")[p].alias(p) for p in ("start", "end", "frame")],
        F.when(found, F.concat(F.col("pct_iden").cast("string"), F.lit("%"))).otherwise("-").alias("iden"),
        F.when(found, F.col("_frac")).when(placed, 1.0).alias("frac"), F.coalesce("ko", F.lit("")).alias("ko"),
        F.when(found & ~placed, F.coalesce("descr", F.lit("")))
        .otherwise(F.coalesce("descr", F.lit("hypothetical protein"))).alias("descr"),
        "depth", F.coalesce("evidence", F.lit("None")).alias("evidence"))


def _scaffold_rows(bins: DataFrame, orf: DataFrame, assigned: DataFrame, depth: DataFrame,
                   by: Sequence[str]) -> DataFrame:
    """All scaffolds of the binning that are not host or contaminant, with length, genes, depth and taxid.

    A narrow row per scaffold, written once: lists and lineages look at its taxids before they join.
    """
    scaffolds = (bins.where(~F.col("taxid").isin("Host", "contaminant"))
                 .select(*names(by), F.col("contig").alias("scaffold"), "length"))
    rows = (scaffolds.join(_gene_counts(orf, by), names(by, "scaffold"), "left")
            .join(assigned.select(*names(by, "scaffold", "taxid", "evidence")), names(by, "scaffold"), "left")
            .join(depth.select(*names(by), F.col("contig").alias("scaffold"), "depth"), names(by, "scaffold"), "left")
            .withColumn("n_genes", F.coalesce("n_genes", F.lit(0)))
            .withColumn("evidence", F.coalesce("evidence", F.lit("None"))))
    return cut_lineage(rows)


def scaffold_annotation(bins: DataFrame, orf: DataFrame, assigned: DataFrame, depth: DataFrame, lineage: DataFrame,
                        contaminants: DataFrame | None = None, by: Sequence[str] = (),
                        listed: bool = False) -> DataFrame:
    """Scaffold table with taxon, length, genes, depth and evidence.

    Scaffolds of a taxid in `contaminants(taxid)` are left out; `listed=True` gives just those instead.
    """
    rows = _scaffold_rows(bins, orf, assigned, depth, by)
    if contaminants is not None:
        rows = keep_or_drop(rows, contaminants, ["taxid"], "left_semi" if listed else "left_anti")
    rows, taxon = _with_taxon(rows, lineage)
    return rows.select(*names(by), *taxon, "scaffold", "length", "n_genes", "depth", "evidence")


def taxon_summary(bins: DataFrame, orf: DataFrame, assigned: DataFrame, depth: DataFrame, lineage: DataFrame,
                  contaminants: DataFrame | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Scaffolds, genes and summed length x depth of each taxid, and of the scaffolds without one.

    In the row without a taxid only scaffolds with genes are counted; their depth counts either way.
    """
    rows = _scaffold_rows(bins, orf, assigned, depth, by)
    if contaminants is not None:
        rows = keep_or_drop(rows, contaminants, ["taxid"], "left_anti")
    counts = F.col("taxid").isNotNull() | (F.col("n_genes") > 0)
    per = rows.groupBy(*names(by, "taxid")).agg(
        F.sum(F.when(counts, 1).otherwise(0)).alias("n_scaffolds"), F.sum("n_genes").alias("n_genes"),
        F.sum((F.col("length") * F.coalesce("depth", F.lit(0.0))).cast(EXACT)).cast("double").alias("sum_depth"))
    per, taxon = _with_taxon(per, lineage)
    return per.select(*names(by), *taxon, "n_scaffolds", "n_genes", "sum_depth")
