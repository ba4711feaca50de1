"""Lineages, rank tables, taxonomic abundance and the coverage-evenness filter.

A lineage table has one row per leaf: `taxid` and, for each rank, `<rank>` (name) and `<rank>_ti` (id).
Taxonomy tables are dimensions: their size is set by the reference collection, not by the reads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqtally.functions.expr import EXACT, expected_breadth, trunc_to
from seqtally.operators.common import checked_broadcast, names, with_group_total, with_totals
from seqtally.session import cut_lineage

# Ranks from the root down, and the four superkingdoms that are reported.
RANKS = ["superkingdom", "kingdom", "phylum", "class", "order", "family", "genus", "species", "toprank"]
PROFILE_RANKS = ["phylum", "class", "order", "family", "genus", "species", "toprank"]
SUPERKINGDOMS = [(2, "Bacteria"), (2157, "Archaea"), (2759, "Eukaryota"), (10239, "Viruses")]
VIRUSES = 10239


def _ti(rank: str) -> str:
    return f"{rank}_ti"


def lineage_ids(nodes: DataFrame, leaves: DataFrame) -> DataFrame:
    """Ancestor id of each leaf at each rank, by pointer doubling over the parent table.

    A node knows the ids on its way up to some ancestor, first its parent. In each round it takes over what that
    ancestor knows and goes on from the ancestor's own, so ways double and a tree of depth d is done after log2(d)
    rounds. What is still on its way after as many rounds as the number of nodes has binary digits is on a cycle, which
    is an error if a leaf leads there. Of several ancestors of a rank the one nearest the root counts. A nameless-rank
    child of the viruses counts as a phylum.
    """
    rank = F.when((F.col("parent") == VIRUSES) & (F.col("rank") == "norank"), "phylum").otherwise(F.col("rank"))
    own = [F.when(rank == r, F.col("taxid").cast("long")).alias(_ti(r)) for r in RANKS[:-1]]
    state = cut_lineage(nodes.select("taxid", F.when(F.col("parent") > 1, F.col("parent")).alias("_up"), *own))
    wanted = cut_lineage(leaves.select("taxid").distinct())
    for _ in range(state.count().bit_length() + 1):
        if state.where(F.col("_up").isNotNull()).join(wanted, "taxid", "left_semi").isEmpty():
            return (wanted.join(state.drop("_up"), "taxid", "left")
                    .withColumn("toprank_ti", F.col("taxid").cast("long")))
        above = state.select(F.col("taxid").alias("_up"), F.col("_up").alias("_next"),
                             *[F.col(_ti(r)).alias(f"_{_ti(r)}") for r in RANKS[:-1]])
        state = cut_lineage(state.join(above, "_up", "left").select(
            "taxid", F.col("_next").alias("_up"),
            *[F.coalesce(f"_{_ti(r)}", _ti(r)).alias(_ti(r)) for r in RANKS[:-1]]))
    turning = state.where(F.col("_up").isNotNull()).join(wanted, "taxid", "left_semi").select("taxid").limit(5).collect()
    raise ValueError(f"the parents of these taxids run in a cycle: {', '.join(str(r.taxid) for r in turning)}")


def _with_names(ids: DataFrame, labels: DataFrame) -> DataFrame:
    """Turn id columns into (name, id) columns with one join: unpivot, look up, pivot back."""
    long = ids.select("*", F.explode(F.array(*[
        F.struct(F.lit(r).alias("_r"), F.col(_ti(r)).alias("_id")) for r in RANKS])).alias("_p"))
    named = long.join(labels.select(F.col("taxid").cast("long").alias("_lid"), F.col("name").alias("_name")),
                      F.col("_p._id") == F.col("_lid"), "left")
    keys = ids.columns
    return named.groupBy(*keys).agg(*[
        F.max(F.when(F.col("_p._r") == r, F.col("_name"))).alias(r) for r in RANKS])


def lineage(nodes: DataFrame, leaves: DataFrame, names_table: DataFrame) -> DataFrame:
    """Wide lineage (name and id per rank) of each leaf."""
    wide = _with_names(lineage_ids(nodes, leaves), names_table)
    return wide.select("taxid", *[c for r in RANKS for c in (r, _ti(r))])


def merge_names(scientific: DataFrame, headers: DataFrame) -> DataFrame:
    """Names by taxid: the scientific name, or else the one stamped into a sequence header (`_` for space)."""
    stamped = headers.groupBy("taxid").agg(F.max(F.translate("taxdes", "_", " ")).alias("_stamped"))
    return (scientific.select("taxid", "name").join(stamped, "taxid", "full")
            .select("taxid", F.coalesce("name", "_stamped").alias("name")))


def rank_table(lineage_table: DataFrame, names_table: DataFrame) -> DataFrame:
    """One row per (rank, taxid) with the lineage of that taxid.

    A leaf without a rank gets a synthetic taxon: minus the id of its nearest ancestor above, or -1.
    """
    ids = lineage_table.select(*[_ti(r) for r in RANKS])
    entries = []
    for i, rank in enumerate(RANKS):
        above = [F.struct(F.col(_ti(a)).alias("id"), F.lit(a).alias("rank"), F.lit(j).alias("depth"))
                 for j, a in reversed(list(enumerate(RANKS[:i])))]
        nearest = F.coalesce(*[F.when(s["id"].isNotNull(), s) for s in above]) if above else F.lit(None)
        own = F.col(_ti(rank))
        entries.append(F.struct(
            F.lit(rank).alias("rank"),
            F.coalesce(own, -nearest["id"] if above else F.lit(None), F.lit(-1).cast("long")).alias("taxid"),
            F.when(own.isNull() & F.lit(bool(above)), nearest["rank"] if above else F.lit(None).cast("string"))
            .alias("above"),
            # Ranks that belong to this taxon: down to its own position.
            F.when(own.isNotNull(), F.lit(i)).otherwise(nearest["depth"] if above else F.lit(None).cast("int"))
            .alias("_depth")))
    rows = ids.select("*", F.explode(F.array(*entries)).alias("_e"))
    rows = rows.select(
        F.col("_e.rank").alias("rank"), F.col("_e.taxid").alias("taxid"), F.col("_e.above").alias("_above"),
        *[F.when(F.col("_e._depth") >= i, F.col(_ti(r))).alias(_ti(r)) for i, r in enumerate(RANKS[:-1])])
    rows = rows.distinct()
    leaves = lineage_table.select(F.col("toprank_ti").alias("_leaf")).distinct()
    rows = (rows.join(leaves, F.abs("taxid") == F.col("_leaf"), "left")
            .withColumnRenamed("_leaf", "toprank_ti"))
    labelled = _with_names(rows, names_table)
    label = names_table.select(F.col("taxid").cast("long").alias("_lid"), F.col("name").alias("_own"))
    labelled = labelled.join(label, F.abs("taxid") == F.col("_lid"), "left")
    name = (F.when(F.col("taxid") == -1, "unknown")
            .when(F.col("taxid") < 0, F.concat(F.lit("Unnamed "), F.col("rank"), F.lit(" in "), F.col("_own"),
                                               F.lit(" "), F.col("_above")))
            .otherwise(F.col("_own")))
    return labelled.select("taxid", "rank", name.alias("name"), *[c for r in RANKS for c in (r, _ti(r))])


def exclude_taxa(df: DataFrame, listed: DataFrame | None = None, text: str | None = None) -> DataFrame:
    """Drop the taxids listed in a table and/or a comma-separated text; entries that are not numbers are ignored."""
    out = df
    if listed is not None:
        numbers = listed.select(F.col("taxid").cast("string").alias("_t")).where(F.col("_t").rlike(r"^\d+$"))
        ids = numbers.select(F.col("_t").cast("long").alias("taxid")).distinct()
        out = out.join(checked_broadcast(ids), "taxid", "left_anti")
    if text:
        out = out.where(~F.col("taxid").isin([int(t) for t in text.split(",") if t.isdigit()]))
    return out


# ---- abundance -----------------------------------------------------------------------------------


def _exact(c: str) -> Column:
    return F.sum(F.col(c).cast(EXACT)).cast("double")


def _mapped(source: DataFrame, by: Sequence[str], df: DataFrame) -> DataFrame:
    """Add the number of mapped reads of the counts in `source` (each read adds up to one)."""
    return with_totals(df, source, {"_mapped": F.round(_exact("reads"))}, by)


def superkingdom_reads(counts: DataFrame, lineage_table: DataFrame, total: int | DataFrame | None = None,
                       mapped_from: DataFrame | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Reads (whole numbers) of the four superkingdoms, in a fixed order, zero when absent.

    With `total` (a number, or a table of `total` per `by` group) the reads that were not mapped follow as
    taxid -1. `mapped_from` holds the counts before any filter; by default the counts themselves.
    """
    source = counts if mapped_from is None else mapped_from
    per = (counts.join(lineage_table.select("taxid", "superkingdom_ti"), "taxid")
           .groupBy(*names(by), F.col("superkingdom_ti").alias("taxid")).agg(_exact("reads").alias("_reads")))
    # A read shared by n taxa adds n times 1/n: the tiny rounding of 1/n must not cut a whole read off.
    whole = F.floor(F.coalesce(F.col("_reads"), F.lit(0.0)) + 1e-9).cast("long")
    groups = source.select(*by).distinct() if by else counts.sparkSession.range(1).select(F.lit(0).alias("_one"))
    four = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(t).cast("long").alias("taxid"), F.lit(n).alias("superkingdom"))
                     for i, (t, n) in enumerate(SUPERKINGDOMS)])
    out = (groups.select(*by, F.explode(four).alias("_f")).select(*by, "_f.*").join(per, names(by, "taxid"), "left")
           .select(*by, "pos", "taxid", "superkingdom", whole.alias("reads")))
    if total is not None:
        known = groups.join(total, list(by)) if isinstance(total, DataFrame) else groups.withColumn("total", F.lit(total))
        rest = (_mapped(source, by, known)
                .select(*by, F.lit(len(SUPERKINGDOMS)).alias("pos"), F.lit(-1).cast("long").alias("taxid"),
                        F.lit("unmaped").alias("superkingdom"),
                        (F.col("total") - F.col("_mapped")).cast("long").alias("reads"))
                .where(F.col("reads") > 0))
        out = out.unionByName(rest)
    return out.orderBy(*by, "pos").drop("pos")


def taxon_abundance(counts: DataFrame, lengths: DataFrame, lineage_table: DataFrame, read_len: int = 300,
                    cutoff: float = 1e-9, mapped_from: DataFrame | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Depth and relative abundance of each taxid.

    Within a superkingdom the abundance follows depth; superkingdoms share by their mapped reads. Values are
    cut after eight decimals, those under `cutoff` dropped and the rest brought back to a sum of one.
    `read_len=0` uses the counted bases instead of a fixed read length.
    """
    bases = F.col("bases") if read_len == 0 else read_len * F.col("reads")
    depth = (counts.join(lengths.select("taxid", "length"), "taxid")
             .join(lineage_table.select("taxid", "superkingdom_ti"), "taxid")
             .withColumn("depth", bases / F.col("length"))
             .withColumn("_sk", F.coalesce("superkingdom_ti", F.lit(0))))
    per_sk = depth.groupBy(*names(by, "_sk")).agg(_exact("depth").alias("_sk_depth"), _exact("reads").alias("_sk_reads"))
    share = (_mapped(counts if mapped_from is None else mapped_from, by, depth.join(per_sk, names(by, "_sk")))
             .withColumn("raw_abundance", trunc_to(
                 F.col("depth") / F.col("_sk_depth") * (F.col("_sk_reads") / F.col("_mapped")), 8))
             .where(F.col("raw_abundance") >= cutoff)
             .select(*names(by, "taxid", "reads", "depth", "raw_abundance")))
    return with_group_total(share, _exact("raw_abundance"), "_kept", by).select(
        *names(by, "taxid", "reads", "depth"), (F.col("raw_abundance") / F.col("_kept")).alias("abundance"))


def rank_rollup_all(abundance: DataFrame, lineage_table: DataFrame, ranks: Sequence[str] = tuple(PROFILE_RANKS),
                    by: Sequence[str] = ()) -> DataFrame:
    """Abundance, depth and reads at every rank in one pass, most abundant first within a rank.

    A taxon without an id at a rank is counted under its next lower rank that has one. The lineage names of
    a row are those of its smallest taxid, down to the rank.
    """
    wide = abundance.join(lineage_table, "taxid")
    entries = []
    for rank in ranks:
        i = RANKS.index(rank)
        entries.append(F.struct(F.lit(rank).alias("rank"), F.lit(i).alias("_depth"),
                                F.coalesce(*[F.col(_ti(r)) for r in RANKS[i:]]).alias("rank_taxid")))
    long = wide.select(*by, "taxid", "reads", "depth", "abundance", F.struct(*RANKS).alias("_names"),
                       F.explode(F.array(*entries)).alias("_e"))
    rolled = long.groupBy(*by, F.col("_e.rank").alias("rank"), F.col("_e._depth").alias("_depth"),
                          F.col("_e.rank_taxid").alias("rank_taxid")).agg(
        F.min_by("_names", "taxid").alias("_names"), _exact("abundance").alias("abundance"),
        _exact("depth").alias("depth"), _exact("reads").alias("reads"))
    return rolled.select(
        *by, "rank", "rank_taxid",
        *[F.when(F.col("_depth") >= i, F.col("_names")[r]).alias(r) for i, r in enumerate(RANKS)],
        "abundance", "depth", "reads").orderBy(*by, "rank", F.desc("abundance"), "rank_taxid")


def rank_rollup(abundance: DataFrame, lineage_table: DataFrame, rank: str, by: Sequence[str] = ()) -> DataFrame:
    """One rank of `rank_rollup_all`, without the columns of the ranks below."""
    below = RANKS[RANKS.index(rank) + 1:]
    return rank_rollup_all(abundance, lineage_table, [rank], by).drop("rank", *below)


# ---- evenness ------------------------------------------------------------------------------------


def evenness(cls: DataFrame, accessions: DataFrame, counts: DataFrame, read_len: int = 300,
             by: Sequence[str] = ()) -> DataFrame:
    """Observed and expected covered fraction of each taxid, with its deepest accession.

    `accessions(acc, taxid, length)`; an accession covers at most its own length.
    """
    per_acc = cls.groupBy(*by, F.col("seq_id").alias("acc")).agg(
        F.count(F.lit(1)).alias("acc_reads"), F.sum("query_len").alias("acc_bases"))
    acc_bases = F.col("acc_bases") if read_len == 0 else F.col("acc_reads") * read_len
    hit = (accessions.where(F.col("length") > 0).join(per_acc, "acc")
           .withColumn("_b", acc_bases).withColumn("_d", acc_bases / F.col("length")))
    observed = hit.groupBy(*names(by, "taxid")).agg(
        F.sum(F.least("_b", "length")).alias("_covered"),
        F.min_by(F.struct("acc", F.col("_d").alias("depth"), F.col("length"), F.col("acc_reads")),
                 F.struct(-F.col("_d"), F.col("acc"))).alias("_deepest"))
    lengths = accessions.groupBy("taxid").agg(F.sum("length").alias("length"))
    bases = F.col("bases") if read_len == 0 else read_len * F.col("reads")
    return (counts.join(lengths, "taxid").join(observed, names(by, "taxid"), "left")
            .withColumn("depth", bases / F.col("length")).where(F.col("depth") > 0)
            .select(*names(by, "taxid", "reads", "depth"),
                    expected_breadth("depth").alias("expected"),
                    (F.coalesce(F.col("_covered"), F.lit(0)) / F.col("length")).alias("observed"),
                    F.col("_deepest.acc").alias("deepest_acc"), F.col("_deepest.depth").alias("deepest_depth"),
                    F.col("_deepest.length").alias("deepest_length"),
                    F.col("_deepest.acc_reads").alias("deepest_reads")))


def evenness_filter(cls: DataFrame, accessions: DataFrame, counts: DataFrame, read_len: int = 300,
                    min_ratio: float = 0.1, by: Sequence[str] = ()) -> DataFrame:
    """The taxids that fail: covered far less evenly than their depth leads one to expect."""
    return evenness(cls, accessions, counts, read_len, by).where(
        F.col("observed") / F.col("expected") < min_ratio)


def mapped_reads(cls: DataFrame, failed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """`read_id, taxids` with the passing taxids of each read joined by `|`; reads with none are dropped.

    The list of a read holds distinct taxids only, so it is bounded by the taxonomy.
    """
    pairs = cls.select(*names(by, "read_id", "taxid")).distinct()
    # Give a written table: then the check costs nothing and, if it is small, the pairs stay where they are.
    return (pairs.join(checked_broadcast(failed.select(*names(by, "taxid"))), names(by, "taxid"), "left_anti")
            .groupBy(*names(by, "read_id"))
            .agg(F.concat_ws("|", F.transform(F.sort_array(F.collect_list("taxid")),
                                              lambda t: t.cast("string"))).alias("taxids")))
