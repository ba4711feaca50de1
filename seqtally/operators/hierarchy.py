"""Functional hierarchies: reading the level structure and rolling gene-family depth up to every level."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqtally.functions.expr import EXACT, trunc_to
from seqtally.operators.common import names, scalar_of, with_totals

LEVELS = ["A", "B", "C", "D", "E"]
# Which level markers close an open node. A closes all; E stays open until the next A.
CLOSED_BY = {"A": ["A"], "B": ["A", "B"], "C": ["A", "B", "C"], "D": ["A", "B", "C", "D"], "E": ["A"]}
FIRST_LEAF_ID = 1000001


def _tagged_lines(lines: DataFrame) -> DataFrame:
    """Data lines of `lines(file, ord, value)` with level, node id or KO, and the open node of each level.

    The windows run over one hierarchy file, a few megabytes of dimension data.
    """
    in_file = Window.partitionBy("file").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    value = F.col("value")
    both = value.contains("<b>") & value.contains("</b>")
    plain = F.when(both, F.regexp_replace(F.regexp_replace(value, "<b>", ""), "</b>", "")).otherwise(value)
    data = (lines.withColumn("_marks", F.sum(F.when(value.startswith("!"), 1).otherwise(0)).over(in_file))
            .where((F.col("_marks") == 1) & ~value.startswith("!") & ~value.startswith("#"))
            .withColumn("_plain", plain)
            .withColumn("level", F.substring("_plain", 1, 1))
            .withColumn("_text", F.ltrim(F.expr("substring(_plain, 2)"))))
    text = F.col("_text")
    filled = text.rlike(r"\w")
    is_ko = filled & text.rlike(r"^K\d")
    module = F.regexp_extract(text, r"^(M\d+)", 1)
    table = F.regexp_extract(text, r"\[BR:(ko\d+)\]", 1)
    path = F.regexp_extract(text, r"\[PATH:(ko\d+)\]", 1)
    code = F.when(module != "", module).when(table != "", table).when(path != "", path)
    bare = (F.when(module != "", F.regexp_replace(text, r"^M\d+\s+", ""))
            .when(table != "", F.regexp_replace(text, r"\s+\[BR:ko\d+\]", ""))
            .when(path != "", F.regexp_replace(F.regexp_replace(text, r"\s+\[PATH:ko\d+\]", ""), r"^\d+\s+", ""))
            .otherwise(text))
    data = (data.withColumn("_ko", is_ko).withColumn("_node", filled & ~is_ko)
            .withColumn("code", code).withColumn("descr", bare)
            .withColumn("node", F.when(filled & ~is_ko, F.coalesce(code, bare))))

    def open_node(level: str, own: bool) -> Column:
        """Open node of a level; `own` counts the line itself (the context that later lines see)."""
        sets = F.when((F.col("level") == level) & F.col("_node") & F.lit(own), F.struct(F.col("node").alias("n")))
        closes = F.when(F.col("level").isin(CLOSED_BY[level]), F.struct(F.lit(None).cast("string").alias("n")))
        return F.last(F.coalesce(sets, closes), ignorenulls=True).over(in_file)["n"]

    return data.select("*", *[open_node(x, True).alias(f"open_{x}") for x in LEVELS])


def flatten_brite(lines: DataFrame) -> DataFrame:
    """One row per KO line, in file order: `file, leaf_ord, level, ko, descr` and the open node of A to E."""
    in_file = Window.partitionBy("file").orderBy("ord")
    ko = F.split("_text", r"\s+", 2)
    return (_tagged_lines(lines).where(F.col("_ko"))
            .select("file", (F.row_number().over(in_file) - 1).alias("leaf_ord"), "level",
                    ko[0].alias("ko"), F.coalesce(F.get(ko, F.lit(1)), F.lit("")).alias("descr"),
                    *[F.col(f"open_{x}").alias(x) for x in LEVELS]))


def brite_nodes(lines: DataFrame) -> DataFrame:
    """One row per (file, level, node): description, position and parents. A repeated node keeps its last line."""
    parents = [F.when(F.lit(x) < F.col("level"), F.col(f"open_{x}")).alias(x) for x in LEVELS[:-1]]
    rows = _tagged_lines(lines).where(F.col("_node"))
    last = F.struct(F.col("ord").alias("node_ord"), F.when(F.col("code").isNotNull(), F.col("descr")).alias("descr"),
                    *parents)
    return (rows.groupBy("file", "level", "node").agg(F.max_by(last, F.col("ord")).alias("_l"))
            .select("file", "level", "node", "_l.*"))


def brite_members(leaves: DataFrame) -> DataFrame:
    """`file, level, node, ko` with repeats: a KO listed twice under a node counts twice.

    The fourth level takes members only in files whose KOs stand on the fifth.
    """
    open_levels = F.array(*[F.struct(F.lit(x).alias("level"), F.col(x).alias("node")) for x in LEVELS[:4]])
    return (leaves.select("file", "ko", F.col("level").alias("_at"), F.explode(open_levels).alias("_m"))
            .where(F.col("_m.node").isNotNull() & ((F.col("_m.level") != "D") | (F.col("_at") == "E")))
            .select("file", "_m.level", "_m.node", "ko"))


def ko_scope(leaves: DataFrame) -> DataFrame:
    """`ko, descr` of the described KOs of a hierarchy (the last description wins)."""
    return (leaves.groupBy("ko").agg(F.max_by("descr", F.struct("file", "leaf_ord")).alias("descr"))
            .where(F.col("descr") != ""))


def single_copy_kos(lines: DataFrame) -> DataFrame:
    """Distinct KOs of a reference list, whose lines read `<letter> <KO> ...`."""
    ko = F.regexp_extract("value", r"^\w\s+(K\d+)\s", 1)
    return lines.select(ko.alias("ko")).where(F.col("ko") != "").distinct()


def _exact(c: str) -> Column:
    return F.sum(F.col(c)).cast("double")


def ko_abundance(orf_ann: DataFrame, scope: DataFrame, depth: DataFrame | None = None,
                 single_copy: DataFrame | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Depth of each KO: summed aligned fractions, and the same weighted by gene depth.

    Also relative to the total, and to the mean of the single-copy reference KOs (whose sums are taken
    before the scope is applied). Genes are summed per KO first; every join after that is KO-sized.
    """
    frac = F.when(F.col("frac") > 0, F.col("frac")).otherwise(1.0)
    rows = orf_ann.where(F.col("ko").rlike(r"^K\d")).select(*names(by, "orf_id", "ko"), frac.alias("_fr"))
    if depth is not None:
        # Without `by` columns in the depth table the gene id alone identifies a gene.
        on = [c for c in names(by, "orf_id") if c in depth.columns]
        rows = (rows.join(depth.select(*on, F.col("depth").alias("_dp")), on, "left")
                .withColumn("_dp", F.when(F.coalesce("_dp", F.lit(0.0)) != 0, F.col("_dp")).otherwise(1.0)))
    else:
        rows = rows.withColumn("_dp", F.lit(1.0))
    per_ko = rows.groupBy(*names(by, "ko")).agg(
        F.sum(F.col("_fr").cast(EXACT)).alias("_d"),
        F.sum((F.col("_fr") * F.col("_dp")).cast(EXACT)).alias("_da"))

    found = per_ko.join(scope.select("ko", "descr"), "ko")
    out = with_totals(found, found, {"_sum": _exact("_d"), "_sum_adj": _exact("_da")}, by)
    if single_copy is not None:
        n_ref = scalar_of(single_copy, F.count_distinct("ko"))
        ref = per_ko.join(single_copy.select("ko"), "ko", "left_semi")
        out = with_totals(out, ref, {"_ref": _exact("_d"), "_ref_adj": _exact("_da")}, by)
        for name in ("_ref", "_ref_adj"):
            out = out.withColumn(name, F.coalesce(name, F.lit(0.0)) / n_ref)
    else:
        out = out.withColumn("_ref", F.lit(1.0)).withColumn("_ref_adj", F.lit(1.0))
    d, da = F.col("_d").cast("double"), F.col("_da").cast("double")
    return out.select(
        *names(by, "ko"), d.alias("depth"), da.alias("depth_adj"),
        trunc_to(d / F.col("_sum"), 6).alias("abundance"), trunc_to(da / F.col("_sum_adj"), 6).alias("abundance_adj"),
        F.when(F.col("_ref") > 0, trunc_to(d / F.col("_ref"), 3)).otherwise(0.0).alias("r_depth"),
        F.when(F.col("_ref") > 0, trunc_to(da / F.col("_ref_adj"), 6)).otherwise(0.0).alias("r_depth_adj"),
        "descr", F.col("_ref").alias("ref_mean"), F.col("_ref_adj").alias("ref_mean_adj"))


def level_rollup(abundance: DataFrame, leaves: DataFrame, nodes: DataFrame, levels: Sequence[str] = ("A", "B", "C", "D"),
                 by: Sequence[str] = ()) -> DataFrame:
    """Members, found members, coverage and mean depth of every node of the given levels, in one grouping.

    The mean runs over all members, found or not, and repeats count.
    """
    member = brite_members(leaves).where(F.col("level").isin(list(levels)))
    sizes = member.groupBy("file", "level", "node").agg(F.count(F.lit(1)).alias("members"))
    per = (member.join(abundance.where(F.col("depth") != 0)
                       .select(*names(by, "ko", "depth", "depth_adj", "ref_mean", "ref_mean_adj")), "ko")
           .groupBy(*names(by, "file", "level", "node"))
           .agg(F.count(F.lit(1)).alias("found"),
                F.sum(F.col("depth").cast(EXACT)).cast("double").alias("_d"),
                F.sum(F.col("depth_adj").cast(EXACT)).cast("double").alias("_da"),
                F.max("ref_mean").alias("_ref"), F.max("ref_mean_adj").alias("_ref_adj")))
    frame = nodes.join(sizes, ["file", "level", "node"])
    if by:  # every node for every key, as the rows of a profile are
        keys = scalar_of(abundance.select(*by).distinct(), F.collect_list(F.struct(*by)))
        frame = frame.withColumn("_by", F.explode(keys)).select("*", "_by.*").drop("_by")
    out = (frame.join(per, names(by, "file", "level", "node"), "left")
           .withColumn("found", F.coalesce("found", F.lit(0)))
           .withColumn("depth", F.coalesce("_d", F.lit(0.0)) / F.col("members"))
           .withColumn("depth_adj", F.coalesce("_da", F.lit(0.0)) / F.col("members")))
    return out.select(
        *names(by, "file", "level", "node"), "descr", "A", "B", "C", "node_ord", "members", "found",
        trunc_to(F.col("found") / F.col("members"), 3).alias("coverage"), "depth", "depth_adj",
        F.when(F.col("_ref") > 0, trunc_to(F.col("depth") / F.col("_ref"), 3)).otherwise(0.0).alias("r_depth"),
        F.when(F.col("_ref") > 0, trunc_to(F.col("depth_adj") / F.col("_ref_adj"), 6)).otherwise(0.0)
        .alias("r_depth_adj")).orderBy("level", "file", "node_ord", *by)


def full_listing(leaves: DataFrame, abundance: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Every leaf of a hierarchy with its KO's numbers, zero when not found; ids run per file.

    With `by`, every leaf for every sample that has a profile: a sample's numbers are gathered per KO, at most one
    row per sample, and spread over the leaves.
    """
    numbers = ["depth", "depth_adj", "abundance", "abundance_adj", "r_depth", "r_depth_adj"]
    rows = leaves
    if by:
        samples = abundance.select(*by).distinct()
        rows = leaves.withColumn("_by", F.explode(scalar_of(samples, F.collect_list(F.struct(*by))))).select("*", "_by.*")
    return (rows.join(abundance.select(*names(by, "ko"), *numbers), names(by, "ko"), "left")
            .select(*by, "file", (F.col("leaf_ord") + FIRST_LEAF_ID).alias("id"), "A", "B", "C", "D", "ko", "descr",
                    *[F.coalesce(n, F.lit(0.0)).alias(n) for n in numbers])
            .orderBy(*by, "file", "id"))


def per_taxon_profiles(orf_ann: DataFrame, scope: DataFrame, single_copy: DataFrame, key: str = "species",
                       depth: DataFrame | None = None, min_ref: float = 0.3, by: Sequence[str] = ()) -> DataFrame:
    """`ko_abundance` within each value of `key` (and sample) that shows enough of the single-copy reference KOs."""
    known = orf_ann.where(F.col(key).isNotNull() & ~F.col(key).contains("Unknown"))
    n_ref = scalar_of(single_copy, F.count_distinct("ko"))
    shown = (known.select(*names(by, key, "ko")).distinct().join(single_copy.select("ko"), "ko", "left_semi")
             .groupBy(*names(by, key)).agg(F.count(F.lit(1)).alias("_refs"))
             .where(F.col("_refs") >= n_ref * F.lit(min_ref)).select(*names(by, key)))
    # The profile is made first: it is KO-sized, while the genes of one species can be most of the table.
    profiles = ko_abundance(known, scope, depth, single_copy, by=names(by, key))
    return profiles.join(shown, names(by, key), "left_semi")
