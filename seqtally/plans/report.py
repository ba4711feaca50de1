"""The multi-sample report: a fixed list of matrices over per-sample tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtally.operators.matrix import merge_samples
from seqtally.operators.taxonomy import PROFILE_RANKS, RANKS
from seqtally.session import cut_lineage


@dataclass(frozen=True)
class Matrix:
    """One matrix of the report: which table, which id and value, what to show, and the cutoff."""

    name: str
    table: str
    ids: Sequence[str]
    value: str
    ann: Sequence[str] = ()
    cutoff: float | None = 0
    where: Mapping[str, str] = field(default_factory=dict)


def _taxon_matrices() -> list[Matrix]:
    # Abundance and depth are reported from 1e-4 on, reads from 1 on.
    metrics = [("taxon", "abundance", 1e-4), ("taxon-depth", "depth", 1e-4), ("taxon-reads", "reads", 1)]
    out = [Matrix("taxon-superkingdom", "superkingdoms", ["taxid"], "reads", ["superkingdom"])]
    for prefix, value, cutoff in metrics:
        for rank in PROFILE_RANKS:
            shown = RANKS[:RANKS.index(rank) + 1]
            out.append(Matrix(f"{prefix}-{rank}", "ranks", ["rank_taxid"], value, shown, cutoff, {"rank": rank}))
    return out


HIERARCHIES = ("module", "pathway", "transporter", "EC", "AMR")


def hierarchy_matrices(files: Mapping[str, str]) -> list[Matrix]:
    """Of each hierarchy (report name: its file) every leaf, and of modules and pathways their own level."""
    metrics = [("depth", "depth"), ("depth-adjusted", "depth_adj"), ("R.depth", "r_depth"),
               ("R.depth-adjusted", "r_depth_adj")]
    out = [Matrix(f"{name}-KO-{label}", "full_listing", ["id"], value, ["A", "B", "C", "D", "ko", "descr"], 0, {"file": file})
           for name, file in files.items() for label, value in metrics]
    own = {"module": ("D", ["A", "B", "C", "descr"]), "pathway": ("C", ["A", "B", "descr"])}
    return out + [Matrix(f"{name}-{label}", "levels", ["node"], value, own[name][1], 0, {"file": file, "level": own[name][0]})
                  for name, file in files.items() if name in own for label, value in metrics]


def _count_matrices() -> list[Matrix]:
    totals = [("assembly-num_scaffolds", "scaffolds"), ("assembly-len_scaffolds", "length"), ("assembly-num_ORFs", "genes")]
    return [Matrix("qc", "qc", ["reads"], "number"),
            Matrix("taxon-superkingdom-whost", "superkingdoms_host", ["taxid", "superkingdom"], "reads"),
            *[Matrix(name, "assembly", ["key"], value, [], 0, {"level": "sample"}) for name, value in totals]]


def _function_matrices() -> list[Matrix]:
    metrics = [("depth", "depth"), ("depth-adjusted", "depth_adj"), ("R.depth", "r_depth"),
               ("R.depth-adjusted", "r_depth_adj")]
    out = [Matrix(f"KO-{label}", "full_listing", ["file", "id"], value, ["A", "B", "C", "ko", "descr"])
           for label, value in metrics]
    for level in "ABCD":
        out += [Matrix(f"level-{level}-{label}", "levels", ["file", "node"], value, ["descr"], 0, {"level": level})
                for label, value in metrics]
    return out


def _assembly_matrices() -> list[Matrix]:
    metrics = ["scaffolds", "length", "coverage", "depth", "genes"]
    return [Matrix(f"assembly-{level}-{m}", "assembly", ["key"], m, [], 0, {"level": level})
            for level in ("genome", "species") for m in metrics]


def _resistance_matrices() -> list[Matrix]:
    labels = [("aro", "RGI"), ("gene_family", "RGI.AMR"), ("drug_class", "RGI.drug"), ("mechanism", "RGI.Mech")]
    out = [Matrix(label, "resistance", ["value"], "depth", [], 0, {"level": level, "bin": "all"})
           for level, label in labels]
    return out + [Matrix(f"{label}-bin", "resistance_bins", ["value", "bin"], "depth", [], 0, {"level": level})
                  for level, label in labels]


REPORT = [*_taxon_matrices(), *_count_matrices(), *_function_matrices(),
          *hierarchy_matrices({name: name for name in HIERARCHIES}), *_assembly_matrices(), *_resistance_matrices()]


def report_matrices(tables: Mapping[str, DataFrame], samples: Sequence[str],
                    wanted: Sequence[Matrix] = tuple(REPORT)) -> dict[str, DataFrame]:
    """The matrices whose table is present. Tables are long, with `sample` and `ord` columns.

    Each matrix is a lazy pivot over its table with the sample list given; persist a table that feeds many.
    """
    out = {}
    for m in wanted:
        if m.table not in tables:
            continue
        rows = tables[m.table]
        for column, value in m.where.items():
            rows = rows.where(F.col(column) == value)
        out[m.name] = merge_samples(rows, samples, m.ids, m.value, m.ann, m.cutoff)
    return out


def report_cells(tables: Mapping[str, DataFrame], wanted: Sequence[Matrix] = tuple(REPORT)) -> DataFrame:
    """`matrix, ids, ann, sample, value`: one long table of all matrices whose table is there.

    Each table is read once: a row gives a cell to every matrix whose conditions and cutoff it meets. The last value of
    a cell counts, and its annotation is that of the first row.
    """
    parts = []
    for name in dict.fromkeys(m.table for m in wanted if m.table in tables):
        cells = []
        for m in (m for m in wanted if m.table == name):
            shown = F.col(m.value) >= m.cutoff if m.cutoff is not None else F.lit(True)
            for column, value in m.where.items():
                shown = shown & (F.col(column) == value)
            text = lambda columns: F.array(*[F.col(c).cast("string") for c in columns]).cast("array<string>")
            cells.append(F.when(shown, F.struct(F.lit(m.name).alias("matrix"), text(m.ids).alias("ids"), text(m.ann).alias("ann"),
                                                F.col(m.value).cast("double").alias("value"))))
        rows = tables[name].select("sample", "ord", F.explode(F.array_compact(F.array(*cells))).alias("_c"))
        parts.append(rows.groupBy("_c.matrix", "_c.ids", "sample").agg(
            F.max_by("_c.value", "ord").alias("value"), F.min_by("_c.ann", "ord").alias("ann")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("matrix", "ids", "ann", "sample", "value")


def report_table(tables: Mapping[str, DataFrame], samples: Sequence[str],
                 wanted: Sequence[Matrix] = tuple(REPORT)) -> DataFrame:
    """`matrix, ids, ann` and a column per sample: all matrices from one pivot. A missing cell is 0, and the annotation is
    that of the first sample that has one."""
    position = F.array_position(F.array(*[F.lit(s) for s in samples]), F.col("sample"))
    cells = cut_lineage(report_cells(tables, wanted).where(F.col("sample").isin(list(samples))).withColumn("_at", position))
    wide = cells.groupBy("matrix", "ids").pivot("sample", list(samples)).agg(F.max("value"))
    about = cells.groupBy("matrix", "ids").agg(F.min_by("ann", "_at").alias("ann"))
    columns = [F.coalesce(F.col(f"`{s}`"), F.lit(0.0)).alias(s) for s in samples]
    return wide.join(about, ["matrix", "ids"]).select("matrix", "ids", "ann", *columns)


def write_report(report: DataFrame, path: str) -> None:
    """One folder per matrix, of tab-separated text with a header, from one write."""
    flat = report.withColumn("ids", F.array_join("ids", "|", "")).withColumn("ann", F.array_join("ann", "|", ""))
    flat.repartition("matrix").sortWithinPartitions("matrix", "ids").write.mode("overwrite").partitionBy("matrix").csv(
        path, sep="\t", header=True, quote="", escapeQuotes=False)
