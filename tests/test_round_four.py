"""Steps that several queries share: read once, in tasks of bounded rows."""

import os
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from __spark_entry__ import queries
from seqtally.catalog import alignment_queries, hit_queries
from seqtally.catalog.registry import Inputs
from seqtally.catalog.views import VIEWS
from seqtally.operators import annotation as an
from seqtally.operators import binning as bn
from seqtally.operators import common
from seqtally.operators.depth import variant_matrix
from seqtally.operators.hits import top_hit


@pytest.fixture
def hits(spark, tmp_path):
    rows = [("q1", "b", 5, 2), ("q1", "a", 9, 1), ("q1", "c", 9, 1), ("q2", "d", 1, 7), ("q2", "e", 1, None), (None, "f", 1, 1)]
    spark.createDataFrame(rows, "query string, subject string, evalue int, ord int").write.parquet(str(tmp_path / "hits"))
    return spark.read.parquet(str(tmp_path / "hits"))


def test_top_hit_reads_the_hits_once(hits):
    first = top_hit(hits, 10)
    assert str(first._jdf.queryExecution().optimizedPlan()).count("Relation") == 1
    # Equal firsts all stay; rows without a query or an order are none.
    assert sorted(r.subject for r in first.collect()) == ["a", "c", "d"]


def test_no_sketch_for_a_lookup_that_is_broadcast(spark, hits, monkeypatch):
    monkeypatch.setattr(common, "hot_keys", lambda *_: pytest.fail("rows were read for a sketch"))
    path = hits.select("query").distinct().withColumn("n", F.lit(1))
    lookup = path.where("query is not null")
    lookup.write.parquet(hits.inputFiles()[0] + "-lookup")
    lookup = spark.read.parquet(hits.inputFiles()[0] + "-lookup")
    out = common.spread_join(hits, lookup, ["query"], "left", small=0)
    assert sorted((r.subject, r.n) for r in out.collect()) == [
        ("a", 1), ("b", 1), ("c", 1), ("d", 1), ("e", 1), ("f", None)]


def test_scaffolds_are_scored_once(spark, monkeypatch, tmp_path):
    """What is read several times is written, so the rest of the assignment doesn't go back to genes or hits."""
    def table(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    orf = table("orf", [("s1_1", "s1"), ("s2_1", "s2"), ("s3_1", "s3")], "orf_id string, scaffold string")
    best = table("best", [("s1_1", "r1", 90.0, 10), ("s2_1", "r2", 90.0, 10), ("s3_1", "r9", 90.0, 10)],
                 "query string, subject string, pct_iden double, aln_len int")
    clusters = table("clusters", [("r1", [1]), ("r2", [1, 2])], "ref_id string, taxids array<long>")
    out = an.assign_scaffolds(orf, best, clusters)
    read = {f.rsplit("/", 2)[-2] for f in out.inputFiles()}
    assert not read & {"orf", "best", "clusters"}, read
    assert sorted((r.scaffold, r.taxid, r.n_genes) for r in out.collect()) == [("s1", 1, 1), ("s2", 1, 1)]


def test_reads_of_bins_stay_in_bounded_tasks(hits, monkeypatch):
    """The number of tasks follows the input and isn't merged again, however well the keys compress."""
    assert common.dealt(hits, ["query"]) is hits  # little input
    monkeypatch.setattr(common, "TASK_INPUT", 64)
    aln = hits.selectExpr("query as read_id", "subject as contig", "67 as flag", "cast(ord as long) as taxid")
    most = -(-common.input_bytes(aln) // 64)
    totals, support = bn._contig_taxa(aln, aln, 3, True, ())
    for df in (bn._contig_reads(aln, True, ()), bn._read_taxa(aln, 3, True, ())):
        df.collect()
        assert "REPARTITION_BY_NUM" in str(df._jdf.queryExecution().executedPlan())
        assert df.rdd.getNumPartitions() == most
    assert sorted((r.contig, r.n_reads) for r in totals.collect()) == [(c, 1) for c in "abcdef"]
    assert sorted((r.contig, r.taxid) for r in support.collect()) == [
        ("a", 1), ("a", 2), ("b", 1), ("b", 2), ("c", 1), ("c", 2), ("d", 7), ("e", 7)]


def test_variants_take_one_grouping(spark):
    calls = spark.createDataFrame([("x", 1, 5, "A", "C", "S1"), ("x", 1, 5, "A", "C", "S1"), ("x", 1, 5, "A", "C", "S2"),
                                   ("x", 1, 6, "A", "G", "other"), ("x", 1, 7, "A", "G", None)],
                                  "acc string, taxid long, position long, ref string, var string, sample string")
    wide = variant_matrix(calls, ["S1", "S2"])
    assert str(wide._jdf.queryExecution().optimizedPlan()).count("Aggregate") == 1
    assert sorted(tuple(r) for r in wide.collect()) == [(1, "x|5|A|C", 1, 1), (1, "x|6|A|G", 0, 0), (1, "x|7|A|G", 0, 0)]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test data")
def test_domain_lines_are_parsed_once(spark):
    """Hits and families come from one written table, so the result doesn't go back to the lines."""
    out = queries()["domain_abundance"](spark, "/root/testdata/sf0.001")
    assert not [f for f in out.inputFiles() if f.endswith(("lineitem.parquet", "part.parquet"))]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test data")
def test_genes_are_made_once(spark):
    """Resistance hits, gene depths and genes come from one written table."""
    out = queries()["resistance_rollup"](spark, "/root/testdata/sf0.001")
    assert not [f for f in out.inputFiles() if f.endswith("lineitem.parquet")]


def test_scores_are_written_before_a_sketch_reads_them(spark, monkeypatch):
    """A lookup that the planner doesn't broadcast has the species rule's scores computed once, not again for hot keys."""
    read = _sketched(monkeypatch)
    orf = spark.createDataFrame([("s1_1", "s1"), ("s2_1", "s2")], "orf_id string, scaffold string")
    best = spark.createDataFrame([("s1_1", "r1", 90.0, 10), ("s2_1", "r2", 90.0, 10)],
                                 "query string, subject string, pct_iden double, aln_len int")
    clusters = spark.createDataFrame([("r1", [1]), ("r2", [1, 2])], "ref_id string, taxids array<long>")
    lineage = spark.createDataFrame([(1, 10), (2, 20)], "taxid long, species_ti long")
    out = an.assign_scaffolds(orf, best, clusters, rule="species", lineage=lineage)
    assert sorted((r.scaffold, r.taxid) for r in out.collect()) == [("s1", 1)]
    assert read and not any("Join" in plan or "Aggregate" in plan for plan in read)


def test_species_of_contigs_are_written_before_a_sketch_reads_them(spark, monkeypatch):
    """The reads of the binning aren't joined and counted again for each of its lookups."""
    read = _sketched(monkeypatch)
    contig_aln = spark.createDataFrame([("r1", "c1", 67), ("r2", "c1", 67), ("r3", "c2", 67)], "read_id string, contig string, flag int")
    ref_aln = spark.createDataFrame([("r1", 67, 1), ("r2", 67, 1), ("r3", 67, 2)], "read_id string, flag int, taxid long")
    contigs = spark.createDataFrame([("c1", 900), ("c2", 800), ("c3", 700)], "contig string, length int")
    lineage = spark.createDataFrame([(1, 10, "a", "a1"), (2, 20, "b", "b1")], "taxid long, species_ti long, species string, toprank string")
    listed = spark.createDataFrame([(2,)], "taxid long")
    out = bn.bin_contigs_species(contig_aln, ref_aln, contigs, lineage, listed)
    assert sorted((r.contig, r.taxid, r.species, r.n_reads) for r in out.collect()) == [
        ("c1", "1", "a", 2), ("c2", "contaminant", "sptid:20", 1), ("c3", "Unknown", "Unknown", 0)]
    assert len(read) == 3 and not any("Join" in plan or "Aggregate" in plan for plan in read)


def _sketched(monkeypatch):
    """The plans of what is read for hot keys, with all joins taken for large ones."""
    read, found = [], common.hot_keys
    monkeypatch.setattr(common, "input_bytes", lambda _: common.UNKNOWN_BYTES)
    monkeypatch.setattr(common, "planner_broadcasts", lambda _: False)
    monkeypatch.setattr(common, "hot_keys", lambda rows, on, *more: (
        read.append(str(rows._jdf.queryExecution().optimizedPlan())), found(rows, on, *more))[1])
    return read


def test_scores_move_once_by_scaffold(spark, monkeypatch, tmp_path):
    """The sum per taxid and the best taxid of a scaffold share a shuffle."""
    monkeypatch.setattr(common, "TASK_INPUT", 64)

    def table(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    orf = table("orf", [("s1_1", "s1"), ("s1_2", "s1"), ("s2_1", "s2")], "orf_id string, scaffold string")
    best = table("best", [("s1_1", "r1", 90.0, 10), ("s1_2", "r2", 50.0, 10), ("s2_1", "r2", 90.0, 10)],
                 "query string, subject string, pct_iden double, aln_len int")
    clusters = table("clusters", [("r1", [1]), ("r2", [1, 2])], "ref_id string, taxids array<long>")
    scored = an.scaffold_scores(orf, best, clusters)
    top = scored.withColumn("top", F.max("score").over(Window.partitionBy("scaffold")))
    plan = str(top._jdf.queryExecution().executedPlan())
    assert plan.count("REPARTITION_BY_NUM") == 1
    assert not re.search(r"Exchange hashpartitioning\(scaffold#\d+, taxid", plan)
    assert sorted((r.scaffold, r.taxid, float(r.score), float(r.top)) for r in top.collect()) == [
        ("s1", 1, 1150.0, 1150.0), ("s1", 2, 250.0, 1150.0), ("s2", 1, 450.0, 450.0), ("s2", 2, 450.0, 450.0)]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test data")
def test_best_hits_are_written_without_their_order(spark):
    assert hit_queries.best(Inputs(spark, "/root/testdata/sf0.001")).columns == [
        "query", "subject", "pct_iden", "aln_len", "ref_len"]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test data")
def test_lines_of_bins_move_once_by_read(spark, monkeypatch):
    """Lines are joined to their orders where the binning then groups them by read."""
    monkeypatch.setattr(common, "TASK_INPUT", 4096)
    given = []
    monkeypatch.setattr(bn, "bin_contigs_species", lambda *tables, **_: given.extend(tables))
    v = Inputs(spark, "/root/testdata/sf0.001")
    alignment_queries.species_bins(v)
    for df, plain in ((bn._contig_reads(given[0], False, ()), bn._contig_reads(v.contig_aln, False, ())),
                      (bn._read_taxa(given[1], 3, False, ()), bn._read_taxa(v.contig_ref, 3, False, ()))):
        plan = str(df._jdf.queryExecution().executedPlan())
        moves = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
        assert moves == ["l_orderkey", "o_orderkey"] and plan.count("REPARTITION_BY_NUM") == 1, plan
        assert sorted(map(tuple, df.collect())) == sorted(map(tuple, plain.collect()))


def test_text_queries_are_sorted_by_their_hash(hits):
    sorts = lambda df: re.findall(r"Sort \[([^#]+)#", df._jdf.queryExecution().executedPlan().toString())
    first = top_hit(hits, 10)
    assert set(sorts(first)) == {"_h"} and first.columns == hits.columns
    assert set(sorts(top_hit(hits.withColumn("query", F.col("ord").cast("long")), 10))) == {"query"}


def test_genes_are_told_apart_by_numbers(spark, tmp_path):
    """No text of a gene is shuffled; the rows are those of the view's SQL."""
    lines = [(4, 9), (4, 2), (4, 3), (5, 9), (5, 9), (5, -9), (5, -2), (4, None), (4, None), (None, 1), (None, 8)]
    spark.createDataFrame(lines, "l_partkey long, l_suppkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    orf = Inputs(spark, str(tmp_path)).orf
    plain = spark.sql(VIEWS["orf"], lineitem=spark.read.parquet(str(tmp_path / "lineitem.parquet")))
    assert orf.schema == plain.schema and plain.count() == 6
    assert sorted(map(str, orf.collect())) == sorted(map(str, plain.collect()))
    moved = set(re.findall(r"Exchange hashpartitioning\((.*)\)", str(orf._jdf.queryExecution().executedPlan())))
    assert len(moved) == 1 and not re.search("orf_id|header", moved.pop())


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test data")
def test_scaffolds_are_assigned_without_headers(spark):
    v = Inputs(spark, "/root/testdata/sf0.001")
    genes = hit_queries.gene_ids(v)
    assert genes.columns == ["orf_id", "scaffold"]
    whole = v.orf.select("orf_id", F.concat(F.lit("ctg"), F.col("p").cast("string")).alias("scaffold"))
    assert sorted(genes.collect()) == sorted(whole.collect())
