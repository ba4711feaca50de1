"""Binning, gene annotation, matrices, sequences, depth, variants and summaries on small tables."""

import pytest
from pyspark.sql import functions as F

from seqtally.functions import expr
from seqtally.operators import annotation as an
from seqtally.operators import binning as bn
from seqtally.operators import depth as dp
from seqtally.operators import matrix as mx
from seqtally.operators import sequences as sq
from seqtally.operators import summaries as su


def one(spark, column, **values):
    row = [tuple(values.values())]
    return spark.createDataFrame(row, list(values)).select(column.alias("x")).first()["x"]


def test_expressions(spark):
    assert one(spark, expr.extract_tag("id", "taxid"), id="acc|X|taxid|757|") == "757"
    assert one(spark, expr.extract_tag("id", "len"), id="acc|X") is None
    for gene, contig in [("a|scaffold|248.1", "a|scaffold|248"), ("a|scaffold|248_1", "a|scaffold|248"), ("x", "x")]:
        assert one(spark, expr.contig_of("g"), g=gene) == contig
    metagene = "gutB|31.8 /source=gutB|31 /start=1200 /end=1817 /frame=-1 /length=205"
    prodigal = "gutB|31_1 # 2 # 667 # 1 # ID=1_1;partial=10"
    assert tuple(one(spark, expr.orf_info("h"), h=metagene)) == ("1200", "1817", "-1")
    assert tuple(one(spark, expr.orf_info("h"), h=prodigal)) == ("2", "667", "1")
    assert tuple(one(spark, expr.orf_info("h"), h="none")) == ("-", "-", "-")
    assert one(spark, expr.header_depth("h"), h="c1_length_9_cov_12.5 x") == 12.5
    assert one(spark, expr.trunc_to("v", 3), v=1.2399) == 1.239
    assert one(spark, expr.flag_string("f"), f=0x1 | 0x2 | 0x40) == "_P_M_._._._._1_._S_F_D"
    assert one(spark, expr.overlap(*[F.col(c) for c in "abcd"]), a=1, b=10, c=5, d=20) == 5
    assert one(spark, expr.overlap(*[F.col(c) for c in "abcd"]), a=1, b=4, c=5, d=20) == 0


def quartiles(values):
    """The rule restated on a plain list."""
    v = sorted(values)
    n = len(v)
    med = (v[n // 2] + v[n // 2 - 1]) / 2 if n % 2 == 0 else v[n // 2]
    return med, v[n // 4], v[::-1][n // 4]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 9, 12])
def test_quartiles(spark, n):
    values = [float((7 * i) % 11) for i in range(n)]
    got = one(spark, expr.index_quartiles(F.array_sort("v")), v=values)
    assert tuple(got) == quartiles(values)


# ---- binning -------------------------------------------------------------------------------------

ALN = "contig string, read_id string, flag int"
REF = "read_id string, taxid long, flag int, score int"


def test_binning(spark):
    aln = spark.createDataFrame([("c1", "a", 67), ("c1", "b", 67), ("c1", "c", 67), ("c1", "d", 131), ("c2", "e", 67)], ALN)
    ref = spark.createDataFrame([("a", 11, 67, 90), ("a", 11, 67, 90), ("b", 11, 67, 90), ("b", 12, 67, 90),
                                 ("d", 13, 131, 90), ("e", 11, 67, 90), ("e", 12, 67, 90), ("e", 13, 67, 90)], REF)
    contigs = spark.createDataFrame([("c1", 100), ("c2", 200), ("c3", 300)], "contig string, length int")
    got = {r["contig"]: tuple(r)[1:] for r in bn.bin_contigs(aln, ref, contigs, max_taxa=2).collect()}
    assert got == {"c1": ("11", 0.5, 3, 100), "c2": ("Unknown", 1.0, 1, 200), "c3": ("Unknown", 1.0, 0, 300)}
    lineage = spark.createDataFrame([(11, 1, "sp1", "st11"), (12, 1, "sp1", "st12"), (13, 2, "sp2", "st13")],
                                    "taxid long, species_ti long, species string, toprank string")
    bad = spark.createDataFrame([(11,)], "taxid long")
    species = {r["contig"]: tuple(r)[1:] for r in bn.bin_contigs_species(aln, ref, contigs, lineage, max_taxa=3).collect()}
    assert species["c1"] == ("1", "sp1", "11", "st11", 0.5, 4, 100)
    assert species["c2"][:5] == ("1", "sp1", "11", "st11", pytest.approx(2 / 3))
    out = {r["contig"]: tuple(r)[1:] for r in
           bn.bin_contigs_species(aln, ref, contigs, lineage, bad, max_taxa=3).collect()}
    assert out["c1"][:4] == ("contaminant", "sptid:1", "contaminant", "taxid:11")


def test_host_binning(spark):
    bins = spark.createDataFrame([("c1", "Unknown", "Unknown", "Unknown", "Unknown", 1.0, 3, 100),
                                  ("c2", "1", "sp", "11", "st", 0.9, 3, 100),
                                  ("c3", "Unknown", "Unknown", "Unknown", "Unknown", 1.0, 1, 50)],
                                 "contig string, species_taxid string, species string, taxid string, strain string, "
                                 "p double, n_reads long, length int")
    aln = spark.createDataFrame([("c1", "a", 67), ("c1", "b", 67), ("c1", "b", 131), ("c2", "a", 67), ("c3", "z", 67)], ALN)
    host = spark.createDataFrame([("a", 0, 67, 80), ("a", 0, 67, 90), ("b", 0, 67, 99), ("z", 0, 67, 50)], REF)
    got = {r["contig"]: (r["taxid"], r["p"], r["n_reads"]) for r in bn.bin_host(bins, aln, host).collect()}
    assert got == {"c1": ("Host", 1.0, 2), "c2": ("11", 0.9, 3), "c3": ("Unknown", 1.0, 1)}


# ---- scaffolds -----------------------------------------------------------------------------------


def test_scaffold_rounds(spark):
    genes = spark.createDataFrame([(f"{s}_{i}", "", s) for s, n in (("s1", 3), ("s2", 1), ("s3", 1), ("s4", 1)) for i in range(n)],
                                  "orf_id string, header string, scaffold string")
    best = spark.createDataFrame([("s1_0", "r1", 50.0, 10, 20), ("s2_0", "r2", 90.0, 10, 20), ("s3_0", "r3", 90.0, 10, 20)],
                                 "query string, subject string, pct_iden double, aln_len int, ref_len long")
    clusters = spark.createDataFrame([("r1", [22], "K1", "d1"), ("r2", [21, 22], "K2", "d2"), ("r3", [31, 32], None, None)],
                                     "ref_id string, taxids array<long>, ko string, descr string")
    got = {r["scaffold"]: r["taxid"] for r in an.assign_scaffolds(genes, best, clusters).collect()}
    # s2 ties between 21 and 22; 22 holds the three genes of s1. s3 ties with nothing else: smaller id.
    assert got == {"s1": 22, "s2": 22, "s3": 31}
    bins = spark.createDataFrame([("s3", "5", "sp", "55", "st", 0.9, 9, 1000), ("s2", "Host", "Host", "Host", "Host", 0.9, 9, 500),
                                  ("s4", "Unknown", "Unknown", "Unknown", "Unknown", 1.0, 0, 700)],
                                 "contig string, species_taxid string, species string, taxid string, strain string, "
                                 "p double, n_reads long, length int")
    seeded = {r["scaffold"]: (r["taxid"], r["evidence"]) for r in an.assign_scaffolds(genes, best, clusters, bins).collect()}
    assert seeded == {"s1": (22, "kegg"), "s3": (55, "mapping")}  # host scaffolds stay out


def test_orf_annotation(spark):
    genes = an.genes(spark.createDataFrame([("a_1", "a_1 # 2 # 667 # 1 # ID=1"), ("a_2", "a_2"), ("b_1", "b_1"), ("b_2", "b_2")],
                                           "orf_id string, header string"))
    best = an.with_ref_len(spark.createDataFrame([("a_1", "r1|len|30", 50.0, 10), ("b_1", "r9", 60.0, 10)],
                                                 "query string, subject string, pct_iden double, aln_len int"))
    clusters = spark.createDataFrame([("r1|len|30", [7], "K1", "d1")], "ref_id string, taxids array<long>, ko string, descr string")
    assigned = spark.createDataFrame([("a", 7, "kegg", 2)], "scaffold string, taxid long, evidence string, n_genes long")
    from tests.test_taxonomy import lineage_rows
    lineage = lineage_rows(spark).withColumn("taxid", F.when(F.col("taxid") == 11, 7).otherwise(F.col("taxid")))
    depth = spark.createDataFrame([("a", 2.5), ("b", 1.0)], "contig string, depth double")
    rows = {r["orf_id"]: r for r in an.orf_annotation(genes, best, clusters, assigned, lineage, depth).collect()}
    assert (rows["a_1"]["iden"], rows["a_1"]["frac"], rows["a_1"]["ko"], rows["a_1"]["start"]) == ("50.0%", 0.3333, "K1", "2")
    assert (rows["a_2"]["iden"], rows["a_2"]["frac"], rows["a_2"]["descr"]) == ("-", 1.0, "hypothetical protein")
    assert (rows["b_1"]["taxid"], rows["b_1"]["frac"], rows["b_1"]["descr"], rows["b_1"]["evidence"]) == ("Unknown", 1.0, "", "None")
    assert (rows["b_2"]["genome"], rows["b_2"]["frac"], rows["b_2"]["descr"]) == ("Unknown", None, "hypothetical protein")
    assert rows["a_1"]["depth"] == 2.5 and rows["b_2"]["depth"] == 1.0


# ---- matrices ------------------------------------------------------------------------------------


def test_merge_rules(spark):
    long = spark.createDataFrame([("s1", "f1", "x", 5.0, 0), ("s1", "f1", "y", 2.0, 1), ("s2", "f1", "z", 9.0, 2),
                                  ("s2", "f2", "q", 0.5, 3), ("s3", "f2", "w", 1.0, 4), ("s9", "f3", "w", 1.0, 5)],
                                 "sample string, feature string, ann string, value double, ord long")
    rows = mx.merge_samples(long, ["s2", "s1", "s3"], ann=["ann"], cutoff=1, missing=-1, stats=True).collect()
    assert [tuple(r)[:5] for r in rows] == [("f1", "z", 9.0, 2.0, -1.0), ("f2", "w", -1.0, -1.0, 1.0)]
    assert (rows[0]["min"], rows[0]["med"], rows[0]["mean"]) == (0.0, 2.0, pytest.approx(11 / 3))  # missing counts as 0


def test_pooling(spark):
    sheet = spark.createDataFrame([("s1", ["x", "my group"]), ("s2", ["x", "b"]), ("s3", ["x", "b"])],
                                  "sample_id string, data array<string>")
    df = spark.createDataFrame([("s1", 1), ("s2", 2), ("s2", 3), ("zz", 4)], "sample_id string, v int")
    assert sorted((r["group"], r["v"]) for r in mx.pool_groups(df, sheet, 2).collect()) == [("b", 2), ("b", 3), ("my_group", 1)]
    assert {r["group"] for r in mx.pool_groups(df, sheet, group="all in one").collect()} == {"all_in_one"}
    assert [r[0] for r in mx.missing_sources(df, sheet).collect()] == ["s3"]


# ---- sequences -----------------------------------------------------------------------------------


def seqs(spark, lengths):
    return spark.createDataFrame([(f"s{i}", f"s{i} d", "A" * n, i) for i, n in enumerate(lengths)],
                                 "seq_id string, header string, seq string, ord long")


def test_assembly_stats(spark):
    row = sq.assembly_stats(seqs(spark, [10, 80, 30, 0, 30, 50])).first()
    assert tuple(row) == (5, 200, 40, 80, 50, 30)
    assert sq.assembly_stats(seqs(spark, [10, 80]), ref_len=1000).first()["n50"] == 0


def test_length_filters(spark):
    df = seqs(spark, [5, 10, 15])
    kept = sq.filter_min_len(df, 10, ann="len").orderBy("ord").collect()
    assert [r["header"] for r in kept] == ["s1|len|10 d", "s2|len|15 d"]
    assert [r["seq_id"] for r in sq.filter_max_len(df, 10).orderBy("ord").collect()] == ["s0", "s1"]
    assert [r["seq_id"] for r in sq.sort_by_len(df).collect()] == ["s2", "s1", "s0"]


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_numbering_is_dense_and_ordered(spark, partitions):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("ord"), (F.col("id") * 7 % 3).alias("s")).repartition(partitions)
    rows = sq.numbered(df, start=5).collect()
    assert all(r["number"] == r["ord"] + 5 for r in rows) and len(rows) == 1000
    per = {}
    for r in sorted(sq.numbered(df, by=["s"]).collect(), key=lambda r: r["ord"]):
        per.setdefault(r["s"], []).append(r["number"])
    assert all(x == list(range(1, len(x) + 1)) for x in per.values())


def test_id_lists(spark):
    df = spark.createDataFrame([(f"s{i % 3 if i < 60 else i}", f"s{i} taxid|{i}|", "A", i) for i in range(100)],
                               "seq_id string, header string, seq string, ord long")
    ids = spark.createDataFrame([(">s0 text",), ("s0",), ("s77",), ("none",)], "id string")
    kept, dropped = sq.fetch_by_ids(df, ids), sq.exclude_ids(df, ids)
    assert kept.count() == 21 and kept.count() + dropped.count() == 100
    tagged = sq.fetch_by_ids(df, spark.createDataFrame([("5",)], "id string"), tag="taxid")
    assert [r["ord"] for r in tagged.collect()] == [5]
    full = sq.fetch_large(df.drop("header"), ids, df.select("seq_id", "header").where("ord = 77")).where("seq_id = 's77'")
    assert full.first()["header"] == "s77 taxid|77|"


def test_interleaving(spark):
    first = spark.createDataFrame([("a", 0), ("b", 1)], "read_id string, ord long")
    second = spark.createDataFrame([("a2", 0), ("b2", 1)], "read_id string, ord long")
    both = sq.interleave(first, second)
    assert [r["read_id"] for r in both.collect()] == ["a", "a2", "b", "b2"]
    assert [(r["mate"], r["pair"]) for r in sq.split_interleaved(both.drop("mate")).orderBy("ord").collect()] == [
        (1, 0), (2, 0), (1, 1), (2, 1)]


def test_header_annotation(spark):
    df = spark.createDataFrame([("NC_1", "NC_1 chromosome", "A", 0), ("NC_2", "NC_2", "A", 1)],
                               "seq_id string, header string, seq string, ord long")
    catalog = spark.createDataFrame([(83333, "Escherichia coli K-12", "NC_1", 0), (83333, "other", "NC_1", 1)],
                                    "taxid long, name string, acc string, ord long")
    rows = sq.annotate_headers(df, catalog).orderBy("ord").collect()
    assert [r["header"] for r in rows] == ["NC_1|taxid|83333|taxdes|Escherichia_coli_K_12 chromosome", "NC_2"]


# ---- depth and variants --------------------------------------------------------------------------


def test_windowed_depth(spark):
    depth = spark.createDataFrame([("c", p, p, 1) for p in range(1, 46)], "seq_id string, pos long, d1 long, d2 long")
    got = {r["node"]: (r["d1"], r["d2"]) for r in dp.windowed_depth(depth, ["d1", "d2"]).collect()}
    assert got == {20: (20.0, 1.0), 40: (32.5, 1.0)}  # positions 1..39 and 20..45


def test_pileup_alleles(spark):
    pile = spark.createDataFrame([("x|taxid|7", 1, "a", ".,$^].Gg+2AGTT-1c*")], "seq_id string, pos long, ref string, bases string")
    got = {r["allele"]: r["n"] for r in dp.pileup_alleles(pile).collect()}
    assert got == {"A": 3, "G": 2, "T": 2, "+AG": 1, "-C": 1}


def test_call_variants(spark):
    alleles = spark.createDataFrame([("x", 1, "A", "A", 1), ("x", 1, "A", "G", 2), ("x", 2, "A", "G", 2), ("x", 3, "A", "A", 2),
                                     ("x", 3, "A", "T", 3), ("x", 4, "A", "A", 3), ("x", 4, "A", "+GG", 3)],
                                    "seq_id string, pos long, ref string, allele string, n long")
    assert [(r["pos"], r["var"], r["coverage"]) for r in dp.call_variants(alleles).collect()] == [(1, "G", 3)]
    assert sorted(r["pos"] for r in dp.call_variants(alleles, min_cov=2).collect()) == [1, 2]
    assert [(r["pos"], r["var"]) for r in dp.call_variants(alleles, kind="indel").collect()] == [(4, "+GG")]


def test_breadth(spark):
    pile = spark.createDataFrame([("a|taxid|7", p, 2 if p <= 80 else 1) for p in range(1, 101)]
                                 + [("a|taxid|8", p, 9) for p in range(1, 70)], "seq_id string, pos long, depth int")
    index = spark.createDataFrame([("a|taxid|7", 60), ("b|taxid|7", 40), ("a|taxid|8", 100)], "seq_id string, length long")
    rows = dp.breadth(pile, index).collect()
    assert [(r["taxid"], r["covered"], r["breadth"]) for r in rows] == [(7, 80, 0.8)]
    assert dp.keep_passing(pile, dp.breadth(pile, index)).count() == 100


# ---- summaries -----------------------------------------------------------------------------------


def test_job_cost(spark):
    log = spark.createDataFrame([("S1", "a", 4, 7), ("S1", "a", 1, 2), ("S2", "b", 2, 1800)],
                                "sample string, job string, cores long, time_spent long")
    rows = [tuple(r) for r in su.job_cost_matrix(log, ["a", "b"]).collect()]
    assert rows == [("S1", 30, None, 30), ("S2", None, 3600, 3600)]
    assert [r["total"] for r in su.job_cost_matrix(log, ["a", "b"], su.HOUR).collect()] == [0.01, 1.0]


def test_rescaling(spark):
    df = spark.createDataFrame([("s", "f1", 1.0), ("s", "f2", 3.0), ("t", "f1", 0.0)], "sample string, feature string, value double")
    cpm = {(r["sample"], r["feature"]): r["value"] for r in mx.renorm_cpm(df).collect()}
    assert cpm == {("s", "f1"): 250000.0, ("s", "f2"): 750000.0, ("t", "f1"): 0.0}
    mapping = spark.createDataFrame([("f1", "g"), ("f1", "h"), ("f1", "g")], "feature string, target string")
    got = {(r["sample"], r["feature"]): r["value"] for r in mx.regroup_table(df, mapping).collect()}
    assert got == {("s", "g"): 1.0, ("s", "h"): 1.0, ("s", "UNGROUPED"): 3.0, ("t", "g"): 0.0, ("t", "h"): 0.0}
