"""Readers on small files in the native formats, and writers read back."""

import gzip

import pytest
from pyspark.sql import functions as F

from seqtally.operators import hierarchy as hi
from seqtally.operators import hits as ht
from seqtally.operators import matrix as mx
from seqtally.sources import sequences as ss
from seqtally.sources import sinks as sk
from seqtally.sources import tables as ts
from seqtally.sources.text import read_lines, read_numbered_lines

FASTA = ">s1 first one\nACGT\nAC GT\n>s2\n\n>s3 a>b\nAAAA\n>AC"


def test_fasta(spark, write):
    rows = ss.read_fasta(spark, write("a.fa", FASTA)).orderBy("ord").collect()
    assert [(r["seq_id"], r["descr"], r["length"]) for r in rows] == [
        ("s1", "first one", 8), ("s2", "", 0), ("s3", "a>b", 4), ("AC", "", 0)]
    assert rows[0]["seq"] == "ACGT\nAC GT"


def test_fasta_gzip_and_crlf(spark, tmp_path):
    path = tmp_path / "b.fa.gz"
    path.write_bytes(gzip.compress(b">s1 x\r\nAC\r\nGT\r\n>s2\r\nA\r\n"))
    assert [(r["seq_id"], r["header"], r["length"]) for r in ss.read_fasta(spark, str(path)).orderBy("ord").collect()] == [
        ("s1", "s1 x", 4), ("s2", "s2", 1)]


def test_fasta_split_over_many_tasks(spark, write):
    text = "".join(f">s{i} d\n{'ACGT' * (i % 50)}\n" for i in range(3000))
    path = write("big.fa", text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = ss.read_fasta(spark, path)
        assert df.rdd.getNumPartitions() > 4
        rows = df.orderBy("ord").collect()
        lines = read_numbered_lines(spark, path).orderBy("ord").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r["seq_id"] for r in rows] == [f"s{i}" for i in range(3000)]
    assert [r["length"] for r in rows] == [4 * (i % 50) for i in range(3000)]
    assert [r["line"] for r in lines] == list(range(len(lines)))


def test_fastq(spark, write):
    text = "".join(f"@r{i} d{i}\nACGT{'A' * i}\n+\n@III{'#' * i}\n" for i in range(500))
    path = write("r.fq", text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        rows = ss.read_fastq(spark, path, mate=1).orderBy("ord").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r["read_id"] for r in rows] == [f"r{i}" for i in range(500)]
    assert all(r["qual"] == "@III" + "#" * i and len(r["seq"]) == 4 + i for i, r in enumerate(rows))
    assert rows[3]["descr"] == "d3" and rows[3]["mate"] == 1


def test_fasta_and_fastq_round_trip(spark, write, tmp_path):
    seq = ss.read_fasta(spark, write("a.fa", ">s1 one\nACGT\nAC\n>s2 two\nG\n"))
    sk.write_fasta(seq, str(tmp_path / "out"))
    again = ss.read_fasta(spark, str(tmp_path / "out"))
    assert sorted(map(tuple, again.select("header", "seq").collect())) == [("s1 one", "ACGT\nAC"), ("s2 two", "G")]
    reads = ss.read_fastq(spark, write("r.fq", "@a x y\nAC\n+a\nII\n@b\nG\n+\n@\n"))
    sk.write_fastq(reads, str(tmp_path / "fq"))
    back = ss.read_fastq(spark, str(tmp_path / "fq"))
    assert sorted(map(tuple, back.select("read_id", "descr", "seq", "qual").collect())) == [
        ("a", "x y", "AC", "II"), ("b", "", "G", "@")]


SAM = ("@HD\tVN:1.0\n@SQ\tSN:x\tLN:5\n"
       "r1\t67\tx\t7\t60\t4M\t=\t9\t20\tACGT\tIIII\tNM:i:0\tAS:i:88\tAS:i:1\n"
       "r1\t131\t*\t0\t0\t*\t*\t0\t0\tACGT\tIIII\n"
       "r2\t0\ty\t1\t60\t4M\t*\t0\t0\tACGT\tIIII\n")


def test_sam(spark, write, tmp_path):
    path = write("a.sam", SAM)
    aln = ts.read_sam(spark, path)
    rows = aln.orderBy("ord").collect()
    assert [(r["read_id"], r["flag"], r["ref_id"], r["score"]) for r in rows] == [
        ("r1", 67, "x", 88), ("r1", 131, "*", None), ("r2", 0, "y", None)]
    assert rows[0]["tags"] == ["NM:i:0", "AS:i:88", "AS:i:1"] and rows[0]["tlen"] == 20
    sk.write_sam(aln, str(tmp_path / "sam"), ts.sam_headers(read_lines(spark, path)))
    text = "".join(p.read_text() for p in sorted((tmp_path / "sam").glob("part-*")))
    assert text.splitlines() == SAM.splitlines()


def test_hits_directory(spark, write):
    row = "gutA|scaffold|7.3   fam|X|42  51.25   120     58     2       3       122     40     159     1e-30    111"
    path = write("hits/a.bl", "# comment\n" + row + "\n")
    write("hits/b.bl", "q\ts\t50\t10\t0\t0\t1\t10\t1\t10\t0.5\t20\n")
    write("hits/.hidden", "x\n")
    rows = ts.read_hits(spark, path.rsplit("/", 1)[0]).orderBy("ord").collect()
    assert len(rows) == 2 and rows[0]["subject"] == "fam|X|42" and rows[0]["evalue"] == 1e-30 and rows[1]["bits"] == 20


DOM = """# target
Shell_dom        PF90001.3   150 gutA|scaffold|7.9 -            300   1.5e-12   40.1  3.2   1   2   1.0e-15   1.5e-12   40.1  2.2     4   140    21   160    20   163 0.90 Made-up shell domain
Shell_dom        PF90001.3   150 gutA|scaffold|7.9 -            300   1.5e-12   40.1  3.2   2   2     0.05   9.0e+02   -0.7   0.4   100   120   230   252   228   255 0.51 Made-up shell domain
"""


def test_domains(spark, write):
    dom = ts.read_domtbl(spark, write("d.txt", DOM))
    first = dom.orderBy("ord").first()
    assert (first["hmm_len"], first["h_b"], first["h_e"], first["q_b"], first["q_e"]) == (150, 4, 140, 21, 160)
    fam = ts.domain_families(dom)
    assert fam.first()["descr"] == "Made-up shell domain"
    got = ht.family_abundance(ht.greedy_nonoverlap(ts.domain_hits(dom)), fam).first()
    assert got["n_hits"] == 2 and got["coverage"] == int((137 + 21) / 150 * 1e6) / 1e6


def test_tbl(spark, write):
    line = "name PF1.2 q1 - 1e-5 " + "x " * 13 + "a long text"
    row = ts.read_tbl(spark, write("t.txt", f"#\n{line}\n")).first()
    assert (row["name"], row["acc"], row["query"], row["evalue"], row["descr"]) == ("name", "PF1.2", "q1", 1e-5, "a long text")


ANN = """1234567 2 11
0 ZZ_1.1 Madeup organism plasmid p1, whole
0 3210 0
0 acc|ZZ_X.1|taxid|611|sptid|611|getid|N
3210 100 0
"""


def test_reference_lengths_and_index(spark, write):
    rows = {r["ref_id"]: r for r in ss.read_ann(spark, write("r.ann", ANN)).collect()}
    assert rows["ZZ_1.1"]["length"] == 3210 and rows["ZZ_1.1"]["taxid"] is None
    assert rows["ZZ_1.1"]["descr"].startswith("Madeup organism")
    other = rows["acc|ZZ_X.1|taxid|611|sptid|611|getid|N"]
    assert (other["taxid"], other["acc"], other["length"]) == (611, "acc|ZZ_X.1", 100)
    fai = ss.read_fai(spark, write("r.fai", "acc|ZZ_Y2.1|taxid|611\t250000\t120\t80\t81\n")).first()
    assert (fai["length"], fai["line_width"]) == (250000, 81)


def test_profile_models(spark, write):
    text = "HMMER3/f\nNAME a\nACC   PF00001.7\nLENG 3\n//\nHMMER3/f\nNAME b\nACC   PF00002.1\n//\n"
    models = ss.read_hmm_flat(spark, write("m.hmm", text))
    assert sorted(r["acc"] for r in models.collect()) == ["PF00001", "PF00002"]


def test_family_reference(spark, write):
    text = (">fam|X|11 COG0001, AbcD, Invented aminotransferase [Some metabolism]\nACDE\nFG\n"
            ">fam|X|12 KOG0008, KOG0008, KOG0008, Invented factor, subunit B [Something]\nAC\n"
            ">fam|X|13 PRK00007, PRK00007, invented factor G; Checked\nACD\n")
    rows = {r["acc"]: r for r in ss.read_family_fasta(spark, write("f.fa", text)).collect()}
    assert rows["COG0001"]["name"] == "AbcD" and rows["COG0001"]["model_len"] == 6
    assert rows["COG0001"]["descr"] == "Invented aminotransferase"
    assert rows["KOG0008"]["descr"] == "Invented factor, subunit B"
    assert rows["PRK00007"]["descr"] == "invented factor G; Checked"
    plain = ss.read_family_fasta(spark, write("f.fa", text), curated=False).collect()
    assert any(r["descr"].startswith("COG0001, AbcD") for r in plain)


def test_classes(spark, write):
    members = ts.read_class_map(spark, write("m.txt", "INFO\n[JK] COG0001 some text\n[J] COG0002 t\n")).collect()
    assert [(r["letters"], r["family"], r["descr"]) for r in members] == [("JK", "COG0001", "some text"), ("J", "COG0002", "t")]
    names = ts.read_class_names(spark, write("n.txt", "GROUP\n  [J] Translation\n [K] Transcription, x\n")).orderBy("ord").collect()
    assert [(r["class"], r["descr"]) for r in names] == [("J", "Translation"), ("K", "Transcription, x")]


def test_cluster_annotation(spark, write):
    text = ">ref1\t3\t2\tKO|K12345\tsome protein\n0\t511145\tx\n1\t562\ty\n>ref2\t1\t0\t-\tother\n>ref3\t1\t1\tKO||\tz\n0\t7\tq\n"
    rows = {r["ref_id"]: r for r in ts.read_clstr_ann(spark, write("c.txt", text)).collect()}
    assert rows["ref1"]["taxids"] == [511145, 562] and rows["ref1"]["ko"] == "K12345" and rows["ref1"]["descr"] == "some protein"
    assert rows["ref2"]["taxids"] == [] and rows["ref2"]["ko"] is None and rows["ref3"]["taxids"] == [7]


def test_classifier(spark, write):
    cls = ts.read_classified(spark, write("c.txt", "readID\tseqID\ttaxID\tscore\t2ndBestScore\thitLength\tqueryLength\tnumMatches\n"
                                                   "r1\tspecies\t9606\t4225\t0\t80\t150\t1\n"))
    assert tuple(cls.first())[:8] == ("r1", "species", 9606, 4225, 0, 80, 150, 1)
    report = ts.read_kreport(spark, write("r.txt", " 1.5\t10\t5\tS\t562\t  E. coli\n 0.1 1 1 U x unclassified\n"))
    assert [r[0] for r in report.collect()] == [562]


def test_taxonomy_files(spark, write):
    folder = write("tax/names.dmp", "562\t|\tEscherichia coli\t|\t\t|\tscientific name\t|\n562\t|\tE. coli\t|\t\t|\tsynonym\t|\n"
                   ).rsplit("/", 1)[0]
    write("tax/nodes.dmp", "562\t|\t561\t|\tspecies\t|\tEC\n9\t|\t1\t|\tno rank\t|\n")
    nodes, names = ts.read_taxdump(spark, folder)
    assert sorted(map(tuple, nodes.collect())) == [(9, 1, "norank"), (562, 561, "species")]
    assert [tuple(r) for r in names.collect()] == [(562, "Escherichia coli")]
    cells = ["511145", "toprank", "K-12", "Bacteria", "2", "\\N", "\\N", "Proteobacteria", "1224"] + ["x", "3"] * 6
    table = ts.read_lineage(spark, write("l.txt", "#taxid\n" + "\t".join(cells) + "\n" + "\t".join(["2", "superkingdom"] + cells[2:]) + "\n"))
    rows = table.collect()
    assert len(rows) == 1 and rows[0]["kingdom"] is None and rows[0]["phylum_ti"] == 1224


def test_catalogues(spark, write):
    row = ts.read_catalog(spark, write("c.txt", "7\tSome name\tNC_1\td\tok\t100\n")).first()
    assert (row["taxid"], row["name"], row["acc"], row["length"]) == (7, "Some name", "NC_1", 100)
    reps = ts.read_rep_genomes(spark, write("g.txt", "species_ti\tgenome\n1\tg1\n")).collect()
    assert reps[0]["genome"] == "g1"


def test_variants_and_pileup(spark, write):
    cells = ["acc|NC_1|taxid|7|x", "12", "A", "G"] + ["-"] * 14 + ["G", "z"]
    rows = ts.read_variants(spark, write("v.txt", "Chrom\tPosition\n" + "\t".join(cells) + "\n")).collect()
    assert [tuple(r) for r in rows] == [("NC_1", 7, 12, "A", "G", "G")]
    row = ts.read_pileup(spark, write("p.txt", 'acc|x|taxid|7\t3\tA\t4\t.,"G\tII"I\n')).first()
    assert (row["pos"], row["depth"], row["bases"], row["quals"]) == (3, 4, '.,"G', 'II"I')


def test_sheets_and_log(spark, write):
    sheet = ts.read_samples(spark, write("s.txt", "#note\nS-10042  R1.fq.gz  R2.fq.gz\n\n -x\n")).collect()
    assert [(r["sample_id"], r["data"]) for r in sheet] == [("S-10042", ["R1.fq.gz", "R2.fq.gz"])]
    assert ts.read_opts(spark, write("o.txt", "assembly  spade  250\n")).first()["opts"] == ["spade", "250"]
    log = ts.read_job_log(spark, write("l.txt", "sample=S job=J host=h pid=1 queue=q cores=4 time_start=10 time_end=17 time_spent=7\nnoise\n"))
    assert [(r["sample"], r["job"], r["cores"] * r["time_spent"]) for r in log.collect()] == [("S", "J", 28)]


KEG = """+D	KO
#NAME        KO
!
A<b>Alpha</b>
B
B  <b>Beta</b>
C    09900 Gamma path [PATH:ko09900]
D      K00844  AA; invented kinase [EC:9.9.9.9]
D      K12407  BB; other kinase
C    Plain text
D      K00844  AA; invented kinase [EC:9.9.9.9]
B  <b>Other</b>
D      K00001  no C open
!
D      K99999  outside
"""


def test_hierarchy(spark, write):
    lines = ts.read_brite(spark, write("ko00001.keg", KEG))
    leaves = hi.flatten_brite(lines).orderBy("leaf_ord").collect()
    assert [(r["ko"], r["A"], r["B"], r["C"]) for r in leaves] == [
        ("K00844", "Alpha", "Beta", "ko09900"), ("K12407", "Alpha", "Beta", "ko09900"),
        ("K00844", "Alpha", "Beta", "Plain text"), ("K00001", "Alpha", "Other", None)]
    assert leaves[0]["descr"] == "AA; invented kinase [EC:9.9.9.9]"
    nodes = {(r["level"], r["node"]): r for r in hi.brite_nodes(lines).collect()}
    assert nodes[("C", "ko09900")]["descr"] == "Gamma path" and nodes[("C", "ko09900")]["B"] == "Beta"
    assert nodes[("B", "Other")]["descr"] is None and nodes[("B", "Other")]["A"] == "Alpha"


MODULES = """+E	Module
!
A<b>Pathway module</b>
B
B  <b>Energy metabolism</b>
C    Carbon fixation
D      M00165  Invented cycle of modules [PATH:map09900 map09910]
E        K00855  PRK, prkB; phosphoribulokinase
E        K01601  rbcL; large chain
D      M00166  Other
E        K00855  PRK, prkB; phosphoribulokinase
!
"""


def test_module_hierarchy_rollup(spark, write):
    lines = ts.read_brite(spark, write("ko00002.keg", MODULES))
    leaves, nodes = hi.flatten_brite(lines), hi.brite_nodes(lines)
    ann = spark.createDataFrame([("g1", "K00855", 0.5), ("g2", "K00855", None), ("g3", "K7", 1.0), ("g4", "", 1.0)],
                                "orf_id string, ko string, frac double")
    depth = spark.createDataFrame([("g1", 4.0), ("g2", 0.0)], "orf_id string, depth double")
    ref = spark.createDataFrame([("K00855",), ("K7",)], "ko string")
    abundance = hi.ko_abundance(ann, hi.ko_scope(leaves), depth, ref)
    row = abundance.first()
    assert (row["ko"], row["depth"], row["depth_adj"], row["abundance"]) == ("K00855", 1.5, 3.0, 1.0)
    assert (row["r_depth"], row["r_depth_adj"]) == (1.2, 1.5)  # means of the two reference KOs: 1.25 and 2.0
    rolled = {(r["level"], r["node"]): r for r in hi.level_rollup(abundance, leaves, nodes).collect()}
    d = rolled[("D", "M00165")]
    assert (d["members"], d["found"], d["coverage"], d["depth"], d["C"]) == (2, 1, 0.5, 0.75, "Carbon fixation")
    a = rolled[("A", "Pathway module")]
    assert (a["members"], a["found"], a["coverage"]) == (3, 2, 0.666)  # a KO under two modules counts twice
    full = hi.full_listing(leaves, abundance).collect()
    assert [(r["id"], r["ko"], r["depth"]) for r in full] == [(1000001, "K00855", 1.5), (1000002, "K01601", 0.0),
                                                             (1000003, "K00855", 1.5)]


def test_per_sample(spark, write, tmp_path):
    write("root/s1/t/x.txt", "#id\tann\tv\nf1\ta\t3\nf2\tb\t1\n")
    write("root/s2/t/x.txt", "#id\tann\tv\nf1\ta2\t5\nf1\ta2\t6\n")
    write("root/s3/t/x.txt", "")
    root = str(tmp_path / "root")
    with pytest.raises(FileNotFoundError, match="s3, s4"):
        ts.read_per_sample(spark, root, "t/x.txt", ["s1", "s2", "s3", "s4"], ts.read_headed_tsv)
    rows = ts.read_per_sample(spark, root, "t/x.txt", ["s1", "s2", "s3", "s4"], ts.read_headed_tsv, on_missing="skip")
    long = rows.select(F.col("sample_id").alias("sample"), F.col("id").alias("feature"), "ann",
                       F.col("v").cast("double").alias("value"), "ord")
    present = ts.present_samples(spark, root, "t/x.txt", ["s1", "s2", "s3", "s4"])
    assert present == ["s1", "s2"]
    got = mx.merge_samples(long, present, ann=["ann"], stats=True).collect()
    assert [(r["feature"], r["ann"], r["s1"], r["s2"], r["max"]) for r in got] == [("f1", "a", 3.0, 6.0, 6.0),
                                                                                  ("f2", "b", 1.0, 0.0, 1.0)]


def test_tsv_and_split(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, None), ("b", 2, "x y")], "id string, n int, t string")
    sk.write_tsv(df.coalesce(1), str(tmp_path / "t"))
    text = next((tmp_path / "t").glob("part-*")).read_text()
    assert text.splitlines() == ["#id\tn\tt", "a\t1\t\\N", "b\t2\tx y"]
    sk.write_split(df, str(tmp_path / "s"), "id")
    assert sorted(p.name for p in (tmp_path / "s").iterdir() if p.is_dir()) == ["id=a", "id=b"]
    sk.write_parquet(df.withColumnRenamed("id", "sample_id"), str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).where("sample_id = 'b'").first()["n"] == 2
