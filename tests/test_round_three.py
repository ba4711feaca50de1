"""Hot keys by sketch, id filters, the sequence store, settled ties, interval index, byte ranges, numbering, writers."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from seqtally.operators import alignments as al
from seqtally.operators import annotation as an
from seqtally.operators import hits as ht
from seqtally.operators import sequences as sq
from seqtally.operators import taxonomy as tx
from seqtally.operators.common import hot_keys, in_all_lanes, input_bytes, keep_or_drop, spread_join
from seqtally.sources import records as rc
from seqtally.sources import sequences as ss
from seqtally.sources import sinks as sk
from seqtally.sources import store as st
from seqtally.sources import tables as ts
from seqtally.sources.text import read_lines


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- hot keys ------------------------------------------------------------------------------------


def test_only_hot_keys_take_lanes(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -7).otherwise(F.col("id")).alias("k"), "id")
    lookup = spark.range(-10, 30_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    hot = hot_keys(rows, ["k"])
    assert hot.count() == 1
    lanes = hot.first()._lanes
    assert lanes <= 8  # as many as the key has half shares, and one
    assert in_all_lanes(lookup, ["k"], hot).count() == lookup.count() + lanes - 1
    assert hot_keys(lookup, ["k"]) is None
    joined = spread_join(rows, lookup, ["k"], small=0)
    assert joined.columns == ["k", "id", "v"] and joined.count() == 30_000
    assert joined.where("v <> 2 * k").isEmpty()
    assert "_lane" in plan(joined) and "_lane" not in plan(spread_join(lookup, rows, ["k"], "left_semi", small=0))


def test_small_inputs_are_joined_plainly(spark):
    rows = spark.range(3000).select(F.lit(1).alias("k"), "id")
    assert input_bytes(rows.join(rows.withColumnRenamed("id", "i"), "k")) < 1 << 20
    assert "_lane" not in plan(spread_join(rows, spark.range(5).withColumnRenamed("id", "k"), ["k"]))


@pytest.mark.parametrize("small", [0, 1 << 40])
def test_null_and_hot_keys(spark, small):
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, "x").otherwise(F.col("id").cast("string")).alias("k"), "id")
    lookup = spark.createDataFrame([("x", 1), ("5", 2), (None, 3)], "k string, v int")
    left = spread_join(rows, lookup, ["k"], "left", small=small)
    assert left.count() == 9000 and left.where("v is not null").count() == 3001
    assert keep_or_drop(rows, lookup, ["k"], "left_anti", small=small).count() == 5999


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
def test_columns_keep_their_order(spark, how):
    rows = spark.createDataFrame([("s", "r1", 1), ("s", "r2", 2)], "sample string, read_id string, n int")
    ids = spark.createDataFrame([("r1", "s", "db")], "read_id string, sample string, db string")
    for small in (0, 1 << 40):
        for on in (["read_id"], ["sample", "read_id"]):
            assert keep_or_drop(rows, ids, on, how, small=small).columns == rows.columns
    assert sq.filter_reads(rows, ids).columns == sq.filter_reads(rows, ids, by=["sample"]).columns == rows.columns
    seq = rows.select("n", F.col("read_id").alias("seq_id"), F.col("read_id").alias("header"))
    assert sq.fetch_by_ids(seq, ids, id_col="read_id").columns == sq.exclude_ids(seq, ids, id_col="read_id").columns == seq.columns
    aln = spark.createDataFrame([("s", 3, "r1", "x", 5)], "sample string, flag int, read_id string, ref_id string, score int")
    assert al.drop_host_groups(aln, 9).columns == al.drop_host_groups(aln, 9, by=["sample"]).columns == aln.columns


@pytest.mark.parametrize("how, expected", [("left_semi", 700), ("left_anti", 20_300)])
def test_filter_of_ids(spark, how, expected):
    rows = spark.range(21_000).select(F.when(F.col("id") % 1000 != 999, F.col("id")).alias("k"), F.repeat(F.lit("x"), 50).alias("w"))
    ids = spark.range(0, 21_000, 30).select(F.col("id").cast("int").alias("k")).union(spark.createDataFrame([(None,)], "k int"))
    plain = keep_or_drop(rows, ids, ["k"], how)
    filtered = keep_or_drop(rows, ids, ["k"], how, bloom_bits=1 << 16)
    assert filtered.columns == rows.columns
    assert plain.count() == filtered.count() == expected
    assert sorted(r.k or -1 for r in plain.collect()) == sorted(r.k or -1 for r in filtered.collect())


def test_filter_keeps_records_out_of_the_shuffle(spark):
    rows = spark.range(20_000).select("id", F.repeat(F.lit("x"), 100).alias("w"))
    ids = spark.range(0, 20_000, 200)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = keep_or_drop(rows, ids, ["id"], "left_semi", bloom_bits=1 << 20)
        assert kept.count() == 100
        text = plan(kept)
        moved = text.split("Exchange hashpartitioning(id")[1]
        assert "_map" in text and "Filter" in moved
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# ---- store ---------------------------------------------------------------------------------------


def test_store_opens_the_files_of_the_ids(spark, tmp_path):
    path = str(tmp_path / "store")
    seq = spark.range(5000).select(F.format_string("s%05d", F.col("id")).alias("seq_id"), F.repeat(F.lit("A"), 9).alias("seq"))
    st.write_store(seq, path, files=20)
    assert spark.read.parquet(f"{path}/manifest").agg(F.sum("rows")).first()[0] == 5000
    ids = spark.createDataFrame([("s00007",), ("s00008",), ("s04999",), ("zz",), ("",), (None,)], "id string")
    opened = st.files_for(spark, path, ids)
    assert 1 <= len(opened) <= 2
    for few in (1000, 1):
        assert sorted(r.seq_id for r in st.fetch_from_store(spark, path, ids, few=few).collect()) == ["s00007", "s00008", "s04999"]
    every = st.fetch_from_store(spark, path, seq.select(F.col("seq_id").alias("id")))
    assert every.count() == 5000 and len(every.inputFiles()) == 20
    assert st.fetch_from_store(spark, path, ids.where("id = 'zz'")).count() == 0
    headers = spark.createDataFrame([("s00007", "s00007 full")], "seq_id string, header string")
    found = sq.fetch_large(path, spark.createDataFrame([(">s00007 x",), ("s00009",)], "id string"), headers)
    assert sorted((r.seq_id, r.header) for r in found.collect()) == [("s00007", "s00007 full"), ("s00009", "s00009")]


def test_store_without_records(spark, tmp_path):
    path = str(tmp_path / "store")
    st.write_store(spark.createDataFrame([], "seq_id string, seq string"), path)
    assert st.fetch_from_store(spark, path, spark.createDataFrame([("a",)], "id string")).count() == 0


# ---- ties ----------------------------------------------------------------------------------------


def fold(tied, standing):
    genes, out = dict(standing), {}
    for name, (n, taxids) in sorted(tied.items(), key=lambda t: (-t[1][0], t[0])):
        best = min(taxids, key=lambda t: (-genes.get(t, 0), t))
        out[name] = best
        genes[best] = genes.get(best, 0) + n
    return out


@pytest.mark.parametrize("seed, block", [(1, 1 << 16), (2, 3), (3, 16), (4, 1 << 16), (5, 2)])
def test_ties_equal_a_fold_in_order(spark, seed, block):
    pick = random.Random(seed)
    tied = {}
    for i in range(60):
        taxids = set(pick.sample(range(1, 9), pick.randint(2, 4)))
        if i % 3 == 0:
            taxids.add(5)  # one taxid in a third of the ties and more
        tied[f"s{i}"] = (pick.randint(1, 4), taxids)
    standing = {t: pick.randint(0, 3) for t in range(1, 5)}
    rows = spark.createDataFrame([(s, t, n) for s, (n, ts_) in tied.items() for t in ts_], "scaffold string, taxid long, n_genes long")
    start = spark.createDataFrame(list(standing.items()), "taxid long, _genes long")
    got = {r.scaffold: r.taxid for r in an.settled_in_order(rows, start, block=block).collect()}
    assert got == fold(tied, standing)


def test_ties_of_samples_are_apart(spark):
    rows = spark.createDataFrame([("a", "x", 1, 2), ("a", "x", 2, 2), ("b", "x", 1, 2), ("b", "x", 2, 2)],
                                 "sample string, scaffold string, taxid long, n_genes long")
    start = spark.createDataFrame([("b", 2, 9)], "sample string, taxid long, _genes long")
    got = {r.sample: r.taxid for r in an.settled_in_order(rows, start, ["sample"]).collect()}
    assert got == {"a": 1, "b": 2}


# ---- intervals -----------------------------------------------------------------------------------


def between(b1, e1, b2, e2):
    return 0 if e2 < b1 or b2 > e1 else min(e1, e2) - max(b1, b2)


@pytest.mark.parametrize("frac", [0.0, 0.01, 0.3, 0.5, 0.9, 1.0])
def test_interval_index_equals_all_comparisons(frac):
    pick = random.Random(int(frac * 100) + 1)
    for spread in (30, 400, 10_000):
        held, kept = ht.Accepted(frac), []
        for _ in range(600):
            b = pick.randint(0, spread)
            e = b + pick.choice([-7, -1, 0, 1, 3, 20, 150, spread])
            allowed = (e - b + 1) * frac
            expected = not any(between(x, y, b, e) > allowed for x, y in kept)
            assert held.takes(b, e) == expected, (frac, b, e)
            if expected:
                kept.append((b, e))


def test_hot_query_in_linear_time(spark):
    hits = spark.range(20_000).select(F.lit("q").alias("query"), F.col("id").alias("ord"), (F.col("id") * 7919 % 100_000).cast("int").alias("q_b"))
    hits = hits.withColumn("q_e", F.col("q_b") + 20)
    kept = ht.greedy_nonoverlap(hits, None)
    again = ht.greedy_nonoverlap(hits, None, round_hits=3000)
    assert kept.columns == again.columns == hits.columns
    assert sorted(r.ord for r in kept.collect()) == sorted(r.ord for r in again.collect())
    held, looked = ht.Accepted(0.5), 0
    for r in hits.orderBy("ord").collect():
        held.takes(r.q_b, r.q_e)
    assert max(len(c) for cells in held.classes.values() for c in cells.values()) < 20


def test_null_queries_and_positions(spark):
    hits = spark.createDataFrame([(None, 1, 1, 9), (None, 2, 1, 9), ("a", 1, None, 5), ("a", 2, 1, 9), ("a", 3, 2, 9)],
                                 "query string, ord int, q_b int, q_e int")
    got = sorted((r.query or "", r.ord) for r in ht.greedy_nonoverlap(hits, None).collect())
    assert got == [("", 1), ("a", 1), ("a", 2)]


# ---- byte ranges ---------------------------------------------------------------------------------


def fastq(n, seed=1):
    pick = random.Random(seed)
    out = []
    for i in range(n):
        size = pick.randint(1, 30)
        qual = "".join(pick.choice("@+I#") for _ in range(size))  # lines that look like others
        out.append((f"q{i}", f"d {i}" if i % 3 else "", "".join(pick.choice("ACGT") for _ in range(size)), qual))
    return out


def text_of(rows):
    return "".join(f"@{i}{' ' + d if d else ''}\n{s}\n+\n{q}\n" for i, d, s, q in rows)


@pytest.mark.parametrize("size", [1, 7, 50, 333, 1 << 20])
def test_fastq_ranges_of_any_size(spark, tmp_path, size):
    rows = fastq(min(40, 4 + size))  # few ranges of a byte
    (tmp_path / "a.fq").write_text(text_of(rows))
    found = ss.read_fastq(spark, str(tmp_path / "a.fq"), 1, range_bytes=size).orderBy("ord").collect()
    assert [(r.read_id, r.descr, r.seq, r.qual) for r in found] == rows
    assert [r.ord for r in found] == list(range(len(rows)))


def test_fastq_folders_patterns_and_gzip(spark, tmp_path):
    rows = fastq(500, 2)
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.fq").write_text(text_of(rows[:200]).replace("\n", "\r\n"))
    (tmp_path / "x" / "b.fq.gz").write_bytes(gzip.compress((text_of(rows[200:]) + "\n\n").encode()))
    (tmp_path / "x" / "_c.fq").write_text("no reads")
    (tmp_path / "x" / "empty.fq").write_text("")
    for path in (str(tmp_path / "x"), f"{tmp_path}/*/*.fq*", [f"{tmp_path}/x/a.fq", f"{tmp_path}/x/b.fq.gz"], f"file:{tmp_path}/x"):
        reads = ss.read_fastq(spark, path, range_bytes=1000)
        assert sorted(r.read_id for r in reads.collect()) == sorted(r[0] for r in rows)
        text = plan(reads)
        assert "Exchange hashpartitioning" not in text and "Aggregate" not in text
    with pytest.raises(Exception, match="nowhere"):
        ss.read_fastq(spark, str(tmp_path / "nowhere")).count()


@pytest.mark.parametrize("size", [1, 9, 64, 1 << 20])
def test_ann_and_fasta_ranges(spark, tmp_path, size):
    pick = random.Random(4)
    at, ann = 0, ["900 30 11"]
    n_records = min(30, 5 + size)
    for i in range(n_records):
        n = pick.randint(0, 40)
        ann += [f"{i} r{i} some 1 2" if i % 2 else f"{i} 7{i} {i}", f"{at} {n} 0"]  # also ids and texts of digits only
        at += n
    (tmp_path / "r.ann").write_text("\n".join(ann) + "\n")
    found = {(r.ref_id, r.length) for r in ss.read_ann(spark, str(tmp_path / "r.ann"), size).collect()}
    assert found == {(a.split()[1], int(b.split()[1])) for a, b in zip(ann[1::2], ann[2::2])}
    (tmp_path / "s.fa").write_text("".join(f">s{i} d\n" + "ACGT\n" * (i % 5) for i in range(n_records)))
    rows = rc.read_records(spark, str(tmp_path / "s.fa"), "fasta", size)
    seqs = ss.parse_fasta(rows.select(F.get("lines", F.lit(0)).alias("value"), "ord"))
    assert [(r.seq_id, r.length) for r in seqs.orderBy("ord").collect()] == [(f"s{i}", 4 * (i % 5)) for i in range(n_records)]
    numbers = sq.numbered(seqs)
    assert all(r.seq_id == f"s{r.number - 1}" for r in numbers.collect())
    assert "Sort" not in plan(numbers).split("BroadcastExchange")[0]


# ---- numbering -----------------------------------------------------------------------------------


def test_dense_order_is_numbered_in_place(spark):
    rows = spark.range(1000).select(F.col("id").alias("ord"), (F.col("id") < 300).alias("s"), F.repeat(F.lit("A"), 50).alias("seq"))
    for by in ((), ("s",)):
        out = sq.numbered(rows.repartition(7), start=3, by=by)
        assert "Sort [" not in plan(out).replace("SortMergeJoin", "") and "Exchange rangepartitioning" not in plan(out)
        assert all(r.number == (r.ord if r.s or not by else r.ord - 300) + 3 for r in out.collect())


def test_gaps_are_numbered_through_narrow_rows(spark, tmp_path):
    (tmp_path / "s.fa").write_text("".join(f">s{i}\n{'A' * (i % 7)}\n" for i in range(200)))
    seqs = ss.read_fasta(spark, str(tmp_path / "s.fa"), ranges=True)
    out = sq.numbered(sq.filter_min_len(seqs, 3)).orderBy("number").collect()
    assert [r.seq_id for r in out] == [f"s{i}" for i in range(200) if i % 7 >= 3]
    assert [r.number for r in out] == list(range(1, len(out) + 1))
    assert sq.numbered(seqs.limit(0)).count() == 0


# ---- lineage -------------------------------------------------------------------------------------


def test_very_deep_lineage_takes_few_rounds(spark, monkeypatch):
    written = []
    cut = tx.cut_lineage
    monkeypatch.setattr(tx, "cut_lineage", lambda df: written.append(1) or cut(df))
    deep = [(2, 1, "superkingdom")] + [(i, i - 1, "genus" if i == 4 else "norank") for i in range(3, 1003)]
    deep += [(5000, 5001, "x"), (5001, 5000, "x"), (6000, 77777, "phylum")]
    nodes = spark.createDataFrame(deep, "taxid long, parent long, rank string")
    leaves = spark.createDataFrame([(1002,), (3,), (6000,), (8888,)], "taxid long")
    rows = {r.taxid: r for r in tx.lineage_ids(nodes, leaves).collect()}
    assert rows[1002].superkingdom_ti == 2 and rows[1002].genus_ti == 4 and rows[3].genus_ti is None
    assert rows[6000].phylum_ti == 6000 and rows[8888].toprank_ti == 8888 and rows[8888].superkingdom_ti is None
    assert len(written) <= 13
    with pytest.raises(ValueError, match="5000|5001"):
        tx.lineage_ids(nodes, spark.createDataFrame([(5001,)], "taxid long"))


# ---- headers -------------------------------------------------------------------------------------

SAM = ("@HD\tVN:1.6\n@SQ\tSN:x\tLN:9\n@SQ\tSN:y\tLN:9\n"
       "a\t67\tx\t1\t9\t4M\t=\t5\t4\tACGT\tIIII\tAS:i:80\na\t131\tx\t5\t9\t4M\t=\t1\t4\tACGT\tIIII\tAS:i:70\n"
       "b\t0\ty\t1\t9\t4M\t*\t0\t0\tACGT\tIIII\tAS:i:90\nc\t67\tx\t1\t9\t4M\t=\t5\t4\tACGT\tIIII\tAS:i:20\n")


@pytest.mark.parametrize("filter_, kept", [
    (lambda a: al.top_pair(a, 50), ["a", "a"]), (lambda a: al.top_pair_or_single(a, 50), ["a", "a"]),
    (lambda a: al.top_scored(a, 75), ["a", "b"]), (lambda a: al.drop_host_groups(a, 75), ["c"])])
def test_filters_on_a_file_with_headers(spark, write, filter_, kept):
    found = sorted(r.read_id for r in filter_(ts.read_sam(spark, write("h.sam", SAM))).collect())
    assert found == kept, found


def test_other_texts_with_headers(spark, write):
    m8 = write("h.m8", "# qseqid sseqid\nq\ts\t50\t10\t0\t0\t1\t10\t1\t10\t0.5\t20\n")
    assert ts.read_hits(spark, m8).where("pct_iden > 1 and evalue < 1").count() == 1
    dom = write("d.tbl", "#  --- full sequence ---\n" + "  ".join(["n", "a", "5", "q", "-", "9", "1e-9", *["1"] * 15, "some text"]) + "\n")
    assert ts.read_domtbl(spark, dom).where("evalue < 1 and hmm_len > 1").count() == 1
    tbl = write("t.tbl", "# target name\n" + "  ".join(["n", "a", "q", "-", "1e-9", *["1"] * 13, "some text"]) + "\n")
    assert ts.read_tbl(spark, tbl).where("evalue < 1").count() == 1
    cls = write("c.txt", "readID\tseqID\ttaxID\tscore\t2ndBestScore\thitLength\tqueryLength\tnumMatches\nr\ts\t9\t1\t1\t70\t80\t1\n")
    assert ts.read_classified(spark, cls).where("hit_len >= 60 and taxid = 9").count() == 1
    cells = ["acc|A|taxid|7", "5", "A", "M", *["-"] * 14, "G", "q"]
    var = write("v.txt", "Chrom\tPosition\tRef\n" + "\t".join(cells) + "\n")
    assert ts.read_variants(spark, var).where("position > 1 and taxid = 7").count() == 1


# ---- writers -------------------------------------------------------------------------------------


def test_header_in_every_file_or_first(spark, write, tmp_path):
    path = write("h.sam", SAM)
    aln, heads = ts.read_sam(spark, path), ts.sam_headers(read_lines(spark, path))
    sk.write_sam(aln, str(tmp_path / "one"), heads)
    text = "".join(p.read_text() for p in sorted((tmp_path / "one").glob("part-*")))
    assert text == SAM
    sk.write_sam(aln, str(tmp_path / "each"), heads, one_section=False)
    files = sorted((tmp_path / "each").glob("part-*"))
    assert files and all(p.read_text().startswith(SAM[:SAM.index("a\t67")]) for p in files)
    assert ts.read_sam(spark, str(tmp_path / "each")).count() == 4
    assert not list((tmp_path / "each").glob("_*"))


def test_one_file_per_key(spark, tmp_path):
    rows = spark.range(300).select(F.concat(F.lit("k/"), (F.col("id") % 3).cast("string")).alias("k"),
                                   F.col("id").cast("string").alias("value"), F.col("id").alias("ord"))
    sk.write_by_key(rows, str(tmp_path / "keys"), "k", header="#n\n")
    names = sorted(p.name for p in (tmp_path / "keys").iterdir())
    assert names == ["k%2F0.tsv", "k%2F1.tsv", "k%2F2.tsv"]
    assert (tmp_path / "keys" / "k%2F1.tsv").read_text().splitlines() == ["#n", *[str(i) for i in range(1, 300, 3)]]
    sk.write_by_key(rows.where("k = 'k/0'"), str(tmp_path / "keys"), "k")
    assert [p.name for p in (tmp_path / "keys").iterdir()] == ["k%2F0.tsv"]


def test_a_failing_task_leaves_no_file(spark, tmp_path):
    rows = spark.range(4000).repartition(8).select(
        F.lit("k").alias("k"), F.when(F.col("id") == 3999, F.raise_error(F.lit("broken"))).otherwise(F.col("id").cast("string")).alias("value"))
    with pytest.raises(Exception, match="broken"):
        sk.write_lines(rows.select(F.lit(None).cast("string").alias("key"), "value"), str(tmp_path / "out"))
    assert not [p for p in (tmp_path / "out").rglob("*") if p.is_file()] if (tmp_path / "out").exists() else True


# ---- samples -------------------------------------------------------------------------------------


def test_files_of_a_sheet(spark, write, tmp_path):
    for name in ("s1", "s2", "other"):
        write(f"root/{name}/x.txt", "#id\tv\nf1\t3\n")
    write("root/s3/x.txt", "")
    root = str(tmp_path / "root")
    sheet = spark.createDataFrame([("s2", 0), ("s1", 1)], "sample_id string, ord long")
    rows = ts.read_per_sample(spark, root, "x.txt", sheet, ts.read_headed_tsv)
    assert sorted(r.sample_id for r in rows.collect()) == ["s1", "s2"]
    assert ts.present_samples(spark, root, "x.txt", sheet) == ["s2", "s1"]
    more = sheet.union(spark.createDataFrame([("s3", 2), ("s4", 3)], "sample_id string, ord long"))
    with pytest.raises(FileNotFoundError, match="s3, s4"):
        ts.read_per_sample(spark, root, "x.txt", more, ts.read_headed_tsv)
    assert ts.read_per_sample(spark, root, "x.txt", more, ts.read_headed_tsv, "skip").count() == 2
    assert ts.present_samples(spark, root, "x.txt", more) == ["s2", "s1"]
    found = {r.sample_id: (r.files, r.bytes) for r in ts.sample_files(spark, root, "x.txt").collect()}
    assert "s3" not in found and found["s1"][1] > 0
