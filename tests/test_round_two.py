"""Lossless numbering, one result for every size, samples kept apart, pivots and narrow plans."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from seqtally.functions.expr import overlap
from seqtally.operators import alignments as al
from seqtally.operators import depth as dp
from seqtally.operators import hits as ht
from seqtally.operators import matrix as mx
from seqtally.operators import sequences as sq
from seqtally.sources import sequences as ss
from seqtally.sources import tables as ts


def test_records_survive_another_number_of_cores(spark, tmp_path):
    for part in range(3):
        (tmp_path / f"r{part}.fq").write_text("".join(
            f"@q{part}.{i} d\n{'ACGT' * (1 + i % 40)}\n+\n{'IIII' * (1 + i % 40)}\n" for i in range(4000)))
    key = "spark.sql.leafNodeDefaultParallelism"
    spark.conf.set(key, "4")
    try:
        reads = ss.read_fastq(spark, str(tmp_path))
        spark.conf.set(key, "13")
        rows = reads.select("read_id", "ord", F.length("seq").alias("n")).collect()
    finally:
        spark.conf.unset(key)
    assert sorted((r.read_id, r.ord, r.n) for r in rows) == sorted(
        (f"q{p}.{i}", i, 4 * (1 + i % 40)) for p in range(3) for i in range(4000))


def test_part_numbers_are_numbers(spark):
    names = ["part-100000-u-c000.snappy.parquet", "part-20000-u-c001.snappy.parquet", "part-20000-u-c000.snappy.parquet",
             "part-00003-u.snappy.parquet"]
    rows = spark.createDataFrame([(n,) for n in names], "name string").orderBy(sq.file_number(F.col("name"))).collect()
    assert [r.name for r in rows] == [names[3], names[2], names[1], names[0]]


def between(b1, e1, b2, e2):
    return 0 if e2 < b1 or b2 > e1 else min(e1, e2) - max(b1, b2)


def test_overlap(spark):
    cases = list(itertools.product([1, 4, 9], [2, 6, 9], [1, 5, 8], [0, 3, 7, 12]))
    rows = spark.createDataFrame(cases, "a int, b int, c int, d int").select(
        "*", overlap(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("o")).collect()
    assert all(r.o == between(r.a, r.b, r.c, r.d) for r in rows)


def accepted_by_hand(hits, frac):
    kept = []
    for h in hits:
        if not any(between(k[0], k[1], h[0], h[1]) > (h[1] - h[0] + 1) * frac for k in kept):
            kept.append(h)
    return kept


@pytest.mark.parametrize("frac", [0.0, 0.3, 1.0])
def test_one_choice_for_every_limit(spark, frac):
    pick = random.Random(int(frac * 100))
    rows = []
    for n in range(24):
        b = pick.randint(1, 40)
        e = b + pick.choice([-9, -3, -1, 0, 0, 1, 4, 12, 30])  # reversed, zero-length and plain
        rows.append(("q", "s", b, e, 1.0, n // 2))  # pairs share their place in the order
    rows += [("q", "s", 5, 20, 1.0, 40)] * 2 + [("r", "s", 1, 9, 1.0, 1)]
    hits = spark.createDataFrame(rows, "query string, subject string, q_b int, q_e int, evalue double, ord int")
    tie = {tuple(r[:6]): r.t for r in hits.select("*", F.xxhash64("subject", "q_b", "q_e", "evalue").alias("t")).collect()}
    ordered = sorted((r for r in rows if r[0] == "q"), key=lambda r: (r[5], tie[r]))
    expected = sorted(accepted_by_hand([(r[2], r[3]) for r in ordered], frac))
    for limit in (5, 10, 1000):
        out = ht.greedy_nonoverlap(hits, None, frac, round_hits=limit, spread=3).collect()
        assert sorted((r.q_b, r.q_e) for r in out if r.query == "q") == expected, limit
        assert [r.q_b for r in out if r.query == "r"] == [1]


def test_frac_outside_its_range(spark):
    with pytest.raises(ValueError):
        ht.greedy_nonoverlap(spark.createDataFrame([], "query int, q_b int, q_e int, ord int"), None, 1.5)


def test_unplaced_pairs_stay_after_host_removal(spark):
    lines = ["@HD\tVN:1", "a\t77\t*\t0\t0\t*\t*\t0\t0\tAC\tII", "a\t141\t*\t0\t0\t*\t*\t0\t0\tAC\tII",
             "b\t99\th\t5\t9\t2M\t=\t9\t0\tAC\tII\tAS:i:99", "b\t147\th\t9\t9\t2M\t=\t5\t0\tAC\tII\tAS:i:9"]
    aln = ts.parse_sam(spark.createDataFrame([(v, i) for i, v in enumerate(lines)], "value string, ord int"))
    assert sorted(r.read_id for r in al.drop_host_groups(aln, 75).collect()) == ["a", "a"]
    assert al.top_pair(aln, 5).count() == 2


def test_samples_do_not_mix(spark):
    reads = spark.createDataFrame([("s1", "x"), ("s1", "y"), ("s2", "x"), ("s2", "z")], "sample string, read_id string")
    hits = spark.createDataFrame([("s1", "d", "x"), ("s2", "d", "z")], "sample string, db string, read_id string")
    together = sq.filter_reads(reads, hits, by=["sample"])
    alone = [sq.filter_reads(reads.where(F.col("sample") == s), hits.where(F.col("sample") == s)) for s in ("s1", "s2")]
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(together) == rows(alone[0].union(alone[1])) == [("s1", "y"), ("s2", "x")]
    assert rows(sq.filter_summary(hits, by=["sample"])) == sorted(
        [("s1", "d", 1), ("s2", "d", 1), ("s1", "both", 1), ("s2", "both", 1)])
    piles = spark.createDataFrame([("s1", "a|taxid|1", 5, "A", "..T"), ("s2", "a|taxid|1", 5, "A", "T"),
                                   ("s2", "a|taxid|2", 5, "A", ".")],
                                  "sample string, seq_id string, pos int, ref string, bases string")
    assert rows(dp.pileup_alleles(piles, by=["sample"]).where("allele = 'T'").select("sample", "n")) == [("s1", 1), ("s2", 1)]
    passing = spark.createDataFrame([("s1", 1), ("s2", 2)], "sample string, taxid int")
    assert rows(dp.keep_passing(piles, passing, by=["sample"]).select("sample", "seq_id")) == [
        ("s1", "a|taxid|1"), ("s2", "a|taxid|2")]


def test_matrix_is_a_pivot(spark):
    samples = [f"s{i}" for i in range(1000)]  # a large cohort
    long = spark.range(4000).select(
        F.concat(F.lit("s"), (F.col("id") % 1000).cast("string")).alias("sample"), (F.col("id") % 7).alias("feature"),
        F.col("id").cast("double").alias("value"), F.col("id").alias("ord"))
    wide = mx.merge_samples(long, samples, cutoff=None)
    assert len(wide.columns) == 1001
    assert "pivot" in wide._jdf.queryExecution().executedPlan().toString().lower()
    row = wide.where("feature = 0").first().asDict()
    assert row["s0"] == max((i for i in range(0, 4000, 1000) if i % 7 == 0), default=0)


def test_choosing_moves_no_sequences(spark):
    aln = spark.createDataFrame([(1, 67, "r", "=", 50, "ACGT", 0)],
                                "read_id int, flag int, ref_id string, mate_ref string, score int, seq string, ord int")
    for chosen in (al.top_pair(aln, 5), al.top_pair_or_single(aln, 5)):
        plan = chosen._jdf.queryExecution().executedPlan().toString()
        assert not any("Aggregate" in line and "seq#" in line for line in plan.splitlines())
