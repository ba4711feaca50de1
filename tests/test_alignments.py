"""Alignment selection and counting: hand-worked rows, and a plain restatement of the rules on random groups."""

import random

import pytest
from pyspark.sql import functions as F

from seqtally.operators import alignments as al

COLUMNS = "read_id string, flag int, ref_id string, mate_ref string, score int, ord long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], COLUMNS)


def picked(df):
    return sorted(r["ord"] for r in df.collect())


def test_top_pair(spark):
    rows = [
        ("a", 67, "x", "=", 90), ("a", 131, "x", "=", 80), ("a", 67, "x", "=", 99),  # first of each mate
        ("b", 67, "x", "=", 90), ("b", 131, "y", "=", 90),                            # references differ
        ("c", 67, "x", "=", 90),                                                      # single mate
        ("d", 67, "x", "z", 90), ("d", 131, "x", "=", 90),                            # mate elsewhere
        ("e", 67, "x", "=", 90), ("e", 131, "x", "=", 30),                            # second below the cutoff
        ("f", 71, "x", "=", 90), ("f", 131, "x", "=", 90),                            # unmapped bit
        ("g", 67, "*", "=", 90), ("g", 131, "*", "=", 90),                            # no place
        ("z", 67, "y", "=", 90), ("z", 131, "y", "=", 90),                            # last group counts too
    ]
    assert picked(al.top_pair(frame(spark, rows), 40)) == [0, 1, 14, 15]


def test_top_pair_or_single(spark):
    rows = [
        ("a", 67, "x", "=", 90), ("a", 131, "x", "=", 80),
        ("b", 67, "x", "=", 90), ("b", 131, "y", "=", 90),
        ("c", 131, "x", "=", 90),
        ("d", 65, "x", "=", 90),    # paired, not proper
        ("e", 0, "x", "=", 90),     # single end: neither first nor second
        ("f", 67, "x", "=", None),  # no score
    ]
    df = frame(spark, rows)
    assert picked(al.top_pair_or_single(df, 40)) == [0, 1, 4]
    assert picked(al.top_pair_or_single(df, 40, proper=False)) == [0, 1, 2, 4, 5]
    assert sorted(r[0] for r in al.kept_read_ids(df, 40).collect()) == ["a", "c"]


def test_top_scored(spark):
    rows = [
        # paired: x concordant 40 + 40 = 80 beats y's single 78
        ("a", 67, "x", "=", 40), ("a", 131, "x", "=", 40), ("a", 67, "y", "=", 78),
        # single end: both tied rows on one reference stay
        ("b", 0, "x", "*", 90), ("b", 0, "x", "*", 90), ("b", 0, "y", "*", 50),
        # tie of the mates of a discordant couple: the second counts
        ("c", 67, "x", "o", 60), ("c", 131, "x", "o", 60),
        # the second mate's reference flag decides
        ("d", 67, "x", "=", 60), ("d", 131, "x", "o", 50),
        # first of equal scores wins
        ("e", 67, "x", "=", 70), ("e", 67, "x", "=", 70),
        # the last row says paired although an earlier one is single-end
        ("f", 0, "x", "*", 90), ("f", 67, "y", "=", 95),
    ]
    assert picked(al.top_scored(frame(spark, rows), 40)) == [0, 1, 3, 4, 7, 8, 10, 13]


def brute_top_scored(rows, cutoff):
    out, groups = [], {}
    for i, (read, flag, ref, mate, score) in enumerate(rows):
        if ref != "*" and score is not None and score >= cutoff:
            groups.setdefault(read, []).append((i, flag, ref, mate, score))
    for g in groups.values():
        second = [r for r in g if r[1] & 1 and r[1] & 128]
        first = [r for r in g if not (r[1] & 1 and r[1] & 128)]
        if not g[-1][1] & 1:
            best = max(r[4] for r in first)
            out += [r[0] for r in first if r[4] == best]
            continue
        refs = {}
        for ref in {r[2] for r in g}:
            a = max((r for r in first if r[2] == ref), key=lambda r: r[4], default=None)
            b = max((r for r in second if r[2] == ref), key=lambda r: r[4], default=None)
            s1, s2 = (a[4] if a else 0), (b[4] if b else 0)
            if (b or a)[3] == "=" and s1 > 0 and s2 > 0:
                refs[ref] = (s1 + s2, [a, b])
            else:
                refs[ref] = (s1, [a]) if s1 > s2 else (s2, [b])
        top = max(s for s, _ in refs.values())
        out += [r[0] for s, chosen in refs.values() if s == top for r in chosen]
    return sorted(out)


def random_rows(n=3000, reads=300, hot=0.33, seed=5):
    rng = random.Random(seed)
    return [("r0" if rng.random() < hot else f"r{rng.randrange(reads)}", rng.choice([0, 65, 67, 67, 129, 131, 131]),
             rng.choice(["x", "y", "z", "*"]), rng.choice(["=", "="," o"]), rng.choice([20, 40, 60, 60, 80]))
            for _ in range(n)]


def test_top_scored_random(spark):
    rows = random_rows()
    assert picked(al.top_scored(frame(spark, rows), 40)) == brute_top_scored(rows, 40)


def test_drop_host_groups(spark):
    rows = [("a", 67, "x", "=", 90), ("a", 131, "x", "=", 20), ("b", 67, "x", "=", 50), ("b", 131, "*", "=", 10),
            ("c", 0, "x", "=", 99), ("c", 67, "x", "=", 10)]
    assert picked(al.drop_host_groups(frame(spark, rows), 75)) == [2, 3, 5]


def test_drop_host_groups_hot_read(spark):
    rows = random_rows(seed=6)
    bad = {r[0] for r in rows if r[1] & 1 and r[4] >= 80}
    expected = [i for i, r in enumerate(rows) if r[1] & 1 and r[0] not in bad]
    assert picked(al.drop_host_groups(frame(spark, rows), 80)) == expected


@pytest.mark.parametrize("partitions", [1, 8, 64])
def test_fractional_counts_are_exact(spark, partitions):
    rows = random_rows(seed=7)
    df = frame(spark, rows).repartition(partitions)
    got = {r["ref_id"]: r["reads"] for r in al.fractional_counts(df).collect()}
    count, expected, mapped = {}, {}, 0
    for read, flag, ref, _, _ in rows:
        if flag & 1 and flag & 2 and ref != "*":
            count.setdefault(read, {}).setdefault(ref, 0)
            count[read][ref] += 1
    for c in count.values():
        top = [t for t, n in c.items() if n == max(c.values())]
        mapped += 1
        for t in top:
            expected[t] = expected.get(t, 0) + 1 / len(top)
    assert got == pytest.approx(expected, abs=1e-9)
    assert sum(got.values()) == pytest.approx(mapped, abs=1e-9)


def test_reference_abundance(spark):
    counts = spark.createDataFrame([("x", 10.0), ("y", 30.0), ("z", 0.0001)], "ref_id string, reads double")
    ref = spark.createDataFrame([("x", 1000, "X"), ("y", 3000, "Y"), ("z", 3000, "Z")],
                                "ref_id string, length long, descr string")
    covered = spark.createDataFrame([("x", 333)], "ref_id string, covered_bp long")
    rows = al.reference_abundance(counts, ref, covered=covered).collect()
    assert [r["ref_id"] for r in rows] == ["x", "y"]
    assert [r["depth"] for r in rows] == [3.0, 3.0]
    assert [r["fraction"] for r in rows] == [0.333, 0.0]


def test_contig_depth(spark):
    aln = spark.createDataFrame([("c1",), ("c1",), ("*",), ("c3",)], "ref_id string")
    contigs = spark.createDataFrame([("c1", 100), ("c2", 50), ("c3", 0)], "contig string, length int")
    got = {r["contig"]: r["depth"] for r in al.contig_depth(aln, contigs).collect()}
    assert got == {"c1": 3.0, "c2": 1.0, "c3": 1.0}


def test_by_sample_equals_one_sample_at_a_time(spark):
    rows = random_rows(seed=8)
    df = frame(spark, rows).withColumn("sample_id", F.concat(F.lit("s"), F.col("ord") % 3))
    together = {(r["sample_id"], r["ref_id"]): r["reads"]
                for r in al.fractional_counts(df, by=["sample_id"]).collect()}
    for s in ("s0", "s1", "s2"):
        alone = {(s, r["ref_id"]): r["reads"]
                 for r in al.fractional_counts(df.where(F.col("sample_id") == s)).collect()}
        assert alone == {k: x for k, x in together.items() if k[0] == s}
