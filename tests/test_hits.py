"""Non-overlapping hits against a plain loop, in the one-pass and in the multi-round way."""

import random

import pytest

from seqtally.operators import hits as ht

SCHEMA = "query string, subject string, pct_iden double, aln_len int, q_b int, q_e int, s_b int, s_e int, evalue double, ord long"


def overlap(b1, e1, b2, e2):
    return 0 if e2 < b1 or b2 > e1 else min(e1, e2) - max(b1, b2)


def brute(rows, frac=0.5):
    kept, out = {}, []
    for i, (query, b, e) in enumerate(rows):
        lo, hi = min(b, e), max(b, e)
        if any(overlap(lb, le, lo, hi) > (hi - lo + 1) * frac for lb, le in kept.get(query, [])):
            continue
        kept.setdefault(query, []).append((lo, hi))
        out.append(i)
    return out


def frame(spark, rows):
    return spark.createDataFrame([(q, f"s{i % 7}", 50.0, 10, b, e, 1, 10, 0.0, i) for i, (q, b, e) in enumerate(rows)],
                                 SCHEMA)


def random_hits(n, seed, queries=20, hot=0.4, length=2000):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        b = rng.randrange(1, length)
        size = int(rng.choice([3, 10, 40, 200, 900]) * rng.random()) + 1
        q = "hot" if rng.random() < hot else f"q{rng.randrange(queries)}"
        rows.append((q, b, b + size) if rng.random() < 0.5 else (q, b + size, b))
    return rows


def test_documented_rows(spark):
    rows = [("s", 1, 236), ("s", 1, 239), ("s", 2, 164)]
    assert brute(rows) == [0]
    got = ht.greedy_nonoverlap(frame(spark, rows), None).collect()
    assert [r["ord"] for r in got] == [0]


@pytest.mark.parametrize("frac", [0.5, 0.3, 0.8])
@pytest.mark.parametrize("limit", [20_000, 60])
def test_greedy_matches_the_loop(spark, frac, limit):
    rows = random_hits(1500, seed=int(frac * 10))
    df = ht.greedy_nonoverlap(frame(spark, rows).repartition(5), None, frac, normalize_strand=True, round_hits=limit,
                              spread=4)
    assert sorted(r["ord"] for r in df.collect()) == brute(rows, frac)


def test_evalue_and_order(spark):
    rows = spark.createDataFrame([("q", "a", 1.0, 5, 1, 50, 1, 5, 0.5, 0), ("q", "b", 1.0, 5, 1, 50, 1, 5, 1e-9, 1),
                                  ("q", "c", 1.0, 5, 2, 50, 1, 5, 1e-9, 2)], SCHEMA)
    assert [r["subject"] for r in ht.greedy_nonoverlap(rows).collect()] == ["b"]
    assert [r["subject"] for r in ht.top_hit(rows).collect()] == ["b"]


def test_blastx_to_orf(spark):
    df = spark.createDataFrame([
        ("sample01|scaffold|0", "p1", 86.61, 1792, 162960, 157636, 1, 1782, 0.0, 0),
        ("sample01|scaffold|0", "p2", 94.99, 499, 170594, 169098, 1, 496, 0.0, 1),
        ("sample01|scaffold|0", "p3", 90.0, 400, 170500, 169200, 1, 400, 0.0, 2)], SCHEMA)
    got = {r["query"]: (r["q_b"], r["q_e"]) for r in ht.blastx_to_orf(df).collect()}
    assert got == {"sample01|scaffold|0.162960.157636": (1, 1775), "sample01|scaffold|0.170594.169098": (1, 499)}


def test_family_abundance_and_classes(spark):
    hits = spark.createDataFrame([("q1", "f1", 1.0, 5, 1, 5, 1, 50, 0.0, 0), ("q2", "f1", 1.0, 5, 1, 5, 1, 50, 0.0, 0),
                                  ("q3", "f2", 1.0, 5, 1, 5, 1, 33, 0.0, 0)], SCHEMA)
    fam = spark.createDataFrame([("f1", 100, "one"), ("f2", 99, "two"), ("f3", 9, "three")],
                                "subject string, model_len int, descr string")
    depth = spark.createDataFrame([("q1", 2.5)], "query string, depth double")
    got = {r["subject"]: r for r in ht.family_abundance(hits, fam, depth).collect()}
    assert (got["f1"]["n_hits"], got["f1"]["coverage"], got["f1"]["abundance"]) == (3, 1.75, 0.84)
    assert (got["f2"]["n_hits"], got["f2"]["coverage"]) == (1, 0.333333)
    members = spark.createDataFrame([("JK", "f1"), ("J", "f2"), ("J", "f3"), ("J", "f3")], "letters string, family string")
    names = spark.createDataFrame([("K", "kay", 0), ("J", "jay", 1), ("Z", "zed", 2)], "class string, descr string, ord int")
    abundance = ht.family_abundance(hits, fam).withColumnRenamed("subject", "family")
    rows = ht.class_rollup(abundance, members, names).collect()
    assert [(r["class"], r["n_families"], r["coverage"]) for r in rows] == [("K", 1, 1.0), ("J", 3, 0.666666)]


def test_class_rollup_by_sample(spark):
    abundance = spark.createDataFrame([("s1", "f1", 0.5), ("s1", "f2", 0.5), ("s2", "f1", 1.0)],
                                      "sample_id string, family string, abundance double")
    members = spark.createDataFrame([("J", "f1"), ("K", "f2")], "letters string, family string")
    names = spark.createDataFrame([("J", "jay", 0), ("K", "kay", 1)], "class string, descr string, ord int")
    rows = ht.class_rollup(abundance, members, names, by=["sample_id"]).collect()
    assert [(r["sample_id"], r["class"], r["abundance"]) for r in rows] == [
        ("s1", "J", 0.5), ("s1", "K", 0.5), ("s2", "J", 1.0), ("s2", "K", 0.0)]
