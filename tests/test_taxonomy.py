"""Lineages, rank tables, abundance and evenness on hand-made taxonomies."""

import pytest
from pyspark.sql import functions as F

from seqtally.operators import taxonomy as tx
from seqtally.plans.profiles import classifier_profile

TREE = [(1, 1, "norank", "root"), (131567, 1, "norank", "cellular"), (2, 131567, "superkingdom", "Bacteria"),
        (1224, 2, "phylum", "Proteobacteria"), (1236, 1224, "class", "Gammaproteobacteria"),
        (91347, 1236, "order", "Enterobacterales"), (543, 91347, "family", "Enterobacteriaceae"),
        (561, 543, "genus", "Escherichia"), (562, 561, "species", "Escherichia coli"),
        (511145, 562, "strain", "K-12"), (10239, 1, "superkingdom", "Viruses"), (35325, 10239, "norank", "dsRNA viruses"),
        (1299296, 35325, "family", "Quadriviridae"), (1299297, 1299296, "genus", "Quadrivirus"),
        (1000373, 1299297, "species", "Rosellinia virus")]


@pytest.fixture
def nodes(spark):
    return spark.createDataFrame(TREE, "taxid long, parent long, rank string, name string")


def leaves(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "taxid long")


def test_lineage(spark, nodes):
    rows = {r["taxid"]: r for r in tx.lineage(nodes, leaves(spark, 511145, 1000373, 1224, 999), nodes).collect()}
    k12, virus = rows[511145], rows[1000373]
    assert [k12[f"{r}_ti"] for r in tx.RANKS] == [2, None, 1224, 1236, 91347, 543, 561, 562, 511145]
    assert [virus[f"{r}_ti"] for r in tx.RANKS] == [10239, None, 35325, None, None, 1299296, 1299297, 1000373, 1000373]
    assert virus["phylum"] == "dsRNA viruses" and k12["toprank"] == "K-12"
    assert [rows[1224][f"{r}_ti"] for r in tx.RANKS] == [2, None, 1224, None, None, None, None, None, 1224]
    assert [rows[999][f"{r}_ti"] for r in tx.RANKS] == [None] * 8 + [999]


def test_lineage_of_a_deep_tree_and_a_cycle(spark):
    deep = [(2, 1, "superkingdom", "B")] + [(i, i - 1, "norank", f"n{i}") for i in range(3, 40)]
    nodes = spark.createDataFrame(deep, "taxid long, parent long, rank string, name string")
    assert tx.lineage_ids(nodes, leaves(spark, 39)).collect()[0]["superkingdom_ti"] == 2
    loop = spark.createDataFrame([(5, 6, "x", "a"), (6, 5, "x", "b")], "taxid long, parent long, rank string, name string")
    with pytest.raises(ValueError):
        tx.lineage_ids(loop, leaves(spark, 5))


def test_rank_table(spark, nodes):
    table = tx.rank_table(tx.lineage(nodes, leaves(spark, 511145, 1000373), nodes), nodes)
    rows = {(r["rank"], r["taxid"]): r for r in table.collect()}
    assert (("kingdom", -2) in rows) and (("kingdom", -10239) in rows)
    assert rows[("class", -35325)]["name"] == "Unnamed class in dsRNA viruses phylum"
    unnamed = rows[("class", -35325)]
    assert [unnamed[f"{r}_ti"] for r in tx.RANKS] == [10239, None, 35325] + [None] * 6
    species = rows[("species", 1000373)]
    assert species["toprank_ti"] == 1000373 and rows[("species", 562)]["toprank_ti"] is None
    assert len(rows) == 18


def lineage_rows(spark):
    def row(taxid, sk, phylum, genus, species):
        ids = {"superkingdom": sk, "phylum": phylum, "genus": genus, "species": species, "toprank": taxid}
        return (taxid, *[x for r in tx.RANKS for x in (f"{r}{ids.get(r)}" if ids.get(r) else None, ids.get(r))])
    schema = "taxid long, " + ", ".join(f"{r} string, {r}_ti long" for r in tx.RANKS)
    return spark.createDataFrame([row(11, 2, 100, 200, 301), row(12, 2, 100, None, 301), row(13, 2, 101, 201, 302),
                                  row(21, 10239, 110, None, 310)], schema)


def test_abundance_and_rollup(spark):
    counts = spark.createDataFrame([(11, 10.0), (12, 5.0), (13, 5.0), (21, 20.0)], "taxid long, reads double")
    lengths = spark.createDataFrame([(11, 1000), (12, 1000), (13, 500), (21, 50)], "taxid long, length long")
    lineage = lineage_rows(spark)
    abundance = tx.taxon_abundance(counts, lengths, lineage)
    got = {r["taxid"]: r["abundance"] for r in abundance.collect()}
    assert got == pytest.approx({11: 0.2, 12: 0.1, 13: 0.2, 21: 0.5})
    rows = tx.rank_rollup_all(abundance, lineage).collect()
    for rank in tx.PROFILE_RANKS:
        assert sum(r["abundance"] for r in rows if r["rank"] == rank) == pytest.approx(1)
    genus = {r["rank_taxid"]: r for r in rows if r["rank"] == "genus"}
    assert set(genus) == {200, 301, 201, 310}  # a missing genus falls to the species
    assert genus[301]["genus"] is None and genus[301]["species"] is None and genus[200]["genus"] == "genus200"
    ordered = [r["abundance"] for r in rows if r["rank"] == "species"]
    assert ordered == sorted(ordered, reverse=True)


def test_superkingdom_reads(spark):
    counts = spark.createDataFrame([(11, 1 / 3), (12, 1 / 3), (13, 1 / 3), (21, 2.9)], "taxid long, reads double")
    rows = tx.superkingdom_reads(counts, lineage_rows(spark), total=10).collect()
    assert [(r["taxid"], r["reads"]) for r in rows] == [(2, 1), (2157, 0), (2759, 0), (10239, 2), (-1, 6)]
    assert len(tx.superkingdom_reads(counts, lineage_rows(spark), total=3).collect()) == 4


def test_profile_drops_uneven_taxa(spark):
    acc = spark.createDataFrame([("a1", 11, 1000), ("b1", 12, 50), ("b2", 12, 9_999_950), ("c1", 21, 1000)],
                                "acc string, taxid long, length long")
    rows = [(f"r{i}", "a1", 11, 100, 150) for i in range(20)] + [(f"s{i}", "b1", 12, 100, 150) for i in range(4000)]
    rows += [("r0", "b1", 12, 100, 150), ("short", "c1", 21, 59, 150), ("out", "c1", 21, 60, 150), ("none", "x", 0, 100, 150)]
    cls = (spark.createDataFrame(rows, "read_id string, seq_id string, taxid long, hit_len int, query_len int")
           .withColumn("ord", F.monotonically_increasing_id()))
    out = classifier_profile(cls, acc, lineage_rows(spark), exclude="21", total=5000)
    assert [r["taxid"] for r in out["failed"].collect()] == [12]
    counts = {r["taxid"]: r["reads"] for r in out["counts"].collect()}
    assert counts == pytest.approx({11: 19.5, 12: 4000.5})
    reads = {r["taxid"]: r["reads"] for r in out["superkingdoms"].collect()}
    assert reads[2] == 19 and reads[-1] == 5000 - 4020  # mapped reads are counted before the filter
    mapped = {r["read_id"]: r["taxids"] for r in tx.mapped_reads(out["usable"], out["failed"]).collect()}
    assert len(mapped) == 20 and set(mapped.values()) == {"11"}


def test_exclude_taxa(spark):
    df = leaves(spark, 1, 2, 3, 4)
    listed = spark.createDataFrame([("2",), ("x3",)], "taxid string")
    assert sorted(r[0] for r in tx.exclude_taxa(df, listed, "4,junk").collect()) == [1, 3]
