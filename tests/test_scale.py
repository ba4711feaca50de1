"""Properties that matter on a cluster: hot keys are split, results do not depend on partitions, plans stay lean."""

import os

import pytest
from pyspark.sql import functions as F

from seqtally.catalog.registry import Inputs
from seqtally.operators import alignments as al
from seqtally.operators.common import checked_broadcast, keep_or_drop, spread_join
from seqtally.session import cut_lineage, shared_folder

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_spread_join_splits_a_hot_key(spark):
    rows = spark.range(4000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    lookup = spark.createDataFrame([(7, "hot"), (8, "x")], "k long, v string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = spread_join(rows, lookup, ["k"], small=0)
        assert joined.count() == joined.select("id").distinct().count() == 1336  # a third, and ids 7 and 8
        tasks = joined.where("k = 7").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
        assert len(tasks) >= 4 and max(r["count"] for r in tasks) < 700
        left = spread_join(rows, lookup, ["k"], "left", small=0)
        assert left.count() == 4000 and left.where("v is not null").count() == 1336
        kept, dropped = (keep_or_drop(rows, lookup, ["k"], h, small=0).count() for h in ("left_semi", "left_anti"))
        assert kept == 1336 and kept + dropped == 4000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_checked_broadcast(spark):
    big, small = spark.range(1000), spark.range(10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(big.join(checked_broadcast(small), "id"))
        assert "BroadcastHashJoin" not in plan(big.join(checked_broadcast(small, max_bytes=9), "id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_cut_lineage_writes_to_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    df = cut_lineage(spark.range(10).select("id", F.array(F.lit("a")).alias("x"), F.struct(F.col("id").alias("y")).alias("s")))
    assert named in shared_folder(spark)
    assert all(named in f for f in df.inputFiles())
    assert sorted(r["id"] for r in df.collect()) == list(range(10)) and df.first()["x"] == ["a"]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
def test_counting_reads_once_and_combines_before_the_shuffle(spark):
    v = Inputs(spark, FOLDER)
    text = plan(al.fractional_counts(v.aln))
    assert text.count("FileScan") == 1
    before = text[text.rindex("Exchange"):]
    assert "HashAggregate" in before and "Window" not in before
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
@pytest.mark.parametrize("name", ["reference_abundance", "taxon_abundance", "ko_abundance", "family_abundance"])
def test_totals_are_not_cross_joins(spark, name):
    from __spark_entry__ import queries
    text = plan(queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
def test_result_does_not_depend_on_partitions(spark):
    v = Inputs(spark, FOLDER)
    results = []
    for n in (1, 8, 64):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        aln = v.aln.repartition(n)
        rows = al.reference_abundance(al.fractional_counts(aln), v.ref).collect()
        results.append([tuple(r) for r in rows])
        picked = al.top_scored(aln, 40).select(F.sum(F.xxhash64("read_id", "ref_id", "pos", "score").cast("decimal(38,0)"))).first()
        results[-1].append(tuple(picked))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1] == results[2]
