"""What steps leave on disk, and what they hold at once."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import seqtally.llm.jaccard_join as jj
from seqtally.session import cut_lineage, discard, shared_folder
from tests.llm.conftest import words
from tests.llm.test_jaccard_join import by_hand, edited, found


def files(spark):
    """Shuffle files of the (local) executor."""
    manager = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    return {x for x in manager.getAllFiles().mkString(" ").split() if "/shuffle_" in x}


def test_a_written_table_leaves_no_shuffle(spark):
    before = files(spark)
    table = cut_lineage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().repartition(3, "k"))
    assert not files(spark) - before and table.count() == 7
    discard(table)
    folder = spark._jvm.org.apache.hadoop.fs.Path(table._cut_path)
    assert not folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(folder)


@pytest.mark.parametrize("width", [3, 60, 64, 65, 700, 5000])
def test_sketches_allow_every_link(width):
    rng = np.random.default_rng(width)
    for _ in range(40):
        base = np.unique(rng.integers(0, 1 << 64, width, dtype=np.uint64))
        p = base[rng.random(len(base)) > 0.1]
        q = np.unique(np.concatenate([base[rng.random(len(base)) > 0.1],
                                      rng.integers(0, 1 << 64, width // 12, dtype=np.uint64)]))
        common = len(np.intersect1d(p, q))
        link = 5 * common >= 4 * (len(p) + len(q) - common)
        assert jj.may_link(jj.sketch(p), jj.sketch(q), len(p) + len(q)) >= link
        far = rng.integers(0, 1 << 64, width, dtype=np.uint64)
        assert width < 60 or not jj.may_link(jj.sketch(base), jj.sketch(far), 2 * width)


def test_sets_are_made_again_for_possible_pairs_alone(spark, docs_of, monkeypatch):
    made, real = [], jj._sets_of

    def counting(*args):
        sets = real(*args)
        made.append(sets.count())
        return sets

    monkeypatch.setattr(jj, "_sets_of", counting)
    rows = [(i, edited(words(7, 400), i, 24)) for i in range(40)]  # meet in many regions, at a similarity of a third
    rows += [(100 + i, edited(words(8, 400), i, 3)) for i in range(3)]
    assert found(docs_of([(i, t, "en", "a") for i, t in rows])) == by_hand(rows)
    assert sum(made) <= 6  # the three alike, twice at most


def test_sets_are_not_left_on_disk(spark, docs_of):
    folder = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    system = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    tables = lambda: {x.getPath().toString() for x in system.listStatus(folder)}
    before, pick = tables(), random.Random(5)
    rows = [(i, edited(words(9, 200), i, 1 + pick.randrange(3))) for i in range(12)]
    assert found(docs_of([(i, t, "en", "a") for i, t in rows])) == by_hand(rows)
    for path in tables() - before:
        assert not {"shingles", "region"} & set(spark.read.parquet(path).columns)


def test_the_pipeline_keeps_the_last_stage_alone(spark, tmp_path, monkeypatch):
    spark.range(50).withColumn("text", F.lit("a b c")).write.parquet(f"{tmp_path}/documents.parquet")
    seen = []

    def stage(s, docs, sf_dir):
        seen.append(docs)
        return docs.withColumn("id", F.col("id") + 1).repartition(2, "id")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("one", stage), ("two", stage), ("three", stage)])
    done = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(r.id for r in done.collect()) == list(range(3, 53)) and spark.read.parquet(f"{tmp_path}/documents.parquet").count() == 50
    for docs in seen[1:]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(docs._cut_path)
        assert not folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(folder)
