import os

import pytest

from tests.llm.conftest import words
from tests.oracle import compare, connect
from seqtally.llm import stages
from seqtally.llm.queries import QUERIES, SQL

corpus_pipeline = pytest.importorskip("corpus_pipeline")

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
def test_run(spark):
    out = corpus_pipeline.run(spark, FOLDER).collect()
    assert out and len({(r.doc_id, r.piece) for r in out}) == len(out)
    assert all(0 <= r.offset and r.offset + r.length <= 4096 for r in out)


def test_stages_keep_columns_and_clean_documents(spark, docs_of, no_docs):
    passage = words(1, 80)
    clean = {i: words(100 + i, 60) for i in range(10)}
    rows = [(i, t, "en" if i % 2 else "de", "a") for i, t in clean.items()]
    rows += [(20, clean[3], "en", "a"), (21, clean[4] + " more", "en", "a"), (22, "12 34", "en", "a"), (23, None, "en", "a"),
             (30, f"{words(7, 30)} {passage} {words(8, 30)}", "en", "a"), (31, f"{words(9, 30)} {passage} {words(10, 30)}", "en", "a")]
    docs, empty = docs_of(rows), no_docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, FOLDER))
        after = {r.doc_id: r.text for r in docs.collect()}
        assert docs.columns == no_docs.columns and set(after) <= set(before)
        if name == "language_id":
            assert set(before) - set(after) == {22, 23}
        elif name == "jaccard_join":
            assert set(before) - set(after) == {20, 21}
        elif name == "suffix_array_dedup":
            assert all(after[i] == t for i, t in clean.items())
            assert all(passage[5:-5] not in after[i] and len(after[i]) > 100 for i in (30, 31))
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        empty = corpus_pipeline.cut_lineage(stage(spark, empty, FOLDER))
        assert empty.columns == no_docs.columns and empty.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() >= docs.count()
    assert corpus_pipeline.STAGES[-1][1](spark, empty, FOLDER).count() == 0


def test_documents_that_lose_everything_go(docs_of):
    text = words(1, 80)
    out = stages.without_repeats(docs_of([(1, text, "en", "a"), (2, text, "en", "a"), (3, None, "en", "a"), (4, "", "en", "a")]))
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(3, None), (4, "")]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
@pytest.mark.parametrize("name", list(SQL))
def test_query_against_sql(spark, name):
    assert compare(QUERIES[name](spark, FOLDER), connect(FOLDER), SQL[name]) is None


def test_mixing_cuts_only_what_the_weights_ask_for(docs_of):
    rows = [(i, words(i, 20), "en", "s1") for i in range(60)] + [(100 + i, words(i, 20), "de", "s1") for i in range(10)]
    rows += [(200 + i, words(i, 20), "fr", "s1") for i in range(40)] + [(300 + i, words(i, 20), "la", "s1") for i in range(5)]
    rows += [(400, words(1, 20), None, "s1"), (401, None, None, None), (402, words(2, 9), "en", "s2"), (None, words(3, 5), "la", None)]
    docs = docs_of(rows)
    kept = stages.weighted(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids))
    count = lambda lo, hi: sum(i is not None and lo <= i < hi for i in ids)
    # en 4, de 2, fr 2: all of de, which is the scarcest, twice as much en, as much fr; others have no target.
    assert count(100, 110) == 10 and count(0, 60) in (20, 21) and count(200, 240) in (10, 11)
    assert count(300, 305) == 5 and {400, 401, 402, None} <= set(ids)


def test_stages_keep_repeated_odd_and_clashing_rows(spark, odd_docs):
    docs = odd_docs.withColumnRenamed("_key", "_was_null").withColumnRenamed("_id", "_row").withColumnRenamed("n", "_kept")
    before = docs.collect()
    assert len({r._was_null for r in before}) == 1
    out = stages.without_repeats(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert all((r._was_null, r._row, r._kept) == ("k", 1, "n") for r in rows)
    assert sorted(str(r.doc_id) for r in rows if r.text is None) == sorted(str(r.doc_id) for r in before if r.text is None)
    for stage in (stages.identified, stages.one_of_each_group, stages.weighted):
        done = stage(docs)
        assert done.columns == docs.columns and done.count() <= len(before)
    assert stages.one_of_each_group(docs).where("doc_id is null").count() == sum(r.doc_id is None for r in before)
    assert stages.packed(docs).where("piece = 0").count() == len(before)
