import os
import zlib

import numpy as np
import pytest

from seqtally.llm.common import read
from seqtally.llm import language_id
from seqtally.llm.language_id import (UNDETERMINED, Model, Predictor, codes_of, expected_counts, identify, pieces_of,
                                      table_of, word_scores, words_of, VOCABULARY)

FOLDER = "/root/testdata/sf0.01"


def sum_over_segmentations(word, chance, longest):
    if not word:
        return 1.0
    return sum(chance(word[:n]) * sum_over_segmentations(word[n:], chance, longest)
               for n in range(1, min(longest, len(word)) + 1))


def known_pieces():
    import public_tokenizers
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(VOCABULARY))
    return {m.id_to_piece(i).lower() for i in range(m.get_piece_size())}


def test_forward_pass_sums_all_segmentations():
    pieces = pieces_of(VOCABULARY)
    rng = np.random.default_rng(1)
    table = table_of(rng.random((pieces.size, 2)) / 50)
    texts = known_pieces()

    def number(piece):
        spans = pieces.spans(codes_of([piece], len(piece)))
        return int(spans[0, len(piece)][0]) if (0, len(piece)) in spans else pieces.size

    words = ["the", "über", "x一y", "zzq"]
    got = word_scores(words, table, pieces)
    for w, row in zip(words, got):
        for lang in range(2):
            total = sum_over_segmentations("▁" + w, lambda p: table[number(p), lang], pieces.longest)
            assert np.isclose(np.exp(row[lang]), total)
    for p in ("▁the", "ing", "qqqq", "e"):
        assert (number(p) < pieces.size) == (p in texts)


def test_long_runs_are_summed_whole(spark):
    pieces = pieces_of(VOCABULARY)
    rng = np.random.default_rng(2)
    probabilities = rng.random((pieces.size, 2)) / 50
    table = table_of(probabilities)
    words = ["theinformationbetweenthelanguagesisgermanerziehung" * k for k in (1, 3, 40)] + ["x一y" * 30, "the"]

    def log_sum(word, lang):  # over all segmentations, in logarithms
        spans, best = pieces.spans(codes_of(["▁" + word], len(word) + 1)), [0.0]
        for e in range(1, len(word) + 2):
            parts = [best[b] + np.log(table[spans[b, e][0], lang]) for b in range(e)
                     if (b, e) in spans and table[spans[b, e][0], lang] > 0]
            best.append(np.logaddexp.reduce(parts))
        return best[-1]

    expected = np.array([[log_sum(w, lang) for lang in range(2)] for w in words])
    assert np.allclose(word_scores(words, table, pieces), expected)
    for i, w in enumerate(words):
        [lang], [score] = Predictor(spark, Model(["a", "b"], probabilities, VOCABULARY))([w])
        assert lang == "ab"[expected[i].argmax()]
        assert np.isclose(score, 1 / np.exp(expected[i] - expected[i].max()).sum())


def test_expected_counts_of_long_runs(monkeypatch):
    pieces = pieces_of(VOCABULARY)
    table = table_of(np.random.default_rng(3).random((pieces.size, 2)) / 50)
    words = ["theinformationbetweenthelanguages", "informationbetweenthelanguagesthe", "the", "x一y" * 12]
    langs, counts = np.array([0, 1, 1, 0]), np.array([2.0, 1.0, 3.0, 5.0])
    got = expected_counts(words, langs, counts, table, pieces)
    monkeypatch.setattr(language_id, "LONGEST", 99)  # every span of a run at once
    assert np.allclose(got, expected_counts(words, langs, counts, table, pieces))


def test_expected_counts_fit_the_words():
    pieces = pieces_of(VOCABULARY)
    table = table_of(np.full((pieces.size, 1), 1.0 / pieces.size))
    counts = expected_counts(["the"], np.array([0]), np.array([3.0]), table, pieces)
    lengths = np.array([p for p in range(pieces.size) if counts[p, 0] > 0])
    assert 3.0 <= counts.sum() <= 12.0 and len(lengths) > 1


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
def test_held_out_accuracy(spark):
    docs = read(spark, FOLDER, "documents")
    truth = {r.doc_id: (r.lang, r.text) for r in docs.collect()}
    found = identify(docs).collect()
    assert len(found) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    tested = [r for r in found if r.held_out and truth[r.doc_id][0] is not None]
    right = sum(r.lang_pred == truth[r.doc_id][0] for r in tested)
    assert right >= 0.97 * len(tested)
    assert all(0 <= r.score <= 1 for r in found)


def test_odd_rows(odd_docs):
    found = identify(odd_docs, sample=5, rounds=1).collect()
    texts = sorted((str(r.doc_id), r.text) for r in odd_docs.collect() if r.text)
    assert len(found) == odd_docs.count()
    for r in found:
        mine = [t for i, t in texts if i == str(r.doc_id)]
        if r.doc_id in (1, 2, 3, 9):
            assert (r.lang_pred, r.score) == (UNDETERMINED, 0.0)
        elif r.doc_id is not None and mine:
            assert r.lang_pred in ("de", "en")
    assert not any(r.held_out for r in found if r.doc_id is None)


def test_nothing_to_learn_from(spark, docs_of, no_docs):
    assert identify(no_docs).count() == 0
    found = identify(docs_of([(4, "some text", None, "a")])).collect()
    assert [(r.lang_pred, r.score) for r in found] == [(UNDETERMINED, 0.0)]


def test_words():
    assert words_of("It's 12 ÀB_c") == ["it", "s", "àb", "c"]
    assert words_of("½ ² 12 _!") == [] and words_of(None) == []
    assert words_of("a" * 50) == ["a" * 24, "a" * 24, "aa"]
