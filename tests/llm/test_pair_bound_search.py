import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from seqtally.llm.pair_bound_search import Index, best_in_segment, chain_bounds, ranked_search, relative_lengths, terms_of, weight

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def by_hand(docs, items, k):
    held = [(d, Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in docs]
    sizes = [sum(c.values()) for _, c in held]
    n_docs, n_terms = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for (d, counts), n in zip(held, sizes):
            m = 100 - 25 + (25 * n * n_docs) // n_terms if n_terms else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * counts[t]) // (1000 * counts[t] + 12 * m))
                        for t in TERM.findall((text or "").translate(LOWER)) if counts[t])
            if score > 0:
                scores.append((-score, d is not None, d or 0))
        out += [(item, rank, d if there else None, -s) for rank, (s, there, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def corpus(seed, n):
    pick = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    return [(i, " ".join(pick.choices(words, weights, k=pick.choice([1, 5, 30, 80])))) for i in range(n)]


def table(spark, rows, name):
    return spark.createDataFrame([(i, t, 1, "q", 0.5) for i, t in rows],
                                 f"{name} long, text string, query int, rank string, score double").repartition(4)


@pytest.mark.parametrize("seed, segment_docs, probe", [(1, 4096, 8), (2, 16, 1), (3, 7, 2)])
def test_equals_brute_force(spark, seed, segment_docs, probe):
    docs, items = corpus(seed, 400), corpus(seed + 50, 12)
    found = ranked_search(table(spark, docs, "doc_id"), table(spark, items, "item_id"), segment_docs=segment_docs, probe=probe)
    assert sorted(map(tuple, found.collect()), key=str) == by_hand(docs, items, 20)


def test_blocks_of_the_query_set_change_nothing(spark):
    docs, items = corpus(5, 100), corpus(6, 9)
    found = ranked_search(table(spark, docs, "doc_id"), table(spark, items, "item_id"), block_terms=40, k=3)
    assert sorted(map(tuple, found.collect()), key=str) == by_hand(docs, items, 3)


def test_odd_rows(odd_docs, no_docs, spark):
    items = [(1, "one two"), (1, "ONE é-Ünïcode 12"), (2, None), (3, ""), (None, "two 𝛼 𝛼"), (4, "nowhere"), (5, "a b c dd ee")]
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    found = ranked_search(odd_docs, table(spark, items, "item_id"))
    assert sorted(map(tuple, found.collect()), key=str) == by_hand(docs, items, 20)
    assert ranked_search(no_docs, table(spark, items, "item_id")).count() == 0
    assert ranked_search(odd_docs, table(spark, [], "item_id")).count() == 0


def test_terms():
    text = "The K\u212aelvin, it's 3-fold_a\u00c9\n\x00end@"
    assert [t.decode() for t in terms_of(text.encode())] == TERM.findall(text.translate(LOWER))
    assert weight(10, 10) == math.floor(1000 * math.log(22 / 21))


def segment(n_docs, postings, pairs):
    """postings: term -> {doc: impact}; one block of documents."""
    terms = sorted(postings)
    docs = np.concatenate([np.array(sorted(postings[t]), np.int32) for t in terms])
    impacts = np.concatenate([np.array([postings[t][d] for d in sorted(postings[t])], np.int64) for t in terms])
    starts = np.cumsum([0, *(len(postings[t]) for t in terms)])
    joint = [[max([postings[a][d] + postings[b][d] for d in postings[a] if d in postings[b]], default=0)] for a, b in pairs]
    return Index(n_docs, np.array(terms), starts, docs, impacts, np.array([[max(postings[t].values())] for t in terms]),
                 np.array(joint).reshape(-1, 1))


def test_pairs_that_never_meet_at_their_best_tighten_the_bound():
    postings = {0: {d: 10 for d in range(0, 100, 2)}, 1: {d: 10 for d in range(1, 100, 2)}, 2: {7: 15}}
    chain = [(0, 1, -1), (1, 1, 0), (2, 1, 1)]
    index = segment(100, postings, [(0, 1), (1, 2)])
    assert chain_bounds(index, chain)[:, 0].tolist() == [0, 10, 10, 25]
    docs, scores, looked = best_in_segment(index, chain, 16)
    assert (docs.tolist(), scores.tolist()) == ([7], [25])
    without = segment(100, postings, [])
    plain = [(t, n, -1) for t, n, _ in chain]
    assert chain_bounds(without, plain)[:, 0].tolist() == [0, 10, 20, 35]
    more = best_in_segment(without, plain, 16)
    assert more[0].tolist() == [7] and looked < more[2]
    assert best_in_segment(index, chain, 26)[2] == 0  # the segment is passed over


@pytest.mark.parametrize("seed", range(30))
def test_bounds_hold_and_nothing_is_lost(seed):
    pick = np.random.default_rng(seed)
    postings = {t: {int(d): int(pick.integers(1, 50)) for d in pick.choice(60, pick.integers(1, 40), replace=False)} for t in range(6)}
    pairs = [(a, a + 1) for a in range(5)]
    chain = [(t, int(pick.integers(1, 4)), t - 1) for t in range(6)]
    index = segment(60, postings, pairs)
    bounds = chain_bounds(index, chain)[:, 0]
    total = np.zeros(60, np.int64)
    for i, (t, times, _) in enumerate(chain, 1):
        for d, x in postings[t].items():
            total[d] += times * x
        assert total.max() <= bounds[i]
    least = int(np.sort(total)[-5])
    docs, scores, _ = best_in_segment(index, chain, max(least, 1))
    assert dict(zip(docs.tolist(), scores.tolist())) == {d: int(s) for d, s in enumerate(total) if s >= max(least, 1)}


def test_lengths_beyond_64_bits():
    n = np.array([0, 7, 3 * 10 ** 9], np.int64)
    assert relative_lengths(n, 10 ** 10, 3 * 10 ** 12).tolist() == [25 * x * 10 ** 10 // (3 * 10 ** 12) for x in n.tolist()]
    assert relative_lengths(n[:2], 5, 9).tolist() == [0, 97] and relative_lengths(n[:0], 5, 0).tolist() == []
