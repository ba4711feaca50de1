import hashlib
import random
import zlib

import numpy as np
import pytest

from seqtally.llm.periodic_runs import COVER, MODULUS, Extensions, collapsed, grid_pairs, periodic_runs, runs_digest, runs_of


def brute(words, least=12):
    found = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(least, 2 * p):
                found.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted((b, e - b, p) for (b, e), p in found.items())


def left(words, runs):
    gone = {i for b, n, p in runs for i in range(b + p, b + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def some_texts(seed):
    pick = random.Random(seed)
    texts = []
    for _ in range(pick.randint(1, 12)):
        n, letters = pick.randint(0, pick.choice([20, 60, 250])), pick.choice([1, 2, 3, 9])
        words = [pick.randrange(letters) for _ in range(n)]
        if n and pick.random() < 0.6:
            a = pick.randrange(n)
            p = pick.randint(1, max(1, (n - a) // 2))
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        texts.append(words)
    return texts


def test_cover_has_all_differences():
    assert {(a - b) % MODULUS for a in COVER for b in COVER} == set(range(MODULUS))


@pytest.mark.parametrize("seed", range(60))
def test_runs_equal_brute_force(seed):
    texts = some_texts(seed)
    found = runs_of([np.array(t, dtype=np.int64) for t in texts])
    assert [[tuple(r) for r in f.tolist()] for f in found] == [brute(t) for t in texts]


@pytest.mark.parametrize("least", [12, 17, 30])
def test_other_least_lengths(least):
    texts = some_texts(99) + some_texts(98)
    found = runs_of([np.array(t, dtype=np.int64) for t in texts], least)
    assert [[tuple(r) for r in f.tolist()] for f in found] == [brute(t, least) for t in texts]


@pytest.mark.parametrize("seed", range(20))
def test_extensions_equal_brute_force(seed):
    texts = [t for t in some_texts(seed) if t] or [[0, 0, 0]]
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    word = np.concatenate([np.array(t, dtype=np.int64) for t in texts])
    pick = np.random.default_rng(seed)
    i, j = pick.integers(0, len(word), (2, 400))
    i, j = i[i != j], j[i != j]

    def common(a, b):
        k = 0
        while max(a, b) + k < len(word) and word[a + k] == word[b + k] and text[a + k] == text[b + k]:
            k += 1
        return k
    assert Extensions(text, word).of(i, j).tolist() == [common(a, b) for a, b in zip(i.tolist(), j.tolist())]


def test_grid_in_small_pieces_is_the_same():
    letters, sizes = np.tile(np.arange(7), 40), np.array([280])
    whole = sorted(p for a, b in grid_pairs(letters, sizes, 12) for p in zip(a.tolist(), b.tolist()))
    pieces = sorted(p for a, b in grid_pairs(letters, sizes, 12, most=10) for p in zip(a.tolist(), b.tolist()))
    assert whole == pieces and whole


def test_runs_grow_in_proportion_to_n_log_n():
    points = [sum(len(a) for a, _ in grid_pairs(np.zeros(n, np.int64), np.array([n]), 12)) for n in (10_000, 40_000)]
    assert points[1] < 5 * points[0]


def test_odd_rows(odd_docs, no_docs, spark):
    rows = {}
    for r in periodic_runs(odd_docs).collect():
        rows.setdefault(r.doc_id, []).append(r)
    for r in odd_docs.collect():
        words = (r.text or "").split()
        runs = brute(words) if len(words) < 3000 else []
        assert any([tuple(x) for x in f.runs] == runs and f.collapsed == left(words, runs) for f in rows[r.doc_id])
    assert sum(map(len, rows.values())) == odd_docs.count()
    assert periodic_runs(no_docs).count() == 0 and runs_digest(no_docs).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(odd_docs, min_length=5)


def test_digest_of_planted_periods(docs_of):
    pick = random.Random(4)
    rows = [(i, " \n".join(pick.choice("abcdefgh") for _ in range(pick.randint(0, 90))), None, None) for i in range(-40, 160)]
    rows += [(500 + i, "x y " * 40 + "z", None, None) for i in range(5)]
    found = {r.doc_id: r for r in runs_digest(docs_of(rows)).collect()}
    planted = 0
    for key, text, *_ in rows:
        w = text.split()
        n, h = len(w), zlib.crc32(str(key).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            planted += 1
        runs, r = brute(w), found[key]
        assert r.n_runs == len(runs)
        if runs:
            b, size, p = min(runs, key=lambda v: (-v[1], v[0], v[2]))
            assert (r.start, r.length, r.period, r.exponent_milli) == (b, size, p, 1000 * size // p)
        else:
            assert (r.start, r.length, r.period, r.exponent_milli) == (None,) * 4
        assert r.runs_sha256 == hashlib.sha256("".join(f"{b},{s},{p}\n" for b, s, p in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(left(w, runs).encode()).hexdigest()
    assert planted > 5


def test_collapsed_keeps_one_period():
    words = b"a b c b c b c b c b c b c d".split()
    assert collapsed(words, np.array([[1, 12, 2]])) == b"a b c d"
