import random

import numpy as np
import pytest

from seqtally.llm.components import components
from seqtally.llm.jaccard_join import jaccard_components
from seqtally.llm.shingles import shingle_sets
from tests.llm.conftest import words


def sets_by_hand(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def by_hand(rows):
    sets = [sets_by_hand(t) for _, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, _) in enumerate(rows):
        for b in range(a):
            j = rows[b][0]
            s, t = sets[a], sets[b]
            if i is not None and j is not None and s and t and 100 * len(s & t) >= 80 * len(s | t):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return sorted((-1 if i is None else i, len(s), -1 if i is None else root(i)) for (i, _), s in zip(rows, sets))


def found(docs, **options):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, -1 if r.component_id is None else r.component_id)
                  for r in jaccard_components(docs, **options).collect())


def edited(text, seed, n):
    pick, w = random.Random(seed), text.split()
    for _ in range(n):
        w[pick.randrange(len(w))] = f"e{pick.randrange(10 ** 6)}"
    return " ".join(w)


@pytest.fixture(scope="module")
def rows():
    passage = words(50, 40)
    out = [(100 + i, words(i, 30 + i % 7)) for i in range(20)]
    out += [(200 + i, edited(words(7, 120), i, 1 + i % 4)) for i in range(40)]  # near copies, many of them of one text
    out += [(300 + i, passage + " " + words(900 + i, 8 + i % 5)) for i in range(25)]  # one passage, mostly not alike
    out += [(400 + i, words(60, 12)[:20 + 6 * i]) for i in range(8)]
    five = words(70, 9).split()  # sets of 5 and 4 with 4 in common: exactly at the bound
    out += [(500, " ".join(five)), (501, " ".join(five[:8])), (502, " ".join(five).upper()), (503, "\n".join(five))]
    return out


@pytest.mark.parametrize("options", [{}, {"small": 3}, {"small": 1, "pivots": 1}, {"small": 2, "pivots": 5}])
def test_components(docs_of, rows, options):
    docs = docs_of([(i, t, "en", "a") for i, t in rows])
    assert found(docs, **options) == by_hand(rows)


def test_odd_rows(odd_docs):
    assert found(odd_docs) == by_hand([(r.doc_id, r.text) for r in odd_docs.collect()])


def test_empty_table(no_docs):
    assert jaccard_components(no_docs).count() == 0


def test_shingles_match_words(rows):
    texts = [t for _, t in rows] + [None, "", "a\x0bb\x0c c\td\re f", "é É x y z   w", "A b C d E"]
    got = list(shingle_sets(texts))
    for text, s in zip(texts, got):
        assert len(s) == len(sets_by_hand(text)) and bool(np.all(s[1:] > s[:-1]))
    assert (got[-1] == next(iter(shingle_sets(["a B c D e"])))).all()


def test_long_chain_of_links(spark):
    pick = random.Random(4)
    order = list(range(300))
    pick.shuffle(order)
    links = list(zip(order, order[1:]))[:250] + [(700, 700), (None, 3), (901, 900), (900, 901), (901, 900)]
    got = {r.node: r.component_id for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {x: min(order[:251]) for x in order[:251]} | {900: 900, 901: 900}


def template(n, own, seed=1):
    """Texts of 140 words of which the last `own` are their own: at a similarity that falls with `own`."""
    base = words(seed, 140).split()
    return [(i, " ".join(base[:140 - own] + words(1000 + i, own).split())) for i in range(n)]


@pytest.mark.parametrize("own", [4, 9, 14, 22])
@pytest.mark.parametrize("options", [{"small": 16}, {"small": 1, "pivots": 1}])
def test_one_template(docs_of, own, options):
    rows = template(60, own) + [(100 + i, t) for i, t in template(30, 9)] + [(200, words(1, 140))]
    assert found(docs_of([(i, t, "en", "a") for i, t in rows]), **options) == by_hand(rows)


def test_far_copies_of_one_template_take_rows_in_proportion(docs_of, monkeypatch):
    import seqtally.llm.jaccard_join as jj
    measured, real = [], jj._measured

    def counting(pairs, sets):
        measured[-1] += pairs.select("a", "b").distinct().count()
        return real(pairs, sets)

    monkeypatch.setattr(jj, "_measured", counting)
    for n in (600, 1200):
        measured.append(0)
        rows = jaccard_components(docs_of([(i, t, "en", "a") for i, t in template(n, 22)])).collect()
        assert all(r.component_id == r.doc_id for r in rows)
    assert measured[1] <= 2.5 * max(measured[0], 300) and measured[1] < 6000


def test_dense_region_with_links_across_blocks(spark):
    import seqtally.llm.jaccard_join as jj
    pick = random.Random(3)
    sets, groups = [], []
    for g in range(12):
        base = set(range(1000 * g, 1000 * g + 40)) | set(range(10))
        for _ in range(6):
            s = set(base)
            s.discard(pick.choice(sorted(base)))
            sets.append(np.array(sorted(s), dtype=np.uint64))
            groups.append(g)
    rows = [(7, i, i) for i in range(len(sets))]
    members = spark.createDataFrame(rows, "region long, a long, la long")
    bytes_of = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in enumerate(sets)], "key long, shingles binary")
    for block in (4, 1000):
        links = jj._dense_links(members, bytes_of, block)
        label = {r.node: r.component_id for r in components(links, "a", "b").collect()}
        assert {label[i] for i in range(len(sets))} == {6 * g for g in range(12)}
        assert all(groups[i] == groups[j] for i, j in label.items())
