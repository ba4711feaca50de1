import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from seqtally.llm.mixing import leaf_budgets, mixed
from tests.llm.conftest import words


def poured(budget, children):
    """children: name -> (weight, limit)."""
    out, open_ = {}, {k: v for k, v in children.items() if v[0] > 0}
    while open_:
        price = budget / sum(w for w, _ in open_.values())
        full = {k: lim for k, (w, lim) in open_.items() if lim < price * w}
        if not full:
            return out | {k: price * w for k, (w, _) in open_.items()}
        out |= full
        budget -= sum(full.values())
        open_ = {k: v for k, v in open_.items() if k not in full}
    return out


def by_hand(leaves, total, weights, epochs):
    """Budgets top-down; leaves: path -> tokens."""
    def limit(prefix):
        return sum(t * epochs for p, t in leaves.items() if p[:len(prefix)] == prefix)

    budgets = {(): min(limit(()), total)}
    depth = len(next(iter(leaves)))
    for d in range(depth):
        new = {}
        for prefix, b in budgets.items():
            names = {p[d] for p in leaves if p[:d] == prefix}
            new |= {(*prefix, k): v for k, v in poured(b, {
                k: (weights[d].get(k, 1.0), limit((*prefix, k))) for k in names}).items()}
        budgets = new
    return budgets


LEAVES = {("x", "en", "a"): 100, ("x", "en", "b"): 5, ("x", "de", "a"): 40, ("y", "en", "a"): 7, ("y", "fr", "c"): 9,
          ("z", "en", "d"): 1000, ("z", "de", "d"): 1, ("w", "en", "zero"): 50}


@pytest.mark.parametrize("total, epochs", [(120, 1), (600, 1), (5000, 3), (90, 2), (0, 1)])
def test_shortages_go_to_siblings_before_ancestors(spark, total, epochs):
    weights = [{"x": 2.0, "w": 0.0}, {"en": 3.0}, {}]
    table = spark.createDataFrame([(*p, t) for p, t in LEAVES.items()], "_level0 string, _level1 string, _level2 string, tokens long")
    got = {(r._level0, r._level1, r._level2): r.budget for r in leaf_budgets(table, 3, total, weights, epochs).collect()}
    expected = {k: math.floor(v + 1e-6) for k, v in by_hand(LEAVES, total, weights, epochs).items()}
    assert got == expected


def docs_and_tree(docs_of, rows):
    return docs_of(rows), [F.col("lang"), F.col("source")]


def test_prefixes_of_seeded_epochs(spark, docs_of):
    rows = [(i, words(i, 1 + i % 9), "en" if i % 3 else "de", f"s{i % 4}") for i in range(150)]
    rows += [(20, "a b c", "en", "s0"), (20, "a b c", "en", "s0"), (None, "x", "en", "s1"), (151, None, None, None),
             (152, "", "en", "s1"), (153, words(9, 3000), "fr", "s9")]
    docs, tree = docs_and_tree(docs_of, rows)
    out = mixed(docs, tree, [{"en": 5.0}, {"s0": 3.0}], share=0.4, epochs=3, seed=11).collect()
    assert all(r.n == "n" and r["_key"] == "k" for r in out)

    leaves = defaultdict(list)
    for i, t, lang, source in rows:
        leaves[lang or "", source or ""].append((i, len((t or "").split())))
    tokens = {k: sum(n for _, n in v) for k, v in leaves.items() if sum(n for _, n in v)}
    budgets = by_hand(tokens, 0.4 * sum(tokens.values()), [{"en": 5.0}, {"s0": 3.0}], 3)
    expected = Counter()
    for leaf, budget in budgets.items():
        whole, rest = divmod(math.floor(budget + 1e-6), tokens[leaf])
        ids = {i for i, _ in leaves[leaf]}
        turns = {i: spark.range(1).select(F.xxhash64(F.lit(11), F.lit(whole).cast("long"), F.lit("" if i is None else str(i)))
                                          .bitwiseAND(F.lit((1 << 63) - 1))).first()[0] for i in ids} if rest and len(ids) < 12 else None
        for e in range(whole):
            expected.update((i, e) for i, _ in leaves[leaf])
        part = [r for r in out if (r._level0, r._level1, r._epoch) == (*leaf, whole)]
        taken = sum(r._n_tokens for r in part)
        biggest = max(sum(n for j, n in leaves[leaf] if j == i) for i in ids)
        assert (not part) if not rest else rest <= taken < rest + biggest
        if turns:
            at, chosen = 0, set()
            for i in sorted(ids, key=lambda i: (turns[i], "" if i is None else str(i))):
                if at < rest:
                    chosen.add(i)
                at += sum(n for j, n in leaves[leaf] if j == i)
            assert {r.doc_id for r in part} == chosen
        expected.update((r.doc_id, whole) for r in part)
    assert Counter((r.doc_id, r._epoch) for r in out) == expected


def test_a_seed_repeats_itself(docs_of):
    rows = [(i, words(i, 5), "en", "a") for i in range(60)]
    docs, tree = docs_and_tree(docs_of, rows)
    chosen = [sorted(r.doc_id for r in mixed(docs, tree, share=0.5, seed=s).collect()) for s in (1, 1, 2)]
    assert chosen[0] == chosen[1] != chosen[2] and len(chosen[0]) == 30


def test_empty_table_and_no_tokens(docs_of, no_docs):
    tree = [F.col("lang"), F.col("source")]
    assert mixed(no_docs, tree).count() == 0
    assert mixed(docs_of([(1, None, "en", "a"), (2, "", "en", "b")]), tree).count() == 0


def test_stays_in_the_engine(docs_of):
    docs, tree = docs_and_tree(docs_of, [(1, "a b", "en", "a")])
    plan = mixed(docs, tree)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
