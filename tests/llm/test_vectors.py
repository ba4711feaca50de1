import math

import numpy as np
import pytest

from seqtally.llm.embedding_dedup import CrossPolytope, hadamard, near_duplicates
from seqtally.llm.topk_search import best_of, Blocks, search

SCHEMA = "vec_id long, embedding array<float>, label int, rep long, n string, _id int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "n", 3) for i, v in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 20))
    near = [base[i % 12] + rng.normal(size=20) * 0.05 * (1 + i % 5) for i in range(160)]
    out = [(i, v.astype(np.float32).tolist()) for i, v in enumerate([*base, *near])]
    same = out[5][1]
    out += [(300, same), (301, same), (302, [x * 2 for x in same]), (5, same)]
    out += [(400, None), (401, []), (402, [0.0] * 20), (403, [None] + same[1:]), (404, [math.nan] + same[1:]),
            (405, [math.inf] + same[1:]), (406, same[:10]), (407, same + [0.0]), (None, same), (408, [-0.0] + same[1:]),
            (409, [0.0] + same[1:])]
    return out


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)


@pytest.mark.parametrize("lane_size", [2048, 7])
def test_links_and_components(spark, rows, lane_size):
    good = [(i, np.array(v, dtype=np.float64)) for i, v in rows if i is not None and usable(v)]
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(good)
    for a, (i, v) in enumerate(good):
        for b in range(a):
            j, w = good[b]
            if len(v) == len(w) and v @ w / math.sqrt(v @ v) / math.sqrt(w @ w) >= 0.95 - 1e-12:
                links[a] += 1
                links[b] += 1
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    expected = sorted([(i, n, root(i), i == root(i)) for (i, _), n in zip(good, links)]
                      + [(i, 0, i, True) for i, v in rows if i is not None and not usable(v)])
    found = near_duplicates(table(spark, rows), lane_size=lane_size).collect()
    assert sorted(tuple(r) for r in found if r.vec_id is not None) == expected
    assert [tuple(r) for r in found if r.vec_id is None] == [(None, 0, None, None)]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert near_duplicates(empty).count() == 0
    assert search(empty, empty).count() == 0


def test_transform_keeps_lengths_and_is_its_own_inverse():
    x = np.random.default_rng(1).normal(size=(5, 32))
    assert np.allclose(hadamard(hadamard(x)), x)
    assert np.allclose((hadamard(x) ** 2).sum(1), (x ** 2).sum(1))


def test_recall_at_the_bound():
    rng = np.random.default_rng(2)
    u = rng.normal(size=(4000, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w = rng.normal(size=u.shape)
    w -= (w * u).sum(1, keepdims=True) * u
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    v = 0.95 * u + math.sqrt(1 - 0.95 ** 2) * w
    lsh = CrossPolytope()
    p, q = lsh.buckets(u), lsh.buckets(v)
    met = (p[:, :, None] == q[:, None, :]).any(axis=(1, 2))
    assert met.mean() > 0.995
    far = (p[:, :, None] == lsh.buckets(w)[:, None, :]).any(axis=(1, 2))
    assert far.mean() < 0.05


def test_top_k(spark, rows):
    part = [(i, tuple(v)) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    whole = [(i, [math.floor(1024 * x) for x in np.array(v, dtype=np.float64)]) for i, v in part]  # repeated rows count
    expected = []
    for i, q in dict.fromkeys((i, tuple(x)) for i, x in whole):
        if i % 4 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, x)), j) for j, x in whole if j != i)
            expected += [(i, k + 1, j, -s) for k, (s, j) in enumerate(scored[:10])]
    vectors = table(spark, rows)
    for sizes in ({}, {"block_size": 3, "range_size": 20, "batch_size": 9}, {"block_size": 2, "range_size": 6, "probe": 1}):
        found = search(vectors.where("vec_id % 4 = 0"), vectors, **sizes)
        assert sorted(tuple(r) for r in found.collect()) == sorted(expected)


def test_a_known_score_saves_blocks():
    rng = np.random.default_rng(3)
    vectors = rng.choice([-80, 80], (4096, 8)) + rng.integers(-20, 20, (4096, 8))
    queries, none = rng.choice([-80, 80], (20, 8)) + rng.integers(-40, 40, (20, 8)), np.full(20, -1)
    blocks = Blocks(np.arange(4096), vectors, 64)
    ids, top, scored = best_of(none, queries, blocks, 10)
    again, top_again, fewer = best_of(none, queries, blocks, 10, top[:, -1])
    assert (ids == again).all() and (top == top_again).all() and fewer <= scored
    assert scored < 20 * 64 / 4  # signs keep blocks apart
    weak = Blocks(np.arange(4096, 8192), vectors // 4, 64)  # another range, without any of the best
    assert best_of(none, queries, weak, 10, top[:, -1])[2] == 0 < best_of(none, queries, weak, 10)[2]


def test_repeated_candidates_all_count(spark):
    vectors = table(spark, [(0, [1.0]), (1, [2.0]), (1, [2.0]), (2, [1.0])])
    got = [(r.rank, r.vec_id) for r in search(vectors.where("vec_id = 0"), vectors).collect()]
    assert sorted(got) == [(1, 1), (2, 1), (3, 2)]


def test_fewer_candidates_than_k(spark):
    vectors = table(spark, [(0, [1.0, 2.0]), (1, [3.0, 0.5]), (2, [3.0, 0.5])])
    got = [tuple(r) for r in search(vectors.where("vec_id = 0"), vectors).collect()]
    score = 1024 * 3 * 1024 + 2048 * 512
    assert sorted(got) == [(0, 1, 1, score), (0, 2, 2, score)]


def test_blocks_below_the_bound_are_skipped():
    vectors = np.concatenate([np.full((64, 4), 100), np.full((640, 4), 1)]).astype(np.int64)
    blocks = Blocks(np.arange(len(vectors)), vectors, 64)
    ids, top, scored = best_of(np.array([-1]), np.array([[1, 1, 1, 1]]), blocks, 10)
    assert ids[0].tolist() == list(range(10)) and set(top[0].tolist()) == {400} and scored == 1


def test_scores_beyond_float_precision():
    vectors = np.array([[3 * 10 ** 8, 1], [3 * 10 ** 8, 0]], dtype=np.int64)
    _, top, _ = best_of(np.array([9]), np.array([[3 * 10 ** 8, 1]]), Blocks(np.arange(2), vectors, 64), 2)
    assert top[0].tolist() == [9 * 10 ** 16 + 1, 9 * 10 ** 16]
