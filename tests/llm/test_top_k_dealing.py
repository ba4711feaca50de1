import numpy as np
import pytest

from seqtally.llm.topk_search import _narrow, _padded, search

SCHEMA = "vec_id long, embedding array<float>"


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(11)
    made = [(i, rng.integers(-9, 9, 6 + i % 3).astype(np.float32).tolist()) for i in range(240)]
    return made, spark.createDataFrame(made, SCHEMA).repartition(3)


@pytest.mark.parametrize("sizes", [{"range_size": 16, "batch_size": 7, "held": 70, "groups": 3, "block_size": 5},
                                   {"range_size": 6, "batch_size": 50, "held": 1, "groups": 1, "probe": 2},
                                   {"range_size": 16, "batch_size": 7, "groups": 500, "probe": 1}])
def test_parts_and_groups_change_nothing(spark, vectors, sizes):
    made, table = vectors
    whole = {i: np.pad(1024 * np.array(v, dtype=np.int64), (0, 8 - len(v))) for i, v in made}
    expected = []
    for i in range(0, 240, 3):
        best = sorted((-int(whole[i] @ w), j) for j, w in whole.items() if j != i)[:10]
        expected += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    found = search(table.where("vec_id % 3 = 0"), table, **sizes)
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected)


def test_no_vectors_pass_the_driver(spark, vectors):
    """The planner takes packed rows for small, however often they are repeated: nothing may leave it a broadcast of them."""
    _, table = vectors
    found = search(table.where("vec_id % 3 = 0"), table, range_size=16)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "_values" in plan


def test_integers_in_as_few_bytes_as_hold_them():
    for most, size in ((127, 1), (128, 2), (2 ** 15, 4), (2 ** 31, 8)):
        values = np.array([0, -1, most, 5, 6], dtype=np.int64)
        narrow = _narrow(values)
        assert narrow.itemsize == size and (narrow == values).all()
    assert _padded(np.array([1, 2, 3], dtype=np.int8), np.array([2, 0, 1])).tolist() == [[1, 2], [0, 0], [3, 0]]
    assert _padded(_narrow(np.empty(0, np.int64)), np.array([0, 0])).tolist() in ([[], []], [[0], [0]])
