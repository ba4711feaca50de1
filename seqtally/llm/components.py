"""Connected components of a link table.

Tasks first contract the links they hold to spanning trees. What several tasks have found is joined by alternating
star operations: each round points nodes at their smallest known neighbour with one aggregation and one join, so
no component is ever gathered anywhere; the number of rounds grows with the logarithm of the number of nodes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtally.llm.common import written


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest node around."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the smallest one. Links point downwards."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, smallest node it reaches by this task's links)."""
    forest, seen = UnionFind(), set()
    for batch in batches:
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            forest.join(x, y)
            seen.update((x, y))
    nodes = sorted(seen)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([forest.root(x) for x in nodes], pa.int64())],
                                     ["u", "v"])


def components(links: DataFrame, u: str = "u", v: str = "v", per_task: int = 200_000) -> DataFrame:
    """`node, component_id` for every node that has a link to another: the smallest node it can reach.

    Links may repeat, point either way or be loops; rows with a null end are left out. A task contracts about
    `per_task` links; if one task holds all of them, its trees are the result.
    """
    a, b = F.col(u).cast("long"), F.col(v).cast("long")
    table = written(links.where(a != b).select(a.alias("u"), b.alias("v")))
    tasks = max(1, -(-table.count() // per_task))
    local = written(table.coalesce(tasks).mapInArrow(_contracted, "u long, v long"))
    if tasks == 1:
        return local.select(F.col("u").alias("node"), F.col("v").alias("component_id"))
    now = written(local.where("u <> v").distinct())
    seen = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(state) == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component_id")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("component_id"))).distinct()
        seen = tuple(state)
        now = written(_small_star(_large_star(now)))


class UnionFind:
    """For links that one task has found; the roots are smallest members."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        path = []
        while (up := self.parent.get(x, x)) != x:
            path.append(x)
            x = up
        for y in path:
            self.parent[y] = x
        return x

    def join(self, x: int, y: int) -> bool:
        """Whether the two were apart before."""
        a, b = self.root(x), self.root(y)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True
