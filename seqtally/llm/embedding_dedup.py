"""Embedding near-duplicates by cross-polytope hashing.

A vector is turned by random signs and fast Hadamard transforms; its hash is the nearest of the 2n signed unit
vectors. A table joins a few hashes to one bucket, and each vector enters, besides the best bucket of a table,
the next best ones (multiprobe). Pairs that share a bucket are verified by their cosine in double precision.

Equal vectors are one class, found by an aggregation that combines before its shuffle, so a vector that holds
a third of all rows costs one hash. Buckets with many classes are split into lanes, and each pair of lanes is
one task's work; nothing is capped. Tasks return sums per vector and spanning links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqtally.llm.common import written
from seqtally.llm.components import UnionFind, components

MIN_COSINE = 0.95


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row, scaled to keep lengths."""
    n, step = rows.shape[1], 1
    while step < n:
        pairs = rows.reshape(len(rows), n // (2 * step), 2, step)
        a, b = pairs[:, :, 0], pairs[:, :, 1]
        rows = np.stack([a + b, a - b], axis=2).reshape(len(rows), n)
        step *= 2
    return rows / np.sqrt(n)


class CrossPolytope:
    """Buckets of unit vectors: `tables` x `probes` per vector, each a non-negative 62-bit number."""

    def __init__(self, tables: int = 4, hashes: int = 2, probes: int = 4, seed: int = 1) -> None:
        self.tables, self.hashes, self.probes, self.seed = tables, hashes, probes, seed
        choices = np.indices((2,) * hashes).reshape(hashes, -1).T  # best or second best of each hash
        self.choices = choices[np.argsort(choices.sum(axis=1), kind="stable")]

    def buckets(self, unit: np.ndarray) -> np.ndarray:
        size = 1 << max(1, int(unit.shape[1] - 1).bit_length())
        padded = np.zeros((len(unit), size))
        padded[:, :unit.shape[1]] = unit
        signs = np.random.default_rng([self.seed, size]).choice([-1.0, 1.0], (self.tables, self.hashes, 3, size))
        out = np.empty((len(unit), self.tables, self.probes), dtype=np.int64)
        for t in range(self.tables):
            codes, losses = [], []
            for h in range(self.hashes):
                turned = padded
                for s in signs[t, h]:
                    turned = hadamard(turned * s)
                strength = np.abs(turned)
                best = np.argsort(-strength, axis=1, kind="stable")[:, :2]
                height = np.take_along_axis(strength, best, axis=1)
                codes.append(best * 2 + (np.take_along_axis(turned, best, axis=1) > 0))
                losses.append(height[:, :1] - height)
            loss = sum(x[:, self.choices[:, h]] for h, x in enumerate(losses))
            order = np.argsort(loss, axis=1, kind="stable")[:, :self.probes]
            code = np.full(loss.shape, t, dtype=np.int64)
            for h, x in enumerate(codes):
                code = code * (2 * size) + x[:, self.choices[:, h]]
            out[:, t] = np.take_along_axis(code, order, axis=1)
        return out.reshape(len(unit), -1)


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.max(np.abs(rows), axis=1, keepdims=True)  # no overflow or underflow in the squares
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def is_usable(x: Column) -> Column:
    """Whether a vector is not null or all zero and has only finite components."""
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce(~bad & F.exists(x, lambda c: c != 0), F.lit(False))


def _verified(batches: Iterator[pa.RecordBatch], lsh: CrossPolytope, min_cosine: float) -> Iterator[pa.RecordBatch]:
    """Groups of (dim, bucket, lane pair) arrive sorted. Of each: per vector the weight of its links here, and links
    that connect the same vectors. A pair that shares several buckets counts in the smallest one only."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("weight", pa.int64())])
    held: list[pa.RecordBatch] = []
    key = None

    def close() -> pa.RecordBatch | None:
        table = pa.Table.from_batches(held).combine_chunks()
        if table.num_rows < 2:
            return None
        ids, weights = table["rep"].to_numpy(), table["n"].to_numpy()
        home, low, high = table["lane"].to_numpy(), key[2], key[3]
        unit = _unit(_matrix(table["vec"].combine_chunks()))
        left = np.flatnonzero(home == low)
        right = np.flatnonzero(home == high) if low != high else left
        us, vs = [], []
        for at in range(0, len(left), 512):
            part = left[at:at + 512]
            close_by = unit[part] @ unit[right].T >= min_cosine - 1e-9
            a, b = np.nonzero(close_by)
            a, b = part[a], right[b]
            keep = ids[a] < ids[b] if low == high else a != b
            a, b = a[keep], b[keep]
            exact = (unit[a] * unit[b]).sum(axis=1) >= min_cosine
            us.append(a[exact])
            vs.append(b[exact])
        a, b = np.concatenate(us), np.concatenate(vs)
        if not len(a):
            return None
        some, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
        codes = lsh.buckets(unit[some])
        x, y = inverse[:len(a)], inverse[len(a):]
        first = np.empty(len(a), dtype=bool)
        for at in range(0, len(a), 20_000):
            p, q = codes[x[at:at + 20_000]], codes[y[at:at + 20_000]]
            shared = (p[:, :, None] == q[:, None, :]).any(axis=2)
            first[at:at + 20_000] = np.where(shared, p, np.iinfo(np.int64).max).min(axis=1) == key[1]
        links = np.zeros(table.num_rows, dtype=np.int64)
        np.add.at(links, a[first], weights[b[first]])
        np.add.at(links, b[first], weights[a[first]])
        forest, spanning = UnionFind(), []
        for x, y in zip(ids[a].tolist(), ids[b].tolist()):
            if forest.join(x, y):
                spanning.append((x, y))
        some = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays(
            [pa.array([*ids[some].tolist(), *[x for x, _ in spanning]], pa.int64()),
             pa.array([*[None] * len(some), *[y for _, y in spanning]], pa.int64()),
             pa.array([*links[some].tolist(), *[0] * len(spanning)], pa.int64())], schema=schema)

    for batch in batches:
        columns = [batch.column(n).to_numpy() for n in ("dim", "bucket", "low", "high")]
        changes = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        for b, e in zip([0, *changes.tolist()], [*changes.tolist(), batch.num_rows]):
            here = tuple(int(c[b]) for c in columns)
            if here != key and held:
                if (out := close()) is not None:
                    yield out
                held = []
            key = here
            held.append(batch.slice(b, e - b))
    if held and (out := close()) is not None:
        yield out


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    min_cosine: float = MIN_COSINE, lsh: CrossPolytope | None = None,
                    lane_size: int = 2048) -> DataFrame:
    """`vec_id, n_links, component_id, kept`, one row per input row.

    Vectors that are null, empty, all zero, or hold null or non-finite components link with nothing. Vectors of
    different lengths never link. Repeated rows count as rows: equal vectors link with each other, also under
    one id. Ids are compared as longs; a row with a null id links with nothing and is kept as null. An empty
    table gives no rows. Other columns are not read.

    More hashes per table make buckets finer: one more for each growth of the table by the square root of
    four times its dimension or so keeps buckets small.
    """
    lsh = lsh or CrossPolytope()
    rows = vectors.select(F.col(id_col).cast("long").alias("_id"), F.col(vec_col).alias("_vec"))
    takes_part = F.col("_id").isNotNull() & is_usable(F.col("_vec"))
    # 128 bits of hash stand for the vector where whole vectors need not travel. A negative zero becomes zero.
    vec = F.transform("_vec", lambda c: c + F.lit(0).cast("float"))
    keyed = (rows.where(takes_part).select("_id", vec.alias("_vec"))
             .select("_id", "_vec", F.xxhash64("_vec").alias("_k1"), F.xxhash64(F.lit(1), "_vec").alias("_k2")))
    classes = written(keyed.groupBy("_k1", "_k2").agg(
        F.min("_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.min("_vec").alias("vec")))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            lengths = np.diff(whole.column("vec").offsets.to_numpy())
            for dim in np.unique(lengths).tolist():
                some = whole.take(pa.array(np.flatnonzero(lengths == dim)))
                codes = lsh.buckets(_unit(_matrix(some.column("vec"))))
                at = pa.array(np.repeat(np.arange(len(codes)), codes.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), dim, dtype=np.int32)), pa.array(codes.ravel()),
                     some.column("rep").take(at), some.column("n").take(at)], ["dim", "bucket", "rep", "n"])

    narrow = classes.select("rep", "n", "vec").mapInArrow(hashed, "dim int, bucket long, rep long, n long")
    entries = written(narrow)  # without vectors
    sizes = (entries.groupBy("dim", "bucket").agg(F.count(F.lit(1)).alias("_size")).where("_size > 1")
             .withColumn("lanes", F.ceil(F.col("_size") / lane_size).cast("int")))
    lane = F.pmod(F.xxhash64("rep"), F.col("lanes")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("lanes") - 1))
    # Buckets with one class are gone before vectors are fetched.
    met = (entries.join(sizes, ["dim", "bucket"]).withColumn("lane", lane).withColumn("_other", other)
           .withColumn("low", F.least("lane", "_other")).withColumn("high", F.greatest("lane", "_other"))
           .join(classes.select("rep", "vec"), "rep"))
    group = ["dim", "bucket", "low", "high"]
    found = written(met.select(*group, "lane", "rep", "n", "vec").repartition(*group)
                    .sortWithinPartitions(*group, "rep")
                    .mapInArrow(lambda it: _verified(it, lsh, min_cosine), "u long, v long, weight long"))
    links = found.groupBy(F.col("u").alias("rep")).agg(F.sum("weight").alias("_links"))
    reach = components(found.where("v is not null"))
    done = (classes.join(links, "rep", "left").join(reach, F.col("rep") == F.col("node"), "left")
            .select("_k1", "_k2", (F.coalesce("_links", F.lit(0)) + F.col("n") - 1).alias("_n_links"),
                    F.coalesce("component_id", "rep").alias("_component")))
    # Wide rows are not joined: a row's key is made again from its vector.
    labelled = keyed.select("_id", "_k1", "_k2").join(done, ["_k1", "_k2"]).select("_id", "_n_links", "_component")
    spoilt = rows.where(~takes_part).select("_id", F.lit(0), "_id")
    return labelled.union(spoilt).select(
        F.col("_id").alias(id_col), F.col("_n_links").cast("long").alias("n_links"),
        F.col("_component").alias("component_id"), (F.col("_id") == F.col("_component")).alias("kept"))
