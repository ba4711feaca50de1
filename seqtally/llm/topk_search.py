"""Exact top-k search by integer inner product, a block of documents at a time.

Components are terms and their integer values impacts. Documents are cut into blocks of neighbours in id order
(document ranges); a block keeps its vectors as a forward index and the largest and smallest value of every
term. The sum of a query's best products with these maxima bounds every score in the block. Each query visits
blocks from the highest bound down, scores them whole through the forward index, and stops when the next bound
is below its k-th score. Blocks are gathered into ranges and queries into batches. A task holds the batches of one part
of the queries and passes one group of ranges by them; each query's few best rows of each group are merged at the end.
So a query is sent to as many tasks as there are groups, a bounded number, and a range to as many as there are parts.
Within a range vectors stand in order of their signs, strongest components first, so that a block's maxima are those of
vectors that point alike. A few ranges are searched first: the k-th score they give a query is where all others begin.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqtally.llm.common import written

EXACT_FLOAT = 2.0 ** 53


def quantized(x: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component, x as double."""
    return F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long"))


def _narrow(values: np.ndarray) -> np.ndarray:
    """The same integers in as few bytes each as hold all of them."""
    least, most = int(values.min(initial=0)), int(values.max(initial=0))
    return values.astype(next(t for t in ("i1", "i2", "i4", "i8") if np.iinfo(t).min <= least and most <= np.iinfo(t).max))


def _padded(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The rows of these lengths that follow each other in `values`, shorter ones filled with 0."""
    out = np.zeros((len(lengths), int(lengths.max(initial=1))), dtype=values.dtype)
    out[np.arange(out.shape[1]) < lengths[:, None]] = values
    return out


def _widened(rows: np.ndarray, width: int) -> np.ndarray:
    return np.pad(rows.astype(np.int64), ((0, 0), (0, width - rows.shape[1])))


class Blocks:
    """Forward index and term maxima of consecutive blocks."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, block_size: int) -> None:
        self.starts = np.arange(0, len(ids), block_size)
        strongest = np.argsort(-np.abs(vectors).sum(axis=0), kind="stable")[:62]
        signs = (vectors[:, strongest] > 0) @ (np.int64(1) << np.arange(len(strongest), dtype=np.int64)[::-1])
        order = np.argsort(signs, kind="stable")
        self.ids, self.vectors, self.size = ids[order], vectors[order], block_size
        vectors = self.vectors
        self.high = np.maximum.reduceat(vectors, self.starts, axis=0)
        self.low = np.minimum.reduceat(vectors, self.starts, axis=0)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        return product(np.maximum(queries, 0), self.high) + product(np.minimum(queries, 0), self.low)


def factors(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as floating point if their products are exact so, else as they are."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    return (a.astype(np.float64), b.astype(np.float64)) if most < EXACT_FLOAT else (a, b)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T in integers; by floating point where that is exact."""
    a, b = factors(a, b)
    return (a @ b.T).astype(np.int64)


LOWEST = np.iinfo(np.int64).min + 1


def best_of(q_ids: np.ndarray, queries: np.ndarray, blocks: Blocks, k: int, least: np.ndarray | None = None,
            known: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """(ids, scores) of the k best rows per query, unused places at the lowest score, and how many of the
    query-block pairs were scored. Ties go to the smaller id; a query's own id does not count. Rows below the
    score `least` of their query may be left out. `known` has the ids and scores of best rows found elsewhere."""
    lowest, no_id = LOWEST, np.iinfo(np.int64).max
    n = len(q_ids)
    least = np.full(n, lowest) if least is None else least
    top_ids, top = (np.full((n, k), no_id), np.full((n, k), lowest)) if known is None else (c.copy() for c in known)
    bounds = blocks.bounds(queries)
    order = np.argsort(-bounds, axis=1, kind="stable")
    left, right = factors(queries, blocks.vectors)
    waiting, scored = np.arange(n), 0
    for step in range(order.shape[1]):
        next_block = order[waiting, step]
        # An equal score may still win by its id.
        going = bounds[waiting, next_block] >= np.maximum(top[waiting, -1], least[waiting])
        waiting, next_block = waiting[going], next_block[going]
        if not len(waiting):
            break
        scored += len(waiting)
        for b in np.unique(next_block).tolist():
            who = waiting[next_block == b]
            part = slice(blocks.starts[b], blocks.starts[b] + blocks.size)
            scores = (left[who] @ right[part].T).astype(np.int64)
            hit = (scores >= np.maximum(top[who, -1], least[who])[:, None]) & (blocks.ids[part] != q_ids[who, None])
            some = hit.any(axis=1)
            if not some.any():
                continue
            who, scores, hit = who[some], scores[some], hit[some]
            scores = np.concatenate([top[who], np.where(hit, scores, lowest)], axis=1)
            ids = np.concatenate([top_ids[who], np.where(hit, blocks.ids[part], no_id)], axis=1)
            best = np.lexsort((ids, -scores), axis=1)[:, :k]
            top[who] = np.take_along_axis(scores, best, axis=1)
            top_ids[who] = np.take_along_axis(ids, best, axis=1)
    return top_ids, top, scored


def search(queries: DataFrame, candidates: DataFrame, k: int = 10, id_col: str = "vec_id",
           vec_col: str = "embedding", scale: int = 1024, block_size: int = 64, range_size: int = 4096,
           batch_size: int = 4096, probe: int = 4, groups: int = 128, held: int = 1 << 22) -> DataFrame:
    """`query_id, rank, vec_id, score`: each query's k best candidates by the inner product of quantized vectors.

    Rows with a null id, a null vector, or null or non-finite components take no part; an empty vector scores 0
    with everything, and missing components of shorter vectors count as 0. Every candidate row counts, repeated ones as
    often as they occur; equal query rows are one query, different vectors under one id are queries of that id each. A
    query's own id is no candidate. Fewer candidates than k give fewer rows; an empty table gives none. Other columns are
    not read. `block_size`, `range_size`, `batch_size`, `probe`, the ranges searched first, `groups` of ranges and `held`,
    the components of all queries that a task holds, only steer the work.
    """
    def prepared(df: DataFrame) -> DataFrame:
        x = F.col(vec_col)
        bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
        kept = df.where(F.col(id_col).isNotNull() & x.isNotNull() & ~bad)
        return kept.select(F.col(id_col).cast("long").alias("_id"), quantized(x, scale).alias("_x"))

    docs = written(prepared(candidates))
    asked = written(prepared(queries).distinct().withColumn("_mark", F.xxhash64("_id", "_x")))  # tells queries of one id apart
    n_docs = docs.count()
    n_asked, components = asked.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("_x")), F.lit(0))).first()
    n_ranges = max(1, -(-n_docs // range_size))
    n_batches = max(1, -(-n_asked // batch_size))
    n_parts = min(n_batches, max(1, -(-components // held)))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Up to `range_size` neighbouring rows as one row: ids, marks, scores to begin with, lengths, components, and
        the bytes of a component."""
        for whole in batches:
            for at in range(0, whole.num_rows, range_size):
                part = [c.slice(0) for c in whole.slice(at, range_size).columns]
                lengths = np.diff(part[1].offsets.to_numpy())
                values = _narrow(part[1].flatten().to_numpy())
                blobs = (*(c.to_numpy().astype(np.int64) for c in (part[0], part[2], part[3])), lengths.astype(np.int64), values)
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array([v.tobytes()], pa.binary()) for v in blobs], pa.array([values.itemsize], pa.int32())],
                    ["_ids", "_marks", "_least", "_lengths", "_values", "_bytes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cells one by one: the batches of a part of the queries, and then the ranges of a group."""
        cell, mine = None, []  # of each batch: ids, marks, least scores, vectors, and the ids and scores of its best rows

        def best() -> Iterator[pa.RecordBatch]:
            for ids, marks, least, _, (top_ids, top) in mine:
                who, place = np.nonzero((top_ids != np.iinfo(np.int64).max) & (top >= least[:, None]))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (
                    ids[who], marks[who], top_ids[who, place], top[who, place])], ["query_id", "_mark", "vec_id", "score"])

        for row in (r for b in batches for i in range(b.num_rows) for r in b.slice(i, 1).to_pylist()):
            if row["_cell"] != cell:
                yield from best()
                cell, mine = row["_cell"], []
            ids, marks, least, lengths = (np.frombuffer(row[n], dtype=np.int64) for n in ("_ids", "_marks", "_least", "_lengths"))
            rows = _padded(np.frombuffer(row["_values"], dtype=f"i{row['_bytes']}"), lengths)
            if row["_side"] == 0:
                none = np.full((len(ids), k), np.iinfo(np.int64).max), np.full((len(ids), k), LOWEST)
                mine.append((ids, marks, least, rows, none))
                continue
            width = max([rows.shape[1], *(q.shape[1] for *_, q, _ in mine)])
            blocks = Blocks(ids, _widened(rows, width), block_size)
            mine = [(i, m, s, q, best_of(i, _widened(q, width), blocks, k, s, known)[:2]) for i, m, s, q, known in mine]
        yield from best()

    blob = ["_ids", "_marks", "_least", "_lengths", "_values", "_bytes"]
    schema = "_ids binary, _marks binary, _least binary, _lengths binary, _values binary, _bytes int"
    none = F.lit(LOWEST).cast("long")
    # A range's number only says where it is worked on: in turn, one of each partition and then the next of each.
    at = F.monotonically_increasing_id()
    turn = (F.shiftright(at, 33) + at.bitwiseAND(F.lit((1 << 33) - 1)) * n_ranges).alias("_turn")
    ranges = written(docs.select("_id", "_x", F.lit(0).cast("long").alias("_mark"), none.alias("_least"))
                     .repartitionByRange(n_ranges, "_id").sortWithinPartitions("_id", "_x").mapInArrow(packed, schema)
                     .select(turn, *blob))

    def ranked(some: DataFrame, rows: DataFrame, n_groups: int) -> DataFrame:
        cell = (F.col("_part") * n_groups + F.col("_group")).cast("int").alias("_cell")
        dealt = (rows.select("_id", "_x", "_mark", "_least").repartitionByRange(n_batches, "_mark").mapInArrow(packed, schema)
                 .withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(n_parts)))
                 .withColumn("_group", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))
                 .select(cell, F.lit(0).alias("_side"), *blob))
        here = (some.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))))
                .withColumn("_group", F.pmod("_turn", F.lit(n_groups))).select(cell, F.lit(1).alias("_side"), *blob))
        found = (dealt.union(here).repartitionById(n_parts * n_groups, "_cell").sortWithinPartitions("_cell", "_side")
                 .mapInArrow(run, "query_id long, _mark long, vec_id long, score long"))
        # A query has at most k rows of each group here.
        order = Window.partitionBy("query_id", "_mark").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    asked = asked.withColumn("_least", none)
    if n_ranges > 4 * probe:
        some = ranges.where(F.pmod(F.xxhash64("_turn"), F.lit(n_ranges)) < probe)
        first = ranked(some, asked, probe).where(F.col("rank") == k)
        least = written(first.select(F.col("query_id").alias("_id"), "_mark", F.col("score").alias("_known")))
        asked = (asked.join(least, ["_id", "_mark"], "left")
                 .withColumn("_least", F.coalesce("_known", "_least")).drop("_known"))
    return ranked(ranges, asked, min(n_ranges, groups)).select("query_id", "rank", "vec_id", "score")
