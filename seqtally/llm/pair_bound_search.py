"""Exact ranked search with MaxScore whose bounds come from pairs of terms.

Index. Documents stand in segments. A segment holds, for the terms that the queries use, postings with their impacts
(a term's weight times its saturated frequency), and per block of documents two kinds of maxima: of each term, and of
each listed pair of terms, whose intersection list is reduced to the largest joint impact per block. A query's terms
form a chain in order of weight, and the listed pairs are the neighbours in these chains.

Bounds. What the first terms of a chain can add to a score in a block is at most the least cost of covering them by
single terms and neighbouring pairs, which a pass along the chain finds. A joint maximum is never above the sum of
both terms' maxima, and far below it where no document has both at their best.

Search. Terms are added from the rarest on. As long as the rest of the chain may still lift a document that has none
of the terms so far above the threshold, all documents of the block stay in; from then on only those whose score and
bound reach it. Segments without such a block are not scored. The threshold is the lowest of the best scores found so
far; a few segments are searched first, so that all others start from theirs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqtally.llm.common import written
from seqtally.llm.shingles import chunked

BLOCK = 256
_TERM_BYTES = bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_TABLE = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if b in _TERM_BYTES else 0x20 for b in range(256))


def terms_of(raw: bytes) -> list[bytes]:
    """Runs of letters, digits and bytes of other characters; A-Z lower-cased."""
    return raw.translate(_TABLE).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def relative_lengths(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """(25 n n_docs) div n_terms, in big integers where 64 bits could be too few."""
    if 25 * int(n.max(initial=0)) * n_docs < 1 << 63:
        return 25 * n * n_docs // max(n_terms, 1)
    return np.array([25 * x * n_docs // n_terms for x in n.tolist()], np.int64)


SEGMENTS = ("segment long, n_docs long, n_terms long, ids array<long>, sizes binary, term binary, doc binary, tf binary")


def segments(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str, size: int) -> DataFrame:
    """Postings (term, document in the segment, occurrences) of segments of at most `size` documents of a task."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number = shared.value, TaskContext.get().partitionId() << 32
        ids: list = []
        sizes: list[int] = []
        parts: list[np.ndarray] = []
        held = 0

        def segment() -> pa.RecordBatch:
            key = np.concatenate(parts) if parts else np.empty(0, np.int64)
            # by term, then document
            place = (key % len(known)) * size + key // len(known) if len(known) else key
            place, tf = np.unique(place, return_counts=True)
            n = np.array(sizes, np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([int((n > 0).sum())], pa.int64()), pa.array([int(n.sum())], pa.int64()),
                 pa.array([ids], pa.list_(pa.int64())),
                 *[pa.array([a.tobytes()], pa.binary()) for a in (n, (place // size).astype(np.int32),
                                                                 (place % size).astype(np.int32), tf.astype(np.int64))]],
                ["segment", "n_docs", "n_terms", "ids", "sizes", "term", "doc", "tf"])

        for whole in batches:
            for first, raws in chunked(whole.column(1).to_pylist()):
                for at, raw in enumerate(raws, first):
                    words = terms_of(raw)
                    found = np.array([known[w] for w in words if w in known], dtype=np.int64)
                    if len(ids) == size or held + len(found) > 1 << 24:
                        yield segment()
                        ids, sizes, parts, held, number = [], [], [], 0, number + 1
                    parts.append(found + len(ids) * len(known))
                    held += len(found)
                    ids.append(whole.column(0)[at].as_py())
                    sizes.append(len(words))
        if ids:
            yield segment()

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(run, SEGMENTS)


def document_frequencies(table: DataFrame, n_terms: int) -> np.ndarray:
    """Documents that hold each term; tasks add up their segments, and the driver gets one row per known term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(n_terms, np.int64)
        for batch in batches:
            for blob in batch.column(0):
                count += np.bincount(np.frombuffer(blob.as_py(), np.int32), minlength=n_terms)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(count[some])], ["term", "df"])

    out = np.zeros(n_terms, np.int64)
    for term, df in table.select("term").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df")).collect():
        out[term] = df
    return out


class Index:
    """One segment: postings of the terms it has, with impacts and the maxima per block."""

    def __init__(self, n_docs: int, terms: np.ndarray, starts: np.ndarray, docs: np.ndarray, impacts: np.ndarray,
                 maxima: np.ndarray, joint: np.ndarray) -> None:
        self.n_docs, self.docs, self.impacts, self.maxima, self.joint = n_docs, docs, impacts, maxima, joint
        self.place = {t: i for i, t in enumerate(terms.tolist())}
        self.starts = starts

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray] | None:
        i = self.place.get(term)
        if i is None:
            return None
        return self.docs[self.starts[i]:self.starts[i + 1]], self.impacts[self.starts[i]:self.starts[i + 1]]


INDEX = ("segment long, ids array<long>, terms binary, starts binary, docs binary, impacts binary, maxima binary, "
         "joint binary")


def indexed(table: DataFrame, weights: np.ndarray, n_docs: int, n_terms: int, pairs: list[tuple[int, int]]) -> DataFrame:
    """Segments with impacts instead of occurrences, block maxima of their terms and joint ones of the pairs."""
    shared = table.sparkSession.sparkContext.broadcast((weights, pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight_of, listed = shared.value
        for batch in batches:
            for at in range(batch.num_rows):
                n, term, doc, tf = (np.frombuffer(batch.column(c)[at].as_py(), kind) for c, kind in (
                    ("sizes", np.int64), ("term", np.int32), ("doc", np.int32), ("tf", np.int64)))
                length = 75 + relative_lengths(n, n_docs, n_terms)
                impacts = weight_of[term] * (1_000_000_000 * tf // (1000 * tf + 12 * length[doc]))
                some = impacts > 0
                term, doc, impacts = term[some], doc[some], impacts[some]
                terms, starts = np.unique(term, return_index=True)
                starts = np.append(starts, len(term))
                blocks = -(-len(n) // BLOCK)
                maxima = np.zeros((len(terms), blocks), np.int64)
                np.maximum.at(maxima, (np.repeat(np.arange(len(terms)), np.diff(starts)), doc // BLOCK), impacts)
                joint = np.zeros((len(listed), blocks), np.int64)
                place = {t: i for i, t in enumerate(terms.tolist())}
                row = np.zeros(blocks * BLOCK, np.int64)
                for k, (a, b) in enumerate(listed):
                    x, y = place.get(a), place.get(b)
                    if x is None or y is None:
                        continue
                    one, two = slice(starts[x], starts[x + 1]), slice(starts[y], starts[y + 1])
                    row[doc[one]] = impacts[one]
                    other = row[doc[two]]
                    both = np.flatnonzero(other)
                    if len(both):
                        np.maximum.at(joint[k], doc[two][both] // BLOCK, other[both] + impacts[two][both])
                    row[doc[one]] = 0
                yield pa.RecordBatch.from_arrays(
                    [batch.column("segment").slice(at, 1), batch.column("ids").slice(at, 1),
                     *[pa.array([a.tobytes()], pa.binary()) for a in (
                         terms.astype(np.int32), starts.astype(np.int64), doc, impacts, maxima, joint)]],
                    ["segment", "ids", "terms", "starts", "docs", "impacts", "maxima", "joint"])

    return table.mapInArrow(run, INDEX)


def chain_bounds(index: Index, chain: list[tuple[int, int, int]]) -> np.ndarray:
    """Row i: the most that the first i terms of the chain add to a score, per block.

    A chain has (term, how often the query holds it, place of its pair with the term before, or -1)."""
    blocks = index.maxima.shape[1]
    bounds = np.zeros((len(chain) + 1, blocks), np.int64)
    before, times_before = np.zeros(blocks, np.int64), 0
    for i, (term, times, pair) in enumerate(chain, 1):
        at = index.place.get(term)
        own = index.maxima[at] if at is not None else np.zeros(blocks, np.int64)
        bounds[i] = bounds[i - 1] + times * own
        if i > 1 and pair >= 0:
            joint = np.maximum(index.joint[pair], np.maximum(own, before))
            low = min(times, times_before)
            cover = low * joint + (times - low) * own + (times_before - low) * before
            np.minimum(bounds[i], bounds[i - 2] + cover, out=bounds[i])
        before, times_before = own, times
    return bounds


def best_in_segment(index: Index, chain: list[tuple[int, int, int]], threshold: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(documents, scores) from `threshold` on, and the number of postings looked at."""
    none = np.empty(0, np.int64)
    bounds = chain_bounds(index, chain)
    if not (bounds[-1] >= threshold).any():
        return none, none, 0
    score, looked = np.zeros(index.n_docs, np.int64), 0
    block = np.arange(index.n_docs) // BLOCK
    left = len(chain)
    while left and (bounds[left] >= threshold).any():
        term, times, _ = chain[left - 1]
        if (found := index.postings(term)) is not None:
            score[found[0]] += times * found[1]
            looked += len(found[0])
        left -= 1
    docs = np.flatnonzero(score + bounds[left][block] >= threshold)
    score = score[docs]
    while left and len(docs):
        term, times, _ = chain[left - 1]
        if (found := index.postings(term)) is not None:
            at = np.minimum(np.searchsorted(found[0], docs), len(found[0]) - 1)
            score = score + times * found[1][at] * (found[0][at] == docs)
            looked += len(docs)
        left -= 1
        some = score + bounds[left][block[docs]] >= threshold
        docs, score = docs[some], score[some]
    return docs, score, looked


def _searched(index: DataFrame, chains: list[list[tuple[int, int, int]]], thresholds: list[int], k: int) -> DataFrame:
    """`query, doc_id, score`: each task's best k of every query."""
    shared = index.sparkSession.sparkContext.broadcast((chains, thresholds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, start = shared.value
        best: list[list[tuple]] = [[] for _ in wanted]
        least = list(start)
        for batch in batches:
            for at in range(batch.num_rows):
                ids = batch.column("ids")[at].values
                terms, starts, docs, impacts, maxima, joint = (np.frombuffer(batch.column(c)[at].as_py(), kind) for c, kind in (
                    ("terms", np.int32), ("starts", np.int64), ("docs", np.int32), ("impacts", np.int64),
                    ("maxima", np.int64), ("joint", np.int64)))
                blocks = -(-len(ids) // BLOCK)
                segment = Index(len(ids), terms, starts, docs, impacts, maxima.reshape(-1, blocks), joint.reshape(-1, blocks))
                for q, chain in enumerate(wanted):
                    found, scores, _ = best_in_segment(segment, chain, least[q])
                    if not len(found):
                        continue
                    names = ids.take(pa.array(found)).to_pylist()
                    rows = best[q] + [(-s, d is not None, d or 0) for s, d in zip(scores.tolist(), names)]
                    best[q] = sorted(rows)[:k]
                    if len(best[q]) == k:
                        least[q] = max(least[q], -best[q][-1][0])
        rows = [(q, d if there else None, -s) for q, some in enumerate(best) for s, there, d in some]
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query", "doc_id", "score"])

    return index.mapInArrow(run, "query long, doc_id long, score long")


def _blocks(items: DataFrame, id_col: str, text_col: str, most: int) -> Iterator[list[tuple[int, list[bytes]]]]:
    """The query set in blocks of about `most` terms."""
    held: list[tuple[int, list[bytes]]] = []
    size = 0
    for key, text in items.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).toLocalIterator():
        words = terms_of((text or "").encode("utf-8", "surrogatepass"))
        if held and size + len(words) > most:
            yield held
            held, size = [], 0
        held.append((key, words))
        size += len(words)
    if held:
        yield held


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", segment_docs: int = 4096, probe: int = 8,
                  block_terms: int = 200_000) -> DataFrame:
    """`item_id, rank, doc_id, score`: the k documents with the highest scores above 0 for each item, ties by id.

    The items are the stated query set. They are taken in blocks of about `block_terms` terms, which bounds what the
    driver and the tasks hold of them; every block is run against all documents.

    Null and empty texts, of documents or items, have no terms and give no rows. Repeated document rows are documents
    of their own; a null id comes before the others of the same score. Items that repeat an id each have a ranking
    under it. An empty table on either side gives no rows. Other columns are not read. `segment_docs` and `probe`
    steer the work only.
    """
    found = [_block_searched(docs, block, k, id_col, text_col, segment_docs, probe)
             for block in _blocks(items, item_col, item_text_col, block_terms)]
    schema = "item_id long, rank int, doc_id long, score long"
    out = docs.sparkSession.createDataFrame([], schema)
    for rows in found:
        out = out.union(rows)
    return out.withColumnRenamed("item_id", item_col).withColumnRenamed("doc_id", id_col)


def _block_searched(docs: DataFrame, block: list[tuple[int, list[bytes]]], k: int, id_col: str, text_col: str,
                    segment_docs: int, probe: int) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = {w: i for i, w in enumerate(sorted({w for _, words in block for w in words}))}
    table = written(segments(docs, vocabulary, id_col, text_col, segment_docs))
    n_docs, n_terms, n_segments = table.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0)),
                                            F.count(F.lit(1))).first()
    df = document_frequencies(table, len(vocabulary))
    weights = np.array([weight(n_docs, d) for d in df.tolist()], np.int64)
    chains, pairs = _chains([[vocabulary[w] for w in words] for _, words in block], weights, df)
    index = written(indexed(table, weights, n_docs, n_terms, list(pairs)))
    thresholds = [1] * len(chains)
    if n_segments > 4 * probe:
        some = [r[0] for r in index.select("segment").orderBy(F.xxhash64("segment"), "segment").limit(probe).collect()]
        first = _ranked(_searched(index.where(F.col("segment").isin(some)), chains, thresholds, k), k)
        for query, score in first.where(F.col("rank") == k).select("query", "score").collect():
            thresholds[query] = max(1, score)
    ranked = _ranked(_searched(index, chains, thresholds, k), k)
    names = spark.createDataFrame(list(enumerate(key for key, _ in block)), "query long, item_id long")
    return ranked.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best_first = Window.partitionBy("query").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)


def _chains(queries: list[list[int]], weights: np.ndarray, df: np.ndarray):
    """Each query's terms that any document has, light ones first, and the pairs of neighbours with their places."""
    pairs: dict[tuple[int, int], int] = {}
    chains = []
    for terms in queries:
        distinct, times = np.unique(np.array(terms, np.int64), return_counts=True)
        some = df[distinct] > 0
        distinct, times = distinct[some], times[some]
        order = np.lexsort((distinct, weights[distinct]))
        chain, before = [], -1
        for term, n in zip(distinct[order].tolist(), times[order].tolist()):
            pair = pairs.setdefault((before, term), len(pairs)) if before >= 0 else -1
            chain.append((term, n, pair))
            before = term
        chains.append(chain)
    return chains, pairs
