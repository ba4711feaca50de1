"""Exact n-gram Jaccard join in the metric space of shingle sets.

The Jaccard distance is a metric, so pivots divide the documents into Voronoi regions, and the triangle
inequality says which other regions a document within the radius of a border has to be shown to.

First level. Pivots are single shingles. All pivots inside a document are equally near, so a fixed order of
pivots decides, frequent shingles last. Two sets within the radius share one of their first few pivots: a set of n
that lies within distance 1 - t of another has at most n - ceil(t n) shingles outside it. A document is shown to
the regions of that many pivots and one more. Regions of up to `small` sets are joined as they are; the number of
regions that two sets share also bounds what they can have in common, which drops most chance meetings.

Windows inside a region. If a region's pivot is the first that two sets share, they have at most as much in common as
either has from this pivot on. So a set of n shingles, r of them from the pivot on, is within the radius only of sets of
at most (1 + 1 / t) r - n shingles: its window of sizes, outside which no partner has to be looked at. Sets that are each
far from a common template by shingles of their own have no partner in each other's windows, however many they are.

Second level. In a larger region the sets nearest its pivot (with the fewest shingles before it) become pivots
themselves, and each set is measured against those of one of its regions. Sets that links already connect need no more
links between them, so a region whose sets are all connected is done. In the others only pairs of different components
that are in each other's windows are left to measure. Where these are too many to list, the region is cut into blocks,
and tasks compare the sets of two blocks where they are and pass on links alone.

Sketches. A set's sketch tells for each of about as many places as it has shingles whether an odd number of them falls
there. Where two sketches differ the sets differ, so sketches bound from above what the sets have in common, in a
fiftieth of their bytes. Only pairs that their sketches allow are measured, and only their sets are made once more.

Equal sets are one class throughout. Distances are computed on whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqtally.llm.common import written
from seqtally.llm.components import UnionFind, components
from seqtally.llm.shingles import WIDTH, set_key, shingle_sets
from seqtally.session import discard

NUMERATOR, DENOMINATOR = 4, 5  # similarity 0.8


def window(n: np.ndarray | int, num: int = NUMERATOR, den: int = DENOMINATOR) -> np.ndarray | int:
    """How many pivots, in order, a set of n shingles is shown to."""
    return n - (-(-num * n // den)) + 1


def sketch(found: np.ndarray) -> bytes:
    """For each of a power of two of places, at least 64 and at least as many as shingles, a bit: whether an odd number
    of shingles falls there."""
    places = max(64, 1 << (max(1, len(found)) - 1).bit_length())
    at = (found & np.uint64(places - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=places) & 1).astype(np.uint8), bitorder="little").tobytes()


def may_link(x: bytes, y: bytes, both: int) -> bool:
    """Whether sets of these sketches, of `both` shingles together, may be within the radius: shingles that only one
    set has are at least as many as the places where the sketches differ."""
    p, q = int.from_bytes(x, "little"), int.from_bytes(y, "little")
    if len(x) < len(y):
        x, y, p, q = y, x, q, p
    n = 8 * len(x)
    while n > 8 * len(y):  # half the places: those that fall together
        n //= 2
        p = (p >> n) ^ (p & ((1 << n) - 1))
    return (DENOMINATOR + NUMERATOR) * (both - (p ^ q).bit_count()) >= 2 * NUMERATOR * both


def fingerprints(docs: DataFrame, id_col: str, text_col: str, width: int, often: float = 0.0003) -> DataFrame:
    """`_id, n, key, sketch` per document, and rows with a null key for shingles that are frequent among the documents a
    task saw together: the shingle in `_shingle` and in n the documents that held it."""
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4000):
                batch = whole.slice(at, 4000)
                found = list(shingle_sets(batch.column(1).to_pylist(), width))
                shingles, counts = np.unique(np.concatenate(found), return_counts=True)
                some = counts >= max(3, often * len(found))
                k, n = int(some.sum()), len(found)
                yield pa.RecordBatch.from_arrays([
                    pa.concat_arrays([batch.column(0), pa.nulls(k, pa.int64())]),
                    pa.array(np.concatenate([[len(f) for f in found], counts[some]]).astype(np.int64)),
                    pa.concat_arrays([pa.array([set_key(f) for f in found], pa.int64()), pa.nulls(k, pa.int64())]),
                    pa.concat_arrays([pa.array([sketch(f) for f in found], pa.binary()), pa.nulls(k, pa.binary())]),
                    pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(shingles[some].view(np.int64))])],
                    ["_id", "n", "key", "sketch", "_shingle"])

    return rows.mapInArrow(run, "_id long, n long, key long, sketch binary, _shingle long")


def size_window(n: np.ndarray, i: np.ndarray) -> np.ndarray:
    """The most shingles that a partner may have for a set of n with i shingles before the region's pivot."""
    return (DENOMINATOR + NUMERATOR) * (n - i) // NUMERATOR - n


def _shown(docs: DataFrame, text_col: str, width: int, frequent: np.ndarray, hot: np.ndarray) -> DataFrame:
    """`shingle, key, n, i` for the pivots whose regions a document is shown to, i of its shingles before the pivot;
    each set once per task. In regions that are known to be large n is negative.

    `frequent` lists shingles in the order in which they come after all others, `hot` tells which have large regions."""
    order = np.argsort(frequent)
    shared = docs.sparkSession.sparkContext.broadcast((frequent[order], order, hot[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, rank, large = shared.value
        seen: set[int] = set()
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                pivots, keys, sizes, places = [], [], [], []
                for found in shingle_sets(whole.column(0).slice(at, 1000).to_pylist(), width):
                    key = set_key(found)
                    if not len(found) or key in seen:
                        continue
                    if len(seen) < 1_000_000:  # only saves repeated rows
                        seen.add(key)
                    n = len(found)
                    take = window(n)
                    sign = np.ones(take, dtype=np.int32)
                    if len(listed):
                        place = np.minimum(np.searchsorted(listed, found), len(listed) - 1)
                        late = listed[place] == found
                        turn = np.argsort(rank[place[late]])
                        first = found[~late]
                        if len(first) < take:
                            sign[len(first):] -= 2 * large[place[late]][turn][:take - len(first)].astype(np.int32)
                        found = np.concatenate([first, found[late][turn]])
                    pivots.append(found[:take])
                    keys.append(np.full(take, key, dtype=np.int64))
                    sizes.append(n * sign)
                    places.append(np.arange(take, dtype=np.int32))
                if pivots:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(pivots).view(np.int64)), pa.array(np.concatenate(keys)),
                         pa.array(np.concatenate(sizes).astype(np.int32)), pa.array(np.concatenate(places))],
                        ["shingle", "key", "n", "i"])

    return docs.select(F.col(text_col).cast("string")).mapInArrow(run, "shingle long, key long, n int, i int")


def _meetings(shown: DataFrame, small: int) -> DataFrame:
    """Regions one by one. Of a small one, rows (a, b, na, nb) for its pairs of fitting size, region null; of a large
    one its members (a, na, nb = shingles before the pivot) with the region's number.

    The members of regions that are known to be large are dealt out singly and pass through.
    """

    def emit(s: np.ndarray, key: np.ndarray, n: np.ndarray, place: np.ndarray) -> Iterator[pa.RecordBatch]:
        first = np.concatenate([[True], (s[1:] != s[:-1]) | (key[1:] != key[:-1])])  # a set may come from several tasks
        s, key, n, place = s[first], key[first], n[first], place[first]
        starts = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        sizes = np.diff(np.append(starts, len(s)))
        known = n < 0
        n = np.abs(n)
        sizes[known[starts]] = small + 1
        pairs: list[tuple[np.ndarray, np.ndarray]] = []
        for size in np.unique(sizes[(sizes > 1) & (sizes <= small)]).tolist():
            i, j = np.triu_indices(size, 1)
            at = starts[sizes == size]
            for b in range(0, len(at), max(1, 200_000 // len(i))):
                some = at[b:b + max(1, 200_000 // len(i)), None]
                x, y = (some + i).ravel(), (some + j).ravel()
                fits = DENOMINATOR * np.minimum(n[x], n[y]) >= NUMERATOR * np.maximum(n[x], n[y])
                pairs.append((x[fits], y[fits]))
        large = np.repeat(sizes > small, np.diff(np.append(starts, len(s))))
        x = np.concatenate([p for p, _ in pairs] or [np.empty(0, np.int64)])
        y = np.concatenate([p for _, p in pairs] or [np.empty(0, np.int64)])
        m = int(large.sum())
        if len(x) + m:
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([pa.nulls(len(x), pa.int64()), pa.array(s[large])]),
                pa.array(np.concatenate([key[x], key[large]])),
                pa.concat_arrays([pa.array(key[y]), pa.nulls(m, pa.int64())]),
                pa.array(np.concatenate([n[x], n[large]]).astype(np.int32)),
                pa.array(np.concatenate([n[y], place[large]]).astype(np.int32))], ["region", "a", "b", "na", "nb"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[list[np.ndarray]] = []
        for batch in batches:
            now = [c.to_numpy() for c in batch.columns]
            cut = int(np.searchsorted(now[0], now[0][-1]))  # the last region may go on
            if cut:
                yield from emit(*(np.concatenate([p[k] for p in parts] + [now[k][:cut]]) for k in range(4)))
                parts = []
            parts.append([c[cut:] for c in now])
        if parts:
            yield from emit(*(np.concatenate([p[k] for p in parts]) for k in range(4)))

    deal = F.when(F.col("n") < 0, F.xxhash64("shingle", "key")).otherwise(F.col("shingle"))
    return (shown.repartition(deal).sortWithinPartitions("shingle", "key")
            .mapInArrow(run, "region long, a long, b long, na int, nb int"))


def _possible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Those of `pairs(a, b)` that may be links by the sizes and sketches in `classes(key, n, sketch)`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [may_link(x, y, n + m) for x, y, n, m in
                    zip(*(batch.column(c).to_pylist() for c in ("_x", "_y", "_n", "_m")))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = classes.select(F.col("key").alias("a"), F.col("n").alias("_n"), F.col("sketch").alias("_x"))
    two = classes.select(F.col("key").alias("b"), F.col("n").alias("_m"), F.col("sketch").alias("_y"))
    return pairs.select("a", "b").join(one, "a").join(two, "b").mapInArrow(run, "a long, b long")


def _bitmap(ids: DataFrame, most: int = 27) -> tuple[np.ndarray, int]:
    """Words of a bitmap of 2^bits places, of which those that the hashes of `_id` begin with are marked; a table of ids
    that is never gathered itself. Beyond 2^most places more ids than the listed ones hit a mark."""
    bits = min(most, max(16, (32 * ids.count()).bit_length()))
    places = ids.select(F.shiftrightunsigned(F.xxhash64("_id"), 64 - bits).alias("place"))
    words = places.groupBy(F.shiftright("place", 6).alias("at")).agg(
        F.expr("bit_or(shiftleft(1L, cast(place & 63 as int)))").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    out[words.column("at").to_numpy()] = words.column("bits").to_numpy()
    return out.view(np.uint64), bits


def _sets_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """`key, shingles` for the classes in `wanted(_id)` at least; texts of other documents, but for a few, stay where
    they are."""
    marks, bits = _bitmap(wanted)
    shared = docs.sparkSession.sparkContext.broadcast(marks)
    i = F.col(id_col).cast("long")
    rows = docs.select(F.xxhash64(i).alias("_h"), F.col(text_col).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = shared.value
        for whole in batches:
            at = whole.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - bits)
            hit = np.flatnonzero(listed[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1))
            for b in range(0, len(hit), 500):
                texts = whole.column(1).take(pa.array(hit[b:b + 500])).to_pylist()
                found = [(set_key(f), f.tobytes()) for f in shingle_sets(texts, width)]
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int64()),
                                                  pa.array([x for _, x in found], pa.binary())], ["key", "shingles"])

    return rows.mapInArrow(run, "key long, shingles binary").dropDuplicates(["key"])


def _measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """`a, b, common, na, nb` from the whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x, y in zip(batch.column("_x"), batch.column("_y")):
                p, q = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                if len(p) > len(q):
                    p, q, turned = q, p, True
                else:
                    turned = False
                at = np.minimum(np.searchsorted(q, p), max(len(q) - 1, 0))
                common = int((q[at] == p).sum()) if len(q) else 0
                out.append((common, len(q) if turned else len(p), len(p) if turned else len(q)))
            columns = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), *[pa.array(c, pa.int64()) for c in columns]],
                ["a", "b", "common", "na", "nb"])

    one = sets.select(F.col("key").alias("a"), F.col("shingles").alias("_x"))
    two = sets.select(F.col("key").alias("b"), F.col("shingles").alias("_y"))
    return pairs.select("a", "b").join(one, "a").join(two, "b").mapInArrow(
        run, "a long, b long, common long, na long, nb long")


def is_link(common: Column, na: Column, nb: Column) -> Column:
    return DENOMINATOR * common >= NUMERATOR * (na + nb - common)


def _labelled(rows: DataFrame, labels: DataFrame | None, key: str, label: str) -> DataFrame:
    """Adds the component that a class is known to be in; itself if no link is known."""
    if labels is None:
        return rows.withColumn(label, F.col(key))
    named = labels.select(F.col("node").alias(key), F.col("component_id").alias(label))
    return rows.join(named, key, "left").withColumn(label, F.coalesce(label, key))


def in_windows(n: Column, i: Column, m: Column, j: Column) -> Column:
    """Whether two sets of a region are in each other's windows of sizes."""
    return (DENOMINATOR + NUMERATOR) * F.least(n - i, m - j) >= NUMERATOR * (n + m)


def _star(large: DataFrame, pivots: int) -> DataFrame:
    """`a, b`: each set with the pivots of the first of its large regions, if they are in each other's windows.

    Pivots are the sets with the smallest share of shingles before the region's own pivot; lanes keep them apart."""
    home = large.groupBy("a").agg(F.min(F.struct("i", "region", "na")).alias("_h")).select(
        "a", "_h.region", "_h.na", "_h.i")
    lane = F.pmod(F.xxhash64("a"), F.lit(pivots))
    nearest = F.struct((F.col("i") / F.col("na")).alias("d"), F.xxhash64("a").alias("o"), F.col("a").alias("b"),
                       F.col("na").alias("nb"), F.col("i").alias("j"))
    chosen = large.groupBy("region", lane.alias("_lane")).agg(F.min(nearest).alias("_p")).select(
        "region", "_p.b", "_p.nb", "_p.j")
    return home.join(chosen, "region").where(
        (F.col("a") != F.col("b")) & in_windows(F.col("na"), F.col("i"), F.col("nb"), F.col("j"))).select("a", "b")


def _apart(region: DataFrame, small: int, block: int = 1 << 16) -> DataFrame:
    """What regions `region, a, na, i, la` leave to measure: rows `a, b` of pairs in each other's windows from different
    components, or, where a region has more than `small` of these a set, its members with b null.

    A region of more than `block` sets is cut into as many blocks, and pairs of blocks go to a task each."""
    sizes = region.groupBy("region").agg(F.count(F.lit(1)).alias("_size"), F.min("la").alias("_lo"),
                                         F.max("la").alias("_hi")).where("_lo <> _hi")
    blocks = (1 + F.floor(F.col("_size") / block)).cast("int")
    mine = F.pmod(F.xxhash64("a"), F.col("_blocks")).cast("int")
    open_ = (region.join(sizes.select("region", blocks.alias("_blocks")), "region").withColumn("_mine", mine)
             .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
             .select("region", F.least("_mine", "_other").alias("_x"), F.greatest("_mine", "_other").alias("_y"),
                     "_mine", "a", "na", "i", "la"))

    def emit(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        (region_,), (x_,), (y_,) = (np.unique(r) for r in rows[:3])
        mine_, a, n, i, label = rows[3:]
        n, i = n.astype(np.int64), i.astype(np.int64)
        order = np.lexsort((a, n))
        mine_, a, n, most, label = mine_[order], a[order], n[order], size_window(n, i)[order], label[order]
        labels, counts = np.unique(label, return_counts=True)
        minor = np.flatnonzero(label != labels[np.argmax(counts)])
        found, total = [], 0
        for at in range(0, len(minor), 512):
            p = minor[at:at + 512]
            low, high = n[p[0]] * NUMERATOR // DENOMINATOR, most[p].max()
            q = np.flatnonzero((n >= low) & (n <= high) & (most >= n[p[0]]))
            meets = ((n[q] <= most[p, None]) & (n[p, None] <= most[q]) & (label[p, None] != label[q])
                     & (DENOMINATOR * np.minimum(n[p, None], n[q]) >= NUMERATOR * np.maximum(n[p, None], n[q])))
            if x_ != y_:
                meets &= mine_[p, None] != mine_[q]
            u, v = np.nonzero(meets)
            found.append((a[p[u]], a[q[v]]))
            total += len(u)
            if total > small * len(a):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), region_)), pa.array(a), pa.nulls(len(a), pa.int64())],
                                                 ["region", "a", "b"])
                return
        if total:
            u, v = (np.concatenate(c) for c in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.nulls(total, pa.int64()), pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))],
                                             ["region", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[list[np.ndarray]] = []

        def cuts(now: list[np.ndarray]) -> np.ndarray:
            return np.flatnonzero((np.diff(now[0]) != 0) | (np.diff(now[1]) != 0) | (np.diff(now[2]) != 0)) + 1

        for batch in batches:
            now = [c.to_numpy() for c in batch.columns]
            if parts and any(parts[-1][k][-1] != now[k][0] for k in range(3)):
                yield from emit([np.concatenate([p[k] for p in parts]) for k in range(8)])
                parts = []
            begin = 0
            for cut in cuts(now).tolist():
                yield from emit([np.concatenate([p[k] for p in parts] + [now[k][begin:cut]]) for k in range(8)])
                parts, begin = [], cut
            parts.append([c[begin:] for c in now])
        if parts:
            yield from emit([np.concatenate([p[k] for p in parts]) for k in range(8)])

    return (open_.repartition("region", "_x", "_y").sortWithinPartitions("region", "_x", "_y")
            .mapInArrow(run, "region long, a long, b long"))


def _dense_links(members: DataFrame, sets: DataFrame, block: int = 1024) -> DataFrame:
    """Links `a, b` inside regions `region, a, la` too dense to list their pairs; sets of one component are not
    compared. Tasks hold the sets of two blocks and pass on a spanning forest of what they link."""
    sizes = members.groupBy("region").agg((1 + F.floor(F.count(F.lit(1)) / block)).cast("int").alias("_blocks"))
    dealt = (members.join(sizes, "region").withColumn("_mine", F.pmod(F.xxhash64("a"), F.col("_blocks")).cast("int"))
             .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
             .select(F.xxhash64("region", F.least("_mine", "_other"), F.greatest("_mine", "_other")).alias("_g"), "a", "la")
             .join(sets.withColumnRenamed("key", "a"), "a").select("_g", "a", "la", "shingles"))

    def compare(keys: list[int], labels: list[int], held: list[np.ndarray]) -> Iterator[tuple[int, int]]:
        forest = UnionFind()
        for key, label in zip(keys, labels):
            forest.join(key, label)
        sizes = np.array([len(h) for h in held])
        words, codes = np.unique(np.concatenate(held), return_inverse=True)
        starts = np.cumsum(sizes) - sizes
        mark = np.zeros(len(words), dtype=np.int64)
        for at in range(len(held)):
            own = codes[starts[at]:starts[at] + sizes[at]]
            mark[own] = 1
            common = np.add.reduceat(mark[codes[starts[at]:]], starts[at:] - starts[at])
            mark[own] = 0
            near = DENOMINATOR * common >= NUMERATOR * (sizes[at:] + sizes[at] - common)
            for other in (np.flatnonzero(near[1:]) + at + 1).tolist():
                if forest.join(keys[at], keys[other]):
                    yield keys[at], keys[other]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, keys, labels, held = None, [], [], []

        def done() -> pa.RecordBatch:
            links = list(compare(keys, labels, held))
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()),
                                               pa.array([y for _, y in links], pa.int64())], ["a", "b"])

        for batch in batches:
            for at, g in enumerate(batch.column("_g").to_pylist()):
                if g != group and keys:
                    yield done()
                    keys, labels, held = [], [], []
                group = g
                keys.append(batch.column("a")[at].as_py())
                labels.append(batch.column("la")[at].as_py())
                held.append(np.frombuffer(batch.column("shingles")[at].as_py(), dtype=np.uint64))
        if keys:
            yield done()

    return dealt.repartition("_g").sortWithinPartitions("_g", "a").mapInArrow(run, "a long, b long")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                       small: int = 128, pivots: int = 3, most_frequent: int = 1 << 20) -> DataFrame:
    """`doc_id, n_shingles, component_id`, one row per input row.

    Null and empty texts have no shingles and link with nothing, as do rows with a null id, whose component is null.
    Repeated rows and rows under one id are in one component if their sets are alike. Similarity exactly at the
    bound links. An empty table gives no rows. Other columns are not read. Sets are compared as 64-bit hashes of
    their shingles.

    `small` and `pivots` only steer the work. `most_frequent` bounds the list of shingles that come last,
    which changes no result either.
    """
    prints = written(fingerprints(docs, id_col, text_col, width))
    rows = prints.where("key is not null").select("_id", "n", "key")
    n_docs = max(1, rows.count())
    # Shingles of at least one document in 5000: no more of them than 5000 documents have shingles.
    listed = (prints.where("key is null").groupBy("_shingle").agg(F.sum("n").alias("n"))
              .where(F.col("n") >= max(8, n_docs // 5000)).orderBy(F.desc("n"), "_shingle").limit(most_frequent).collect())
    frequent = np.array([r[0] for r in reversed(listed)], dtype=np.int64).view(np.uint64)
    hot = np.array([r[1] > 8 * small for r in reversed(listed)], dtype=bool)
    classes = written(prints.where("key is not null and n > 0 and _id is not null").groupBy("key").agg(
        F.min("_id").alias("_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch")))
    met = written(_meetings(_shown(docs, text_col, width, frequent, hot), small))
    large = met.where("region is not null").select("region", "a", "na", F.col("nb").alias("i"))

    # Two sets share at most the small regions where they met, the large ones both may be in, and what lies behind
    # the windows.
    in_large = large.groupBy("a").agg(F.count(F.lit(1)).alias("_l"))
    behind = lambda n: F.ceil(F.lit(NUMERATOR) * F.col(n) / DENOMINATOR) - 1
    counted = (met.where("b is not null")
               .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
                       F.when(F.col("a") < F.col("b"), F.col("na")).otherwise(F.col("nb")).alias("na"),
                       F.when(F.col("a") < F.col("b"), F.col("nb")).otherwise(F.col("na")).alias("nb"))
               .groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("_c"))
               .join(in_large, "a", "left")
               .join(in_large.select(F.col("a").alias("b"), F.col("_l").alias("_m")), "b", "left"))
    bound = (F.col("_c") + F.least(F.coalesce("_l", F.lit(0)), F.coalesce("_m", F.lit(0)))
             + F.greatest(behind("na"), behind("nb")))
    pairs = written(_possible(counted.where(is_link(bound, F.col("na"), F.col("nb"))).select("a", "b"), classes))

    def sets_of(keys: DataFrame) -> DataFrame:
        return written(_sets_of(docs, keys.distinct().join(classes, "key").select("_id"), id_col, text_col, width))

    def labelled(found: DataFrame, labels: DataFrame | None, more: DataFrame | None = None) -> DataFrame:
        """Components by the links among the pairs found, those known and those given."""
        found = written(found)
        sets = sets_of(found.select(F.col("a").alias("key")).union(found.select("b")))
        links = _measured(found, sets).where(is_link(F.col("common"), F.col("na"), F.col("nb"))).select("a", "b")
        if labels is not None:
            links = links.union(labels.select(F.col("node").alias("a"), F.col("component_id").alias("b")))
        out = components(links if more is None else links.union(more), "a", "b")
        discard(found, sets)
        return out

    # One partner of each set, and a few pivots for all of a large region, first; then what these have not connected.
    partner = pairs.groupBy(F.col("b").alias("a")).agg(F.min("a").alias("b"))
    labels = labelled(partner.union(_possible(_star(large, pivots), classes)).distinct(), None)
    left = written(_apart(_labelled(large, labels, "a", "la"), small))
    discard(met)
    near = _labelled(_labelled(pairs, labels, "a", "la"), labels, "b", "lb").where("la <> lb").select("a", "b")
    due = near.union(_possible(left.where("b is not null").select("a", "b").distinct(), classes)).distinct()
    dense = left.where("b is null").select("region", "a").distinct()
    links = None if dense.isEmpty() else written(_dense_links(
        _labelled(dense, labels, "a", "la"), sets_of(dense.select(F.col("a").alias("key")))))
    labels = labelled(due, labels, links)
    discard(pairs, left)

    # From class keys to smallest ids.
    placed = _labelled(classes, labels, "key", "_label")
    smallest = placed.groupBy("_label").agg(F.min("_id").alias("component_id"))
    reached = placed.join(smallest, "_label").select("key", "component_id")
    alone = F.col("n").eqNullSafe(F.lit(0)) | F.col("_id").isNull()
    return (rows.where(~alone).join(reached, "key").select("_id", "n", "component_id")
            .union(rows.where(alone).select("_id", "n", "_id"))
            .select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id"))
