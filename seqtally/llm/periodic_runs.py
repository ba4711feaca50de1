"""Runs: maximal stretches of words that repeat with a period.

Every run of period p spans two neighbouring points of the grid 0, p, 2p, ...; summed over all p these harmonic grids
have n log n points. At a pair of grid points with equal words, the longest common extension forwards and backwards
gives the run around it, if it is long enough.

Common extensions come from a difference cover modulo 13: of any two positions, some shift below 13 takes both to
sampled ones, of which there are 4 in 13. Only sampled suffixes are sorted, by their first 13 words and then by
doubling, ties only. An extension compares the few words before the sampled positions, and takes the rest as the
minimum of common prefixes between their ranks, from a sparse table.

Many texts are handled at once: words of different texts never count as equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtally.llm.shingles import chunked

MODULUS, COVER = 13, (0, 1, 3, 9)  # the differences of the cover are all numbers modulo 13
MIN_LENGTH = 12


def _shifts() -> np.ndarray:
    sampled = np.isin(np.arange(2 * MODULUS) % MODULUS, COVER)
    return np.array([[next(d for d in range(MODULUS) if sampled[a + d] and sampled[b + d]) for b in range(MODULUS)]
                     for a in range(MODULUS)], dtype=np.int64)


SHIFT = _shifts()
PLACE = np.full(MODULUS, -1, dtype=np.int64)
PLACE[list(COVER)] = np.arange(len(COVER))


class Extensions:
    """Longest common extensions of positions of one array in constant time each.

    `text` numbers the texts that the array holds one after another, `word` the words.
    """

    def __init__(self, text: np.ndarray, word: np.ndarray) -> None:
        n, pad = len(word), 2 * MODULUS
        self.text = np.concatenate([text, -1 - np.arange(pad)])  # what follows the end is equal to nothing
        self.word = np.concatenate([word, np.zeros(pad, np.int64)])
        blocks = np.arange((n + MODULUS) // MODULUS, dtype=np.int64)
        self.sampled = (blocks[:, None] * MODULUS + np.array(COVER)).ravel()
        self._sort()
        self._prefixes()

    def _sort(self) -> None:
        at, n = self.sampled, len(self.sampled)
        bits = 1 + max(1, int(self.word.max()).bit_length())
        each = max(1, 63 // bits)
        # A word beyond the end of the text is marked, so a stretch that leaves its text is equal to no other.
        keys = [self.text[at]]
        for first in range(0, MODULUS, each):
            key = np.zeros(n, np.int64)
            for k in range(first, min(first + each, MODULUS)):
                out = (self.text[at + k] != keys[0]).astype(np.int64)
                key = (key << bits) | (out << (bits - 1)) | self.word[at + k]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        new = np.ones(n, bool)
        new[1:] = False
        for key in keys:
            placed = key[order]
            new[1:] |= placed[1:] != placed[:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
        self.levels, step = [rank], len(COVER)
        while True:
            sizes = np.bincount(rank, minlength=n)
            tied = np.flatnonzero(sizes[rank] > 1)
            if not len(tied):
                break
            follows = rank[tied + step]
            by = np.lexsort((follows, rank[tied]))
            tied, follows, group = tied[by], follows[by], rank[tied][by]
            starts = np.ones(len(tied), bool)
            starts[1:] = group[1:] != group[:-1]
            new = starts.copy()
            new[1:] |= follows[1:] != follows[:-1]
            within = np.arange(len(tied)) - np.flatnonzero(starts)[np.cumsum(starts) - 1]
            rank = rank.copy()
            rank[tied] = group + within[np.flatnonzero(new)[np.cumsum(new) - 1]]
            self.levels.append(rank)
            step *= 2
        self.rank = rank

    def _prefixes(self) -> None:
        """Common prefixes of neighbours in the order of suffixes, and the sparse table of their minima."""
        order = np.empty(len(self.rank), np.int64)
        order[self.rank] = np.arange(len(self.rank))
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(a), np.int64)
        for level in reversed(range(len(self.levels))):
            same = self.levels[level][a] == self.levels[level][b]
            common += same * (MODULUS << level)
            a += same * (len(COVER) << level)
            b += same * (len(COVER) << level)
        common += self._compared(self.sampled[a], self.sampled[b], np.full(len(a), MODULUS))
        self.minima = [common]
        width = 1
        while 2 * width <= len(common):
            last = self.minima[-1]
            self.minima.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def _compared(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Common words from i and j on, at most as many as given."""
        common = np.zeros(len(i), np.int64)
        open_ = np.flatnonzero(most > 0)
        for k in range(MODULUS):
            x, y = i[open_] + k, j[open_] + k
            open_ = open_[(self.word[x] == self.word[y]) & (self.text[x] == self.text[y])]
            common[open_] = k + 1
            open_ = open_[most[open_] > k + 1]
            if not len(open_):
                break
        return common

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common words from i and j on; i and j differ."""
        shift = SHIFT[i % MODULUS, j % MODULUS]
        common = self._compared(i, j, shift)
        go = np.flatnonzero(common == shift)
        x, y = i[go] + shift[go], j[go] + shift[go]
        x, y = (self.rank[v // MODULUS * len(COVER) + PLACE[v % MODULUS]] for v in (x, y))
        low, high = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp((high - low).astype(float))[1] - 1
        least = np.empty(len(go), np.int64)
        for k in np.unique(level).tolist():
            some = level == k
            table = self.minima[k]
            least[some] = np.minimum(table[low[some]], table[high[some] - (1 << k)])
        common[go] += least
        return common


def grid_pairs(letters: np.ndarray, sizes: np.ndarray, min_length: int, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, p), about `most` grid points at a time: neighbouring grid points i and i + p with the same word, beside which
    at least three further pairs of words on one side agree or, counting i itself, on the other.

    A run of a period p and a length from `min_length` and 2 p on has at least max(p, min_length - p) such pairs of
    words in a row, six or more, so one of its grid points is found. Texts are sorted by falling size.
    """
    least = -(-min_length // 2) // 2  # half of the pairs in a row that there are at least
    ends = np.cumsum(sizes)
    longest = int(sizes[0]) // 2 if len(sizes) else 0
    pad = np.arange(1, least + 1)
    framed = np.concatenate([-pad, letters, -least - pad])
    p = 1
    while p <= longest:
        # Texts of at least 2 p words, which come first, are all that matter for p.
        n = int(ends[np.searchsorted(-sizes, -2 * p, side="right") - 1])
        q, points = p, 0
        while q <= longest and points + n // q <= most or q == p:
            points += n // q
            q += 1
        periods = np.arange(p, q)
        counts = np.maximum((n - 1) // periods, 0)
        step = np.repeat(periods, counts)
        i = (np.arange(len(step)) - np.repeat(np.cumsum(counts) - counts, counts)) * step
        same = np.flatnonzero(letters[i] == letters[i + step])
        i, step = i[same], step[same]
        ahead, behind = np.ones(len(i), bool), np.ones(len(i), bool)
        for k in range(1, least + 1):
            x = i + least
            if k < least:
                ahead &= framed[x + k] == framed[x + step + k]
            behind &= framed[x - k] == framed[x + step - k]
        some = ahead | behind
        yield i[some], step[some]
        p = q


def runs_of(texts: list[np.ndarray], min_length: int = MIN_LENGTH) -> list[np.ndarray]:
    """For each text (its words as numbers) its runs, rows (start, length, period) in order of start and period.

    A run has its smallest period, at least `min_length` words and two periods, and ends where its period does.
    """
    empty = np.empty((0, 3), np.int64)
    out = [empty] * len(texts)
    long = [d for d in range(len(texts)) if len(texts[d]) >= min_length]
    # Texts with any candidate first: the others need no sorting.
    found = _arranged(texts, long)
    if found is None:
        return out
    order, sizes, text, word, letters = found
    starts = np.cumsum(sizes) - sizes
    some = np.zeros(len(order), bool)
    for i, _ in grid_pairs(letters, sizes, min_length):
        some[np.searchsorted(starts, i, side="right") - 1] = True
    found = _arranged(texts, [order[k] for k in np.flatnonzero(some).tolist()])
    if found is None:
        return out
    order, sizes, text, word, letters = found
    n = len(word)
    ahead, behind = Extensions(text, word), Extensions(text[::-1], word[::-1])
    runs = empty
    for i, p in grid_pairs(letters, sizes, min_length):
        for b in range(0, len(i), 1 << 18):
            at, q = i[b:b + (1 << 18)], p[b:b + (1 << 18)]
            after, before = ahead.of(at, at + q), behind.of(n - at, n - at - q)
            start, end = at - before, at + q + after
            fits = (after + before >= q) & (end - start >= min_length)
            runs = _smallest(np.concatenate([runs, np.stack([start, end, q], 1)[fits]]))
    starts = np.cumsum(sizes) - sizes
    of = np.searchsorted(starts, runs[:, 0], side="right") - 1
    runs[:, 1] -= runs[:, 0]
    runs[:, 0] -= starts[of]
    limits = np.searchsorted(of, np.arange(len(order) + 1))
    for k, d in enumerate(order):
        mine = runs[limits[k]:limits[k + 1]]
        out[d] = mine[np.lexsort((mine[:, 2], mine[:, 0]))]
    return out


def _arranged(texts: list[np.ndarray], which: list[int]):
    if not which:
        return None
    order = sorted(which, key=lambda d: -len(texts[d]))
    sizes = np.array([len(texts[d]) for d in order])
    word = np.concatenate([texts[d] for d in order]).astype(np.int64)
    text = np.repeat(np.arange(len(order), dtype=np.int64), sizes)
    return order, sizes, text, word, text * (int(word.max()) + 1) + word


def _smallest(runs: np.ndarray) -> np.ndarray:
    """Of equal (start, end) the smallest period: a run is also found with multiples of its period."""
    order = np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))
    runs = runs[order]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    return runs[first]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """`doc_id, runs, collapsed`, one row per input row: the runs of words as (start, length, period) in order of start
    and period, and the text without the words that repeat a run's first period.

    Words stand between ASCII white space and are compared exactly. Null and empty texts have no words, no runs and
    an empty collapsed text. Repeated rows come out as often as they go in; a null id stays null. An empty table gives
    no rows; other columns are not read. `min_length` is 12 at least, so that grid points can be told by their
    neighbours.
    """
    if min_length < 12:
        raise ValueError("min_length is at least 12")
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first, raws in chunked(whole.column(1).to_pylist()):
                numbers: dict[bytes, int] = {}
                words = [raw.split() for raw in raws]
                texts = [np.fromiter((numbers.setdefault(w, len(numbers)) for w in ws), np.int64, len(ws)) for ws in words]
                found = runs_of(texts, min_length)
                limits = np.cumsum([0, *map(len, found)]).astype(np.int32)
                rows = np.concatenate(found)
                spans = pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(3)], ["start", "length", "period"])
                texts_left = pa.array([collapsed(ws, r) for ws, r in zip(words, found)], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [whole.column(0).slice(first, len(raws)), pa.ListArray.from_arrays(pa.array(limits), spans), texts_left],
                    ["_id", "runs", "collapsed"])

    schema = f"_id {kind}, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return (docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
            .mapInArrow(run, schema).withColumnRenamed("_id", id_col))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """`doc_id, text`, where a tenth of the documents, chosen by id, repeat a stretch of their words to the end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), h.alias("_h"),
                       F.floor(h / 10).alias("_g"),
                       F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^ \t-\r]+)"), F.lit(1))).alias("_w"))
    rows = rows.withColumn("_n", F.size("_w")).withColumn("_a", F.when(F.col("_n") > 0, (F.col("_g") % F.col("_n")).cast("int")))
    rest = F.col("_n") - F.col("_a")
    rows = rows.withColumn("_p", (1 + F.floor(rest / (3 + F.col("_g") % 8))).cast("int"))
    times = F.ceil(rest / F.col("_p")).cast("int")
    repeated = F.slice(F.flatten(F.array_repeat(F.slice("_w", F.col("_a") + 1, F.col("_p")), times)), F.lit(1), rest)
    text = F.when(F.col("_n") > 0, F.array_join(F.concat(F.slice("_w", F.lit(1), F.col("_a")), repeated), " "))
    return rows.select("doc_id", F.when(F.col("_n") > 0, text).otherwise(F.col("text")).alias("text"))


def runs_digest(docs: DataFrame) -> DataFrame:
    """Number of runs, the greatest, and digests of all of them and of the text without repeats."""
    found = periodic_runs(with_planted_periods(docs))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("b"),
                                                              (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    top = found.withColumn("_best", best)
    return top.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_best.b")).alias("start"),
        F.col("_best.length").alias("length"), (-F.col("_best.p")).alias("period"),
        F.floor(1000 * F.col("_best.length") / -F.col("_best.p")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
