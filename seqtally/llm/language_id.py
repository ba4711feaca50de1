"""Language identification by unigrams over a fixed public vocabulary, summed over all segmentations.

A language is a probability for each piece of the vocabulary. A word's probability in a language is the sum,
over all ways of cutting it into pieces, of the products of their probabilities: a forward pass. A text's
score is the product over its words, whole. The probabilities are fitted by expectation maximisation on a bounded
sample of the labelled documents; counts are gathered by Spark, and a model has one number per piece and
language whatever the input.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtally.llm.common import written

VOCABULARY = "piece_bpe_32k.model"
UNDETERMINED = "und"
LETTERS = re.compile(r"[^\W\d_]+")
LONGEST = 24  # longer runs of letters are not remembered and are scored letter by letter
UNKNOWN = 1e-7  # probability of a letter that is no piece, the same in every language
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """Pieces of letters, with or without the mark for a word's beginning, by hash."""

    def __init__(self, vocabulary: str) -> None:
        import public_tokenizers
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(vocabulary))
        known = {model.id_to_piece(i) for i in range(model.get_piece_size())}
        texts = sorted({p.lower() for p in known if LETTERS.fullmatch(p.lstrip("▁") or "a")})
        self.longest = max(map(len, texts))
        self.size = len(texts)
        hashes = np.empty(self.size, dtype=np.uint64)
        for n in {len(t) for t in texts}:
            at = [i for i, t in enumerate(texts) if len(t) == n]
            hashes[at] = self._hash(codes_of([texts[i] for i in at], n))
        self.order = np.argsort(hashes)
        self.sorted = hashes[self.order]

    @staticmethod
    def _hash(codes: np.ndarray, h: np.ndarray | None = None) -> np.ndarray:
        h = np.zeros(len(codes), dtype=np.uint64) if h is None else h
        for c in codes.T:
            h = (h ^ c) * MULTIPLIER
            h ^= h >> np.uint64(29)
        return h

    def spans(self, codes: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
        """For each stretch of the words' columns: the piece number, `size` for none, `size` + 1 for a single
        letter that is no piece."""
        out = {}
        n, width = codes.shape
        for b in range(width):
            h = np.zeros(n, dtype=np.uint64)
            for e in range(b + 1, min(width, b + self.longest) + 1):
                h = self._hash(codes[:, e - 1:e], h)
                at = np.minimum(np.searchsorted(self.sorted, h), self.size - 1)
                out[b, e] = np.where(self.sorted[at] == h, self.order[at], self.size + (e == b + 1))
        return out

    def ending(self, hashes: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One letter further along runs: the hashes of the last 1, 2, .. `longest` letters, from those one letter
        before, and their piece numbers as in `spans`."""
        before = np.concatenate([np.zeros((1, len(letters)), dtype=np.uint64), hashes[:-1]])
        hashes = self._hash(np.broadcast_to(letters, before.shape).reshape(-1, 1), before.ravel()).reshape(before.shape)
        at = np.minimum(np.searchsorted(self.sorted, hashes), self.size - 1)
        none = self.size + (np.arange(self.longest) == 0)[:, None]
        return hashes, np.where(self.sorted[at] == hashes, self.order[at], none)


@lru_cache(maxsize=2)
def pieces_of(vocabulary: str) -> Pieces:
    return Pieces(vocabulary)


def codes_of(texts: list[str], width: int) -> np.ndarray:
    joined = "".join(texts).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(joined, dtype="<u4").reshape(-1, width).astype(np.uint64)


def words_of(text: str | None, most: int | None = LONGEST) -> list[str]:
    """Lower-cased runs of letters, whole or in stretches of at most `most`; none if no character is a letter."""
    words = LETTERS.findall(text.lower()) if text else []
    if words and not any(any(map(str.isalpha, w)) for w in words):
        return []
    if most and any(len(w) > most for w in words):
        words = [w[i:i + most] for w in words for i in range(0, len(w), most)]
    return words


def by_length(words: list[str]) -> Iterator[tuple[list[int], np.ndarray]]:
    """Positions and characters of words of equal length, the mark for the beginning in front."""
    at: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        at.setdefault(len(w), []).append(i)
    for n, places in at.items():
        step = 20_000 if n <= LONGEST else max(1, 200_000 // n)
        for b in range(0, len(places), step):
            some = places[b:b + step]
            yield some, codes_of(["▁" + words[i] for i in some], n + 1)


def long_runs(words: list[str], most: int = 500_000) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Positions, characters as in `by_length` and widths of the words above `LONGEST`, longest first, filled up with
    zeros; up to `most` characters or one longer word at a time."""
    places = sorted((i for i, w in enumerate(words) if len(w) > LONGEST), key=lambda i: -len(words[i]))
    while places:
        width = len(words[places[0]]) + 1
        some, places = places[:max(1, most // width)], places[max(1, most // width):]
        yield (some, codes_of(["▁" + words[i] + "\0" * (width - 1 - len(words[i])) for i in some], width),
               np.array([len(words[i]) + 1 for i in some]))


def table_of(model: np.ndarray) -> np.ndarray:
    """Probabilities by piece number, with rows for no piece and for an unknown letter."""
    return np.concatenate([model, np.zeros((1, model.shape[1])), np.full((1, model.shape[1]), UNKNOWN)])


def forward(spans: dict, table: np.ndarray, n: int, width: int) -> list[np.ndarray]:
    alpha = [np.ones((n, table.shape[1]))] + [np.zeros((n, table.shape[1])) for _ in range(width)]
    for e in range(1, width + 1):
        for b in range(e):
            if (b, e) in spans:
                alpha[e] += alpha[b] * table[spans[b, e]]
    return alpha


def word_scores(words: list[str], table: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Log probability of each word in each language, over all segmentations."""
    out = np.empty((len(words), table.shape[1]))
    short = [i for i, w in enumerate(words) if len(w) <= LONGEST]
    for at, codes in by_length([words[i] for i in short]):
        out[[short[i] for i in at]] = np.log(forward(pieces.spans(codes), table, *codes.shape)[-1])
    for at, codes, widths in long_runs(words):
        out[at] = carried(codes, widths, table, pieces)
    return out


def carried(codes: np.ndarray, widths: np.ndarray, table: np.ndarray, pieces: Pieces) -> np.ndarray:
    """`word_scores` of runs of any length, longest first: only the forward values of the last `pieces.longest`
    positions are kept, as multiples of the newest one, whose logarithm is summed up."""
    hashes = np.zeros((pieces.longest, len(codes)), dtype=np.uint64)
    last = np.zeros((pieces.longest, len(codes), table.shape[1]))
    last[0] = 1
    out = np.zeros(last.shape[1:])
    for e in range(codes.shape[1]):
        n = int((widths > e).sum())
        hashes, ids = pieces.ending(hashes[:, :n], codes[:n, e])
        new = (last[:, :n] * table[ids]).sum(axis=0)
        out[:n] += np.log(new)
        last = np.concatenate([np.ones_like(new)[None], last[:-1, :n] / new])
    return out


def carried_counts(codes: np.ndarray, lang: np.ndarray, weight: np.ndarray, table: np.ndarray, pieces: Pieces,
                   total: np.ndarray) -> None:
    """Adds the expected uses in long runs of one length to `total`. Besides the carried values a run's piece numbers
    and the logarithms of its forward values are kept for the way back."""
    n, width = codes.shape
    ids = np.empty((width, pieces.longest, n), dtype=np.int32)
    ahead, back = np.zeros((width + 1, n)), np.zeros((width + 1, n))
    hashes = np.zeros((pieces.longest, n), dtype=np.uint64)
    last = np.zeros((pieces.longest, n))
    last[0] = 1
    for e in range(width):
        hashes, ids[e] = pieces.ending(hashes, codes[:, e])
        new = (last * table[ids[e], lang]).sum(axis=0)
        ahead[e + 1] = ahead[e] + np.log(new)
        last = np.concatenate([np.ones((1, n)), last[:-1] / new])
    last[:] = 0
    last[0] = 1
    for b in range(width - 1, -1, -1):
        k = np.arange(min(pieces.longest, width - b))
        here = ids[b + k, k]
        chance = table[here, lang]
        new = (last[:len(k)] * chance).sum(axis=0)
        back[b] = back[b + 1] + np.log(new)
        np.add.at(total, (here, lang), weight * chance * np.exp(ahead[b] + back[b + 1 + k] - ahead[width]))
        last = np.concatenate([np.ones((1, n)), last[:-1] / new])


def expected_counts(words: list[str], langs: np.ndarray, counts: np.ndarray, table: np.ndarray,
                    pieces: Pieces) -> np.ndarray:
    """Expected uses of each piece over all segmentations of the words, each word in its own language."""
    total = np.zeros((pieces.size + 2, table.shape[1]))
    for at, codes in by_length(words):
        n, width = codes.shape
        lang, weight = langs[at], counts[at]
        if width > LONGEST + 1:
            carried_counts(codes, lang, weight, table, pieces, total)
            continue
        spans = pieces.spans(codes)
        own = {s: table[ids, lang] for s, ids in spans.items()}
        a = [np.ones(n)] + [np.zeros(n) for _ in range(width)]
        z = [np.zeros(n) for _ in range(width)] + [np.ones(n)]
        for e in range(1, width + 1):
            for b in range(e):
                if (b, e) in spans:
                    a[e] += a[b] * own[b, e]
        for b in range(width - 1, -1, -1):
            for e in range(b + 1, width + 1):
                if (b, e) in spans:
                    z[b] += own[b, e] * z[e]
        for (b, e), ids in spans.items():
            np.add.at(total, (ids, lang), weight * a[b] * own[b, e] * z[e] / a[width])
    return total[:pieces.size]


class Model:
    """Languages and the probability of every piece in each."""

    def __init__(self, languages: list[str], probabilities: np.ndarray, vocabulary: str) -> None:
        self.languages, self.vocabulary, self.key = languages, vocabulary, uuid.uuid4().hex
        self.table = table_of(probabilities)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample: int = 600, rounds: int = 3, smoothing: float = 0.05, vocabulary: str = VOCABULARY) -> Model:
    """Piece probabilities from about `sample` whole documents of each language, chosen by a hash of the id.

    `sample` bounds the work of fitting: the sample's distinct words are what each round reads. Rows with a null
    id, text or label teach nothing.
    """
    spark = docs.sparkSession
    labelled = docs.where(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("_lang"), F.col(text_col).alias("_text"),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(1_000_000)).alias("_h"))
    sizes = {r[0]: r[1] for r in labelled.groupBy("_lang").count().collect()}  # a row per language
    languages = sorted(sizes)
    pieces = pieces_of(vocabulary)
    model = np.full((pieces.size, len(languages)), 1.0 / pieces.size)
    if not languages:
        return Model([], model, vocabulary)
    chosen = F.lit(False)
    for name in languages:
        chosen = chosen | ((F.col("_lang") == name) & (F.col("_h") < F.lit(-(-sample * 1_000_000 // sizes[name]))))
    number = {name: i for i, name in enumerate(languages)}

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[tuple[int, str], int] = {}
            for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                for w in words_of(text, None):
                    counts[number[lang], w] = counts.get((number[lang], w), 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in counts], pa.int32()), pa.array([k[1] for k in counts], pa.string()),
                 pa.array(list(counts.values()), pa.int64())], ["lang", "word", "n"])

    words = written(labelled.where(chosen).select("_lang", "_text").mapInArrow(count_words, "lang int, word string, n long")
                    .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(table_of(model))

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known = pieces_of(vocabulary)
            total = np.zeros((known.size, shared.value.shape[1]))
            for batch in batches:
                total += expected_counts(batch.column(1).to_pylist(), batch.column(0).to_numpy().astype(np.int64),
                                         batch.column(2).to_numpy().astype(float), shared.value, known)
            at, lang = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(lang.astype(np.int32)),
                                              pa.array(total[at, lang])], ["piece", "lang", "n"])

        # At most one number per piece and language.
        found = (words.mapInArrow(expect, "piece int, lang int, n double").groupBy("piece", "lang")
                 .agg(F.sum(F.col("n").cast("decimal(38,9)")).cast("double").alias("n")).collect())
        model = np.full((pieces.size, len(languages)), smoothing)
        for piece, lang, n in found:
            model[piece, lang] += n
        model /= model.sum(axis=0)
        shared.unpersist()
    return Model(languages, model, vocabulary)


class Scores:
    """Scores of the words met so far in a Python worker; it only saves work. Emptied beyond `bound` words."""

    def __init__(self, model: Model, bound: int = 200_000) -> None:
        self.model, self.bound = model, bound
        self.places: dict[str, int] = {}
        self.rows = np.empty((0, len(model.languages)))

    def add(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.places]
        if len(self.places) + len(new) > self.bound:
            self.places, new = {}, list(words)
        if len(self.places) + len(new) > len(self.rows):
            grown = np.empty((2 * (len(self.places) + len(new)), self.rows.shape[1]))
            grown[:len(self.places)] = self.rows[:len(self.places)]
            self.rows = grown
        first = len(self.places)
        self.rows[first:first + len(new)] = word_scores(new, self.model.table, pieces_of(self.model.vocabulary))
        self.places.update(zip(new, range(first, first + len(new))))


_SCORES: dict[str, Scores] = {}


class Predictor:
    """Languages and scores of texts inside tasks; the model travels as a broadcast of bounded size."""

    def __init__(self, spark: SparkSession, model: Model) -> None:
        self.shared = spark.sparkContext.broadcast(model)

    def __call__(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        known = self.shared.value
        words = [words_of(t, None) for t in texts]
        langs, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        if known.languages:
            if known.key not in _SCORES:
                _SCORES.clear()
                _SCORES[known.key] = Scores(known)
            memory = _SCORES[known.key]
            distinct = set().union(*words)
            long = [w for w in distinct if len(w) > LONGEST]
            memory.add(distinct.difference(long))
            apart = dict(zip(long, word_scores(long, known.table, pieces_of(known.vocabulary)))) if long else {}
            for i, some in enumerate(words):
                if some:
                    short = [w for w in some if w not in apart] if apart else some
                    places = np.fromiter(map(memory.places.__getitem__, short), dtype=np.int64, count=len(short))
                    total = memory.rows[places].sum(axis=0)
                    for w in some if apart else ():
                        if w in apart:
                            total = total + apart[w]
                    best = int(total.argmax())
                    langs[i], scores[i] = known.languages[best], 1 / np.exp(total - total[best]).sum()
        return langs, scores


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id, lang_pred, score` of every row; see `identify`."""
    predictor = Predictor(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):  # bounds what is held besides the batch
                batch = whole.slice(at, 500)
                langs, scores = predictor(batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(langs, pa.string()), pa.array(scores)], ["_id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return (rows.mapInArrow(run, f"_id {dict(rows.dtypes)['_id']}, lang_pred string, score double")
            .withColumnRenamed("_id", id_col))


def held_out(id_col: str, folds: int = 3, fold: int = 1) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             **options) -> DataFrame:
    """`doc_id, held_out, lang_pred, score`, one row per input row, from a model that saw no held-out row.

    `score` is the predicted language's share of the probability, all languages equally likely before. Ties go to
    the name that sorts first. Null texts and texts without a letter are `und` with score 0, as is everything when
    no row teaches a language. Rows with a null id are predicted, not learned from, and not held out. Repeated
    rows are predicted alike. An empty table gives no rows. Other columns are not read.
    """
    model = fit(docs.where(~held_out(id_col)), id_col, text_col, lang_col, **options)
    found = predict(docs, model, id_col, text_col)
    return found.select(id_col, held_out(id_col).alias("held_out"), "lang_pred", "score")
