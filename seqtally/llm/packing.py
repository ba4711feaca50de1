"""Best-fit packing of token sequences.

Texts become token ids inside tasks; the shuffle carries one narrow row per piece. Pieces are dealt to groups
of about `group_size` by a hash of the piece and its place in the table, so that groups are alike in size also when
many rows are equal, and each group is packed by bounded-space best-fit: a fixed number of bins is open, a bitset with
one bit per amount of free space finds the fullest bin that still takes a piece, and when one bin too many is open the
fullest closes. The bound holds for what a group takes of memory, whatever its size. Pieces arrive longest first, so the
bins of the long ones have to stay open until the short ones come; by default there are as many as a group of the usual
size has pieces, and a bin closes early only in a group that a chance of the hash made larger than that.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtally.llm.common import written

CAPACITY = 4096
END_ID = 1
VOCABULARY = "word_bpe_49k.json"

PIECES = "_id {id}, piece int, start long, length long, ids_crc32 long"
PACKED = "_id {id}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


# A Latin word and ASCII marks after it; no mark that could begin a contraction has a letter behind it here.
PLAIN = re.compile(r"([a-z\u00df-\u00f6\u00f8-\u00ff]+)([!-/:-@\[-`{-~]*)")


def _byte_letters() -> dict[int, str]:
    """The characters that stand for bytes in byte-level vocabularies: visible ones for themselves, the others in
    order from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


class Ids(dict):
    """Token ids, as little-endian bytes, of chunks that stand between ASCII white space.

    The tokenizer drops white space and never joins symbols across it, nor letters with marks, so a text's ids
    are those of its chunks in a row, and a plain word with marks has the word's ids and then the marks'. Plain
    Latin words are already in the tokenizer's normal form and go straight to its merges. `fill` looks up all new
    chunks of a batch at once; beyond `bound` entries the memory is emptied and starts again.
    """

    def __init__(self, vocabulary: str, bound: int = 300_000) -> None:
        import os

        import public_tokenizers
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        super().__init__()
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self.added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.merge = self.tokenizer.model.tokenize
        self.letters = _byte_letters()
        self.bound = bound

    def fill(self, chunks: set[bytes]) -> None:
        new = list(chunks.difference(self))
        if len(self) + len(new) > self.bound:
            self.clear()
            new = list(chunks)
        others = []
        for chunk in new:
            text = chunk.decode()
            plain = PLAIN.fullmatch(text.lower()) if max(text) < "\u0100" else None
            if plain is None:
                others.append(chunk)
                continue
            word, marks = plain.groups()
            ids = self._merged(word)
            self[chunk] = ids + self._marks(marks) if marks else ids
        for i in range(0, len(others), 1000):
            part = others[i:i + 1000]
            found = self.tokenizer.encode_batch_fast([c.decode() for c in part], add_special_tokens=False)
            for chunk, one in zip(part, found):
                self[chunk] = _packed(one.ids)

    def of_text(self, text: str) -> bytes:
        """The ids of a whole text as the tokenizer gives them: for texts that contain one of its added tokens, which
        it looks for before anything else."""
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def has_added(self, text: str) -> bool:
        low = text.lower()
        return any(t in low for t in self.added)

    def _merged(self, word: str) -> bytes:
        key = word.encode()
        ids = self.get(key)
        if ids is None:
            spelled = word if word.isascii() else "".join(map(self.letters.__getitem__, key))
            ids = self[key] = _packed([t.id for t in self.merge(spelled)])
        return ids

    def _marks(self, marks: str) -> bytes:
        key = marks.encode()
        if key not in self:
            self[key] = _packed(self.tokenizer.encode(marks, add_special_tokens=False).ids)
        return self[key]


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_IDS: dict[str, Ids] = {}


def ids_of(vocabulary: str) -> Ids:
    """One memory per Python worker; it only saves work and never changes a result."""
    if vocabulary not in _IDS:
        _IDS[vocabulary] = Ids(vocabulary)
    return _IDS[vocabulary]


def chunks_of(text: str) -> list[bytes]:
    """White-space separated chunks. A-Z are lower-cased where no combining mark (bytes CC, CD) could make
    composing before lower-casing, as the tokenizer does it, matter."""
    raw = text.encode()
    return raw.split() if b"\xcc" in raw or b"\xcd" in raw else raw.lower().split()


def tokenize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
             capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of at most `capacity` ids: the text's ids and then `end_id`. Null text counts as empty."""
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = ids_of(vocabulary)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):  # bounds what is held besides the batch
                batch = whole.slice(at, 500)
                whole_texts = [t or "" for t in batch.column(1).to_pylist()]
                texts = [None if memory.has_added(t) else chunks_of(t) for t in whole_texts]
                memory.fill(set().union(*filter(None, texts)))
                rows = []
                for key, text, chunks in zip(batch.column(0).to_pylist(), whole_texts, texts):
                    ids = (memory.of_text(text) if chunks is None else b"".join(map(memory.__getitem__, chunks))) + end
                    for piece, b in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[b:b + 4 * capacity]
                        rows.append((key, piece, b // 4, len(part) // 4, zlib.crc32(part)))
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], batch.schema.field(0).type), pa.array(columns[1], pa.int32()),
                     *[pa.array(c, pa.int64()) for c in columns[2:]]],
                    ["_id", "piece", "start", "length", "ids_crc32"])

    kind = dict(docs.dtypes)[id_col]
    return (docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
            .mapInArrow(run, PIECES.format(id=kind)))


class OpenBins:
    """Bounded-space best-fit over a fixed capacity."""

    def __init__(self, capacity: int, most_open: int, first: int) -> None:
        self.capacity, self.most_open, self.next = capacity, most_open, first
        self.free_bits, self.count = 0, 0
        self.by_free: dict[int, list[int]] = {}

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) for a piece: the fullest open bin that takes it, or else a new one."""
        fits = self.free_bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            bin_id = self._take(free)
        else:
            free, bin_id = self.capacity, self.next
            self.next += 1
            if self.count >= self.most_open and length < self.capacity:
                self._take((self.free_bits & -self.free_bits).bit_length() - 1)  # the fullest closes
        if left := free - length:
            self.by_free.setdefault(left, []).append(bin_id)
            self.free_bits |= 1 << left
            self.count += 1
        return bin_id, self.capacity - free

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        bin_id = bins.pop()
        if not bins:
            self.free_bits &= ~(1 << free)
        self.count -= 1
        return bin_id


def pack(pieces: DataFrame, capacity: int = CAPACITY, most_open: int | None = None, group_size: int = 16_384) -> DataFrame:
    """Adds `sequence_id, offset` to the rows of `tokenize`.

    Within a group pieces arrive longest first. Ties go by id, piece and checksum, so a run repeats itself.
    A sequence belongs to one group: its id is the group's number times 2^32 plus a running number. At most
    `most_open` bins are open, by default `group_size`, so that a group of that size closes none before its last
    piece has come; with fewer, bins of long pieces close before the short pieces that would fill them.
    """
    most_open = most_open or group_size
    rows = written(pieces)
    groups = max(1, -(-rows.count() // group_size))
    kind = dict(pieces.dtypes)["_id"]
    names = ["_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, bins = None, None
        for batch in batches:
            where, offsets = [], []
            for g, length in zip(batch.column(0).to_pylist(), batch.column("length").to_pylist()):
                if g != group:
                    group, bins = g, OpenBins(capacity, most_open, g << 32)
                bin_id, offset = bins.place(length)
                where.append(bin_id)
                offsets.append(offset)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(where, pa.int64()), pa.array(offsets, pa.int64())],
                [*names, "sequence_id", "offset"])

    place = F.struct(F.col("_metadata.file_name"), F.col("_metadata.row_index"))  # of the written row
    dealt = rows.withColumn("_g", F.pmod(F.xxhash64("_id", "piece", "ids_crc32", place), F.lit(groups)))
    return (dealt.select("_g", *names).repartition(groups, "_g")
            .sortWithinPartitions("_g", F.desc("length"), "_id", "piece", "ids_crc32")
            .mapInArrow(run, PACKED.format(id=kind)))


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """`doc_id, piece, start, length, ids_crc32, sequence_id, offset`, one row per piece of each input row.

    Null and empty texts have one piece, the end id alone. Repeated rows are packed as often as they occur. An
    empty table gives no rows. Other columns are not read, whatever their names; a null id stays null.
    """
    packing = {k: options.pop(k) for k in ("most_open", "group_size") if k in options}
    capacity = options.get("capacity", CAPACITY)
    out = pack(tokenize(docs, id_col, text_col, **options), capacity=capacity, **packing)
    return out.withColumnRenamed("_id", id_col)
