import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from seqtally.llm.packing import OpenBins, Ids, chunks_of, pack, pack_documents


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def pieces_by_hand(tokenizer, rows, capacity):
    out = []
    for key, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, b in enumerate(range(0, len(ids), capacity)):
            part = ids[b:b + capacity]
            out.append((key, piece, b, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    return out


def check_layout(rows, capacity):
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


@pytest.mark.parametrize("capacity", [4096, 64])
def test_every_piece_once_and_gapless(odd_docs, tokenizer, capacity):
    rows = pack_documents(odd_docs, capacity=capacity).collect()
    expected = pieces_by_hand(tokenizer, [(r.doc_id, r.text) for r in odd_docs.collect()], capacity)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == Counter(expected)
    sequences = check_layout(rows, capacity)
    assert sequences <= -(-sum(r.length for r in rows) // capacity) + 2


def test_few_open_bins_and_small_groups(odd_docs):
    rows = pack_documents(odd_docs, capacity=64, most_open=2, group_size=40).collect()
    check_layout(rows, 64)


def test_full_group_of_long_texts(spark):
    # 8192 pieces above half a sequence, and for each one that fills what it leaves.
    long = "2049 + (id div 2) % 1900"
    pieces = spark.range(16_384).selectExpr("id as _id", "0 as piece", "0L as start",
                                            f"if(id % 2 = 0, {long}, 4096 - ({long})) as length", "id as ids_crc32")
    assert check_layout(pack(pieces).collect(), 4096) == 8192


def test_empty_table(no_docs):
    assert pack_documents(no_docs).count() == 0


def test_fullest_bin_takes_a_piece_and_closes_first():
    bins = OpenBins(10, 2, 0)
    assert bins.place(6) == (0, 0)
    assert bins.place(7) == (1, 0)
    assert bins.place(3) == (1, 7)  # the fullest that has room; now full
    assert bins.place(5) == (2, 0)
    assert bins.place(8) == (3, 0)  # bin 0, the fullest of two, closes
    assert bins.place(4) == (2, 5)
    assert bins.place(10) == (4, 0)


def test_chunks_have_the_ids_of_the_text(tokenizer):
    texts = ["It's don't WE'LL 12,5 é à-ç Ünï. İstanbul ΣΑΣ H̱a é …a “q” a b µm ×2 'tis", "'''s 's x..y!! ,,, a.,",
             "a\x1cb\x0bc d <|endoftext|> ẞ ß Straßé", "", "Çà et là; ÀÉ! naïve, côte."]
    memory = Ids("word_bpe_49k.json", bound=5)
    for text in texts:
        memory.fill(set(chunks_of(text)))
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert b"".join(map(memory.__getitem__, chunks_of(text))) == struct.pack(f"<{len(ids)}I", *ids)


def test_added_tokens_are_found_first(docs_of, tokenizer):
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    texts = [x for t in added for x in (t, f"a {t} b", f"a{t}b", f" {t}  {t}{t.upper()}", t[:-1], f"{t[:5]} {t[5:]}", "\n" + t)]
    rows = [(i, text) for i, text in enumerate(texts + ["plain"])]
    found = pack_documents(docs_of([(i, t, "en", "a") for i, t in rows])).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == Counter(pieces_by_hand(tokenizer, rows, 4096))


def test_equal_rows_are_dealt_over_groups(docs_of):
    rows = pack_documents(docs_of([(1, "one two three", "en", "a")] * 900), capacity=64, group_size=100).collect()
    check_layout(rows, 64)
    groups = Counter(r.sequence_id >> 32 for r in rows)
    assert len(groups) == 9 and max(groups.values()) < 200
