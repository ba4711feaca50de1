import zlib
from collections import Counter

from seqtally.llm.sharding import first_map, rebalanced, shard_documents, store_map, stored_map


def test_rows_places_and_bytes(odd_docs):
    rows = shard_documents(odd_docs, n_shards=3, n_slots=16).collect()
    expected = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode()))
                       for r in odd_docs.collect())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == expected
    for shard in {r.shard for r in rows}:
        places = sorted(r.slot for r in rows if r.shard == shard)
        assert places == list(range(len(places)))
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    assert len({(r.virtual_slot, r.shard) for r in rows}) == len({r.virtual_slot for r in rows})


def test_sizes_are_near_equal(spark, docs_of):
    docs = docs_of([(i, "x" * (i * 37 % 900), "en", "a") for i in range(1500)])
    load = Counter()
    for r in shard_documents(docs).collect():
        load[r.shard] += r["size"]
    assert set(load) == set(range(8)) and max(load.values()) - min(load.values()) <= 900


def test_empty_table(no_docs):
    assert shard_documents(no_docs).count() == 0


def test_one_more_shard_takes_slots_only_into_itself():
    sizes = [(s, 1, 100 + s * 7 % 50) for s in range(256)]
    old = first_map(sizes, 8)
    new = rebalanced(old, sizes, 9)
    before, after = {s: k for _, s, k, *_ in old}, {s: k for _, s, k, *_ in new}
    moved = [s for s in after if after[s] != before[s]]
    assert moved and {after[s] for s in moved} == {8}
    load = Counter()
    for _, _, shard, _, size in new:
        load[shard] += size
    assert max(load.values()) - min(load.values()) <= 160
    assert {v for v, *_ in new} == {1}


def test_fewer_shards_and_new_sizes():
    sizes = [(s, 1, 10) for s in range(64)]
    new = rebalanced(first_map(sizes, 8), [(s, 1, 10 + (s == 3) * 50) for s in range(64)], 7)
    assert {k for _, _, k, *_ in new} == set(range(7)) and len(new) == 64


def test_map_versions_are_stored(spark, tmp_path):
    sizes = [(s, 1, s) for s in range(8)]
    old = first_map(sizes, 2)
    new = rebalanced(old, sizes, 3)
    for entries in (old, new):
        store_map(spark, entries, str(tmp_path / "map"))
    assert stored_map(spark, str(tmp_path / "map"), 0) == old
    assert stored_map(spark, str(tmp_path / "map")) == new


def test_query_stores_and_edits_the_map(docs_of, spark, tmp_path):
    docs, path = docs_of([(i, "x" * (i % 50), "en", "a") for i in range(300)]), str(tmp_path / "map")
    first = shard_documents(docs, n_shards=3, n_slots=64, map_path=path).collect()
    assert {r.map_version for r in first} == {1}
    more = shard_documents(docs, n_shards=4, n_slots=64, map_path=path).collect()
    assert {r.map_version for r in more} == {2} and {r.shard for r in more} == {0, 1, 2, 3}
    for version, rows in ((1, first), (2, more)):
        shard = {s: k for _, s, k, *_ in stored_map(spark, path, version)}
        assert all(shard[r.virtual_slot] == r.shard for r in rows)
    before, after = ({s: k for _, s, k, *_ in stored_map(spark, path, v)} for v in (1, 2))
    assert 0 < sum(before[s] != after[s] for s in before) < 32  # an edit, no new map


def test_rows_of_one_id_are_spread(docs_of):
    rows = [(i, "x" * 100, "en", "a") for i in range(2000)] + [(7, "same" * 25, "en", "a")] * 2500
    rows += [(None, "z" * 100, "en", "a")] * 500 + [(8, f"{i:0100}", "en", "a") for i in range(1000)]
    found = shard_documents(docs_of(rows)).collect()
    load = Counter()
    for r in found:
        load[r.shard] += r["size"]
    assert Counter((r.doc_id, r["size"]) for r in found) == Counter((i, len(t) + 1) for i, t, *_ in rows)
    assert max(load.values()) - min(load.values()) <= 0.02 * sum(load.values()) / 8


def test_the_first_edit_moves_slots_until_shards_are_even(spark, docs_of, tmp_path):
    rows = [(i, "x" * (1 + i * 37 % 900), "en", "a") for i in range(3000)]
    path = str(tmp_path / "map")
    out = shard_documents(docs_of(rows), map_path=path).collect()
    sizes = Counter()
    for r in out:
        sizes[r.shard] += r.size
    assert max(sizes.values()) - min(sizes.values()) <= 900 and {r.map_version for r in out} == {1}
    before, after = ({e[1]: e[2] for e in stored_map(spark, path, v)} for v in (0, 1))
    assert all(shard == slot % 8 for slot, shard in before.items())
    moved = sum(before[s] != after[s] for s in before)
    assert 0 < moved < len(before) / 4
