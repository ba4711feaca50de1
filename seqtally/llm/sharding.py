"""Shards over fixed virtual slots.

Every record is hashed by its id into one of `n_slots` virtual slots, a number fixed for the life of a data
set. Rows that repeat an id, or have none, are hashed with their checksum and size and a running number too. Bytes are summed per slot, and a slot-to-shard map with a version number says where a slot lives. A
rebalance edits the map: it moves as few slots as it needs, and records only follow their slot. The map has
`n_slots` rows whatever the data, so it is made on the driver and broadcast.
"""

from __future__ import annotations

import heapq
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqtally.llm.common import utf8, written
from seqtally.operators.common import spread_join
from seqtally.session import shared_folder

N_SLOTS = 4096
MAP = "version int, virtual_slot int, shard int, slot_rows long, slot_bytes long"


def slotted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_slots: int = N_SLOTS) -> DataFrame:
    """`_id, size, text_crc32, virtual_slot` per row: narrow, whatever the texts are."""
    data = utf8(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("_id"), (F.length(data) + F.lit(1)).cast("long").alias("size"),
                       F.crc32(data).alias("text_crc32"))
    # Rows are no more than these columns, so equal ones are counted; then they are made again, with a number each.
    kinds = written(rows.groupBy("_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("_n")))
    repeated = (kinds.where("_id is not null").groupBy("_id").agg(F.sum("_n").alias("_rows")).where("_rows > 1")
                .select("_id", F.lit(True).alias("_again")))
    told = spread_join(kinds, repeated, ["_id"], "left")  # null ids find nothing
    again = F.col("_id").isNull() | F.coalesce("_again", F.lit(False))
    # A thousand rows at a time, dealt out before they are made.
    lots = (told.withColumn("_again", again)
            .withColumn("_lot", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / 1000).cast("int"))))
            .repartition(F.col("_id"), F.col("size"), F.col("text_crc32"), F.col("_lot")))
    last = F.least(F.col("_n") - 1, (F.col("_lot") + 1) * F.lit(1000) - 1)
    made = lots.withColumn("_i", F.explode(F.sequence((F.col("_lot") * F.lit(1000)).cast("long"), last.cast("long"))))
    place = F.when(F.col("_again"), F.xxhash64("_id", "text_crc32", "size", "_i")).otherwise(F.xxhash64("_id"))
    return made.select("_id", "size", "text_crc32", F.pmod(place, F.lit(n_slots)).cast("int").alias("virtual_slot"))


def slot_sizes(rows: DataFrame, n_slots: int = N_SLOTS) -> list[tuple[int, int, int]]:
    """(slot, rows, bytes) for all slots, used or not: `n_slots` entries."""
    found = {r[0]: (r[1], r[2]) for r in rows.groupBy("virtual_slot").agg(
        F.count(F.lit(1)), F.sum("size")).collect()}
    return [(s, *found.get(s, (0, 0))) for s in range(n_slots)]


def even_map(sizes: list[tuple[int, int, int]], n_shards: int) -> list[tuple]:
    """Version 0 before any size is known: every shard has as many slots. The sizes are those it turns out to have."""
    return [(0, slot, slot % n_shards, rows, size) for slot, rows, size in sizes]


def first_map(sizes: list[tuple[int, int, int]], n_shards: int) -> list[tuple]:
    """Version 0: the largest slots first, each to the shard with the fewest bytes."""
    load = [(0, 0, shard) for shard in range(n_shards)]
    out = []
    for slot, rows, size in sorted(sizes, key=lambda x: (-x[2], x[0])):
        used, n, shard = heapq.heappop(load)
        out.append((0, slot, shard, rows, size))
        heapq.heappush(load, (used + size, n + 1, shard))
    return sorted(out)


def rebalanced(old: list[tuple], sizes: list[tuple[int, int, int]], n_shards: int) -> list[tuple]:
    """The next version of a map for new sizes or another number of shards.

    Slots of shards that no longer exist are placed first, the largest first, on the lightest shard. Then
    slots move from the heaviest to the lightest shard, each time the largest one that does not overshoot,
    until none helps. With more shards and unchanged sizes slots only move to new shards, because old ones
    never become the lightest before the new ones have caught up.
    """
    size = {s: b for s, _, b in sizes}
    rows = {s: n for s, n, _ in sizes}
    held: dict[int, list[tuple[int, int]]] = {k: [] for k in range(n_shards)}
    homeless = []
    for _, slot, shard, *_ in old:
        (held[shard] if shard < n_shards else homeless).append((size[slot], slot))
    load = {k: sum(b for b, _ in v) for k, v in held.items()}
    for b, slot in sorted(homeless, key=lambda x: (-x[0], x[1])):
        light = min(load, key=lambda k: (load[k], k))
        held[light].append((b, slot))
        load[light] += b
    for v in held.values():
        v.sort()
    while True:
        heavy = max(load, key=lambda k: (load[k], -k))
        light = min(load, key=lambda k: (load[k], k))
        room = (load[heavy] - load[light]) // 2
        movable = [x for x in held[heavy] if 0 < x[0] <= room]
        if not movable:
            break
        b, slot = movable[-1]
        held[heavy].remove((b, slot))
        held[light].append((b, slot))
        held[light].sort()
        load[heavy] -= b
        load[light] += b
    version = max((v for v, *_ in old), default=-1) + 1
    return sorted((version, slot, shard, rows[slot], b) for shard, v in held.items() for b, slot in v)


def store_map(spark: SparkSession, entries: list[tuple], path: str) -> None:
    """Append one version of the map to its table."""
    spark.createDataFrame(entries, MAP).coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def stored_map(spark: SparkSession, path: str, version: int | None = None) -> list[tuple]:
    """The given or latest version."""
    table = spark.read.schema(MAP).parquet(path)
    if version is None:
        version = table.agg(F.max("version")).first()[0]
    return sorted(tuple(r) for r in table.where(F.col("version") == version).select(
        "version", "virtual_slot", "shard", "slot_rows", "slot_bytes").collect())


def placed(rows: DataFrame, entries: list[tuple]) -> DataFrame:
    """Adds `shard`, the row's place `slot` in its shard (gapless from 0) and `map_version`.

    A place is the rows of the shard's earlier virtual slots plus the row's number in its own, by id,
    checksum and size. Windows are as small as virtual slots; no task holds a shard.
    """
    table = rows.sparkSession.createDataFrame(entries, MAP)
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = table.select("virtual_slot", "shard", F.col("version").alias("map_version"),
                           F.coalesce(F.sum("slot_rows").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("virtual_slot").orderBy("_id", "text_crc32", "size")
    return (rows.withColumn("_n", F.row_number().over(inside) - 1)
            .join(F.broadcast(offsets), "virtual_slot")  # n_slots rows
            .withColumn("slot", F.col("_before") + F.col("_n")).drop("_before", "_n"))


def shard_documents(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
                    n_slots: int = N_SLOTS, map_path: str | None = None) -> DataFrame:
    """`doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot, map_version`, by the law `bytes`.

    Null text has size 1 and the checksum of no bytes. Rows that repeat an id, and rows with a null id, are spread
    over virtual slots; repeated rows keep a place each. An empty table gives no rows. Other columns are not read.

    The map is stored at `map_path`, by default in the checkpoint folder. Where there is none yet, version 0 gives every
    shard as many slots. The latest version is then edited for the bytes that the slots have and for the number of shards;
    only slots that even out the shards move. The edit is stored as the next version, read back, and places the rows.
    """
    spark = docs.sparkSession
    path = map_path or f"{shared_folder(spark)}/slot-map-{uuid.uuid4().hex}"
    rows = written(slotted(docs, id_col, text_col, n_slots))
    sizes = slot_sizes(rows, n_slots)
    try:
        latest = stored_map(spark, path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        store_map(spark, even_map(sizes, n_shards), path)
        latest = stored_map(spark, path)
    store_map(spark, rebalanced(latest, sizes, n_shards), path)
    return placed(rows, stored_map(spark, path)).select(
        F.col("_id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version")
