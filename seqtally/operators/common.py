"""Building blocks used by several operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqtally.session import cut_lineage


def names(by: Sequence[str], *more: str) -> list[str]:
    return [*by, *more]


def _told_apart(rows: DataFrame) -> list[Column]:
    """What tells rows apart cheaply: the order column with the ids next to it, or everything."""
    narrow = [n for n, kind in rows.dtypes if n == "ord" or kind in ("int", "bigint")]
    return [F.col(c) for c in (narrow if "ord" in rows.columns else rows.columns)]


def shuffle_tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def planned_bytes(df: DataFrame) -> int:
    """The planner's estimate of a table's size; far too high behind joins, which it takes for cross products."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def input_bytes(df: DataFrame) -> int:
    """The planner's estimate of all the tables that a table is made from."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def key_hash(on: Sequence[str], *salt: Column) -> Column:
    """Equal for equal keys, whichever integer types or strings hold them."""
    return F.xxhash64(*salt, *[F.col(c).cast("string") for c in on])


def hot_keys(rows: DataFrame, on: Sequence[str], fair: float | None = None) -> DataFrame | None:
    """`_h, _lanes` for the keys that hold more rows than a task's fair share; None if there is none.

    One pass over the key columns feeds a heavy-hitter sketch, whose size follows the number of shuffle tasks. A key is
    hot from `fair` rows on, by default an equal share of all rows, and gets a lane for each half share it holds, as
    lanes may meet in a task: there are no more lanes than three times the number of tasks, however many rows or keys
    there are. Keys are known by
    their 64-bit hash; a chance collision only gives a cold key lanes as well.
    """
    tasks = shuffle_tasks(rows)
    tracked = 8 * max(tasks, 128)
    found = rows.select(key_hash(on).alias("_h")).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(_h, {2 * tasks}, {tracked})").alias("top")).first()
    fair = fair or max(1.0, found.n / tasks)
    hot = [(t["item"], 1 + int(2 * t["count"] / fair)) for t in found.top or [] if t["count"] > fair]
    return rows.sparkSession.createDataFrame(hot, "_h long, _lanes int") if hot else None


def with_lanes(rows: DataFrame, on: Sequence[str], hot: DataFrame) -> DataFrame:
    """Adds `_lane`: for rows of a hot key one of its lanes, from a hash of the row's order or content, else 0."""
    lane = F.when(F.col("_lanes").isNull(), 0).otherwise(F.pmod(F.xxhash64(*_told_apart(rows)), F.col("_lanes")))
    return (rows.withColumn("_h", key_hash(on)).join(F.broadcast(hot), "_h", "left")
            .withColumn("_lane", lane.cast("int")).drop("_h", "_lanes"))


def in_all_lanes(lookup: DataFrame, on: Sequence[str], hot: DataFrame) -> DataFrame:
    """A lookup with `_lane`: rows of hot keys once per lane, all others once."""
    lanes = F.sequence(F.lit(0), F.coalesce("_lanes", F.lit(1)) - 1)
    return (lookup.withColumn("_h", key_hash(on)).join(F.broadcast(hot), "_h", "left")
            .withColumn("_lane", F.explode(lanes)).drop("_h", "_lanes"))


SMALL = 256 << 20


def planner_broadcasts(lookup: DataFrame) -> bool:
    """Whether the planner takes a lookup along to every task by itself."""
    return planned_bytes(lookup) <= lookup.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


TASK_INPUT, UNKNOWN_BYTES = 4 << 20, 1 << 60


def dealt(rows: DataFrame, on: Sequence[str], beside: Sequence[DataFrame] = ()) -> DataFrame:
    """Rows by key in as many tasks as the files they are made from ask for, one for each `TASK_INPUT` bytes.

    Adaptive execution merges shuffled partitions by their compressed size down to the number of cores, so where keys
    compress well a task's rows, and the memory of the joins and groupings on them, grow with the input. A number that is
    given stays. Rows of unknown or little input are left to it. Files of the tables `beside` count too: rows that are
    dealt before they are joined to those on the key aren't moved again where the joined rows are dealt by it.
    """
    size = input_bytes(rows) + sum(input_bytes(table) for table in beside)
    tasks = 0 if size >= UNKNOWN_BYTES else -(-size // TASK_INPUT)
    return rows.repartition(tasks, *on) if tasks > 1 else rows


def spread_join(rows: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "inner",
                counted: DataFrame | None = None, small: int = SMALL, computed: bool = False) -> DataFrame:
    """Join fact rows to a lookup with one row per key, safe when one key owns a large share of the rows.

    Only keys that a sketch finds hot are split over lanes, and only their lookup rows are repeated; all others are
    joined plainly. The sketch reads the keys of `counted`, by default of `rows`: give the source that the keys come
    from if `rows` is long to compute; where no table holds them, `computed` writes the rows once before a sketch reads
    them. Rows made from less than `small` bytes are joined without a sketch, as no key
    of theirs can be too much for a task, and so are those whose lookup the planner broadcasts, as they aren't shuffled.
    Columns: those of `rows` in their order, then those of the lookup.
    """
    on = list(on)
    more = [] if how in ("left_semi", "left_anti") else [c for c in lookup.columns if c not in on]
    plain = input_bytes(rows) < small or planner_broadcasts(lookup)
    if computed and not plain:
        rows = cut_lineage(rows)
    hot = None if plain else hot_keys(rows if counted is None else counted, on)
    if hot is None:
        out = rows.join(lookup, on, how)
    else:
        out = with_lanes(rows, on, hot).join(in_all_lanes(lookup, on, hot), [*on, "_lane"], how)
    return out.select(*rows.columns, *more)


def keep_or_drop(rows: DataFrame, ids: DataFrame, on: Sequence[str], how: str, small: int = SMALL,
                 bloom_bits: int | None = None) -> DataFrame:
    """Semi or anti join of fact rows with an id list; hot keys are split as in `spread_join`.

    With `bloom_bits` (a power of two) rows are first tested against a filter of the ids, which is built as a table
    of bitmaps and broadcast: `bloom_bits / 8` bytes, so the size is known beforehand. Rows that it rules out are not
    shuffled at all; for wide records and id lists that are too long to broadcast.
    """
    ids = ids.select(*on).distinct()
    if bloom_bits is None:
        return spread_join(rows, ids, on, how, small=small)
    maps = id_bitmaps(ids, on, bloom_bits)
    tested = rows.withColumn("_bit", key_bit(on, bloom_bits)).join(
        F.broadcast(maps), F.bitmap_bucket_number("_bit") == F.col("_bucket"), "left")
    maybe = F.coalesce(has_bit(F.col("_map"), F.bitmap_bit_position("_bit")), F.lit(False))
    kept = spread_join(tested.where(maybe).select(*rows.columns), ids, on, how, small=small)
    return kept if how == "left_semi" else kept.unionByName(tested.where(~maybe).select(*rows.columns))


def key_bit(on: Sequence[str], bits: int) -> Column:
    """The bit of a key in a filter of so many bits. Not the hash that lanes or shuffles go by."""
    return F.pmod(key_hash(on, F.lit("filter")), F.lit(bits))


def id_bitmaps(ids: DataFrame, on: Sequence[str], bits: int) -> DataFrame:
    """`_bucket, _map`: the bits of all ids, in maps of 32768 bits; combined before the shuffle."""
    return (ids.select(key_bit(on, bits).alias("_bit")).groupBy(F.bitmap_bucket_number("_bit").alias("_bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("_map")))


def has_bit(bitmap: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (position % 8).cast("int")) == 1


def checked_broadcast(lookup: DataFrame, max_bytes: int = 64 << 20, row_bytes: int = 64) -> DataFrame:
    """Ask for a broadcast of a narrow lookup of at most `max_bytes`; otherwise leave it as it is.

    For lookups whose size follows the reference collection, joined to fact rows on a key that may be hot:
    the fact rows are then not shuffled at all. Where the planner's estimate is not below the bound, rows are counted,
    one past the bound at most, at a width of `row_bytes` or the planner's width of the types, whichever is more.
    """
    if 4 * planned_bytes(lookup) <= max_bytes:  # files are smaller than rows in memory
        return F.broadcast(lookup)
    most = max_bytes // max(row_bytes, 16 * len(lookup.columns))
    return F.broadcast(lookup) if lookup.limit(most + 1).count() <= most else lookup


def scalar_of(df: DataFrame, value: Column) -> Column:
    """One total as an uncorrelated scalar subquery."""
    return df.agg(value.alias("_total")).scalar()


def with_totals(df: DataFrame, source: DataFrame, totals: dict[str, Column], by: Sequence[str]) -> DataFrame:
    """Add totals over an already aggregated `source` to the rows of `df`, per `by` group if there is one.

    Without `by` all totals come from one scalar subquery; with it, from a join to one row per group.
    """
    named = [value.alias(name) for name, value in totals.items()]
    if by:
        return df.join(source.groupBy(*by).agg(*named), list(by), "left")
    one = source.agg(*named).select(F.struct(*totals).alias("_t")).scalar()
    return df.withColumn("_t", one).select("*", *[F.col("_t")[name].alias(name) for name in totals]).drop("_t")


def with_group_total(df: DataFrame, total: Column, name: str, by: Sequence[str]) -> DataFrame:
    """Add one total over the table itself."""
    return with_totals(df, df, {name: total}, by)
