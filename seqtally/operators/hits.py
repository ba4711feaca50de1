"""Tabular similarity hits: best hit, non-overlapping hits, family abundance and class roll-up.

Hit rows have `query, subject, pct_iden, aln_len, q_b, q_e, s_b, s_e, evalue, ord`; within a query `ord`
follows the search tool's order, best first.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqtally.functions.expr import EXACT, overlap, trunc_to
from seqtally.operators.common import key_hash, names, scalar_of, spread_join, with_group_total
from seqtally.session import cut_lineage

FRAC = 0.5


def top_hit(hits: DataFrame, max_evalue: float = 1e-6, by: Sequence[str] = ()) -> DataFrame:
    """First hit of each query with an e-value of at most `max_evalue`.

    The hits are read once: the rank is limited before the shuffle as well, so a task passes on a query's first hit alone.
    Text ids are sorted by their hash first, as ids with a common beginning are slow to compare.
    """
    key = names(by, "query")
    rows = hits.where(F.col("evalue") <= max_evalue)
    for c in [*key, "ord"]:
        rows = rows.where(F.col(c).isNotNull())
    hashed = ["_h"] if any(kind == "string" for c, kind in rows.dtypes if c in key) else []
    in_query = Window.partitionBy(*hashed, *key).orderBy("ord")
    rows = rows.withColumns({h: key_hash(key) for h in hashed}).withColumn("_n", F.rank().over(in_query))
    return rows.where(F.col("_n") == 1).select(*hits.columns)


class Accepted:
    """The intervals that one query has accepted so far, indexed by size.

    Sizes fall into classes that double; an interval stands in the one or two cells of its class's width that it
    touches. Only an interval longer than the allowed overlap can exclude another, so a hit looks into the few cells
    it touches in the classes from there on. As accepted intervals hardly overlap, cells stay short, and a query
    takes time in proportion to its hits.
    """

    def __init__(self, frac: float) -> None:
        self.frac = frac
        self.least_e = self.most_b = None
        self.few: list[tuple[int, int]] = []
        self.classes: dict[int, dict[int, list[tuple[int, int]]]] = {}

    def takes(self, b: int | None, e: int | None) -> bool:
        """Accepts a hit unless an accepted one overlaps it by more than `frac` of it."""
        if b is None or e is None:
            return True  # nothing is known to overlap
        allowed = (e - b + 1) * self.frac
        if self.least_e is not None:
            if e < b:
                # A reversed hit overlaps nothing, which is too much if its own length counts as negative.
                if allowed < 0 and (self.least_e < b or self.most_b > e):
                    return False
            elif self._overlapped(b, e, allowed):
                return False
        self.least_e = e if self.least_e is None else min(self.least_e, e)
        self.most_b = b if self.most_b is None else max(self.most_b, b)
        if e >= b:
            self._hold(b, e)
        return True

    def _overlapped(self, b: int, e: int, allowed: float) -> bool:
        if not self.classes:
            return any(min(y, e) - max(x, b) > allowed for x, y in self.few)
        least = int(allowed).bit_length()
        for k, cells in self.classes.items():
            if k < least:
                continue
            first, last = b >> k, e >> k
            touched = range(first, last + 1) if last - first < len(cells) else [c for c in cells if first <= c <= last]
            for cell in touched:
                for x, y in cells.get(cell, ()):
                    if min(y, e) - max(x, b) > allowed:
                        return True
        return False

    def _hold(self, b: int, e: int) -> None:
        if not self.classes and len(self.few) < 32:
            self.few.append((b, e))
            return
        for x, y in [*self.few, (b, e)]:
            k = (y - x).bit_length()
            cells = self.classes.setdefault(k, {})
            for cell in range(x >> k, (y >> k) + 1):
                cells.setdefault(cell, []).append((x, y))
        self.few = []


def _accept_in_order(rows: DataFrame, key: Sequence[str], frac: float, order: Sequence[str]) -> DataFrame:
    """Greedy choice inside groups: each group's hits pass through a task in order, and only the accepted ones are held.

    Needs `_b` and `_e`; the rows that are accepted come out as they are.
    """
    keys = list(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, Accepted(frac)
        for batch in batches:
            if not batch.num_rows:
                continue
            new = np.zeros(batch.num_rows, bool)
            for name in keys:
                column = batch.column(name)
                missing = column.is_null().to_numpy(zero_copy_only=False)
                new[1:] |= missing[1:] != missing[:-1]
                new[1:] |= pc.fill_null(pc.not_equal(column[1:], column[:-1]), False).to_numpy(zero_copy_only=False)
            first = [batch.column(name)[0].as_py() for name in keys]
            new[0] = last is None or first != last
            last = [batch.column(name)[batch.num_rows - 1].as_py() for name in keys]
            kept = []
            for fresh, b, e in zip(new.tolist(), batch.column("_b").to_pylist(), batch.column("_e").to_pylist()):
                if fresh:
                    held = Accepted(frac)
                kept.append(held.takes(b, e))
            yield batch.filter(pa.array(kept, pa.bool_()))

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, rows.schema)


def _accept_hot(rows: DataFrame, key: Sequence[str], frac: float, round_hits: int, spread: int) -> DataFrame:
    """`_row` of the accepted hits of queries too big for one task, in rounds over narrow rows.

    The first `round_hits` remaining hits of a query depend only on earlier ones, so they can be decided
    exactly. What they accept then strikes out every later conflicting hit, by a join on
    position bins. Two accepted hits of a size cannot share much of the query, so the bins stay short and
    each round clears far more than it decides. The rest is written for the next round.
    """
    order = ["ord", "_tie", "_row"]
    rest = cut_lineage(rows.select(*key, *order, "_b", "_e"))
    done = None
    while not rest.isEmpty():
        # First within lanes, so that no task sorts a whole group; then among what the lanes leave.
        lane = F.pmod(F.xxhash64("_row"), F.lit(spread))
        in_lane = Window.partitionBy(*key, "_lane").orderBy(*order)
        in_key = Window.partitionBy(*key).orderBy(*order)
        head = (rest.withColumn("_lane", lane).withColumn("_n", F.row_number().over(in_lane))
                .where(F.col("_n") <= round_hits)
                .withColumn("_n", F.row_number().over(in_key)).where(F.col("_n") <= round_hits)
                .select(*rest.columns))
        head = cut_lineage(head)
        last = head.groupBy(*key).agg(F.max(F.struct(*order)).alias("_last"))
        accepted = cut_lineage(_accept_in_order(head, key, frac, order))
        done = accepted.select("_row") if done is None else done.unionByName(accepted.select("_row"))
        undecided = spread_join(rest, last, key).where(F.struct(*order) > F.col("_last")).drop("_last")
        rest = cut_lineage(_strike_out(undecided, accepted, key, frac))
    return done


def _strike_out(rows: DataFrame, accepted: DataFrame, key: Sequence[str], frac: float, bins: int = 4096) -> DataFrame:
    """Rows that conflict with no accepted hit.

    An overlap longer than `frac` of a hit contains one of the points b + t * frac * length, so a hit needs
    to look only into the bins of those points, and an accepted hit stands in the bins it covers. For tiny
    `frac` it looks into all bins it covers itself. A hit whose end lies before its begin covers nothing: the
    accepted hits that it is disjoint from are those that end before its begin or begin after its end, and
    it is enough to know the smallest end and the largest begin.
    """
    span = accepted.groupBy(*key).agg(
        F.greatest(F.ceil((F.max(F.greatest("_b", "_e")) - F.min(F.least("_b", "_e")) + 1) / bins), F.lit(1)).alias("_w"),
        F.min("_e").alias("_least_e"), F.max("_b").alias("_most_b"))
    placed = spread_join(rows, span, key, "left")
    length = F.col("_e") - F.col("_b") + 1
    turned = F.col("_e") < F.col("_b")
    apart = (F.col("_least_e") < F.col("_b")) | (F.col("_most_b") > F.col("_e"))
    struck_turned = F.coalesce(turned & apart & (length * frac < 0), F.lit(False))
    forward = placed.where(~struck_turned)

    cells = lambda b, e: F.sequence(F.floor(b / F.col("_w")), F.floor(e / F.col("_w")))
    if frac < 1 / 64:
        looked = cells(F.col("_b"), F.col("_e"))
    else:
        points = F.array(*[F.col("_b") + length * (t * frac) for t in range(1, int(1 / frac) + 1)])
        looked = F.transform(F.filter(points, lambda p: p <= F.col("_e")), lambda p: F.floor(p / F.col("_w")))
    probe = (forward.where(~turned & F.col("_w").isNotNull())
             .select(*key, "_row", "_b", "_e", F.explode(F.array_distinct(looked)).alias("_bin")))
    held = (spread_join(accepted.where(~turned), span.select(*key, "_w"), key)
            .select(*key, F.col("_b").alias("_ab"), F.col("_e").alias("_ae"),
                    F.explode(cells(F.col("_b"), F.col("_e"))).alias("_bin")))
    condition = overlap(F.col("_ab"), F.col("_ae"), F.col("_b"), F.col("_e")) > length * frac
    for c in [*key, "_bin"]:
        condition = condition & (probe[c] == held[c])
    struck = probe.join(held, condition, "left_semi").select(*key, "_row").distinct()
    return forward.select(*rows.columns).join(struck, [*key, "_row"], "left_anti")


def greedy_nonoverlap(hits: DataFrame, max_evalue: float | None = 1e-3, frac: float = FRAC,
                      normalize_strand: bool = False, by: Sequence[str] = (), round_hits: int = 100_000,
                      spread: int = 64) -> DataFrame:
    """Hits accepted in order: one is left out when it overlaps an accepted hit by more than `frac` of itself.

    Hits of equal `ord` follow each other by the content of the row, so the choice does not depend on how rows are
    dealt out. Every query's hits pass through the same interval index; a query with more than `round_hits` does so in
    rounds, between which accepted hits strike out later ones everywhere. The result is the same for every
    `round_hits`. `frac` lies between 0 and 1.
    """
    if not 0 <= frac <= 1:
        raise ValueError("frac must lie between 0 and 1")
    key = names(by, "query")
    payload = [c for c in hits.columns if c not in (*key, "ord")]
    rows = hits if max_evalue is None else hits.where(F.col("evalue") <= max_evalue)
    low, high = F.col("q_b"), F.col("q_e")
    if normalize_strand:
        low, high = F.least("q_b", "q_e"), F.greatest("q_b", "q_e")
    rows = (rows.withColumn("_b", low.cast("long")).withColumn("_e", high.cast("long"))
            .withColumn("_tie", F.xxhash64(*payload)))
    hot = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_hits")).where(F.col("_hits") > round_hits).select(*key)
    if hot.isEmpty():
        return _accept_in_order(rows, key, frac, ["ord", "_tie"]).select(*hits.columns)
    # Rows that agree in all columns are told apart by a number given when they are written.
    hot = cut_lineage(hot)
    small = spread_join(rows, hot, key, "left_anti")
    large = cut_lineage(spread_join(rows, hot, key, "left_semi").withColumn("_row", F.monotonically_increasing_id()))
    accepted = _accept_hot(large, key, frac, round_hits, spread)
    return (_accept_in_order(small, key, frac, ["ord", "_tie"]).select(*hits.columns)
            .unionByName(large.join(accepted, "_row", "left_semi").select(*hits.columns)))


def family_abundance(accepted: DataFrame, families: DataFrame, depth: DataFrame | None = None, digits: int = 6,
                     subject_like: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Hits, model coverage and relative abundance of each family over non-overlapping hits.

    `families(subject, model_len, ...)`; `depth(query, depth)` weighs each hit. The total is taken before the
    values are cut.
    """
    rows = accepted if subject_like is None else accepted.where(F.col("subject").cast("string").rlike(subject_like))
    on_model = F.col("s_e") - F.col("s_b") + 1
    if depth is None:
        found = rows.groupBy(*names(by, "subject")).agg(
            F.count(F.lit(1)).alias("_n"), F.sum(on_model).alias("_cov"))
    else:
        rows = spread_join(rows, depth.select(*names(by, "query"), "depth"), names(by, "query"), "left")
        weight = F.coalesce("depth", F.lit(1.0))
        found = rows.groupBy(*names(by, "subject")).agg(
            F.sum(weight.cast(EXACT)).cast("double").alias("_n"),
            F.sum((weight * on_model).cast(EXACT)).cast("double").alias("_cov"))
    # A row per family: written once, so that the hits are not decided again for the total.
    found = cut_lineage(found).join(families, "subject").withColumn("_cov", F.col("_cov") / F.col("model_len"))
    found = with_group_total(found, F.sum(F.col("_cov").cast(EXACT)).cast("double"), "_total", by)
    described = [c for c in families.columns if c not in ("subject", "model_len")]
    return (found.withColumn("coverage", trunc_to("_cov", 6))
            .select(*names(by, "subject"), F.col("_n").cast("long").alias("n_hits"), "coverage",
                    trunc_to(F.col("coverage") / F.col("_total"), digits).alias("abundance"), *described))


def annotated_hits(accepted: DataFrame, families: DataFrame) -> DataFrame:
    """Non-overlapping hits with the description columns of their family."""
    described = [c for c in families.columns if c not in ("subject", "model_len")]
    return spread_join(accepted, families.select("subject", *described), ["subject"], "left")


def class_rollup(abundance: DataFrame, class_map: DataFrame, class_names: DataFrame,
                 by: Sequence[str] = ()) -> DataFrame:
    """Per class: families in it, the share of them found, and their summed abundance, in list order.

    `class_map(letters, family)`: a family with k letters counts in k classes. `class_names(class, descr, ord)`.
    """
    member = (class_map.select(F.explode(F.split(F.trim("letters"), "")).alias("class"), "family")
              .where(F.col("class") != "").distinct())
    sizes = member.groupBy("class").agg(F.count(F.lit(1)).alias("n_families"))
    found = (abundance.where(F.col("abundance") != 0).select(*names(by, "family"), "abundance")
             .join(member, "family").groupBy(*names(by, "class"))
             .agg(F.count(F.lit(1)).alias("_found"),
                  F.sum(F.col("abundance").cast(EXACT)).cast("double").alias("_sum")))
    frame = class_names.join(sizes, "class")
    if by:  # every class for every sample; the class list is one short array
        every = scalar_of(frame, F.collect_list(F.struct(*frame.columns)))
        frame = abundance.select(*by).distinct().select(*by, F.explode(every).alias("_c")).select(*by, "_c.*")
    return (frame.join(found, names(by, "class"), "left")
            .withColumn("coverage", trunc_to(F.coalesce(F.col("_found"), F.lit(0)) / F.col("n_families"), 6))
            .withColumn("abundance", F.coalesce("_sum", F.lit(0.0)))
            .orderBy(*by, "ord").select(*names(by, "class"), "n_families", "coverage", "abundance", "descr"))


def blastx_to_orf(hits: DataFrame, frac: float = FRAC, by: Sequence[str] = ()) -> DataFrame:
    """Turn translated hits into gene rows: id `query.begin.end`, position 1 to a third of the length."""
    kept = greedy_nonoverlap(hits, None, frac, normalize_strand=True, by=by)
    length = F.floor((F.abs(F.col("q_e") - F.col("q_b")) + 1) / 3).cast("int")
    gene = F.concat_ws(".", F.col("query").cast("string"), F.col("q_b").cast("string"), F.col("q_e").cast("string"))
    return (kept.withColumn("_len", length).withColumn("query", gene)
            .withColumn("q_b", F.lit(1)).withColumn("q_e", F.col("_len")).drop("_len"))
