"""Mixing sources to target weights, in DataFrame functions only.

Documents are leaves' contents in a tree such as domain, language, source. A budget of tokens flows down: each node
divides what it has among its children by their weights, and a child that cannot use its share, because all
documents below it times the allowed epochs hold fewer tokens, leaves the rest to its siblings. As a child's
limit is that of its whole subtree, a shortage reaches an ancestor's siblings only when its own are used up.

A leaf then reads its documents in epochs, each in its own seeded order: whole epochs, and of the next one the
documents up to the one that fills the budget. That place is found from token sums of hash buckets, then inside one
bucket, so no task orders a leaf.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqtally.llm.common import written

BUCKET_BITS = 12


def count_words(text: Column) -> Column:
    """Words between ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _name(level: int) -> str:
    return f"_level{level}"


def _weight(level: int, weights: Mapping[str, float]) -> Column:
    """The weight of a node by its own name, 1 if none is given."""
    out = F.lit(1.0)
    for name, weight in weights.items():
        out = F.when(F.col(_name(level)) == name, F.lit(float(weight))).otherwise(out)
    return out


def shared_out(children: DataFrame, parent: Sequence[str]) -> DataFrame:
    """Adds `budget` to rows of `_budget` (the parent's), `_weight` and `_limit`.

    Everybody gets the same budget per weight, except those whose limit is lower. Ordered by limit per weight, the
    first child that can use its share of what those before have left settles the price for the rest. Children of
    weight 0 get nothing.
    """
    names = [c for c in children.columns if c not in ("_budget", "_weight", "_limit")]
    order = Window.partitionBy(*parent).orderBy("_ratio", *names)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everyone = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    price = (F.col("_budget") - F.coalesce(F.sum("_limit").over(before), F.lit(0.0))) / F.sum("_weight").over(rest)
    weighty = (children.where("_weight > 0").withColumn("_ratio", F.col("_limit") / F.col("_weight"))
               .withColumn("_price", price))
    settled = F.first(F.when(F.col("_price") <= F.col("_ratio"), F.col("_price")), ignorenulls=True).over(everyone)
    return weighty.withColumn("_settled", settled).select(
        *names, F.least(F.col("_limit"), F.coalesce(F.col("_settled") * F.col("_weight"), F.col("_limit"))).alias("budget"))


def leaf_budgets(leaves: DataFrame, levels: int, total: float, weights: Sequence[Mapping[str, float]],
                 epochs: int) -> DataFrame:
    """The leaves `_level0.., tokens` with a `budget` each, in whole tokens."""
    limits = leaves.withColumn("_limit", F.col("tokens") * F.lit(float(epochs)))
    nodes = limits.agg(F.least(F.sum("_limit"), F.lit(float(total))).alias("_budget")).withColumn("_all", F.lit(0))
    path: list[str] = ["_all"]
    for level in range(levels):
        below = [*path, _name(level)]
        children = (limits.withColumn("_all", F.lit(0)).groupBy(*below).agg(F.sum("_limit").alias("_limit"))
                    .withColumn("_weight", _weight(level, weights[level]))
                    .join(nodes.where("_budget is not null"), path))
        nodes = shared_out(children, path).withColumnRenamed("budget", "_budget")
        path = below
    return (leaves.join(nodes, [_name(i) for i in range(levels)])
            .withColumn("budget", F.floor(F.col("_budget") + 1e-6)).drop("_budget", "_all"))


def mixed(docs: DataFrame, levels: Sequence[Column], weights: Sequence[Mapping[str, float]] | None = None,
          share: float = 1.0, epochs: int = 1, seed: int = 0, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """The chosen rows of `docs`, all columns, with `_epoch`, `_n_tokens`, `_budget` and the names of the levels
    `_level0..`; a row comes once for each epoch that it is chosen in.

    The budget is `share` of all tokens, but no more than all leaves can give in `epochs` epochs. `levels` are the
    columns of the tree from the top; null counts as the empty name. Tokens are words between white space. Null and
    empty texts have none: they are chosen if their turn comes before the budget is filled. Rows under one id,
    repeated ones too, stand together in the order and are chosen together; so are rows with a null id. A leaf
    without tokens gives nothing. An empty table gives no rows. Columns of `docs` may have any names but these.
    """
    weights = weights or [{} for _ in levels]
    names = [_name(i) for i in range(len(levels))]
    place = [F.coalesce(c.cast("string"), F.lit("")).alias(n) for c, n in zip(levels, names)]
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_key")
    rows = written(docs.select(*place, key, count_words(F.col(text_col)).alias("_n_tokens")))  # without texts
    leaves = rows.groupBy(*names).agg(F.sum("_n_tokens").alias("tokens")).where("tokens > 0")
    total = rows.agg(F.coalesce(F.sum("_n_tokens"), F.lit(0))).first()[0]
    plan = leaf_budgets(written(leaves), len(levels), share * total, weights, epochs)
    plan = written(plan.select(*names, "budget", F.floor(F.col("budget") / F.col("tokens")).alias("_whole"),
                               F.pmod(F.col("budget"), F.col("tokens")).alias("_rest")))

    turn = F.xxhash64(F.lit(seed), F.col("_whole"), F.col("_key")).bitwiseAND(F.lit((1 << 63) - 1))
    bucket = F.shiftright(F.col("_turn"), 63 - BUCKET_BITS)
    open_ = (rows.join(plan.where("_rest > 0"), names).withColumn("_turn", turn).withColumn("_bucket", bucket))
    so_far = Window.partitionBy(*names).orderBy("_bucket")
    sums = (open_.groupBy(*names, "_bucket").agg(F.sum("_n_tokens").alias("_sum"))
            .withColumn("_before", F.sum("_sum").over(so_far) - F.col("_sum")))
    # The last bucket that begins before the budget is filled, and in it the last id.
    last = (sums.join(plan.select(*names, "_rest"), names).where("_before < _rest").groupBy(*names)
            .agg(F.max(F.struct("_bucket", "_before")).alias("_l")).select(*names, "_l.*"))
    inside = Window.partitionBy(*names).orderBy("_turn", "_key")
    ends = (open_.join(last, [*names, "_bucket"]).groupBy(*names, "_turn", "_key")
            .agg(F.sum("_n_tokens").alias("_sum"), F.first("_before").alias("_before"), F.first("_rest").alias("_rest"))
            .withColumn("_start", F.col("_before") + F.sum("_sum").over(inside) - F.col("_sum"))
            .where("_start < _rest").groupBy(*names).agg(F.max(F.struct("_turn", "_key")).alias("_cut")))
    cuts = written(plan.join(ends, names, "left"))

    held = docs.select(F.struct("*").alias("_row"), *place, key, count_words(F.col(text_col)).alias("_n_tokens"))
    chosen = F.coalesce(F.struct(turn.alias("_turn"), F.col("_key")) <= F.col("_cut"), F.lit(False)).cast("long")
    return (held.join(cuts, names).withColumn("_times", F.col("_whole") + chosen).where("_times > 0")
            .withColumn("_epoch", F.explode(F.sequence(F.lit(0), (F.col("_times") - 1).cast("int"))))
            .select("_row.*", "_epoch", "_n_tokens", F.col("budget").alias("_budget"), *names))


def source_tree(domains: int = 4) -> list[Column]:
    """Domain, language and source of `documents`. The table names no domains: a source's checksum gives it one of a few."""
    source = F.coalesce(F.col("source"), F.lit(""))
    domain = F.concat(F.lit("domain"), (F.crc32(source.cast("binary")) % domains).cast("string"))
    return [domain, F.col("lang"), F.col("source")]


LANGUAGE_WEIGHTS = {"en": 4.0, "de": 2.0, "fr": 2.0, "es": 1.0}


def mixture(docs: DataFrame, share: float = 1.0, epochs: int = 4, seed: int = 7) -> DataFrame:
    """`doc_id, domain, lang, source, epoch, n_tokens, leaf_budget`: the documents chosen in each epoch, languages by
    `LANGUAGE_WEIGHTS`, domains and sources alike."""
    out = mixed(docs, source_tree(), [{}, LANGUAGE_WEIGHTS, {}], share, epochs, seed)
    return out.select("doc_id", F.col("_level0").alias("domain"), "lang", "source", F.col("_epoch").alias("epoch"),
                      F.col("_n_tokens").alias("n_tokens"), F.col("_budget").alias("leaf_budget"))
