"""License passages by diagonal voting, in DataFrame functions only.

Every pair of neighbouring words of every text meets the template positions that hold the same pair. A match
votes for the diagonal text position minus template position. A long template has many common pairs, so it needs a
few votes on a diagonal before that counts. Neighbouring diagonals, which insertions and
deletions separate, are merged into spans, and a span stands if it shows enough of the template within a
bounded stretch of text. The words themselves are compared, not only their hashes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqtally.llm.common import lower_ascii
from seqtally.llm.license_texts import BODIES

# Phrases of the contract with their labels.
BASE = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]

# Customary notices of public licenses.
NOTICES = [
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("released under the mit license", "mit"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("licensed under cc by sa 4 0", "cc-by-sa-4.0"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met", "bsd"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license", "gpl"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
]

TEMPLATES = [*NOTICES, *BODIES]
LONG, LONG_VOTES = 64, 3  # templates of so many word pairs need so many votes on a diagonal

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of the contract's pattern, lower-cased; null text has none."""
    return F.filter(F.split(F.coalesce(lower_ascii(text), F.lit("")), SEPARATOR), lambda w: w != "")


def pairs_of(words: Column) -> Column:
    """Entry i: words i and i + 1; the last has no second word."""
    return F.arrays_zip(words.alias("w"), F.slice(words, F.lit(2), F.greatest(F.size(words), F.lit(1))).alias("v"))


def template_pairs(spark: SparkSession, base: Sequence[tuple[str, str]] = tuple(BASE),
                   notices: Sequence[tuple[str, str]] = tuple(TEMPLATES)) -> DataFrame:
    """A row for each pair of neighbouring words in a template: a table as small as the template texts."""
    rows = []
    for number, (text, label) in enumerate([*base, *notices]):
        words = text.split()
        rows += [(number, label, number < len(base), len(words) - 1, at, w, v)
                 for at, (w, v) in enumerate(zip(words, words[1:]))]
    return spark.createDataFrame(rows, "template int, label string, is_base boolean, n_pairs int, t_pos int, "
                                       "t_w string, t_v string").withColumn("_h", F.xxhash64("t_w", "t_v"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         base: Sequence[tuple[str, str]] = tuple(BASE), notices: Sequence[tuple[str, str]] = tuple(TEMPLATES),
         min_shown: float = 0.8, max_gap: int = 3) -> DataFrame:
    """`_id, _text_hash, n_words, n_rows, label, is_base, start, end, shown`: a row per place found, and one with
    a null label per document, which alone has `n_words` and the number of equal input rows.

    A base phrase stands only where all its words stand in a row. A notice stands where merged diagonals, at
    most `max_gap` apart, show at least `min_shown` of its pairs within one and a half times its length.
    `start` and `end` count words, `end` exclusive. The texts are read once: a document's last word, which has
    no second, goes along and tells the number of words.
    """
    key = ["_id", "_text_hash"]
    templates = template_pairs(docs.sparkSession, base, notices)
    pairs = (docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_text_hash"),
                         words_of(F.col(text_col)).alias("_words"))
             .select(*key, F.posexplode_outer(pairs_of(F.col("_words"))).alias("_pos", "_p"))
             .select(*key, "_pos", F.col("_p.w").alias("_w"), F.col("_p.v").alias("_v"))
             .withColumn("_h", F.when(F.col("_v").isNotNull(), F.xxhash64("_w", "_v"))))
    same = ((pairs["_h"] == templates["_h"]) & (pairs["_w"] == templates["t_w"]) & (pairs["_v"] == templates["t_v"]))
    # The templates are a constant of this module or the caller's list.
    met = (pairs.join(F.broadcast(templates), same, "left")
           .where(F.col("template").isNotNull() | F.col("_v").isNull())
           .withColumn("_diagonal", F.col("_pos") - F.col("t_pos")))
    what = ["template", "label", "is_base", "n_pairs"]
    # Repeated input rows repeat their votes: sets of template positions, at most as long as a template, do not.
    votes = met.groupBy(*key, *what, "_diagonal").agg(
        F.collect_set("t_pos").alias("_seen"), F.coalesce(F.max("_pos") + 1, F.lit(0)).cast("long").alias("n_words"),
        F.count(F.lit(1)).alias("n_rows"))
    at_diagonal = F.when(F.col("is_base"), F.col("_diagonal"))  # places of a phrase stay apart
    in_text = Window.partitionBy(*key, "template").orderBy("_diagonal")
    apart = F.coalesce(F.col("_diagonal") - F.lag("_diagonal").over(in_text) > max_gap, F.lit(False)).cast("int")
    enough = F.col("template").isNull() | (F.col("n_pairs") < LONG) | (F.size("_seen") >= LONG_VOTES)
    spans = (votes.where(enough).withColumn("_apart", apart)
             .withColumn("_span", F.coalesce(at_diagonal, F.sum("_apart").over(in_text)))
             .groupBy(*key, *what, "_span")
             .agg(F.max("n_words").alias("n_words"), F.sum("n_rows").alias("n_rows"),
                  F.size(F.array_distinct(F.flatten(F.collect_list("_seen")))).alias("_n"),
                  F.min(F.col("_diagonal") + F.array_min("_seen")).cast("long").alias("start"),
                  F.max(F.col("_diagonal") + F.array_max("_seen") + 2).cast("long").alias("end"))
             .withColumn("shown", F.col("_n") / F.col("n_pairs")))
    least = F.when(F.col("is_base"), F.lit(1.0)).otherwise(F.lit(min_shown))
    stands = (F.col("shown") >= least) & (F.col("end") - F.col("start") <= 1.5 * (F.col("n_pairs") + 1))
    return spans.where(F.col("template").isNull() | stands).select(
        *key, F.when(F.col("label").isNull(), F.col("n_words")).alias("n_words"),
        F.when(F.col("label").isNull(), F.col("n_rows")).alias("n_rows"), "label", "is_base", "start", "end", "shown")


def license_labels(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """`doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`, one row per input row.

    `labels` holds the base labels and those of notices; `score` is the best share shown, 0 without a find.
    Null and empty texts have no words, no places, null positions, empty labels and score 0. Repeated rows each
    get the same result; rows that share an id but not a text are told apart. An empty table gives no rows.
    Other columns are not read, whatever their names.
    """
    base = lambda c: F.when(F.col("is_base"), c)
    joined = lambda c: F.concat_ws(",", F.array_sort(F.collect_set(c)))
    found = scan(docs, id_col, text_col, **options).groupBy("_id", "_text_hash").agg(
        F.max("n_words").alias("n_words"), F.max("n_rows").alias("_rows"),
        F.count(base(F.lit(1))).alias("n_base"), F.min(base(F.col("start"))).alias("first_word"),
        F.max(base(F.col("start"))).alias("last_word"), joined(base(F.col("label"))).alias("base_labels"),
        joined(F.col("label")).alias("labels"), F.coalesce(F.max("shown"), F.lit(0.0)).alias("score"))
    return (found.withColumn("_again", F.explode(F.array_repeat(F.lit(1), F.col("_rows").cast("int"))))
            .select(F.col("_id").alias(id_col), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
                    "score"))
