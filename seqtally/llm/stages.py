"""The operators as stages over a documents table: rows in, rows with the same columns out."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtally.llm.jaccard_join import jaccard_components
from seqtally.llm.language_id import UNDETERMINED, Predictor, fit, held_out
from seqtally.llm.mixing import LANGUAGE_WEIGHTS, count_words, mixed, source_tree
from seqtally.llm.packing import pack_documents
from seqtally.llm.repeat_removal import remove_repeats


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Rows whose language is determined: those with a letter, once any row has taught a language.

    Null and empty texts have no letter and go. Repeated rows and rows with a null id or language are judged like any
    other. Without a row that teaches a language, and so for an empty table, all rows stay. Other columns pass through
    whatever their names."""
    model = fit(docs.where(~held_out(id_col)), id_col, text_col, lang_col)
    if not model.languages:
        return docs
    predict = Predictor(docs.sparkSession, model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in range(0, whole.num_rows, 500):
                batch = whole.slice(b, 500)
                langs, _ = predict(batch.column(at).to_pylist())
                yield batch.filter(pa.array([x != UNDETERMINED for x in langs]))

    return docs.mapInArrow(run, docs.schema)


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of documents that the Jaccard join connects, the one with the smallest id; rows with a null id all stay, and
    so do rows that repeat the id that stays. Null and empty texts are alike to nothing and stay. An empty table gives no
    rows. Other columns pass through whatever their names."""
    found = jaccard_components(docs, id_col, text_col)
    first = found.where(F.col(id_col) == F.col("component_id")).select(id_col).distinct()
    stay = docs.join(first, id_col, "left_semi").select(*docs.columns)
    return stay.unionByName(docs.where(F.col(id_col).isNull()))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts without the byte strings that repeat; `n_chars` follows where the table has it.

    Characters that a cut leaves incomplete go too. Texts that lose nothing are as before, null and empty ones included. A
    document that loses everything goes. Rows that repeat a text lose it alike, whatever their ids. An empty table gives no
    rows. Other columns pass through whatever their names.
    """
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col])
    held = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(text_col).isNull().alias("null"),
                       others.alias("others"))
    out = remove_repeats(held, "id", "text", as_text=True)
    row, touched = F.col("_row"), F.col("_n_removed") > 0
    columns = []
    for name in docs.columns:
        c = F.when(~row["null"], F.col("_kept")) if name == text_col else row["others"][name]
        if name == "n_chars":
            c = F.when(touched, F.length("_kept").cast(docs.schema[name].dataType)).otherwise(c)
        columns.append(c.alias(name))
    return out.where(~touched | (F.length("_kept") > 0)).select(*columns)


def weighted(docs: DataFrame, weights: Mapping[str, float] = LANGUAGE_WEIGHTS, text_col: str = "text") -> DataFrame:
    """Documents chosen so that in each domain the languages stand in the proportion of `weights`, in one epoch.

    The budget is the largest that meets the weights without repeating a document: of at least one language of a domain
    all documents stay, and others lose only what the weights ask for. Sources share a language's budget alike, and what
    small ones leave goes to their siblings. Rows of a language without a weight, or without a language, have no target
    and stay. Null and empty texts have no tokens and stay with the documents around them. Rows under one id stay or go
    together, those with a null id too. An empty table gives no rows. Other columns pass through whatever their names.
    """
    tree = source_tree()
    listed = F.coalesce(F.col("lang").isin(list(weights)), F.lit(False))
    sums = (docs.where(listed).groupBy(tree[0].alias("domain"), F.col("lang").alias("lang"))
            .agg(F.sum(count_words(F.col(text_col))).alias("tokens")).where("tokens > 0").collect())  # a row per domain and language
    held: dict[str, dict[str, int]] = {}
    for r in sums:
        held.setdefault(r.domain, {})[r.lang] = r.tokens
    most = {d: min(t * sum(weights[x] for x in langs) / weights[lang] for lang, t in langs.items()) for d, langs in held.items()}
    total = sum(t for langs in held.values() for t in langs.values())
    if not total:
        return docs
    chosen = mixed(docs.where(listed), tree, [most, weights, {}], sum(most.values()) / total, 1, 7).select(*docs.columns)
    return chosen.unionByName(docs.where(~listed))


def packed(docs: DataFrame) -> DataFrame:
    """The pieces of all documents and their places in sequences. Null and empty texts have the end id alone, repeated rows
    are packed as often as they occur, a null id stays null, an empty table gives no rows, and other columns are not read."""
    return pack_documents(docs)
