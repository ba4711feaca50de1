"""Sequence formats: FASTA, FASTQ, reference lengths, sequence indexes and profile models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtally.functions.expr import extract_tag, without_space
from seqtally.sources.records import RANGE_BYTES, read_records
from seqtally.sources.text import read_lines


def _first_word(c: Column) -> Column:
    return F.regexp_extract(c, r"^(\S*)", 1)


def _after_first_word(c: Column) -> Column:
    return F.regexp_extract(c, r"^\S*\s+(.*)$", 1)


def parse_fasta(records: DataFrame) -> DataFrame:
    """`seq_id, descr, header, seq, length, ord` from records split at line-start `>`.

    `seq` keeps its line breaks, so that a record can be written back as it was; `length` ignores white space.
    """
    body = F.regexp_replace("value", r"^\s*>", "")
    cut = F.locate("\n", body)
    header = F.rtrim(F.translate(F.when(cut > 0, F.substring_index(body, "\n", 1)).otherwise(body), "\r", ""))
    seq = F.when(cut > 0, body.substr(cut + 1, F.length(body))).otherwise("")
    seq = F.regexp_replace(seq, r"\s+$", "")
    return (records.where(F.trim("value") != "")
            .select(_first_word(header).alias("seq_id"), _after_first_word(header).alias("descr"),
                    header.alias("header"), seq.alias("seq"), F.length(without_space(seq)).alias("length"), "ord"))


def read_fasta(spark: SparkSession, path: str | list[str], ranges: bool = False) -> DataFrame:
    """FASTA files, plain or gzipped; plain ones are read in parallel splits, one record per row.

    With `ranges` files are read in byte ranges of a fixed size, so that `ord` is the same in every scan."""
    if ranges:
        return parse_fasta(read_records(spark, path, "fasta").select(F.get("lines", F.lit(0)).alias("value"), "ord"))
    return parse_fasta(read_lines(spark, path, "\n>"))


def parse_fastq(lines: DataFrame, mate: int | None = None) -> DataFrame:
    """Reads from numbered lines (`value, file, line, ord`): four lines make a record."""
    part = F.col("line") % 4

    def nth(n: int) -> Column:
        return F.max(F.when(part == n, F.col("value")))

    records = lines.groupBy("file", F.floor(F.col("line") / 4).alias("ord")).agg(
        nth(0).alias("_head"), nth(1).alias("seq"), nth(3).alias("qual"))
    head = F.regexp_replace("_head", "^@", "")
    return records.where(F.col("_head") != "").select(
        "file", _first_word(head).alias("read_id"), _after_first_word(head).alias("descr"), "seq", "qual",
        F.lit(mate).cast("int").alias("mate"), "ord")


def read_fastq(spark: SparkSession, path: str | list[str], mate: int | None = None,
               range_bytes: int = RANGE_BYTES) -> DataFrame:
    """FASTQ files; `ord` is the 0-based number of the record in its file.

    Tasks find the records of their byte range themselves: lines are neither landed nor shuffled. A gzipped file is
    one task's work; repartition after reading if there are few large ones.
    """
    rows = read_records(spark, path, "fastq", range_bytes, number=True)
    head = F.regexp_replace(F.get("lines", F.lit(0)), "^@", "")
    return rows.select("file", _first_word(head).alias("read_id"), _after_first_word(head).alias("descr"),
                       F.get("lines", F.lit(1)).alias("seq"), F.get("lines", F.lit(3)).alias("qual"),
                       F.lit(mate).cast("int").alias("mate"), "ord")


def _ann_rows(pairs: DataFrame) -> DataFrame:
    """From the two lines `_a` and `_b` of each sequence."""
    a, b = F.split("_a", r"\s+", 3), F.split(F.col("_b"), r"\s+")
    out = pairs.where(F.col("_b").isNotNull()).select(
        F.get(a, F.lit(1)).alias("ref_id"), F.coalesce(F.get(a, F.lit(2)), F.lit("")).alias("descr"),
        F.get(b, F.lit(1)).try_cast("long").alias("length"))
    acc = F.regexp_extract("ref_id", r"(acc\|[^|]+)", 1)
    return out.withColumn("taxid", extract_tag("ref_id", "taxid").try_cast("long")).withColumn(
        "acc", F.when(acc != "", acc))


def parse_ann(lines: DataFrame) -> DataFrame:
    """Reference lengths from numbered lines: after one header line, two lines per sequence."""
    body = lines.where(F.col("line") > 0).withColumn("_pair", F.floor((F.col("line") - 1) / 2))
    first = (F.col("line") - 1) % 2 == 0
    return _ann_rows(body.groupBy("file", "_pair").agg(
        F.max(F.when(first, F.col("value"))).alias("_a"), F.max(F.when(~first, F.col("value"))).alias("_b")))


def read_ann(spark: SparkSession, path: str | list[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Reference-length files, read in byte ranges; the first line is a total."""
    rows = read_records(spark, path, "ann", range_bytes)
    return _ann_rows(rows.select(F.get("lines", F.lit(0)).alias("_a"), F.get("lines", F.lit(1)).alias("_b")))


def read_fai(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Sequence index: id, length, offset, bases and bytes per line."""
    return spark.read.csv(path, sep="\t", quote="", schema=(
        "seq_id string, length long, offset long, line_bases int, line_width int"))


def parse_hmm_flat(records: DataFrame) -> DataFrame:
    """`acc, body, ord` per profile model; the accession has no version."""
    acc = F.regexp_extract("value", r"(?m)^ACC\s+(PF\d+)", 1)
    return records.where(F.trim("value") != "").select(acc.alias("acc"), F.col("value").alias("body"), "ord")


def read_hmm_flat(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_hmm_flat(read_lines(spark, path, "\n//\n"))


def parse_family_fasta(records: DataFrame, curated: bool = True) -> DataFrame:
    """Family references: `subject, model_len, acc, name, descr`.

    A curated header reads `id acc, name, description [class]`; trailing punctuation, a repeated family id in
    front of the description and the class behind it are removed. Otherwise all text after the id is `descr`.
    """
    rows = parse_fasta(records).where(F.col("length") > 0)
    if not curated:
        return rows.select(F.col("seq_id").alias("subject"), F.col("length").alias("model_len"), "descr")
    part = F.split("header", r"\s+", 4)

    def bare(c: Column) -> Column:
        return F.regexp_replace(F.coalesce(c, F.lit("")), r"\W+$", "")

    descr = F.regexp_replace(F.regexp_replace(F.coalesce(F.get(part, F.lit(3)), F.lit("")), r"^KOG\d+,\s+", ""),
                             r"\s+\[.+$", "")
    return rows.select(F.col("seq_id").alias("subject"), F.col("length").alias("model_len"),
                       bare(F.get(part, F.lit(1))).alias("acc"), bare(F.get(part, F.lit(2))).alias("name"),
                       descr.alias("descr"))


def read_family_fasta(spark: SparkSession, path: str | list[str], curated: bool = True) -> DataFrame:
    return parse_family_fasta(read_lines(spark, path, "\n>"), curated)
