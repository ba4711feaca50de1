"""Writers for the text formats. Parquet is the native format: `write_parquet`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtally.sources.lines import write_lines


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ("sample_id",),
                  max_rows: int = 20_000_000) -> None:
    """Parquet by sample; a file holds at most `max_rows`, so that a big sample is several files."""
    df.write.mode("overwrite").option("maxRecordsPerFile", max_rows).partitionBy(*partition_by).parquet(path)


def write_tsv(df: DataFrame, path: str, null: str = "\\N") -> None:
    """Tab-separated text whose header line starts with `#`."""
    first, *others = df.columns
    (df.withColumnRenamed(first, f"#{first}").select(f"#{first}", *others)
     .write.mode("overwrite").option("comment", "\x01")  # else a leading # would be quoted
     .csv(path, sep="\t", header=True, nullValue=null, quote="", escapeQuotes=False))


def _write_text(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").text(path)


def fasta_text(seq: DataFrame) -> DataFrame:
    return seq.select(F.concat(F.lit(">"), F.col("header"), F.lit("\n"), F.col("seq")).alias("value"))


def write_fasta(seq: DataFrame, path: str) -> None:
    _write_text(fasta_text(seq), path)


def fastq_text(reads: DataFrame, *keep: str) -> DataFrame:
    head = F.concat(F.lit("@"), F.concat_ws(" ", F.col("read_id"), F.nullif(F.col("descr"), F.lit(""))))
    return reads.select(F.concat_ws("\n", head, "seq", F.lit("+"), "qual").alias("value"), *keep)


def write_fastq(reads: DataFrame, path: str) -> None:
    _write_text(fastq_text(reads), path)


def write_sam(aln: DataFrame, path: str, headers: DataFrame | None = None, one_section: bool = True) -> None:
    """Alignment lines as they were read, header lines first.

    Files are ranges of the order, so that their names follow it. The headers stand in front of the first file, or
    with `one_section=False` of every file, each of which is then a SAM file of its own. Either all files are there in
    the end or none. Header lines are as many as references: up to 64 MB of them pass through the driver, more are an
    error.
    """
    text = "" if headers is None else header_text(headers)
    rows = aln.select("ord", F.col("raw").alias("value")).repartitionByRange("ord").sortWithinPartitions("ord")
    write_lines(rows.select(F.lit(None).cast("string").alias("key"), "value"), path, text, "first" if one_section else "each")


def header_text(headers: DataFrame, most_bytes: int = 64 << 20) -> str:
    """Header lines in order of `ord`, if there is one."""
    size = headers.agg(F.sum(F.octet_length("value") + 1)).first()[0] or 0
    if size > most_bytes:
        raise ValueError(f"{size} bytes of header lines")
    rows = headers.orderBy("ord") if "ord" in headers.columns else headers
    return "".join(f"{r.value}\n" for r in rows.select("value").collect())


def write_by_key(lines: DataFrame, path: str, key: str, header: str = "", suffix: str = ".tsv") -> None:
    """One text file per key, `<path>/<key><suffix>`, with a header in front; `lines` has `value` and may have `ord`.

    A key's lines pass one by one through one task, which holds none of them. Either all files are there or none.
    """
    order = [key] + (["ord"] if "ord" in lines.columns else [])
    rows = lines.repartition(key).sortWithinPartitions(*order)
    write_lines(rows.select(F.col(key).cast("string").alias("key"), "value"), path, header, "each", suffix)


def write_split(df: DataFrame, path: str, key: str, fmt: str = "parquet", max_rows: int = 20_000_000) -> None:
    """One folder per key value; the rows of a big key stay spread over the tasks that hold them."""
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", max_rows).partitionBy(key)
    if fmt == "parquet":
        writer.parquet(path)
    else:
        writer.csv(path, sep="\t", header=True)
