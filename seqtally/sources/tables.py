"""Alignment, hit, classifier, taxonomy, hierarchy, variant and sheet formats.

Each `read_x` is a text scan followed by `parse_x`, which works on any DataFrame of `value` (and `ord`).
Land the result as Parquet once: text cannot be filtered or pruned while it is read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtally.functions.expr import extract_tag
from seqtally.sources.text import read_lines, without_comments


def _at(parts: Column, i: int) -> Column:
    return F.get(parts, F.lit(i))


def _columns(lines: DataFrame, pattern: str, schema: Sequence[tuple[str, int, str]], limit: int = -1) -> DataFrame:
    """Chosen fields of each line, as (name, position, type); `ord` is kept when there is one.

    A field that is no number is null: filters of later steps may be evaluated before the one that takes out headers.
    """
    parts = F.col("_p")
    return lines.withColumn("_p", F.split("value", pattern, limit)).select(
        *[_at(parts, i).try_cast(kind).alias(name) for name, i, kind in schema],
        *(["ord"] if "ord" in lines.columns else []))


# ---- alignments ----------------------------------------------------------------------------------


def parse_sam(lines: DataFrame) -> DataFrame:
    """Alignment rows with score and tags, those without a place (reference `*`) included; no header lines."""
    fixed = [("read_id", 0, "string"), ("flag", 1, "int"), ("ref_id", 2, "string"), ("pos", 3, "int"),
             ("mapq", 4, "int"), ("cigar", 5, "string"), ("mate_ref", 6, "string"), ("mate_pos", 7, "int"),
             ("tlen", 8, "int"), ("seq", 9, "string"), ("qual", 10, "string")]
    rows = (lines.where(~F.col("value").startswith("@") & (F.col("value") != ""))
            .withColumn("_p", F.split("value", "\t")))
    tags = F.slice("_p", 12, F.greatest(F.size("_p") - 11, F.lit(0)))
    scores = F.filter(tags, lambda t: t.contains("AS:i:"))
    score = F.regexp_extract(F.get(scores, F.lit(0)), r"AS:i:(-?\d+)", 1)
    return rows.select(
        *[_at(F.col("_p"), i).try_cast(kind).alias(name) for name, i, kind in fixed], tags.alias("tags"),
        score.try_cast("int").alias("score"), F.col("value").alias("raw"),
        *(["ord"] if "ord" in lines.columns else []))


def read_sam(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The lines are landed once: choosing alignments joins rows on their order."""
    return parse_sam(read_lines(spark, path, land=True))


def sam_headers(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("value").startswith("@"))


# ---- hits ----------------------------------------------------------------------------------------

HIT_COLUMNS = [("query", 0, "string"), ("subject", 1, "string"), ("pct_iden", 2, "double"), ("aln_len", 3, "int"),
               ("mism", 4, "int"), ("gaps", 5, "int"), ("q_b", 6, "int"), ("q_e", 7, "int"), ("s_b", 8, "int"),
               ("s_e", 9, "int"), ("evalue", 10, "double"), ("bits", 11, "double")]


def parse_hits(lines: DataFrame) -> DataFrame:
    """Tabular hits, twelve fields between white space, `#` lines skipped."""
    return _columns(without_comments(lines), r"\s+", HIT_COLUMNS)


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """A hits file, or a directory of them (hidden files are skipped)."""
    return parse_hits(read_lines(spark, path))


def parse_domtbl(lines: DataFrame) -> DataFrame:
    """Domain hits: 22 fields between white space, then a description that keeps its spaces."""
    return _columns(without_comments(lines), r"\s+", [
        ("hmm_name", 0, "string"), ("hmm_acc", 1, "string"), ("hmm_len", 2, "int"), ("query", 3, "string"),
        ("q_len", 5, "int"), ("evalue", 6, "double"), ("h_b", 15, "int"), ("h_e", 16, "int"), ("q_b", 17, "int"),
        ("q_e", 18, "int"), ("descr", 22, "string")], 23)


def read_domtbl(spark: SparkSession, path: str) -> DataFrame:
    return parse_domtbl(read_lines(spark, path))


def domain_hits(dom: DataFrame) -> DataFrame:
    """Domain rows in the column names of tabular hits, for the non-overlap and abundance operators."""
    return dom.select("query", F.col("hmm_acc").alias("subject"), F.col("h_b").alias("s_b"), F.col("h_e").alias("s_e"),
                      "q_b", "q_e", "evalue", "ord")


def domain_families(dom: DataFrame, max_evalue: float = 1e-3) -> DataFrame:
    """Family table of the domains hit: name, length and description of the first row of each."""
    first = F.min_by(F.struct(F.col("hmm_len").alias("model_len"), F.col("hmm_name").alias("name"), "descr"),
                     F.col("ord"))
    return (dom.where(F.col("evalue") <= max_evalue).groupBy(F.col("hmm_acc").alias("subject"))
            .agg(first.alias("_f")).select("subject", "_f.*"))


def parse_tbl(lines: DataFrame) -> DataFrame:
    """Per-sequence model hits: name, accession, query, e-value and description."""
    return _columns(without_comments(lines), r"\s+", [
        ("name", 0, "string"), ("acc", 1, "string"), ("query", 2, "string"), ("evalue", 4, "double"),
        ("descr", 18, "string")], 19)


def read_tbl(spark: SparkSession, path: str) -> DataFrame:
    return parse_tbl(read_lines(spark, path))


def parse_clstr_ann(records: DataFrame) -> DataFrame:
    """`ref_id, n_members, ko, descr, taxids` from records of a `>` line and its child lines."""
    lines = F.split(F.regexp_replace("value", "^>", ""), "\n")
    head = F.split(lines[0], "\t")
    n_taxa = F.coalesce(_at(head, 2).try_cast("int"), F.lit(0))
    child = F.transform(F.slice(lines, F.lit(2), n_taxa), lambda x: F.get(F.split(x, "\t"), F.lit(1)).try_cast("long"))
    return records.where(F.trim("value") != "").select(
        head[0].alias("ref_id"), _at(head, 1).try_cast("int").alias("n_members"),
        extract_tag(F.coalesce(_at(head, 3), F.lit("")), "KO", r"\w+").alias("ko"), _at(head, 4).alias("descr"),
        child.alias("taxids"))


def read_clstr_ann(spark: SparkSession, path: str) -> DataFrame:
    return parse_clstr_ann(read_lines(spark, path, "\n>"))


def parse_class_map(lines: DataFrame) -> DataFrame:
    """`letters, family, descr` from `[JK] COG0001 text` lines."""
    pattern = r"^\[(\w+)\]\s*(\S*)\s*(.*)$"
    return lines.where(F.col("value").rlike(r"^\[\w+\]")).select(
        *[F.regexp_extract("value", pattern, i).alias(n) for i, n in ((1, "letters"), (2, "family"), (3, "descr"))])


def read_class_map(spark: SparkSession, path: str) -> DataFrame:
    return parse_class_map(read_lines(spark, path))


def parse_class_names(lines: DataFrame) -> DataFrame:
    """`class, descr, ord` from indented `[J] text` lines."""
    pattern = r"^\s+\[(\w+)\]\s*(.*)$"
    return lines.where(F.col("value").rlike(r"^\s+\[\w+\]")).select(
        F.regexp_extract("value", pattern, 1).alias("class"), F.regexp_extract("value", pattern, 2).alias("descr"),
        "ord")


def read_class_names(spark: SparkSession, path: str) -> DataFrame:
    return parse_class_names(read_lines(spark, path))


# ---- classifier and taxonomy ---------------------------------------------------------------------


def parse_classified(lines: DataFrame) -> DataFrame:
    """Per-read classifier rows; the header line is skipped."""
    rows = lines.where(~F.col("value").startswith("readID") & (F.col("value") != ""))
    return _columns(rows, "\t", [
        ("read_id", 0, "string"), ("seq_id", 1, "string"), ("taxid", 2, "long"), ("score", 3, "long"),
        ("score2", 4, "long"), ("hit_len", 5, "int"), ("query_len", 6, "int"), ("n_match", 7, "int")])


def read_classified(spark: SparkSession, path: str) -> DataFrame:
    return parse_classified(read_lines(spark, path))


def parse_kreport(lines: DataFrame) -> DataFrame:
    """Taxids of a classifier report: the fifth field, where it is a number."""
    taxid = F.get(F.split(F.ltrim(F.regexp_replace("value", r"^\s+", "")), r"\s+"), F.lit(4))
    return lines.select(taxid.alias("_t")).where(F.col("_t").rlike(r"^\d+$")).select(
        F.col("_t").try_cast("long").alias("taxid")).distinct()


def read_kreport(spark: SparkSession, path: str) -> DataFrame:
    return parse_kreport(read_lines(spark, path))


def parse_names_dmp(lines: DataFrame) -> DataFrame:
    """Scientific names of a taxonomy dump."""
    p = F.split("value", r"\|")
    return lines.where(F.col("value").contains("scientific name")).select(
        F.regexp_replace(p[0], r"\s+", "").try_cast("long").alias("taxid"),
        F.regexp_replace(p[1], r"^\s+|\s+$", "").alias("name"))


def parse_nodes_dmp(lines: DataFrame) -> DataFrame:
    """Taxonomy tree; white space is removed from the rank (`no rank` becomes `norank`)."""
    p = F.transform(F.split("value", r"\|"), lambda x: F.regexp_replace(x, r"\s+", ""))
    return lines.where(F.col("value") != "").select(
        p[0].try_cast("long").alias("taxid"), p[1].try_cast("long").alias("parent"), p[2].alias("rank"))


def read_taxdump(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, names) of a taxonomy dump folder."""
    return (parse_nodes_dmp(read_lines(spark, f"{folder}/nodes.dmp")),
            parse_names_dmp(read_lines(spark, f"{folder}/names.dmp")))


LINEAGE_RANKS = ["superkingdom", "kingdom", "phylum", "class", "order", "family", "genus", "species", "toprank"]


def parse_lineage(lines: DataFrame) -> DataFrame:
    """Leaf rows of a lineage table; `\\N` is null."""
    fields = [("taxid", 0, "long"), ("rank", 1, "string"), ("name", 2, "string")]
    for i, rank in enumerate(LINEAGE_RANKS):
        fields += [(rank, 3 + 2 * i, "string"), (f"{rank}_ti", 4 + 2 * i, "string")]
    rows = _columns(without_comments(lines), "\t", fields).where(F.col("rank") == "toprank")
    out = [F.nullif(F.col(r), F.lit("\\N")).alias(r) for r in LINEAGE_RANKS]
    ids = [F.nullif(F.col(f"{r}_ti"), F.lit("\\N")).try_cast("long").alias(f"{r}_ti") for r in LINEAGE_RANKS]
    return rows.select("taxid", *[c for pair in zip(out, ids) for c in pair])


def read_lineage(spark: SparkSession, path: str) -> DataFrame:
    return parse_lineage(read_lines(spark, path))


def parse_header_taxa(seq: DataFrame, tag: str = "taxid", name_tag: str = "taxdes") -> DataFrame:
    """`taxid, taxdes` stamped into sequence headers."""
    return seq.select(extract_tag("header", tag).try_cast("long").alias("taxid"),
                      extract_tag("header", name_tag, r"\w+").alias("taxdes")).where(F.col("taxid").isNotNull())


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Accession catalogue: taxid, name, accession, division, status, length."""
    return _columns(read_lines(spark, path), "\t", [
        ("taxid", 0, "long"), ("name", 1, "string"), ("acc", 2, "string"), ("div", 3, "string"),
        ("status", 4, "string"), ("length", 5, "long")])


def read_rep_genomes(spark: SparkSession, path: str) -> DataFrame:
    """Catalogue of representative genomes: a headed table of tab-separated text."""
    return spark.read.csv(path, sep="\t", header=True, quote="")


# ---- hierarchy -----------------------------------------------------------------------------------


def read_brite(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """`file, ord, value` lines of hierarchy files, as `flatten_brite` and `brite_nodes` take them."""
    return read_lines(spark, path).select(F.col("ord.file").alias("file"), "ord", "value")


# ---- variants and pileups ------------------------------------------------------------------------


def parse_variants(lines: DataFrame) -> DataFrame:
    """`acc, taxid, position, ref, cons, var` from caller rows whose id carries `acc|X|taxid|N`."""
    rows = _columns(lines.where(~F.col("value").startswith("Chrom") & (F.col("value") != "")), "\t", [
        ("chrom", 0, "string"), ("position", 1, "long"), ("ref", 2, "string"), ("cons", 3, "string"),
        ("var", 18, "string")])
    part = F.split("chrom", r"\|")
    return rows.select(F.get(part, F.lit(1)).alias("acc"), F.get(part, F.lit(3)).try_cast("long").alias("taxid"),
                       "position", "ref", "cons", "var")


def read_variants(spark: SparkSession, path: str) -> DataFrame:
    return parse_variants(read_lines(spark, path))


def parse_pileup(lines: DataFrame) -> DataFrame:
    return _columns(lines, "\t", [("seq_id", 0, "string"), ("pos", 1, "long"), ("ref", 2, "string"),
                                  ("depth", 3, "int"), ("bases", 4, "string"), ("quals", 5, "string")])


def read_pileup(spark: SparkSession, path: str) -> DataFrame:
    return parse_pileup(read_lines(spark, path))


# ---- sheets and logs -----------------------------------------------------------------------------


def parse_samples(lines: DataFrame) -> DataFrame:
    """`sample_id, data, ord`: lines that start with a word character."""
    p = F.split(F.rtrim("value"), r"\s+")
    return lines.where(F.col("value").rlike(r"^\w")).select(
        p[0].alias("sample_id"), F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))).alias("data"), "ord")


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    return parse_samples(read_lines(spark, path))


def read_opts(spark: SparkSession, path: str) -> DataFrame:
    """Parameter sheet: `job, opts`."""
    return read_samples(spark, path).select(F.col("sample_id").alias("job"), F.col("data").alias("opts"))


def parse_job_log(lines: DataFrame) -> DataFrame:
    """Job cost rows from `key=value` lines; lines without the four cost fields are skipped."""
    def field(name: str, pattern: str = r"\S+") -> Column:
        return F.regexp_extract("value", rf"\b{name}=({pattern})", 1)

    numbers = ["cores", "time_start", "time_end", "time_spent"]
    rows = lines.where(F.col("value").rlike(r"cores=\d+ time_start=\d+ time_end=\d+ time_spent=\d+"))
    return rows.select(*[field(n).alias(n) for n in ("sample", "job", "host", "queue")],
                       *[field(n, r"\d+").try_cast("long").alias(n) for n in numbers])


def read_job_log(spark: SparkSession, path: str) -> DataFrame:
    return parse_job_log(read_lines(spark, path))


# ---- many samples --------------------------------------------------------------------------------


def sample_files(spark: SparkSession, root: str, file: str) -> DataFrame:
    """`sample_id, files, bytes` of the samples whose `root/<sample>/<file>` isn't empty; `file` may be a pattern.

    A scan of names and sizes: nothing is opened, and no list of paths is kept on the driver.
    """
    depth = len(file.split("/"))
    found = spark.read.format("binaryFile").load(f"{root}/*/{file}").select("path", "length")
    sample = F.element_at(F.split("path", "/"), -1 - depth)
    return found.groupBy(sample.alias("sample_id")).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def _sheet(spark: SparkSession, samples: DataFrame | Sequence[str]) -> DataFrame:
    if isinstance(samples, DataFrame):
        return samples
    return spark.createDataFrame([(s, i) for i, s in enumerate(samples)], "sample_id string, ord long")


def present_samples(spark: SparkSession, root: str, file: str, samples: DataFrame | Sequence[str]) -> list[str]:
    """The samples whose `root/<sample>/<file>` exists and is not empty, in sheet order: the columns of a matrix."""
    sheet = _sheet(spark, samples)
    held = sheet.join(sample_files(spark, root, file).where("bytes > 0"), "sample_id", "left_semi")
    return [r.sample_id for r in held.orderBy("ord").select("sample_id").collect()]


def read_per_sample(spark: SparkSession, root: str, file: str, samples: DataFrame | Sequence[str],
                    reader: Callable[[SparkSession, str], DataFrame], on_missing: str = "error") -> DataFrame:
    """Rows of `root/<sample>/<file>` of all samples of the sheet in one scan, with `sample_id` from the path.

    The table of files is joined to the sheet `sample_id, ord`. A sample whose file is missing or empty is an error, or
    skipped with `on_missing="skip"`; give `merge_samples` the `present_samples` then, so that a skipped sample gets no
    column. Files of samples that the sheet doesn't name give no rows.
    """
    sheet = _sheet(spark, samples)
    if on_missing == "error":
        missing = sheet.join(sample_files(spark, root, file).where("bytes > 0"), "sample_id", "left_anti")
        named = [r.sample_id for r in missing.orderBy("ord").select("sample_id").limit(21).collect()]
        if named:
            more = ", ..." if len(named) > 20 else ""
            raise FileNotFoundError(f"{file} is missing or empty for: {', '.join(named[:20])}{more}")
    rows = reader(spark, f"{root}/*/{file}")
    depth = len(file.split("/"))
    named = rows.withColumn("sample_id", F.element_at(F.split(F.col("ord.file"), "/"), -1 - depth))
    # One row per sample: a cohort's sheet, which the planner may broadcast by its size.
    return named.join(sheet.select("sample_id").distinct(), "sample_id", "left_semi").select(*named.columns)


def read_headed_tsv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Headed tab-separated tables with text columns and `ord`; a `#` in front of the header is dropped."""
    table = spark.read.csv(paths, sep="\t", header=True, quote="")
    named = table.select("*", F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row")).alias("ord"))
    first = table.columns[0]
    return named.withColumnRenamed(first, first.lstrip("#"))
