"""Operators on sequence records and reads.

Sequence rows have `seq_id, header, seq` (and `ord`), read rows `read_id, descr, seq, qual, ord`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructType

from seqtally.functions.expr import extract_tag, header_depth, without_space
from seqtally.operators.common import checked_broadcast, keep_or_drop, names, spread_join
from seqtally.session import cut_lineage
from seqtally.sources.store import fetch_from_store


def with_length(seq: DataFrame) -> DataFrame:
    return seq.withColumn("length", F.length(without_space("seq")))


def seq_lengths(seq: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """`seq_id, length`; white space does not count and empty sequences are dropped."""
    return with_length(seq).where(F.col("length") > 0).select(*names(by, "seq_id"), "length")


def filter_min_len(seq: DataFrame, cutoff: int, ann: str | None = None) -> DataFrame:
    """Sequences of at least `cutoff`; `ann` stamps `|ann|length` before the first white space of the header."""
    kept = with_length(seq).where(F.col("length") >= cutoff)
    if ann:
        stamp = F.concat(F.lit(f"|{ann}|"), F.col("length").cast("string"))
        split = F.regexp_extract("header", r"^(\S*)", 1)
        rest = F.expr("substring(header, length(regexp_extract(header, '^(\\\\S*)', 1)) + 1)")
        kept = kept.withColumn("header", F.concat(split, stamp, rest))
    return kept


def filter_max_len(seq: DataFrame, cutoff: int) -> DataFrame:
    return with_length(seq).where(F.col("length") <= cutoff)


def sort_by_len(seq: DataFrame, decreasing: bool = True) -> DataFrame:
    """Sequences by length, in input order among equals. A range-partitioned sort, not a single task."""
    lengths = with_length(seq)
    return lengths.orderBy(F.desc("length") if decreasing else F.col("length"), "ord")


def file_number(name: Column) -> Column:
    """(part, split) numbers of a file that Spark wrote; as text, part 100000 would come before part 20000."""
    return F.struct(F.regexp_extract(name, r"^part-(\d+)", 1).try_cast("long").alias("part"),
                    F.regexp_extract(name, r"-c(\d+)\.", 1).try_cast("long").alias("split"))


def numbered(df: DataFrame, order: str = "ord", start: int = 1, by: Sequence[str] = ()) -> DataFrame:
    """Add `number`: start, start + 1, ... in the given order, separately within each `by` group.

    An order that ends in a running number, as readers give it (file, split, row), needs only the counts per split:
    a row's number is its own plus those of the splits before, a table of one row per split that is joined to the
    rows where they are. Nothing is sorted or copied. Where rows have been filtered out, so that a split's numbers
    have gaps, its order columns alone are sorted and written, and the records meet their number by them.

    The rows are read twice, so their order has to be the same for both: that of tables, landed text and
    `read_fasta(..., ranges=True)` is; plain text scans may be split anew if the number of cores changes.
    """
    kind = df.schema[order].dataType
    fields = kind.fields if isinstance(kind, StructType) else []
    if not isinstance(kind, IntegralType) and [f.name for f in fields] != ["file", "block", "row"]:
        return _numbered_by_sort(df, order, start, by)
    at = F.col(f"{order}.{fields[-1].name}") if fields else F.col(order)
    split = [F.col(f"{order}.{f.name}").alias(f"_split{i}") for i, f in enumerate(fields[:-1])]
    splits = [f"_split{i}" for i in range(len(split))]
    sizes = cut_lineage(df.groupBy(*by, *split).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(at).alias("_first"), F.max(at).alias("_last")))
    if not sizes.where((F.col("_last") - F.col("_first") + 1 != F.col("_rows")) | F.col("_first").isNull()).isEmpty():
        return _numbered_by_rank(df, order, start, by) if fields else _numbered_by_sort(df, order, start, by)
    before = Window.partitionBy(*by).orderBy(*splits).rowsBetween(Window.unboundedPreceding, -1) if splits else None
    offsets = sizes.select(*by, *splits, (F.coalesce(F.sum("_rows").over(before), F.lit(0)) if splits else F.lit(0))
                           .cast("long").alias("_before"), "_first")
    if not by and not splits:
        one = offsets.first()
        return df.withColumn("number", at - F.lit(one._first if one else 0) + start)
    rows = df.withColumns({name: c for name, c in zip(splits, split)})
    return (rows.join(checked_broadcast(cut_lineage(offsets)), [*by, *splits])
            .withColumn("number", F.col("_before") + at - F.col("_first") + start)
            .select(*df.columns, "number"))


def _numbered_by_rank(df: DataFrame, order: str, start: int, by: Sequence[str]) -> DataFrame:
    """For a unique order: order columns are numbered by themselves, and meet the rows again."""
    ranks = _numbered_by_sort(df.select(*by, order), order, start, by)
    return df.join(ranks, [*by, order]).select(*df.columns, "number")


def _numbered_by_sort(df: DataFrame, order: str, start: int, by: Sequence[str]) -> DataFrame:
    """The rows are range-sorted and written out, which fixes their place: the files follow the order by the part and
    split numbers in their names, and a row knows its index in its file. No task ever sees more than its range.
    """
    columns = df.columns
    placed = cut_lineage(df.orderBy(*by, order)).select(
        *columns, file_number(F.col("_metadata.file_name")).alias("_file"), F.col("_metadata.row_index").alias("_pos"))
    sizes = placed.groupBy(*by, "_file").agg(F.count(F.lit(1)).alias("_rows"), F.min("_pos").alias("_first"))
    before = Window.partitionBy(*by).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*by, "_file", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    # Written and counted, so that the rows are not shuffled to meet this short table.
    return (placed.join(checked_broadcast(cut_lineage(offsets)), [*by, "_file"])
            .withColumn("number", F.col("_before") + F.col("_pos") - F.col("_first") + start)
            .select(*columns, "number"))


def renumber(seq: DataFrame, prefix: str, start: int = 1, by: Sequence[str] = ()) -> DataFrame:
    """New ids `prefix` + running number; the old header becomes the description."""
    out = numbered(seq, start=start, by=by)
    new = F.concat(F.lit(prefix), F.col("number").cast("string"))
    return (out.withColumn("seq_id", new).withColumn("descr", F.col("header"))
            .withColumn("header", F.concat_ws(" ", new, F.col("header"))).drop("number"))


def fastq_to_fasta(reads: DataFrame, sample: str = "sample_id") -> DataFrame:
    """Sequence records named `Sample|<sample>|<n>`, numbered per sample in read order."""
    out = numbered(reads, by=[sample])
    new = F.concat(F.lit("Sample|"), F.col(sample), F.lit("|"), F.col("number").cast("string"))
    old = F.concat_ws(" ", F.col("read_id"), F.nullif(F.col("descr"), F.lit("")))
    return out.select(sample, new.alias("seq_id"), F.concat_ws(" ", new, old).alias("header"), "seq", "ord")


def assembly_stats(seq: DataFrame, ref_len: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Contigs, total, mean (whole) and longest length, N50 and N80, against the total or `ref_len`.

    Sequences are first counted per length; the running sum goes over that histogram, whose size is the
    number of distinct lengths.
    """
    hist = seq_lengths(seq, by).groupBy(*names(by, "length")).agg(F.count(F.lit(1)).alias("_n"))
    totals = hist.groupBy(*by).agg(
        F.sum("_n").alias("n_contigs"), F.sum(F.col("_n") * F.col("length")).alias("total_length"),
        F.max("length").alias("longest"))
    down = Window.partitionBy(*by).orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*by)
    run = (hist.withColumn("_cum", F.sum(F.col("_n") * F.col("length")).over(down))
           .withColumn("_goal", F.lit(ref_len) if ref_len is not None
                       else F.sum(F.col("_n") * F.col("length")).over(whole)))
    nx = run.groupBy(*by).agg(
        F.max(F.when(F.col("_cum") >= F.col("_goal") * 0.5, F.col("length"))).alias("n50"),
        F.max(F.when(F.col("_cum") >= F.col("_goal") * 0.8, F.col("length"))).alias("n80"))
    mean = F.floor(F.col("total_length") / F.col("n_contigs")).cast("long")
    if by:
        out = totals.join(nx, list(by))
    else:
        out = totals.select("*", nx.select("n50").scalar().alias("n50"), nx.select("n80").scalar().alias("n80"))
    return out.select(*by, "n_contigs", "total_length", mean.alias("mean_length"), "longest",
                      F.coalesce("n50", F.lit(0)).alias("n50"), F.coalesce("n80", F.lit(0)).alias("n80"))


def contig_header_depths(seq: DataFrame) -> DataFrame:
    """`seq_id, depth` of the contigs whose header carries `_cov_X`."""
    return seq.select("seq_id", header_depth("header").alias("depth")).where(F.col("depth").isNotNull())


def strip_stops(seq: DataFrame) -> DataFrame:
    """Protein sequences without stop symbols."""
    return seq.withColumn("seq", F.translate("seq", "*", ""))


# ---- selection by id -----------------------------------------------------------------------------


def _keyed(seq: DataFrame, key: str, tag: str | None) -> DataFrame:
    return seq.withColumn("_id", extract_tag("header", tag) if tag else F.col(key).cast("string"))


def _id_list(ids: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """Ids as given in list files: `>` and anything after the first white space do not count."""
    text = F.regexp_replace(F.regexp_replace(F.col(column).cast("string"), r"\s.*$", ""), "^>", "")
    return ids.select(*by, text.alias("_id"))


def fetch_by_ids(seq: DataFrame, ids: DataFrame, tag: str | None = None, key: str = "seq_id",
                 id_col: str = "id", by: Sequence[str] = (), bloom_bits: int | None = None) -> DataFrame:
    """Records whose id (or `tag|N` in the header) is listed. A header without the tag is not selected.

    With `by`, a list counts for the records of its own sample only. `bloom_bits` (see `keep_or_drop`) keeps records
    that are surely not listed out of the shuffle: for wide records and long lists.
    """
    return keep_or_drop(_keyed(seq, key, tag), _id_list(ids, id_col, by), names(by, "_id"), "left_semi",
                        bloom_bits=bloom_bits).drop("_id")


def exclude_ids(seq: DataFrame, ids: DataFrame, tag: str | None = None, key: str = "seq_id",
                id_col: str = "id", by: Sequence[str] = (), bloom_bits: int | None = None) -> DataFrame:
    """Records whose id is not listed (for their sample, with `by`). With `bloom_bits`, records that are surely not
    listed are kept without a shuffle."""
    return keep_or_drop(_keyed(seq, key, tag), _id_list(ids, id_col, by), names(by, "_id"), "left_anti",
                        bloom_bits=bloom_bits).drop("_id")


def fetch_large(store: DataFrame | str, ids: DataFrame, headers: DataFrame | None = None, tag: str | None = None,
                id_col: str = "id") -> DataFrame:
    """Records of a large store with their full header text attached from `headers(seq_id, header)`.

    A path names a store made by `write_store`: then only the files whose id range holds a listed id are opened.
    """
    if isinstance(store, str):
        if tag:
            raise ValueError("a store is fetched from by its key; rows of a tag need a scan")
        listed = _id_list(ids, id_col, ()).withColumnRenamed("_id", "id")
        found = fetch_from_store(ids.sparkSession, store, listed)
        out = found if "header" in found.columns else found.withColumn("header", F.col("seq_id"))
    else:
        keyed = store if "header" in store.columns else store.withColumn("header", F.col("seq_id"))
        out = fetch_by_ids(keyed, ids, tag, id_col=id_col)
    if headers is None:
        return out
    full = headers.select("seq_id", F.col("header").alias("_full"))
    return (out.join(full, "seq_id", "left").withColumn("header", F.coalesce("_full", "header")).drop("_full"))


def fetch_hmm(models: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Profile models by accession, versions ignored on both sides."""
    bare = F.regexp_extract(F.col(id_col), r"(PF\d+)", 1)
    return models.join(ids.select(bare.alias("acc")).distinct(), "acc", "left_semi")


def rep_genomes_for(species: DataFrame, catalog: DataFrame) -> DataFrame:
    """Catalogue rows of the listed species."""
    return catalog.join(species.select("species_ti").distinct(), "species_ti", "left_semi")


def pass_depth(orf: DataFrame, depth: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Contig depth handed down to genes; genes of a contig with no or zero depth are dropped."""
    genes = orf.select(*names(by, "orf_id"), F.col("scaffold").alias("contig"))
    known = depth.where(F.col("depth") != 0).select(*names(by, "contig"), "depth")
    return spread_join(genes, known, names(by, "contig")).select(*names(by, "orf_id"), "depth")


def filter_reads(reads: DataFrame, hits_by_db: DataFrame, key: str = "read_id", by: Sequence[str] = ()) -> DataFrame:
    """Reads that hit none of the host and contaminant databases in `hits_by_db(<by>, db, read_id)`."""
    hits = hits_by_db.select(*by, F.col("read_id").alias(key))
    return keep_or_drop(reads, hits, names(by, key), "left_anti")


def filter_summary(hits_by_db: DataFrame, both: str = "both", by: Sequence[str] = ()) -> DataFrame:
    """Distinct reads hit per database, and in any of them."""
    pairs = hits_by_db.select(*names(by, "db", "read_id")).distinct()
    per = pairs.groupBy(*names(by, "db")).agg(F.count(F.lit(1)).alias("reads"))
    union = (pairs.select(*names(by, "read_id")).distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("reads"))
             .select(*by, F.lit(both).alias("db"), "reads"))
    return per.unionByName(union)


def with_host_rows(superkingdoms: DataFrame, summary: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Superkingdom read table followed by the reads removed per database."""
    rows = summary.select(*by, F.lit(None).cast("long").alias("taxid"), F.col("db").alias("superkingdom"), "reads")
    return superkingdoms.unionByName(rows)


def ids_above(df: DataFrame, column: str, cutoff: float, key: str = "id") -> DataFrame:
    """Ids of the rows whose value exceeds the cutoff."""
    return df.where(F.col(column).cast("double") > cutoff).select(key)


def rank_classifier_report(df: DataFrame, abundance: str = "abundance", key: str = "taxid") -> DataFrame:
    """Rows with some abundance, largest first."""
    return df.where(F.col(abundance) != 0).orderBy(F.desc(abundance), key)


def annotate_headers(seq: DataFrame, catalog: DataFrame) -> DataFrame:
    """Stamp `|taxid|N|taxdes|name` behind the id of the sequences found in `catalog(acc, taxid, name, ord)`.

    The first name of a taxid is used, with everything but word characters turned into `_`.
    """
    wanted = catalog.join(seq.select(F.col("seq_id").alias("acc")).distinct(), "acc", "left_semi")
    label = wanted.groupBy("taxid").agg(F.min_by("name", F.col("ord")).alias("_name"))
    found = (wanted.groupBy("acc").agg(F.max_by("taxid", F.col("ord")).alias("taxid")).join(label, "taxid")
             .select(F.col("acc").alias("seq_id"), "taxid",
                     F.coalesce(F.nullif(F.regexp_replace("_name", r"\W+", "_"), F.lit("")), F.lit("none"))
                     .alias("taxdes")))
    out = seq.join(found, "seq_id", "left")
    stamp = F.concat(F.lit("|taxid|"), F.col("taxid").cast("string"), F.lit("|taxdes|"), F.col("taxdes"))
    rest = F.expr("substring(header, length(regexp_extract(header, '^(\\\\S*)', 1)) + 1)")
    header = F.when(F.col("taxid").isNotNull(), F.concat(F.col("seq_id"), stamp, rest)).otherwise(F.col("header"))
    return out.withColumn("header", header).select(*seq.columns)


# ---- pairs ---------------------------------------------------------------------------------------


def split_interleaved(reads: DataFrame, order: str = "ord") -> DataFrame:
    """Add `mate` (1, 2) and `pair` to records that alternate first and second mates by a 0-based number."""
    return reads.withColumn("mate", (F.col(order) % 2 + 1).cast("int")).withColumn("pair", F.floor(F.col(order) / 2))


def interleave(first: DataFrame, second: DataFrame, order: str = "ord") -> DataFrame:
    """Merge two mate tables into one that alternates, matched on their record number.

    The merged order is twice the record number, plus one for the second mate: no join is needed.
    """
    def placed(df: DataFrame, mate: int) -> DataFrame:
        return df.withColumn("mate", F.lit(mate)).withColumn(order, F.col(order) * 2 + (mate - 1))

    return placed(first, 1).unionByName(placed(second, 2)).orderBy(order)


def dereplicate(pairs: DataFrame, len1: int = 150, len2: int = 100, r1: str = "r1", r2: str = "r2",
                key: str = "read_id") -> DataFrame:
    """Read pairs that agree on their first bases, counted, with the smallest id as representative."""
    return (pairs.groupBy(F.substring(r1, 1, len1).alias("r1_prefix"), F.substring(r2, 1, len2).alias("r2_prefix"))
            .agg(F.count(F.lit(1)).alias("size"), F.min(key).alias("representative")))


def model_hit_counts(tbl: DataFrame) -> DataFrame:
    """Hits per model with the name and description of its last row."""
    return (tbl.groupBy("acc").agg(F.max_by(F.struct("name", "descr"), F.col("ord")).alias("_l"),
                                   F.count(F.lit(1)).alias("n_hits"))
            .select(F.col("_l.name").alias("name"), "acc", F.col("_l.descr").alias("descr"), "n_hits"))


def qc_summary(counts: DataFrame, by: Sequence[str] = ("sample_id",)) -> DataFrame:
    """`Total_reads` and `QC_reads` per sample from rows with a `passed` flag, as name and number."""
    per = counts.groupBy(*by).agg(F.count(F.lit(1)).alias("_all"),
                                  F.sum(F.when(F.col("passed"), 1).otherwise(0)).alias("_pass"))
    pairs: list[Column] = [F.struct(F.lit("Total_reads").alias("reads"), F.col("_all").alias("number")),
                           F.struct(F.lit("QC_reads").alias("reads"), F.col("_pass").alias("number"))]
    return per.select(*by, F.explode(F.array(*pairs)).alias("_p")).select(*by, "_p.*")

