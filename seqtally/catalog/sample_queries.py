"""Queries over several samples at once, and queries that write files and read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from seqtally.catalog.hit_queries import leaves, refs
from seqtally.catalog.registry import register
from seqtally.catalog.source_queries import _sam_lines
from seqtally.operators import alignments as al
from seqtally.operators import depth as dp
from seqtally.operators import hierarchy as hi
from seqtally.operators import sequences as sq
from seqtally.plans.report import REPORT, hierarchy_matrices, report_table
from seqtally.session import shared_folder
from seqtally.sources import sequences as ss
from seqtally.sources import sinks as sk
from seqtally.sources import tables as ts
from seqtally.sources.store import write_store
from seqtally.sources.text import read_lines

BY = ["sample"]

# ---- samples side by side ------------------------------------------------------------------------

register("filter_reads_by_sample", lambda v: sq.filter_reads(v.sample_reads, v.sample_hits, by=BY).select(
    "sample", "read_id", "seq"), """
    select sample, read_id, seq from {sample_reads} r
    where not exists (select 1 from {sample_hits} h where h.sample = r.sample and h.read_id = r.read_id)""")
register("filter_summary_by_sample", lambda v: sq.filter_summary(v.sample_hits, by=BY), """
    select sample, db, count(distinct read_id) as reads from {sample_hits} group by sample, db
    union all select sample, 'both', count(distinct read_id) from {sample_hits} group by sample""")
register("host_rows_by_sample", lambda v: sq.with_host_rows(
    v.sample_reads.groupBy("sample", "lang").agg(F.count(F.lit(1)).alias("reads"))
    .select("sample", F.length("lang").cast("long").alias("taxid"), F.col("lang").alias("superkingdom"), "reads"),
    sq.filter_summary(v.sample_hits, by=BY), by=BY), """
    select sample, length(lang)::bigint as taxid, lang as superkingdom, count(*) as reads from {sample_reads} group by all
    union all select sample, null, db, count(distinct read_id) from {sample_hits} group by sample, db
    union all select sample, null, 'both', count(distinct read_id) from {sample_hits} group by sample""")


def _listed(v):
    return v.sample_hits.select("sample", F.concat(F.lit(">"), "read_id", F.lit(" note")).alias("id"))


_IN_LIST = "exists (select 1 from {sample_hits} h where h.sample = r.sample and h.read_id = r.read_id)"
register("fetch_by_ids_by_sample", lambda v: sq.fetch_by_ids(v.sample_reads, _listed(v), key="read_id", by=BY).select(
    "sample", "read_id", "seq"), f"select sample, read_id, seq from {{sample_reads}} r where {_IN_LIST}")
register("exclude_ids_by_sample", lambda v: sq.exclude_ids(v.sample_reads, _listed(v), key="read_id", by=BY).select(
    "sample", "read_id", "seq"), f"select sample, read_id, seq from {{sample_reads}} r where not {_IN_LIST}")
register("keep_passing_by_sample", lambda v: dp.keep_passing(
    v.sample_pileup, dp.breadth(v.sample_pileup, v.genome_index, min_breadth=0.2, by=BY), by=BY)
    .select("sample", "seq_id", "pos", "depth"), """
    select sample, seq_id, pos, depth from {sample_pileup} where (sample, seq_id) in (
      select (sample, seq_id) from {sample_pileup} join {genome_index} using (seq_id)
      where depth >= 2 group by sample, seq_id having count(*) / any_value(length) > 0.2)""")
register("pileup_alleles_by_sample", lambda v: dp.pileup_alleles(v.sample_pileup, by=BY), """
    select sample, seq_id, pos, ref, allele, cast(n as bigint) as n from (
      select seq_id, pos, 'C' as ref, 'C' as allele, n_a + n_f as n from {pileup}
      union all select seq_id, pos, 'C', 'A', n_n from {pileup}
      union all select seq_id, pos, 'C', 'G', n_r from {pileup}
      union all select seq_id, pos, 'C', 'T', n_f from {pileup}
      union all select seq_id, pos, 'C', '+AG', n_f from {pileup}) x
    join (select 'S1' as sample, 1 as m union all select 'S2', 3) s on pos % m = 0 where n > 0""")


def _sample_profile(v):
    return hi.ko_abundance(v.sample_genes.where("ko <> ''"), hi.ko_scope(leaves(v)), None, refs(v), by=BY)


register("full_listing_by_sample", lambda v: hi.full_listing(leaves(v), _sample_profile(v), by=BY).groupBy(
    "sample", "file", "ko").agg(F.count(F.lit(1)).alias("leaves"), F.max("depth").alias("depth")), """
    select s.sample, l.file, l.ko, count(*) as leaves, round(coalesce(max(k.depth), 0.0), 6) as depth
    from (select distinct sample from {sample_genes} where ko <> '') s cross join (
      select p_brand as file, 'K' || lpad(cast(p_partkey % 300 as varchar), 5, '0') as ko from part) l
    left join {k} k on k.sample = s.sample and k.ko = l.ko group by s.sample, l.file, l.ko""", {
    "k": """select sample, ko, sum(cast(case when frac > 0 then frac else 1 end as decimal(38,12)))::double as depth
      from {sample_genes} where ko <> '' group by sample, ko"""})
register("per_taxon_profiles_by_sample", lambda v: hi.per_taxon_profiles(
    v.sample_genes, hi.ko_scope(leaves(v)), refs(v), min_ref=0.01, by=BY).select("sample", "species", "ko", "depth"), """
    select sample, species, ko, round(sum(cast(case when frac > 0 then frac else 1 end as decimal(38,12)))::double, 6) as depth
    from {g} join {shown} using (sample, species)
    where ko in (select 'K' || lpad(cast(p_partkey % 300 as varchar), 5, '0') from part) group by sample, species, ko""", {
    "listed": "select distinct 'K' || lpad(cast(p_partkey % 300 as varchar), 5, '0') as ko from {part} where p_size <= 4",
    "g": "select * from {sample_genes} where species not like '%Unknown%'",
    "shown": """select sample, species from {g} where ko in (select ko from {listed}) group by sample, species
      having count(distinct ko) >= 0.01 * (select count(*) from {listed})"""})

TWO = ["S1", "S2"]
FILES = {"module": "Brand#11", "pathway": "Brand#22", "transporter": "Brand#33", "EC": "Brand#44", "AMR": "Brand#55"}


def function_report(v):
    """Quality, host and function matrices of the report for two samples."""
    hosts = sq.with_host_rows(
        v.sample_reads.groupBy("sample", "lang").agg(F.count(F.lit(1)).alias("reads"))
        .select("sample", F.length("lang").cast("long").alias("taxid"), F.col("lang").alias("superkingdom"), "reads"),
        sq.filter_summary(v.sample_hits, by=BY), by=BY)
    tables = {"full_listing": hi.full_listing(leaves(v), _sample_profile(v), by=BY).withColumn("ord", F.col("id")),
              "qc": sq.qc_summary(v.sample_reads.withColumn("passed", F.length("seq") > 1000), BY).withColumn("ord", F.col("reads")),
              "superkingdoms_host": hosts.withColumn("ord", F.col("superkingdom"))}
    wanted = [m for m in [*REPORT, *hierarchy_matrices(FILES)]
              if m.table in ("qc", "superkingdoms_host") or m.where.get("file", "").startswith("Brand")]
    report = report_table(tables, TWO, wanted)
    # A leaf's number depends on the order of its file: leaves are compared by KO.
    report = report.where("matrix not like '%-KO-%' or matrix like '%-KO-depth'")
    return report.select("matrix", F.when(F.size("ann") == 6, F.col("ann")[4]).otherwise(F.array_join("ids", "|")).alias("ids"), *TWO).groupBy(
        "matrix", "ids").agg(F.count(F.lit(1)).alias("rows"), *[F.max(s).alias(s) for s in TWO])


_CELL = ", ".join(f"coalesce(max(case when sample = '{s}' then round(value, 6) end), 0.0) as {s}" for s in TWO)
register("report_functions", function_report, f"""
    select 'qc' as matrix, r as ids, 1::bigint as rows, {_CELL} from (
      select sample, 'Total_reads' as r, count(*)::double as value from {{sample_reads}} group by sample
      union all select sample, 'QC_reads', (count(*) filter (length(seq) > 1000))::double from {{sample_reads}} group by sample) x group by r
    union all
    select 'taxon-superkingdom-whost', ids, 1::bigint, {_CELL} from (
      select sample, length(lang)::varchar || '|' || lang as ids, count(*)::double as value from {{sample_reads}} group by all
      union all select sample, db, count(distinct read_id)::double from {{sample_hits}} group by sample, db
      union all select sample, 'both', count(distinct read_id)::double from {{sample_hits}} group by sample) x group by ids
    union all
    select l.name || '-KO-' || m.label, l.ko, count(distinct l.leaf), {_CELL.replace("value", "case m.label when 'depth' then k.depth else 0.0 end")} from
      (select p_partkey as leaf, case p_brand {" ".join(f"when '{b}' then '{n}'" for n, b in FILES.items())} end as name,
         'K' || lpad(cast(p_partkey % 300 as varchar), 5, '0') as ko from part) l
      cross join (values ('depth')) m(label) left join {{k}} k on k.ko = l.ko
    where l.name is not null group by 1, 2""", {
    "k": """select sample, ko, sum(cast(case when frac > 0 then frac else 1 end as decimal(38,12)))::double as depth
      from {sample_genes} where ko <> '' group by sample, ko"""})

# ---- files written and read back -----------------------------------------------------------------


def _folder(v) -> str:
    return f"{shared_folder(v.spark)}/files-{uuid.uuid4().hex}"


def _flat(v):
    return v.reads.select("read_id", F.col("lang").alias("descr"), F.translate("seq", "\n\r", "  ").alias("seq"),
                          F.col("source").alias("qual"), "ord")


def fastq_files(v):
    path = _folder(v)
    sk.write_fastq(_flat(v), path)
    return ss.read_fastq(v.spark, path, mate=1).select("read_id", "descr", "seq", "qual", "mate")


def fasta_files(v):
    path = _folder(v)
    sk.write_fasta(v.seq.withColumn("header", F.concat_ws(" ", "seq_id", "lang"))
                   .withColumn("seq", F.translate("seq", "\n\r>", "   ")), path)
    return ss.read_fasta(v.spark, path).select("seq_id", "seq")


def sam_files(v):
    """Host groups removed from SAM text, pairs without a place included."""
    path = _folder(v)
    _sam_lines(v).write.text(path)
    aln = ts.read_sam(v.spark, path)
    again = _folder(v)
    sk.write_sam(al.drop_host_groups(aln, 60), again)
    return ts.read_sam(v.spark, again).select("read_id", "flag", "ref_id", "pos", "score")


def sam_header_files(v):
    """Host groups removed from SAM text whose header is passed through to every file."""
    path = _folder(v)
    _sam_lines(v).write.text(path)
    again = _folder(v)
    heads = ts.sam_headers(read_lines(v.spark, path))
    sk.write_sam(al.drop_host_groups(ts.read_sam(v.spark, path), 60), again, heads, one_section=False)
    lines = read_lines(v.spark, again)
    rows = ts.parse_sam(lines).select(F.concat_ws("|", "read_id", "flag", "ref_id", "pos").alias("value"))
    return ts.sam_headers(lines).select("value").distinct().unionByName(rows)


def key_files(v):
    """One text file per sample, each with a header, read back as tables."""
    path = _folder(v)
    sk.write_by_key(v.long.select("sample", F.concat_ws("\t", "feature", F.col("ord").cast("string")).alias("value"), "ord"),
                    path, "sample", header="#feature\tnumber\n")
    table = ts.read_headed_tsv(v.spark, path)
    return table.select(F.regexp_extract("ord.file", r"([^/]+)\.tsv$", 1).alias("sample"), "feature",
                        F.col("number").cast("long").alias("number"))


def sample_folders(v):
    """A file per sample of the sheet, one of them missing and one empty: both modes."""
    path = _folder(v)
    long = v.long.select("sample", "feature", F.col("ord").alias("number"))
    long.write.partitionBy("sample").csv(path, sep="\t", header=True)
    v.spark.range(0).select(F.lit("").alias("value")).coalesce(1).write.text(f"{path}/sample=none")
    listed = long.select(F.concat(F.lit("sample="), "sample").alias("sample_id")).distinct().withColumn("ord", F.lit(0))
    odd = v.spark.createDataFrame([("sample=none", 1), ("sample=nowhere", 2)], "sample_id string, ord int")
    read = lambda sheet, mode: ts.read_per_sample(
        v.spark, path, "part-*", sheet, ts.read_headed_tsv, mode).select(
            F.lit(mode).alias("mode"), F.substring_index("sample_id", "=", -1).alias("sample"), "feature",
            F.col("number").cast("long").alias("number"))
    return read(listed, "error").unionByName(read(listed.unionByName(odd), "skip"))


def store_files(v):
    """A sequence store, and the records of an id list from the files that may hold them."""
    path = _folder(v)
    write_store(v.seq.select("seq_id", "header", "seq"), path)
    return sq.fetch_large(path, v.id_list).select("seq_id", "header")


def filtered_ids(v):
    """Listed and other records, told apart by a filter of the ids before anything is shuffled."""
    kept = sq.fetch_by_ids(v.seq, v.id_list, bloom_bits=1 << 20).select("seq_id", F.lit(True).alias("listed"))
    return kept.unionByName(sq.exclude_ids(v.seq, v.id_list, bloom_bits=1 << 20).select("seq_id", F.lit(False).alias("listed")))


def tsv_files(v):
    path = _folder(v)
    sk.write_tsv(v.catalog.select("acc", "taxid", "name"), path)
    return ts.read_headed_tsv(v.spark, path).select("acc", "taxid", "name")


def split_files(v):
    path = _folder(v)
    sk.write_split(v.long.select("sample", "feature", "value", F.col("ord").alias("number")), path, "sample", max_rows=500)
    return v.spark.read.parquet(path).select("sample", "feature", "value", "number")


def parquet_files(v):
    path = _folder(v)
    sk.write_parquet(v.long.select(F.col("sample").alias("sample_id"), "feature", F.col("ord").alias("number")), path)
    return v.spark.read.parquet(path).select("sample_id", "feature", "number")


def index_files(v):
    path = _folder(v)
    (v.seq.select(F.concat_ws("\t", "seq_id", F.length("seq").cast("string"), F.col("ord").cast("string"), F.lit("60"),
                              F.lit("61")).alias("value")).write.text(path))
    return ss.read_fai(v.spark, path)


def catalog_files(v):
    path = _folder(v)
    (v.catalog.select(F.concat_ws("\t", F.col("taxid").cast("string"), "name", "acc", F.lit("BCT"), F.lit("live"),
                                  (F.col("taxid") * 10).cast("string")).alias("value")).write.text(path))
    return ts.read_catalog(v.spark, path).select("taxid", "name", "acc", "div", "status", "length")


def genome_files(v):
    path = _folder(v)
    (v.catalog.selectExpr("cast(species_ti as string) as species_ti", "acc", "name")
     .write.csv(path, sep="\t", header=True, quote=""))
    return ts.read_rep_genomes(v.spark, path)


register("fastq_files", fastq_files, """
    select read_id, lang as descr, translate(seq, chr(10) || chr(13), '  ') as seq, source as qual, 1 as mate from {reads}""")
register("fasta_files", fasta_files, """
    select seq_id, rtrim(translate(seq, chr(10) || chr(13) || '>', '   ')) as seq from {seq}""")
register("sam_files_host_groups", sam_files, """
    select cast(read_id as varchar) as read_id, flag, ref_id, cast(pos as int) as pos, case when flag <> 67 then score end as score
    from {aln} where flag % 2 = 1 and read_id not in (
      select read_id from {aln} where flag % 2 = 1 and flag <> 67 and score >= 60)""")
register("sam_header_files", sam_header_files, """
    select '@SQ' || chr(9) || 'SN:' || ref_id || chr(9) || 'LN:' || length as value from {ref}
    union all select read_id || '|' || flag || '|' || ref_id || '|' || pos from {aln} where flag % 2 = 1 and read_id not in (
      select read_id from {aln} where flag % 2 = 1 and flag <> 67 and score >= 60)""")
register("key_files", key_files, "select sample, feature, ord as number from {long}")
register("sample_folders", sample_folders, """
    select mode, sample, feature, ord as number from {long} cross join (values ('error'), ('skip')) m(mode)""")
register("store_files", store_files, """
    select seq_id, header from {seq} where seq_id in (select split_part(id, ' ', 1) from {id_list})""")
register("filtered_ids", filtered_ids, """
    select seq_id, seq_id in (select split_part(id, ' ', 1) from {id_list}) as listed from {seq}""")
register("tsv_files", tsv_files, "select acc, taxid::varchar as taxid, name from {catalog}")
register("split_files", split_files, "select sample, feature, round(value, 6) as value, ord as number from {long}")
register("parquet_files", parquet_files, "select sample as sample_id, feature, ord as number from {long}")
register("index_files", index_files, """
    select seq_id, length(seq) as length, ord as "offset", 60 as line_bases, 61 as line_width from {seq}""")
register("catalog_files", catalog_files, """
    select taxid, name, acc, 'BCT' as div, 'live' as status, taxid * 10 as length from {catalog}""")
register("genome_files", genome_files, "select species_ti::varchar as species_ti, acc, name from {catalog}")
