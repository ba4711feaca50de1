"""Sample matrix, sequence, depth, variant and summary queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from seqtally.catalog.alignment_queries import host_bins
from seqtally.catalog.hit_queries import TABLES as GENE_TABLES
from seqtally.catalog.hit_queries import depth_of_contigs, genes, scaffold_tables
from seqtally.catalog.registry import register
from seqtally.functions.expr import flag_string
from seqtally.operators import annotation as an
from seqtally.operators import depth as dp
from seqtally.operators import matrix as mx
from seqtally.operators import sequences as sq
from seqtally.operators import summaries as su
from seqtally.operators.alignments import fractional_counts, reference_abundance
from seqtally.plans.report import Matrix, report_matrices, report_table
from seqtally.sources.tables import parse_job_log

SAMPLES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

# ---- sequences -----------------------------------------------------------------------------------

_BARE = "translate(seq, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')"
SEQ = {"bare": f"select *, length({_BARE}) as n from {{seq}}"}

register("seq_lengths", lambda v: sq.seq_lengths(v.seq), "select seq_id, n as length from {bare} where n > 0", SEQ)
register("seq_min_len", lambda v: sq.filter_min_len(v.seq, 2000, ann="len").select("seq_id", "header", "length"), """
    select seq_id, split_part(header, ' ', 1) || '|len|' || n || substr(header, position(' ' in header)) as header, n as length
    from {bare} where n >= 2000""", SEQ)
register("seq_max_len", lambda v: sq.filter_max_len(v.seq, 1000).select("seq_id", "seq", "length"),
         "select seq_id, seq, n as length from {bare} where n <= 1000", SEQ)
register("seq_sort_by_len", lambda v: sq.sort_by_len(v.seq).select("seq_id", "length"),
         "select seq_id, n as length from {bare} order by n desc, ord", SEQ)
register("seq_renumber", lambda v: sq.renumber(v.seq, "ctg", start=1).select("seq_id", "header"), """
    select 'ctg' || row_number() over (order by ord) as seq_id, 'ctg' || row_number() over (order by ord) || ' ' || header as header
    from {seq}""")
register("fastq_to_fasta", lambda v: sq.fastq_to_fasta(v.reads.withColumn("descr", F.col("source")), "lang")
         .select("lang", "seq_id", "header"), """
    select lang, 'Sample|' || lang || '|' || n as seq_id, 'Sample|' || lang || '|' || n || ' ' || read_id || ' ' || source as header
    from (select *, row_number() over (partition by lang order by ord) as n from {reads}) x""")
_NX = "(select max(n) from {cum} c where c.lang = t.lang and c.cum >= t.total * %s)"
register("assembly_stats", lambda v: sq.assembly_stats(v.seq, by=["lang"]), f"""
    select lang, count(*) as n_contigs, total as total_length, cast(floor(total / count(*)) as bigint) as mean_length,
      max(n) as longest, {_NX % 0.5} as n50, {_NX % 0.8} as n80
    from (select *, cast(sum(n) over (partition by lang) as bigint) as total from {{bare}} where n > 0) t
    group by lang, total""", {
    **SEQ, "cum": "select lang, n, sum(n) over (partition by lang order by n desc, ord) as cum from {bare} where n > 0"})
register("assembly_stats_all", lambda v: sq.assembly_stats(v.seq, ref_len=1_000_000), """
    select count(*) as n_contigs, cast(sum(n) as bigint) as total_length, cast(floor(sum(n) / count(*)) as bigint) as mean_length,
      max(n) as longest, coalesce((select max(n) from {cum} where cum >= 500000), 0) as n50,
      coalesce((select max(n) from {cum} where cum >= 800000), 0) as n80
    from {bare} where n > 0""", {
    **SEQ, "cum": "select n, sum(n) over (order by n desc, ord) as cum from {bare} where n > 0"})
register("header_depth", lambda v: sq.contig_header_depths(v.seq),
         "select seq_id, cast(regexp_extract(header, '_cov_([0-9.]+)', 1) as double) as depth from {seq}")
register("strip_stops", lambda v: sq.strip_stops(v.seq.withColumn("seq", F.translate("seq", "a", "*")))
         .select("seq_id", "seq"), "select seq_id, replace(replace(seq, 'a', ''), '*', '') as seq from {seq}")

_LISTED = "(select split_part(id, ' ', 1) from {id_list})"
register("fetch_by_ids", lambda v: sq.fetch_by_ids(v.seq, v.id_list).select("seq_id", "header", "seq"),
         f"select seq_id, header, seq from {{seq}} where seq_id in {_LISTED}")
register("fetch_by_tag", lambda v: sq.fetch_by_ids(v.seq, v.id_list, tag="taxid").select("seq_id", "header"),
         f"select seq_id, header from {{seq}} where seq_id in {_LISTED}")
register("exclude_ids", lambda v: sq.exclude_ids(v.seq, v.id_list).select("seq_id", "header", "seq"),
         f"select seq_id, header, seq from {{seq}} where seq_id not in {_LISTED}")
register("fetch_large", lambda v: sq.fetch_large(
    v.seq.drop("header"), v.id_list, v.seq.select("seq_id", "header")).select("seq_id", "header", "seq"),
         f"select seq_id, header, seq from {{seq}} where seq_id in {_LISTED}")
register("filter_reads", lambda v: sq.filter_reads(v.reads, v.db_hits).select("read_id", "seq"),
         "select read_id, seq from {reads} where read_id not in (select read_id from {db_hits})")
SUMMARY = {"fsum": """select db, count(distinct read_id) as reads from {db_hits} group by db
    union all select 'both', count(distinct read_id) from {db_hits}"""}
register("filter_summary", lambda v: sq.filter_summary(v.db_hits), "select * from {fsum}", SUMMARY)
register("with_host_rows", lambda v: sq.with_host_rows(
    v.reads.groupBy("lang").agg(F.count(F.lit(1)).alias("reads"))
    .select(F.length("lang").cast("long").alias("taxid"), F.col("lang").alias("superkingdom"), "reads"),
    sq.filter_summary(v.db_hits)), """
    select length(lang)::bigint as taxid, lang as superkingdom, count(*) as reads from {reads} group by lang
    union all select null, db, reads from {fsum}""", SUMMARY)
register("rep_genomes_for", lambda v: sq.rep_genomes_for(
    v.catalog.groupBy("species_ti").count().where("count >= 3"), v.catalog), """
    select species_ti, taxid, name, acc from {catalog}
    where species_ti in (select species_ti from {catalog} group by 1 having count(*) >= 3)""")
register("annotate_headers", lambda v: sq.annotate_headers(
    v.seq.withColumn("seq_id", F.concat(F.lit("s"), F.col("ord") % 300))
    .withColumn("header", F.concat(F.lit("s"), F.col("ord") % 300, F.lit(" "), F.col("lang"))), v.catalog)
         .select("seq_id", "header"), """
    select 's' || ord % 300 as seq_id, case when acc is null then 's' || ord % 300 || ' ' || lang else
      acc || '|taxid|' || taxid || '|taxdes|' || regexp_replace(name, '[^A-Za-z0-9_]+', '_', 'g') || ' ' || lang end as header
    from {seq} s left join (select acc, taxid, name from {catalog}) c on c.acc = 's' || s.ord % 300""")
register("split_interleaved", lambda v: sq.split_interleaved(v.reads).select("read_id", "mate", "pair"),
         "select read_id, cast(ord % 2 + 1 as int) as mate, cast(floor(ord / 2) as bigint) as pair from {reads}")
register("interleave", lambda v: sq.interleave(
    v.reads.select("read_id", "ord"), v.reads.select(F.concat(F.col("read_id"), F.lit("x")).alias("read_id"), "ord"))
         .withColumn("place", F.col("ord")), """
    select read_id, 1 as mate, ord * 2 as place from {reads} union all select read_id || 'x', 2, ord * 2 + 1 from {reads}""")
register("dereplicate", lambda v: sq.dereplicate(
    v.reads.selectExpr("seq as r1", "lang as r2", "cast(read_id as bigint) as read_id")), """
    select substring(seq, 1, 150) as r1_prefix, substring(lang, 1, 100) as r2_prefix, count(*) as size,
      min(cast(read_id as bigint)) as representative from {reads} group by 1, 2""")
register("qc_summary", lambda v: sq.qc_summary(v.reads.withColumn("passed", F.length("seq") > 1000), by=["lang"]), """
    select lang, 'Total_reads' as reads, count(*) as number from {reads} group by lang
    union all select lang, 'QC_reads', count(*) filter (where length(seq) > 1000) from {reads} group by lang""")
register("model_hit_counts", lambda v: sq.model_hit_counts(
    v.hits.join(v.fam, "subject").select("acc", "name", "descr", F.struct("query", "ord").alias("ord"))), """
    select name, acc, descr, count(*) as n_hits from {hits} join {fam} using (subject) group by name, acc, descr""")
register("fetch_hmm", lambda v: sq.fetch_hmm(
    v.part.selectExpr("concat('PF', lpad(p_partkey, 8, '0')) as acc", "p_name as body"),
    v.lineitem.where("l_tax > 0.07").selectExpr("concat('PF', lpad(l_partkey, 8, '0'), '.', l_linenumber) as id")), """
    select 'PF' || lpad(p_partkey::varchar, 8, '0') as acc, p_name as body from part
    where p_partkey in (select l_partkey from lineitem where l_tax > 0.07)""")

# ---- genes ---------------------------------------------------------------------------------------

register("contig_of_gene", lambda v: genes(v).select("orf_id", "scaffold"),
         "select orf_id, 'ctg' || p as scaffold from {orf}")
register("orf_info", lambda v: v.orf.select("orf_id", an.orf_info("header").alias("i")).select("orf_id", "i.*"), """
    select orf_id, cast(g * 9 + 1 as varchar) as start, cast(g * 9 + 600 as varchar) as "end",
      case when p % 2 = 0 then '-1' else '2' end as frame from {orf}""")
register("extract_tag", lambda v: v.ref.select(
    "ref_id", an.extract_tag("ref_id", "taxid").alias("taxid"), an.extract_tag("ref_id", "acc", r"[^|]+").alias("acc"),
    an.extract_tag("ref_id", "none").alias("none")), """
    select ref_id, cast(taxid as varchar) as taxid, 'A' || (taxid - 200000000) as acc, cast(null as varchar) as none from {ref}""")
register("pass_depth", lambda v: sq.pass_depth(genes(v), depth_of_contigs(v)), """
    select orf_id, round(depth, 6) as depth from {orf} join {cdepth} on contig = 'ctg' || p where depth <> 0""",
         {"cdepth": GENE_TABLES["cdepth"]})
register("flag_string", lambda v: v.aln.select("read_id", "pos", flag_string("flag").alias("text")), """
    select read_id, pos, case when flag & 1 <> 0 then '_P' else '_p' end || case when flag & 2 <> 0 then '_M' else '_m' end
      || case when flag & 4 <> 0 then '_u' else '_.' end || case when flag & 8 <> 0 then '_U' else '_.' end || '_._.'
      || case when flag & 64 <> 0 then '_1' else '_.' end || case when flag & 128 <> 0 then '_2' else '_.' end || '_S_F_D' as text
    from {aln}""")



def _reference(v):
    return reference_abundance(fractional_counts(v.aln), v.ref)


_ABUND = {
    "per": "select read_id, ref_id, count(*) as c from {aln} where flag & 1 <> 0 and flag & 2 <> 0 and ref_id <> '*' group by 1, 2",
    "share": "select *, 1.0 / count(*) over (partition by read_id) as w from "
             "(select * from {per} qualify c = max(c) over (partition by read_id)) x",
    "dep": "select ref_id, 300 * sum(cast(w as double)) / any_value(length) as depth from {share} join {ref} using (ref_id) group by ref_id",
}
register("ids_above", lambda v: sq.ids_above(_reference(v), "depth", 40, key="ref_id"),
         "select ref_id from {dep} where depth > 40", _ABUND)
register("rank_report", lambda v: sq.rank_classifier_report(
    v.long.groupBy(F.col("feature").alias("taxid")).agg(F.sum(F.when(F.col("value") > 100000, 1).otherwise(0)).alias("abundance"))),
         """select feature as taxid, cast(sum(case when value > 100000 then 1 else 0 end) as bigint) as abundance from {long}
    group by feature having sum(case when value > 100000 then 1 else 0 end) <> 0""")

# ---- depth and variants --------------------------------------------------------------------------

register("windowed_depth", lambda v: dp.windowed_depth(v.depth, ["d_a", "d_n", "d_r"]), """
    select seq_id, node, """ + ", ".join(f"round(trunc(sum({c}) / count(*) * 10) / 10, 6) as {c}" for c in ("d_a", "d_n", "d_r"))
         + """ from (select *, pos - pos % 20 as node from {depth} union all select *, pos - pos % 20 + 20 from {depth}) x
    where node > 0 and node <= (select max(pos) from {depth} d where d.seq_id = x.seq_id) group by seq_id, node""")
register("breadth", lambda v: dp.breadth(v.pileup, v.genome_index), """
    select cast(split_part(seq_id, '|', 4) as bigint) as taxid, count(*) as covered, any_value(length) as length,
      round(count(*) / any_value(length), 6) as breadth
    from {pileup} join {genome_index} using (seq_id) where depth >= 2 group by seq_id
    having count(*) / any_value(length) > 0.75""")
register("keep_passing", lambda v: dp.keep_passing(v.pileup, dp.breadth(v.pileup, v.genome_index))
         .select("seq_id", "pos", "depth"), """
    select seq_id, pos, depth from {pileup} where seq_id in (select seq_id from {pileup} join {genome_index} using (seq_id)
      where depth >= 2 group by seq_id having count(*) / any_value(length) > 0.75)""")
ALLELES = {"allele": """select * from (
    select seq_id, pos, 'C' as ref, 'C' as allele, n_a + n_f as n from {pileup}
    union all select seq_id, pos, 'C', 'A', n_n from {pileup}
    union all select seq_id, pos, 'C', 'G', n_r from {pileup}
    union all select seq_id, pos, 'C', 'T', n_f from {pileup}
    union all select seq_id, pos, 'C', '+AG', n_f from {pileup}) x where n > 0"""}
register("pileup_alleles", lambda v: dp.pileup_alleles(v.pileup),
         "select seq_id, pos, ref, allele, cast(n as bigint) as n from {allele}", ALLELES)
_CALL = """
    select seq_id, pos, ref, allele as var, cast(cov as bigint) as coverage, cast(n as bigint) as reads2,
      round(n / cov, 6) as freq
    from (select *, sum(case when allele like '+%%' then 0 else n end) over (partition by seq_id, pos) as cov from {allele}) x
    where %s and cov >= 3 and n >= 2 and n / cov >= %s
    qualify row_number() over (partition by seq_id, pos order by n desc, allele) = 1"""
register("call_variants", lambda v: dp.call_variants(dp.pileup_alleles(v.pileup), min_freq=0.3),
         _CALL % ("allele not like '+%' and allele <> ref", 0.3), ALLELES)
register("call_variants_indel", lambda v: dp.call_variants(dp.pileup_alleles(v.pileup), min_freq=0.3, kind="indel"),
         _CALL % ("allele like '+%'", 0.3), ALLELES)
register("variant_loc", lambda v: dp.variant_loc(v.variant),
         "select taxid, acc || '|' || position || '|' || ref as loc, var as val from {variant}")
register("variant_presence", lambda v: dp.variant_presence(v.variant),
         "select taxid, acc || '|' || position || '|' || ref || '|' || var as variant, 1 as present from {variant}")
TEN = [f"S{i}" for i in range(10)]
register("variant_matrix", lambda v: dp.variant_matrix(v.variant, TEN), """
    select taxid, acc || '|' || position || '|' || ref || '|' || var as variant, """
         + ", ".join(f"max(case when sample = '{s}' then 1 else 0 end) as \"{s}\"" for s in TEN)
         + " from {variant} group by 1, 2")

# ---- matrices ------------------------------------------------------------------------------------

CELLS = {
    "cell": "select sample, feature, arg_max(value, ord) as v from {long} where value >= 1000 group by sample, feature",
    "about": "select feature, any_value(ann) as ann from {long} where value >= 1000 group by feature",
}
_PIVOT = ", ".join(f"max(case when sample = '{s}' then v end) as \"{s}\"" for s in SAMPLES)
CELLS["wide"] = f"select feature, {_PIVOT} from {{cell}} group by feature"
_FILLED = ", ".join(f"round(coalesce(\"{s}\", 0), 6) as \"{s}\"" for s in SAMPLES)
register("merge_samples", lambda v: mx.merge_samples(v.long, SAMPLES, cutoff=1000, missing=-1), """
    select feature, """ + ", ".join(f"round(coalesce(\"{s}\", -1), 6) as \"{s}\"" for s in SAMPLES) + " from {wide}", CELLS)
_LIST = "list_sort([" + ", ".join(f"coalesce(\"{s}\", 0)" for s in SAMPLES) + "])"
register("merge_samples_stats", lambda v: mx.merge_samples(v.long, SAMPLES, ann=["ann"], cutoff=1000, stats=True), f"""
    select w.feature, ann, {_FILLED}, round(l[5], 6) as max, round(l[1], 6) as min, round(l[3], 6) as med,
      round(list_sum(l) / 5, 6) as mean, round(l[5] - l[1], 6) as range, round(l[2], 6) as low_quartile,
      round(l[4], 6) as high_quartile
    from (select *, {_LIST} as l from {{wide}}) w join {{about}} a on a.feature = w.feature""", CELLS)
register("merge_samples_two_ids", lambda v: mx.merge_samples(
    v.long, SAMPLES[:4], ids=["feature", "ann"], cutoff=None, stats=True), """
    select feature, ann, """ + ", ".join(f"round(coalesce(\"{s}\", 0), 6) as \"{s}\"" for s in SAMPLES[:4]) + """,
      round(l[4], 6) as max, round(l[1], 6) as min, round((l[2] + l[3]) / 2, 6) as med, round(list_sum(l) / 4, 6) as mean,
      round(l[4] - l[1], 6) as range, round(l[2], 6) as low_quartile, round(l[3], 6) as high_quartile
    from (select *, list_sort([""" + ", ".join(f"coalesce(\"{s}\", 0)" for s in SAMPLES[:4]) + """]) as l from
      (select feature, ann, """ + ", ".join(f"max(case when sample = '{s}' then v end) as \"{s}\"" for s in SAMPLES[:4])
         + """ from (select sample, feature, ann, arg_max(value, ord) as v from {long}
           where sample <> 'MACHINERY' group by 1, 2, 3) c group by 1, 2) w) y""")
register("concat_samples", lambda v: mx.concat_samples(v.long, ["feature", "value"], sample_col="sample"),
         "select sample as sample_id, feature, round(value, 6) as value from {long}")
register("sample_dictionary", lambda v: mx.sample_dictionary(v.long, ["feature", "ann"]),
         "select distinct feature, ann from {long}")


def _sheet(v):
    return v.nation.join(v.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("sample_id"), F.array(F.lit("x"), F.concat_ws(" ", "r_name", F.lit("pool"))).alias("data"))


def _by_nation(v):
    return v.customer.join(v.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("sample_id"), "c_custkey")


_NATIONS = """from customer join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey"""
register("pool_groups", lambda v: mx.pool_groups(_by_nation(v), _sheet(v), group_col=2),
         f"select n_name as sample_id, c_custkey, replace(r_name, ' ', '_') || '_pool' as \"group\" {_NATIONS}")
register("pool_groups_one", lambda v: mx.pool_groups(_by_nation(v), _sheet(v), group="all samples"),
         f"select n_name as sample_id, c_custkey, 'all_samples' as \"group\" {_NATIONS}")
register("missing_sources", lambda v: mx.missing_sources(
    v.supplier.where("s_acctbal > 8000").select(F.concat(F.lit("NATION_"), F.col("s_nationkey")).alias("sample_id")),
    _sheet(v)), """
    select n_name as sample_id from nation
    where n_nationkey not in (select s_nationkey from supplier where s_acctbal > 8000)""")

CPM = {"cpm": "select sample, feature, value * 1e6 / sum(value) over (partition by sample) as value from "
              "(select sample, feature, cast(value as double) as value from {tall}) x"}


def _cpm(v):
    return mx.renorm_cpm(v.tall.withColumn("value", F.col("value").cast("double")))


def _as_int(df):
    """Millions of a CPM differ in their sixth decimal between engines: compare four."""
    return df.withColumn("value", F.round("value", 4))


register("renorm_cpm", lambda v: _as_int(_cpm(v)), "select sample, feature, round(value, 4) as value from {cpm}", CPM)
register("regroup_table", lambda v: _as_int(mx.regroup_table(_cpm(v), v.feature_map)), """
    select sample, coalesce(target, 'UNGROUPED') as feature, round(sum(value), 4) as value
    from {cpm} c left join (select distinct feature, target from {feature_map}) m on m.feature = c.feature group by 1, 2""", CPM)
register("rename_features", lambda v: _as_int(mx.rename_features(
    _cpm(v), v.feature_map.select("feature", "name").distinct())), """
    select sample, c.feature || ': ' || coalesce(name, 'NO_NAME') as feature, round(value, 4) as value
    from {cpm} c left join (select distinct feature, name from {feature_map}) m on m.feature = c.feature""", CPM)
register("otu_table", lambda v: mx.otu_table(
    v.documents.select(F.col("source").alias("cluster"), F.col("lang").alias("sample")), min_frac=0.05), """
    select source as cluster, lang as sample, count(*) as value from documents
    group by 1, 2 qualify sum(count(*)) over (partition by source) >= 0.05 * sum(count(*)) over ()""")
register("report_matrices", lambda v: report_matrices(
    {"levels": v.long.withColumn("level", F.lit("A")).withColumnRenamed("feature", "node").withColumnRenamed("ann", "file")
     .withColumn("descr", F.lit("d"))}, SAMPLES,
    [Matrix("level-A-depth", "levels", ["file", "node"], "value", ["descr"], 1000, {"level": "A"})])["level-A-depth"], f"""
    select a.ann as file, w.feature as node, 'd' as descr, {_FILLED} from {{wide}} w join {{about}} a on a.feature = w.feature""",
         CELLS)

# ---- summaries -----------------------------------------------------------------------------------

JOBS = ["click", "error", "purchase", "signup", "view"]


def _cost(factor):
    return lambda v: su.job_cost_matrix(parse_job_log(v.log), JOBS, factor)


_LOG = {"cost": """select 'S' || (user_id % 10) as sample, event_type as job, cast(sum((event_id % 16 + 1) * user_id) as bigint) as c
    from events group by 1, 2"""}
register("job_cost_matrix", _cost(1), "select sample, "
         + ", ".join(f"max(case when job = '{j}' then c end) as \"{j}\"" for j in JOBS)
         + ", cast(sum(c) as bigint) as total from {cost} group by sample", _LOG)
register("job_cost_matrix_price", _cost(0.06 / 3600), "select sample, "
         + ", ".join(f"round(max(case when job = '{j}' then c end) * {0.06 / 3600!r}, 2) as \"{j}\"" for j in JOBS)
         + f", round(sum(c) * {0.06 / 3600!r}, 2) as total from {{cost}} group by sample", _LOG)

_LEVELS = {
    "level_rows": """select orf_id, scaffold, 'aro' as level, aro as value from {rgi}
        union all select orf_id, scaffold, 'gene_family', gene_family from {rgi}
        union all select orf_id, scaffold, 'drug_class', unnest(string_split(drug_class, '; ')) from {rgi}
        union all select orf_id, scaffold, 'mechanism', mechanism from {rgi}""",
    "weighed": """select r.*, coalesce(d.depth, 1.0) as depth, coalesce(b.taxid, 'Unknown') as bin from {level_rows} r
        left join {gene_depth} d on d.orf_id = r.orf_id left join {housed} b on b.contig = r.scaffold where value <> ''""",
}
_RESISTANCE = """
    select level, value, 'all' as bin, count(*) as genes, round(sum(depth)::double, 6) as depth from {weighed} group by 1, 2
    union all select level, value, bin, count(*), round(sum(depth)::double, 6) from {weighed} group by 1, 2, 3"""
_ASSEMBLY = """
    select 'genome' as level, taxid as key, n as scaffolds, len as length, round(len / rl, 6) as coverage,
      round(ld / len, 6) as depth, g as genes from {genome}
    union all select 'species', species_ti, cast(sum(n) as bigint), cast(sum(len) as bigint), round(sum(len) / max(rl), 6),
      round(sum(ld) / sum(len), 6), cast(sum(g) as bigint) from {genome} group by species_ti
    union all select 'sample', 'all', cast(sum(n) as bigint), cast(sum(len) as bigint), null,
      round(sum(ld) / sum(len), 6), cast(sum(g) as bigint) from {genome}"""
_GENOMES = {
    **GENE_TABLES,
    "genome": """select s.taxid, s.species_ti, count(*) as n, cast(sum(s.length) as bigint) as len, cast(sum(n_genes) as bigint) as g,
          sum(s.length * depth) as ld, any_value(r.length) as rl
        from {scaffolds} s left join {ref} r on cast(r.taxid as varchar) = s.taxid group by s.taxid, s.species_ti"""}


def resistance(v):
    v.written("orf")  # what the hits and the depths of genes are made from
    return su.resistance_rollup(v.rgi, v.gene_depth, host_bins(v))


def assembly(v):
    return su.assembly_summary(scaffold_tables(v, an.scaffold_annotation), v.ref)


register("resistance_rollup", resistance, _RESISTANCE, {**GENE_TABLES, **_LEVELS}, recursive=True)
register("assembly_summary", assembly, _ASSEMBLY, _GENOMES, recursive=True)


def assembly_report(v):
    """Assembly and resistance matrices of the report for one sample, each upstream table read once."""
    def one(df, order):
        return df.withColumn("sample", F.lit("S1")).withColumn("ord", F.col(order))

    found = v.stage("resistance", resistance)
    tables = {"assembly": one(assembly(v), "key"), "resistance": one(found, "value"),
              "resistance_bins": one(found.where("bin <> 'all'"), "value")}
    return report_table(tables, ["S1"]).select("matrix", F.array_join("ids", "|").alias("ids"), "S1")


_OF_ASSEMBLY = [(f"assembly-{level}-{m}", m, level) for level in ("genome", "species")
                for m in ("scaffolds", "length", "coverage", "depth", "genes")] + [
    ("assembly-num_scaffolds", "scaffolds", "sample"), ("assembly-len_scaffolds", "length", "sample"), ("assembly-num_ORFs", "genes", "sample")]
_OF_RESISTANCE = [("aro", "RGI"), ("gene_family", "RGI.AMR"), ("drug_class", "RGI.drug"), ("mechanism", "RGI.Mech")]
register("report_assembly", assembly_report, " union all ".join(
    [f"select '{name}' as matrix, key as ids, cast({value} as double) as S1 from {{assembly}} where level = '{level}' and {value} >= 0"
     for name, value, level in _OF_ASSEMBLY]
    + [f"select '{name}', value, depth from {{resistance}} where level = '{level}' and bin = 'all'" for level, name in _OF_RESISTANCE]
    + [f"select '{name}-bin', value || '|' || bin, depth from {{resistance}} where level = '{level}' and bin <> 'all'"
       for level, name in _OF_RESISTANCE]), {**_GENOMES, **_LEVELS, "assembly": _ASSEMBLY, "resistance": _RESISTANCE}, recursive=True)
