"""Format queries: lines and records written by Spark from the tables, read back by the parsers."""

from __future__ import annotations

from pyspark.sql import functions as F

from seqtally.catalog.alignment_queries import LINEAGE
from seqtally.catalog.hit_queries import GREEDY, family_sql
from seqtally.catalog.registry import register
from seqtally.catalog.table_queries import SEQ
from seqtally.operators import taxonomy as tx
from seqtally.operators.hits import family_abundance, greedy_nonoverlap
from seqtally.sources import sequences as ss
from seqtally.sources import sinks as sk
from seqtally.sources import tables as ts


def _tabbed(*columns, sep="\t"):
    return F.concat_ws(sep, *[c if not isinstance(c, str) else F.col(c).cast("string") for c in columns]).alias("value")


def _sam_lines(v):
    star = F.lit("*")
    tags = F.concat(F.lit("NM:i:1\tAS:i:"), F.col("score").cast("string"), F.lit("\tXS:i:0"))
    rows = v.aln.select(_tabbed("read_id", "flag", "ref_id", "pos", F.lit("60"), F.lit("100M"), "mate_ref", F.lit("5"),
                                F.lit("-7"), star, star, F.when(F.col("flag") != 67, tags)))
    heads = v.ref.select(F.concat(F.lit("@SQ\tSN:"), "ref_id", F.lit("\tLN:"), "length").alias("value"))
    return heads.unionByName(rows)


register("read_sam", lambda v: ts.parse_sam(_sam_lines(v)).select(
    "read_id", "flag", "ref_id", "pos", "mapq", "cigar", "mate_ref", "mate_pos", "tlen", "score",
    F.size("tags").alias("n_tags")), """
    select cast(read_id as varchar) as read_id, flag, ref_id, cast(pos as int) as pos, 60 as mapq, '100M' as cigar, mate_ref,
      5 as mate_pos, -7 as tlen, case when flag <> 67 then score end as score, case when flag <> 67 then 3 else 0 end as n_tags
    from {aln}""")
register("sam_headers", lambda v: ts.sam_headers(_sam_lines(v)),
         "select '@SQ' || chr(9) || 'SN:' || ref_id || chr(9) || 'LN:' || length as value from {ref}")


def _hit_lines(v):
    rows = v.hits.select(_tabbed("query", "subject", "pct_iden", "aln_len", F.lit("1"), F.lit("2"), "q_b", "q_e", "s_b", "s_e",
                                 "evalue", F.lit("40.5")))
    return rows.unionByName(v.part.select(F.concat(F.lit("# "), "p_name").alias("value")))


register("read_hits", lambda v: ts.parse_hits(_hit_lines(v)), """
    select cast(query as varchar) as query, cast(subject as varchar) as subject, pct_iden, aln_len, 1 as mism, 2 as gaps,
      cast(q_b as int) as q_b, cast(q_e as int) as q_e, s_b, s_e, evalue, 40.5::double as bits from {hits}""")


def _dom_lines(v):
    dash = F.lit("-")
    return v.hits.join(v.fam, "subject").select(
        _tabbed(F.translate("name", " ", "_"), "acc", "model_len", "query", dash, F.lit("500"), "evalue", *[dash] * 8,
                "s_b", "s_e", "q_b", "q_e", *[dash] * 3, F.concat_ws(" ", "descr", "name"), sep="   "), "ord")


register("read_domtbl", lambda v: ts.parse_domtbl(_dom_lines(v)), """
    select replace(name, ' ', '_') as hmm_name, acc as hmm_acc, cast(model_len as int) as hmm_len,
      cast(query as varchar) as query, 500 as q_len, evalue, s_b as h_b, s_e as h_e, cast(q_b as int) as q_b,
      cast(q_e as int) as q_e, descr || ' ' || name as descr
    from {hits} join {fam} using (subject)""")


def _domain_abundance(v):
    dom = v.stage("domains", lambda w: ts.parse_domtbl(_dom_lines(w)))  # lines are parsed once, for the hits and the families
    return family_abundance(greedy_nonoverlap(ts.domain_hits(dom), 0.05), ts.domain_families(dom, 0.05))


register("domain_abundance", _domain_abundance, """
    select acc as subject, n_hits, round(coverage, 6) as coverage, round(abundance, 6) as abundance,
      replace(name, ' ', '_') as name, descr || ' ' || name as descr from {family}""", {**GREEDY, **family_sql("1", 6)}, recursive=True)
register("read_tbl", lambda v: ts.parse_tbl(v.hits.join(v.fam, "subject").select(_tabbed(
    F.translate("name", " ", "_"), "acc", "query", F.lit("-"), "evalue", *[F.lit("-")] * 13,
    F.concat_ws(" ", "descr", "name"), sep="  "))), """
    select replace(name, ' ', '_') as name, acc, cast(query as varchar) as query, evalue, descr || ' ' || name as descr
    from {hits} join {fam} using (subject)""")


def _clstr_records(v):
    child = F.transform("taxids", lambda t: F.concat(F.lit("0\t"), t.cast("string"), F.lit("\tx")))
    return v.clstr.select(F.concat_ws("\n", F.concat_ws(
        "\t", F.concat(F.lit(">"), "ref_id"), F.lit("9"), F.size("taxids").cast("string"),
        F.concat(F.lit("KO|"), "ko"), "descr"), F.concat_ws("\n", child)).alias("value"))


register("read_clstr_ann", lambda v: ts.parse_clstr_ann(_clstr_records(v)).withColumn(
    "taxids", F.concat_ws(",", F.transform("taxids", lambda t: t.cast("string")))), """
    select ref_id, 9 as n_members, ko, descr, array_to_string(taxids, ',') as taxids from {clstr}""")
register("read_class_map", lambda v: ts.parse_class_map(v.class_map.select(
    F.concat(F.lit("["), "letters", F.lit("] "), "family", F.lit(" some text")).alias("value"))),
         "select letters, family, 'some text' as descr from {class_map}")
register("read_class_names", lambda v: ts.parse_class_names(v.class_names.select(
    F.concat(F.lit("  ["), "class", F.lit("] "), "descr").alias("value"), "ord")), 'select class, descr from {class_names}')
register("read_classified", lambda v: ts.parse_classified(
    v.cls.select(_tabbed("read_id", "seq_id", "taxid", F.lit("3"), F.lit("2"), "hit_len", "query_len", F.lit("1")))
    .unionByName(v.region.select(F.concat(F.lit("readID\t"), "r_name").alias("value")))), """
    select cast(read_id as varchar) as read_id, seq_id, taxid, 3::bigint as score, 2::bigint as score2, hit_len,
      cast(query_len as int) as query_len, 1 as n_match from {cls}""")
register("read_kreport", lambda v: ts.parse_kreport(v.nodes.select(F.concat(
    F.lit("  0.5  10 5 "), "rank", F.lit(" "), F.when(F.col("rank") == "species", F.lit("x")).otherwise(
        F.col("taxid").cast("string")), F.lit(" "), "name").alias("value"))),
         "select distinct taxid from {nodes} where rank <> 'species'")


def _dump(v):
    bar = "\t|\t"
    nodes = v.nodes.select(_tabbed("taxid", "parent", F.when(F.col("rank") == "norank", "no rank").otherwise(F.col("rank")),
                                   F.lit("x"), sep=bar))
    names = v.nodes.select(_tabbed("taxid", "name", F.lit(""), F.lit("scientific name"), sep=bar)).unionByName(
        v.nodes.select(_tabbed("taxid", F.concat("name", F.lit(" aka")), F.lit(""), F.lit("synonym"), sep=bar)))
    return ts.parse_nodes_dmp(nodes), ts.parse_names_dmp(names)


register("read_taxdump", lambda v: _dump(v)[0].join(_dump(v)[1], "taxid"), "select taxid, parent, rank, name from {nodes}")


def _lineage_lines(v):
    table = tx.rank_table(tx.lineage(v.nodes, v.leaves, v.nodes), v.nodes)
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for r in tx.RANKS for c in (r, f"{r}_ti")]
    return table.select(_tabbed("taxid", "rank", "name", *cells))


register("read_lineage", lambda v: ts.parse_lineage(_lineage_lines(v)), "select * from {lin}", LINEAGE, recursive=True)
register("merge_names", lambda v: tx.merge_names(
    v.nodes.where("rank <> 'strain'").select("taxid", "name"),
    ts.parse_header_taxa(v.supplier.select(F.concat(
        F.lit("a taxid|"), (F.col("s_suppkey") + 200000000).cast("string"), F.lit("|taxdes|my_bug_"), "s_suppkey",
        F.lit(" z")).alias("header")))), """
    select taxid, case when rank = 'strain' then 'my bug ' || (taxid - 200000000) else name end as name from {nodes}""")
register("read_variants", lambda v: ts.parse_variants(v.variant.select(_tabbed(
    F.concat(F.lit("acc|"), "acc", F.lit("|taxid|"), "taxid"), "position", "ref", F.lit("M"), *[F.lit("-")] * 14, "var", F.lit("q")))
    .unionByName(v.region.select(F.concat(F.lit("Chrom\t"), "r_name").alias("value")))),
         "select acc, taxid, position, ref, 'M' as cons, var from {variant}")
register("read_pileup", lambda v: ts.parse_pileup(v.pileup.select(_tabbed("seq_id", "pos", "ref", "depth", "bases", F.lit("I")))),
         "select seq_id, pos, ref, cast(depth as int) as depth, bases, 'I' as quals from {pileup}")
register("read_samples", lambda v: ts.parse_samples(
    v.customer.select(F.concat("c_custkey", F.lit("  R1.fq  "), "c_mktsegment", F.lit(" ")).alias("value"),
                      F.col("c_custkey").alias("ord")).unionByName(
        v.nation.select(F.concat(F.lit("# "), "n_name").alias("value"), F.col("n_nationkey").cast("long").alias("ord"))))
         .select("sample_id", F.concat_ws(",", "data").alias("data")),
         "select cast(c_custkey as varchar) as sample_id, 'R1.fq,' || c_mktsegment as data from customer")
register("read_job_log", lambda v: ts.parse_job_log(v.log), """
    select 'S' || (user_id % 10) as sample, event_type as job, 'h' as host, 'q' as queue, event_id % 16 + 1 as cores,
      event_id as time_start, event_id + user_id as time_end, user_id as time_spent from events""")

# ---- records -------------------------------------------------------------------------------------


def _fasta(v):
    """Records as the separator leaves them: the text of a record from behind its `>` to the next."""
    text = sk.fasta_text(v.seq.withColumn("seq", F.regexp_replace("seq", r"[\n\r]*>", " ")))
    return text.withColumn("ord", F.lit(0))


register("read_fasta", lambda v: ss.parse_fasta(_fasta(v)).select("seq_id", "descr", "header", "length"), """
    select seq_id, substr(header, position(' ' in header) + 1) as descr, header,
      n - length(regexp_replace(seq, '[^>]', '', 'g')) as length from {bare}""", SEQ)


def _fastq_lines(v):
    reads = v.reads.select("read_id", F.col("source").alias("descr"), F.translate("seq", "\n\r", "").alias("seq"),
                           F.translate("lang", "e", "@").alias("qual"), "ord")
    parts = sk.fastq_text(reads, "ord").select("ord", F.posexplode(F.split("value", "\n")).alias("i", "value"))
    return parts.select("value", F.lit("f").alias("file"), (F.col("ord") * 4 + F.col("i")).alias("line"),
                        F.col("ord"))


register("read_fastq", lambda v: ss.parse_fastq(_fastq_lines(v), mate=1).select("read_id", "descr", "seq", "qual", "mate"), """
    select read_id, source as descr, replace(replace(seq, chr(10), ''), chr(13), '') as seq, replace(lang, 'e', '@') as qual,
      1 as mate from {reads}""")


def _ann_lines(v):
    pair = F.array(F.concat(F.lit("0 "), "ref_id", F.lit(" "), "descr"), F.concat(F.lit("7 "), "length", F.lit(" 0")))
    rows = v.ref.select("taxid", F.posexplode(pair).alias("i", "value"))
    numbered = rows.select("value", F.lit("f").alias("file"), ((F.col("taxid") - 200000000) * 2 + F.col("i") + 1).alias("line"))
    return numbered.unionByName(v.region.where("r_regionkey = 0").select(
        F.lit("99 2 11").alias("value"), F.lit("f").alias("file"), F.lit(0).cast("long").alias("line")))


register("read_ann", lambda v: ss.parse_ann(_ann_lines(v)), """
    select ref_id, descr, length, taxid, 'acc|A' || (taxid - 200000000) as acc from {ref}""")
register("read_family_fasta", lambda v: ss.parse_family_fasta(v.part.select(F.concat(
    F.lit("gnl|CDD|"), "p_partkey", F.lit(" COG"), "p_partkey", F.lit(", "), F.translate("p_name", " ", "_"), F.lit(";, KOG00"),
    "p_size", F.lit(", "), "p_type", F.lit(" thing [Some class]\n"), F.repeat(F.lit("ACD\n"), F.col("p_size"))).alias("value"),
    F.lit(0).alias("ord"))), """
    select 'gnl|CDD|' || p_partkey as subject, 3 * p_size as model_len, 'COG' || p_partkey as acc,
      replace(p_name, ' ', '_') as name, p_type || ' thing' as descr from part""")
register("read_hmm_flat", lambda v: ss.parse_hmm_flat(v.part.select(F.concat(
    F.lit("HMMER3/f\nNAME  "), "p_name", F.lit("\nACC   PF"), F.lpad(F.col("p_partkey").cast("string"), 8, "0"), F.lit(".3\nLENG "),
    "p_size").alias("value"), F.lit(0).alias("ord"))).select("acc", F.length("body").alias("n")), """
    select 'PF' || lpad(p_partkey::varchar, 8, '0') as acc,
      length('HMMER3/f' || 'NAME  ' || p_name || 'ACC   PF' || '00000000' || '.3' || 'LENG ' || p_size) + 3 as n from part""")
