"""Views that give the test tables the shapes the operators work on.

One SQL text per view serves both engines. `{name}` is a base table or another view. `@ORD@` and `@ORD2@`
are order columns: in Spark a struct of the columns that order a group, so that no window is needed; on the
checking side a row number by the same columns. `@LIST@` is the array constructor.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]

# Ids of the derived taxonomy: one species for three neighbouring strains, far from the other ids.
SPECIES, STRAIN = 100_000_000, 200_000_000

_SK = "case {k} when 0 then 2 when 1 then 2157 when 2 then 2759 when 3 then 10239 else 9999 end"

_ORDER = "l_linenumber, l_partkey, l_suppkey, l_extendedprice"

VIEWS: dict[str, str] = {
    # Alignments: a reference per supplier, multi-mapped reads, pairs and single ends, some rows without a place.
    "aln": f"""
        select l_orderkey as read_id,
          case when l_orderkey % 10 = 0 then 0 else 1
            + case when l_returnflag <> 'R' then 2 else 0 end
            + case when l_discount > 0.095 then 4 else 0 end
            + case when l_discount < 0.005 then 8 else 0 end
            + case when l_linenumber % 2 = 1 then 64 else 128 end end as flag,
          case when l_tax > 0.075 then '*' else 'acc|A' || cast(l_suppkey as string) || '|taxid|'
            || cast({STRAIN} + l_suppkey as string) end as ref_id,
          case when l_tax > 0.075 then null else {STRAIN} + l_suppkey end as taxid,
          l_partkey as pos,
          case when l_linestatus = 'F' or l_returnflag = 'A' then '=' else 'other' end as mate_ref,
          2 * cast(l_quantity as int) as score, @ORD@ as ord
        from {{lineitem}}""",
    "ref": f"""
        select 'acc|A' || cast(s_suppkey as string) || '|taxid|' || cast({STRAIN} + s_suppkey as string) as ref_id,
          1000 + 37 * s_suppkey as length, s_name as descr, {STRAIN} + s_suppkey as taxid
        from {{supplier}}""",
    "covered": "select ref_id, count(distinct pos) as covered_bp from {aln} group by ref_id",
    "nodes": f"""
        select cast(1 as bigint) as taxid, cast(1 as bigint) as parent, 'norank' as rank, 'root' as name
        union all
        select {_SK.format(k='r_regionkey')}, 1, 'superkingdom', r_name from {{region}}
        union all
        select 100 + n_nationkey, {_SK.format(k='n_regionkey')},
          case when n_nationkey in (4, 8, 15, 18) then 'norank' else 'phylum' end, n_name from {{nation}}
        union all
        select distinct {SPECIES} + cast(floor(s_suppkey / 3) as bigint),
          100 + min(s_nationkey) over (partition by floor(s_suppkey / 3)), 'species',
          'species ' || cast(cast(floor(s_suppkey / 3) as bigint) as string) from {{supplier}}
        union all
        select {STRAIN} + s_suppkey, {SPECIES} + cast(floor(s_suppkey / 3) as bigint), 'strain', s_name
        from {{supplier}}""",
    "leaves": f"select {STRAIN} + s_suppkey as taxid from {{supplier}}",
    # Classifier rows, accessions (every eighth taxid is covered very unevenly) and the taxids its report lists.
    "cls": f"""
        select l_orderkey as read_id, {STRAIN} + l_suppkey as taxid,
          'acc|' || cast(l_suppkey as string) || '_'
            || cast(case when l_suppkey % 8 = 5 then 0 else l_partkey % 3 end as string) as seq_id,
          3 * cast(l_quantity as int) as hit_len, 150 + l_linenumber as query_len, @ORD@ as ord
        from {{lineitem}}""",
    "acc": f"""
        select 'acc|' || cast(s_suppkey as string) || '_0' as acc, {STRAIN} + s_suppkey as taxid,
          case when s_suppkey % 8 = 5 then 50 else 400 + 7 * s_suppkey end as length from {{supplier}}
        union all
        select 'acc|' || cast(s_suppkey as string) || '_1', {STRAIN} + s_suppkey,
          case when s_suppkey % 8 = 5 then 900000000 else 500 + 7 * s_suppkey end from {{supplier}}
        union all
        select 'acc|' || cast(s_suppkey as string) || '_2', {STRAIN} + s_suppkey, 600 + 7 * s_suppkey from {{supplier}}""",
    "report": f"select {STRAIN} + s_suppkey as taxid from {{supplier}} where s_suppkey % 8 <> 4",
    # Reads on contigs (a contig per customer), the genomes they also map to, and host alignments.
    "contig": """
        select 'ctg' || cast(c_custkey as string) as contig, 500 + 10 * (c_custkey % 50) as length from {customer}""",
    "contig_aln": """
        select l_orderkey as read_id, 'ctg' || cast(o_custkey as string) as contig,
          3 + case when l_linenumber % 2 = 1 then 64 else 128 end as flag
        from {lineitem} join {orders} on o_orderkey = l_orderkey""",
    "contig_ref": f"""
        select l_orderkey as read_id, 3 + case when l_linenumber % 2 = 1 then 64 else 128 end as flag,
          2 * cast(l_quantity as int) as score,
          {STRAIN} + case when o_custkey % 2 = 0 and l_linenumber <> 5 then o_custkey % (select count(*) from {{supplier}})
            else l_suppkey end as taxid
        from {{lineitem}} join {{orders}} on o_orderkey = l_orderkey""",
    "paf": f"""
        select 'ctg' || cast(o_custkey as string) as contig, {STRAIN} + o_custkey % (select count(*) - 1 from {{supplier}}) + l_suppkey % 2 as taxid,
          cast(l_quantity as int) as matches
        from {{lineitem}} join {{orders}} on o_orderkey = l_orderkey""",
    # Similarity hits of reads against a family per part.
    "hits": """
        select l_orderkey as query, l_partkey as subject, 50 + l_quantity as pct_iden,
          4 * cast(l_quantity as int) as aln_len, 10 * (l_partkey % 40) + 1 as q_b,
          10 * (l_partkey % 40) + 4 * cast(l_quantity as int) as q_e, 1 as s_b, cast(l_quantity as int) as s_e,
          l_tax as evalue, @ORD@ as ord
        from {lineitem}""",
    "translated_hits": """
        select query, subject, pct_iden, aln_len,
          case when subject % 2 = 0 then q_e else q_b end as q_b,
          case when subject % 2 = 0 then q_b else q_e end as q_e, s_b, s_e, evalue, ord
        from {hits}""",
    "fam": """
        select p_partkey as subject, 50 + p_size as model_len, 'COG' || lpad(cast(p_partkey as string), 8, '0') as acc,
          p_name as name, p_type as descr from {part}""",
    "query_depth": """
        select l_orderkey as query, count(*) * 5e-1 as depth from {lineitem} group by l_orderkey""",
    "class_map": """
        select case p_partkey % 4 when 0 then 'J' when 1 then 'K' when 2 then 'JK' else 'L' end as letters,
          'COG' || lpad(cast(p_partkey as string), 8, '0') as family from {part}""",
    "class_names": """
        select case n_nationkey when 0 then 'L' when 1 then 'J' when 2 then 'K'
            else 'X' || cast(n_nationkey as string) end as class,
          n_name as descr, n_nationkey as ord from {nation}""",
    # Genes on contigs named after parts, in two header dialects, with hits on annotated clusters.
    "orf": """
        select distinct case when l_partkey % 2 = 0 then
            'ctg' || cast(l_partkey as string) || '_' || cast(l_suppkey % 7 as string)
          else 'ctg' || cast(l_partkey as string) || '.' || cast(l_suppkey % 7 as string) end as orf_id,
          case when l_partkey % 2 = 0 then
            'ctg' || cast(l_partkey as string) || '_' || cast(l_suppkey % 7 as string) || ' # '
              || cast(l_suppkey % 7 * 9 + 1 as string) || ' # ' || cast(l_suppkey % 7 * 9 + 600 as string)
              || ' # -1 # ID=1_1;partial=00'
          else 'ctg' || cast(l_partkey as string) || '.' || cast(l_suppkey % 7 as string) || ' /source=ctg'
              || cast(l_partkey as string) || ' /start=' || cast(l_suppkey % 7 * 9 + 1 as string) || ' /end='
              || cast(l_suppkey % 7 * 9 + 600 as string) || ' /frame=2 /length=200' end as header,
          l_partkey as p, l_suppkey % 7 as g
        from {lineitem}""",
    "orf_hits": """
        select case when l_partkey % 2 = 0 then
            'ctg' || cast(l_partkey as string) || '_' || cast(l_suppkey % 7 as string)
          else 'ctg' || cast(l_partkey as string) || '.' || cast(l_suppkey % 7 as string) end as query,
          'ref|' || cast(p_partkey as string) || '|len|' || cast(100 + p_size as string) as subject,
          50 + l_quantity as pct_iden, 4 * cast(l_quantity as int) as aln_len, l_tax as evalue, @ORD2@ as ord
        from {lineitem} join {part} on p_partkey = l_orderkey % (select count(*) from {part})""",
    "clstr": f"""
        select 'ref|' || cast(p_partkey as string) || '|len|' || cast(100 + p_size as string) as ref_id,
          case when p_partkey % n = p_partkey % 7 then @LIST@({STRAIN} + p_partkey % n)
            else @LIST@({STRAIN} + p_partkey % n, {STRAIN} + p_partkey % 7) end as taxids,
          'K' || lpad(cast(p_partkey % 300 as string), 5, '0') as ko, p_name || ' protein' as descr
        from (select *, (select count(*) from {{supplier}}) as n from {{part}}) p""",
    "gene_ann": """
        select orf_id, case when p % 5 = 0 then 'Unknown' else 'Species ' || cast(p % 20 as string) end as species,
          case when n % 11 = 0 then '' else 'K' || lpad(cast(n % 320 as string), 5, '0') end as ko,
          case when n % 3 = 0 then null else (n % 97 + 1) / 97e0 end as frac
        from (select o.orf_id, o.p, max(l.l_orderkey) as n from {orf} o join {lineitem} l
              on l.l_partkey = o.p and l.l_suppkey % 7 = o.g group by o.orf_id, o.p) x""",
    "gene_depth": """
        select orf_id, (p % 8) * 25e-2 as depth from {orf}""",
    # A hierarchy file per brand: type, size word, path, and a KO line per part.
    "keg": """
        select p_brand as file, ' 1' as ord, '+D KO' as value from {part} group by p_brand
        union all select p_brand, ' 2', '!' from {part} group by p_brand
        union all select p_brand, p_type, 'A<b>' || p_type || '</b>' from {part} group by p_brand, p_type
        union all select p_brand, p_type || '/' || split_part(p_name, ' ', 1), 'B  ' || split_part(p_name, ' ', 1)
          from {part} group by p_brand, p_type, split_part(p_name, ' ', 1)
        union all select p_brand, p_type || '/' || split_part(p_name, ' ', 1) || '/' || lpad(cast(p_size as string), 5, '0'),
          'C    ' || lpad(cast(p_size as string), 5, '0') || ' Path ' || cast(p_size as string) || ' [PATH:ko'
            || lpad(cast(p_size as string), 5, '0') || ']'
          from {part} group by p_brand, p_type, split_part(p_name, ' ', 1), p_size
        union all select p_brand, p_type || '/' || split_part(p_name, ' ', 1) || '/' || lpad(cast(p_size as string), 5, '0')
            || '/' || lpad(cast(p_partkey as string), 12, '0'),
          'D      K' || lpad(cast(p_partkey % 300 as string), 5, '0') || '  gene ' || cast(p_partkey % 300 as string) from {part}
        union all select p_brand, '~1', '!' from {part} group by p_brand
        union all select p_brand, '~2', 'D      K99999  after the end' from {part} group by p_brand""",
    # The same with modules on the fourth level and KOs on the fifth.
    "module_keg": """
        select * from {keg} where substring(value, 1, 1) <> 'D'
        union all select p_brand, p_type || '/' || split_part(p_name, ' ', 1) || '/' || lpad(cast(p_size as string), 5, '0')
            || '/' || cast(p_partkey % 7 as string),
          'D      M' || lpad(cast(p_partkey % 7 as string), 5, '0') || '  Module ' || cast(p_partkey % 7 as string)
          from {part} group by p_brand, p_type, split_part(p_name, ' ', 1), p_size, p_partkey % 7
        union all select p_brand, p_type || '/' || split_part(p_name, ' ', 1) || '/' || lpad(cast(p_size as string), 5, '0')
            || '/' || cast(p_partkey % 7 as string) || '/' || lpad(cast(p_partkey as string), 12, '0'),
          'E        K' || lpad(cast(p_partkey % 300 as string), 5, '0') || '  gene ' || cast(p_partkey % 300 as string) from {part}""",
    "ref_kos": """
        select case when p_size <= 4 then 'J  K' || lpad(cast(p_partkey % 300 as string), 5, '0') || ' ' || p_name
          else '# K' || lpad(cast(p_partkey % 300 as string), 5, '0') end as value from {part}""",
    # Sequences, id lists and reads.
    "seq": """
        select cast(doc_id as string) as seq_id,
          cast(doc_id as string) || ' ' || source || '_cov_' || cast(n_chars as string) || '.5 taxid|'
            || cast(doc_id as string) || '|' as header,
          text as seq, lang, doc_id as ord from {documents}""",
    "id_list": "select cast(doc_id as string) || ' note' as id from {labels} where toxic = 1",
    "reads": "select cast(doc_id as string) as read_id, text as seq, lang, source, doc_id as ord from {documents}",
    "db_hits": """
        select 'Host' as db, cast(doc_id as string) as read_id from {labels} where toxic = 1
        union all select 'rRNA', cast(doc_id as string) from {labels} where quality = 0
        union all select 'Host', cast(doc_id as string) from {labels} where toxic = 1 and quality = 0""",
    # The same read ids in two samples.
    "sample_reads": """
        select cast(cast(floor(doc_id / 2) as bigint) as string) as read_id,
          case when doc_id % 2 = 0 then 'S1' else 'S2' end as sample, lang, text as seq, doc_id as ord from {documents}""",
    "sample_hits": """
        select case when quality = 0 then 'rRNA' else 'Host' end as db,
          cast(cast(floor(doc_id / 2) as bigint) as string) as read_id,
          case when doc_id % 2 = 0 then 'S1' else 'S2' end as sample from {labels} where toxic = 1 or quality = 0""",
    "sample_pileup": """
        select 'S1' as sample, seq_id, pos, ref, depth, bases from {pileup}
        union all select 'S2', seq_id, pos, ref, depth, bases from {pileup} where pos % 3 = 0""",
    "sample_genes": """
        select case when species like '%1%' or species = 'Unknown' then 'S1' else 'S2' end as sample, orf_id, species, ko, frac
        from {gene_ann}""",
    "catalog": """
        select s_nationkey as species_ti, s_suppkey as taxid, s_name as name, 's' || cast(s_suppkey as string) as acc,
          s_suppkey as ord from {supplier}""",
    # Sample by feature values, one row per order.
    "long": """
        select c_mktsegment as sample, n_name || ':' || cast(cast(floor(o_totalprice / 20000) as int) as string) as feature,
          r_name as ann, o_totalprice as value, o_orderkey as ord
        from {orders} join {customer} on c_custkey = o_custkey join {nation} on n_nationkey = c_nationkey
          join {region} on r_regionkey = n_regionkey""",
    "tall": "select sample, feature, sum(cast(value as decimal(38,6))) as value from {long} group by sample, feature",
    "feature_map": """
        select distinct n_name || ':' || cast(cast(floor(o_totalprice / 20000) as int) as string) as feature,
          'G' || cast(cast(floor(o_totalprice / 60000) as int) as string) as target, r_name as name
        from {orders} join {customer} on c_custkey = o_custkey join {nation} on n_nationkey = c_nationkey
          join {region} on r_regionkey = n_regionkey where o_totalprice >= 40000""",
    "variant": """
        select 'a' || cast(l_suppkey as string) as acc, l_suppkey as taxid, l_partkey as position,
          l_linestatus as ref, l_returnflag as var, 'S' || cast(l_orderkey % 10 as string) as sample
        from {lineitem}""",
    "depth": """
        select 'chr' || cast(cast(floor(l_partkey / 500) as bigint) as string) as seq_id, l_partkey + 1 as pos,
          sum(case when l_returnflag = 'A' then 1 else 0 end) as d_a,
          sum(case when l_returnflag = 'N' then 1 else 0 end) as d_n,
          sum(case when l_returnflag = 'R' then 1 else 0 end) as d_r
        from {lineitem} group by l_partkey""",
    "pileup": """
        select 'acc|A|taxid|' || cast(cast(floor(l_partkey / 100) as bigint) as string) as seq_id, l_partkey as pos, 'c' as ref,
          count(*) as depth,
          repeat('.', cast(sum(case when l_returnflag = 'A' then 1 else 0 end) as int))
            || repeat('^~a', cast(sum(case when l_returnflag = 'N' then 1 else 0 end) as int))
            || repeat('g$', cast(sum(case when l_returnflag = 'R' then 1 else 0 end) as int))
            || repeat(',+2AGt', cast(sum(case when l_linestatus = 'F' then 1 else 0 end) as int)) as bases,
          sum(case when l_returnflag = 'A' then 1 else 0 end) as n_a,
          sum(case when l_returnflag = 'N' then 1 else 0 end) as n_n,
          sum(case when l_returnflag = 'R' then 1 else 0 end) as n_r,
          sum(case when l_linestatus = 'F' then 1 else 0 end) as n_f
        from {lineitem} group by l_partkey""",
    "genome_index": """
        select 'acc|A|taxid|' || cast(g as string) as seq_id, cast(floor(100 * (1 + 0.2 * (g % 4))) as bigint) as length
        from (select distinct cast(floor(l_partkey / 100) as bigint) as g from {lineitem}) x""",
    "log": """
        select 'sample=S' || cast(user_id % 10 as string) || ' job=' || event_type || ' host=h pid=1 queue=q cores='
          || cast(event_id % 16 + 1 as string) || ' time_start=' || cast(event_id as string) || ' time_end='
          || cast(event_id + user_id as string) || ' time_spent=' || cast(user_id as string) as value
        from {events}""",
    "rgi": """
        select orf_id, 'ctg' || cast(p as string) as scaffold, 'ARO:' || cast(p % 40 as string) as aro,
          p_type as gene_family, p_brand || '; ' || split_part(p_name, ' ', 1) as drug_class,
          split_part(p_name, ' ', 2) as mechanism
        from {orf} join {part} on p_partkey = p""",
}


def _fill(sql: str, ord_sql: str, ord2_sql: str, array: str) -> str:
    return sql.replace("@ORD@", ord_sql).replace("@ORD2@", ord2_sql).replace("@LIST@", array)


def uses(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))


def view(spark: SparkSession, sf_dir: str, name: str, known: dict[str, DataFrame]) -> DataFrame:
    """A base table or view as a Spark DataFrame; `known` holds those made before for the same folder."""
    if name not in known:
        if name in TABLES:
            known[name] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        else:
            sql = _fill(VIEWS[name], f"struct({_ORDER})", f"struct(l_orderkey, {_ORDER})", "array")
            tables = {n: view(spark, sf_dir, n, known) for n in uses(sql)}
            if "{lineitem} join {orders}" in sql:  # an order's lines pass by its row and need not be sorted
                tables["orders"] = tables["orders"].hint("shuffle_hash")
            if name == "orf":  # its columns follow from two numbers and hold both: those are told apart, before any text is made
                lines = tables["lineitem"].select("l_partkey", (F.col("l_suppkey") % 7).alias("l_suppkey"))
                tables["lineitem"], sql = lines.distinct(), sql.replace("select distinct", "select", 1)
            known[name] = spark.sql(sql, **tables)
    return known[name]


def with_views(body: str, extra: dict[str, str] | None = None, recursive: bool = False) -> str:
    """SQL for the check: `body` after the definitions of all views (and `extra` ones) it names."""
    local = {**VIEWS, **(extra or {})}
    defined: dict[str, str] = {}

    def define(name: str) -> None:
        if name in TABLES or name in defined:
            return
        sql = local[name]
        for n in uses(sql):
            if n != name:
                define(n)
        defined[name] = sql

    for n in uses(body):
        define(n)
    row_number = "row_number() over (partition by {} order by {})"
    text = ",\n".join(f"{n} as ({s})" for n, s in defined.items())
    whole = (f"with {'recursive ' if recursive else ''}{text}\n" if text else "") + body
    whole = _fill(whole, row_number.format("l_orderkey", _ORDER),
                  row_number.format("l_partkey, l_suppkey % 7", f"l_orderkey, {_ORDER}"), "list_value")
    return re.sub(r"\{(\w+)\}", r"\1", whole)
