"""Hit, gene annotation and hierarchy queries."""

from __future__ import annotations

from seqtally.catalog.alignment_queries import HOST_BINS, LINEAGE, host_bins, lin
from seqtally.catalog.registry import register
from seqtally.operators import annotation as an
from seqtally.operators import hierarchy as hi
from seqtally.operators import hits as ht
from seqtally.operators.alignments import contig_depth
from seqtally.operators.taxonomy import RANKS

HIT = "query, subject, pct_iden, aln_len, q_b, q_e, s_b, s_e, evalue"


def greedy_sql(source: str, frac: float = 0.5) -> dict[str, str]:
    """Accepted hits, by stepping through each query's hits with the list of intervals accepted so far."""
    clash = (f"len(list_filter(s.kept, lambda k: least(k.e, h.e) - greatest(k.b, h.b) > (h.e - h.b + 1) * {frac})) > 0")
    return {
        "h": f"""select *, least(q_b, q_e) as b, greatest(q_b, q_e) as e,
            row_number() over (partition by query order by ord) as n from ({source}) x""",
        "walk": f"""select query, n, [{{'b': b, 'e': e}}] as kept, true as ok from {{h}} where n = 1
            union all select h.query, h.n, case when {clash} then s.kept
              else list_append(s.kept, {{'b': h.b, 'e': h.e}}) end, not ({clash})
            from walk s join {{h}} h on h.query = s.query and h.n = s.n + 1""",
        "accepted": "select h.* from {h} h join {walk} w on w.query = h.query and w.n = h.n and w.ok",
    }


GREEDY = greedy_sql("select * from {hits} where evalue <= 0.05")


def accepted(v):
    return ht.greedy_nonoverlap(v.hits, 0.05)


register("top_hit", lambda v: ht.top_hit(v.hits, 0.05), f"""
    select {HIT} from {{hits}} where evalue <= 0.05 qualify row_number() over (partition by query order by ord) = 1""")
register("greedy_nonoverlap", accepted, f"select {HIT} from {{accepted}}", GREEDY, recursive=True)


def family_sql(weight: str, digits: int, source: str = "{accepted}") -> dict[str, str]:
    return {
        "found": f"""select a.subject, sum({weight}) as n, sum({weight} * (s_e - s_b + 1)) as c
            from {source} a left join {{query_depth}} d on d.query = a.query group by a.subject""",
        "cov": "select f.*, n, c / model_len as cov from {found} join {fam} f using (subject)",
        "family": f"""select subject, cast(trunc(n) as bigint) as n_hits, trunc(cov * 1000000) / 1000000 as coverage,
              trunc(trunc(cov * 1000000) / 1000000 / (select sum(cov) from {{cov}}) * 1e{digits}) / 1e{digits} as abundance,
              acc, name, descr from {{cov}}""",
    }


register("family_abundance", lambda v: ht.family_abundance(accepted(v), v.fam), """
    select subject, n_hits, round(coverage, 6) as coverage, round(abundance, 6) as abundance, acc, name, descr
    from {family}""", {**GREEDY, **family_sql("1", 6)}, recursive=True)
register("family_abundance_weighted", lambda v: ht.family_abundance(accepted(v), v.fam, v.query_depth, digits=9), """
    select subject, n_hits, round(coverage, 6) as coverage, round(abundance, 6) as abundance, acc, name, descr
    from {family}""", {**GREEDY, **family_sql("depth", 9)}, recursive=True)
register("family_abundance_subject", lambda v: ht.family_abundance(accepted(v), v.fam, subject_like="7"), """
    select subject, n_hits, round(coverage, 6) as coverage, round(abundance, 6) as abundance, acc, name, descr
    from {family}""", {**GREEDY, **family_sql("1", 6, "(select * from {accepted} where contains(cast(subject as varchar), '7'))")},
         recursive=True)
register("annotated_hits", lambda v: ht.annotated_hits(accepted(v), v.fam),
         f"select {', '.join('a.' + c for c in HIT.split(', '))}, acc, name, descr from {{accepted}} a left join {{fam}} f "
         "on f.subject = a.subject", GREEDY, recursive=True)
register("class_rollup", lambda v: ht.class_rollup(
    ht.family_abundance(accepted(v), v.fam, digits=9).withColumnRenamed("acc", "family"), v.class_map, v.class_names), """
    select n.class, count(*) as n_families,
      round(trunc(count(f.abundance) / count(*) * 1000000) / 1000000, 6) as coverage,
      round(coalesce(sum(f.abundance), 0.0), 6) as abundance, n.descr
    from {class_names} n join (select distinct unnest(string_split(letters, '')) as class, family from {class_map}) m
      on m.class = n.class
    left join (select * from {family} where abundance <> 0) f on f.acc = m.family group by n.class, n.descr""",
         {**GREEDY, **family_sql("1", 9)}, recursive=True)

TRANSLATED = greedy_sql("select * from {translated_hits}")
register("blastx_to_orf", lambda v: ht.blastx_to_orf(v.translated_hits), """
    select query || '.' || q_b || '.' || q_e as query, subject, pct_iden, aln_len, 1 as q_b,
      cast(floor((e - b + 1) / 3) as int) as q_e, s_b, s_e, evalue from {accepted}""", TRANSLATED, recursive=True)

# ---- genes and scaffolds -------------------------------------------------------------------------

ASSIGN = {
    **LINEAGE,
    "gene": "select orf_id, header, 'ctg' || cast(p as varchar) as scaffold, p, g from {orf}",
    "n_of": "select scaffold, count(*) as n_genes from {gene} group by scaffold",
    "tops": "select * from {orf_hits} where evalue <= 0.05 qualify row_number() over (partition by query order by ord) = 1",
    "gene_score": """select scaffold, subject, sum(cast(pct_iden * aln_len as decimal(38,12))) as w
        from {gene} join {tops} on query = orf_id group by scaffold, subject""",
    "score": """select scaffold, taxid, sum(cast(cast(w as double) / len(taxids) as decimal(38,12))) as s from
        (select scaffold, w, taxids, unnest(taxids) as taxid from {gene_score} join {clstr} on ref_id = subject) x
        group by scaffold, taxid""",
}
ROUNDS = {
    **ASSIGN,
    "lead": "select *, count(*) over (partition by scaffold) as ties from "
            "(select * from {open_score} qualify s = max(s) over (partition by scaffold)) x",
    "standing": """select taxid, sum(n_genes) as n from (select taxid, n_genes from {lead} join {n_of} using (scaffold)
        where ties = 1 union all select taxid, n_genes from {seeds}) y group by taxid""",
    "rounds": """select scaffold, taxid, 'kegg' as evidence, n_genes from
        (select l.scaffold, l.taxid from {lead} l left join {standing} t on t.taxid = l.taxid
         qualify row_number() over (partition by l.scaffold order by coalesce(t.n, 0) * (ties > 1)::int desc, l.taxid) = 1) z
        join {n_of} using (scaffold)""",
}
PLAIN = {**ROUNDS, "open_score": "select * from {score}",
         "seeds": "select cast(0 as bigint) as taxid, 0 as n_genes from {region} where false",
         "assigned": "select * from {rounds}"}
PREBIN = {
    **HOST_BINS, **ROUNDS,
    "seeds": """select contig as scaffold, cast(taxid as bigint) as taxid, 'mapping' as evidence, coalesce(n_genes, 0) as n_genes
        from {housed} left join {n_of} on scaffold = contig where regexp_matches(taxid, '[0-9]')""",
    "open_score": """select * from {score} where scaffold not in
        (select contig from {housed} where regexp_matches(taxid, '[0-9]') or taxid in ('Host', 'contaminant'))""",
    "assigned": """select scaffold, taxid, evidence, n_genes from {seeds} union all select * from {rounds}""",
}


def genes(v):
    return an.genes(v.written("orf"))


def gene_ids(v):
    """Genes for steps that read their ids and scaffolds alone: written once, without headers."""
    return v.stage("gene_ids", lambda w: an.genes(w.orf.select("orf_id")))


def best(v):
    return an.with_ref_len(v.stage("best", lambda w: ht.top_hit(w.orf_hits, 0.05).select(
        "query", "subject", "pct_iden", "aln_len")))  # the order has served its turn


def prebinned(v):
    return an.assign_scaffolds(genes(v), best(v), v.clstr, host_bins(v))


def assigned_prebin(v):
    return v.stage("assigned", prebinned)


register("assign_scaffolds", lambda v: an.assign_scaffolds(gene_ids(v), best(v), v.clstr), "select * from {assigned}", PLAIN,
         recursive=True)
IN_ORDER = {
    **PLAIN,
    "turns": """select scaffold, n_genes, list_sort(list(taxid)) as taxids,
        row_number() over (order by n_genes desc, scaffold) as turn
        from {lead} join {n_of} using (scaffold) where ties > 1 group by scaffold, n_genes""",
    "settled": """
        select cast(0 as bigint) as turn, '' as scaffold, cast(0 as bigint) as n_genes, cast(0 as bigint) as taxid,
          (select map_from_entries(list((taxid, cast(n as bigint)))) from {standing}) as genes
        union all
        select turn, scaffold, n_genes, taxid, map_concat(genes, map {taxid: coalesce(genes[taxid], 0) + n_genes})
        from (select t.turn, t.scaffold, t.n_genes, s.genes,
                -list_max(list_transform(t.taxids, lambda x: struct_pack(n := coalesce(s.genes[x], 0), t := -x))).t as taxid
              from settled s join {turns} t on t.turn = s.turn + 1) x""",
}
register("assign_scaffolds_in_order", lambda v: an.assign_scaffolds(gene_ids(v), best(v), v.clstr, ties="in_order"), """
    select scaffold, taxid, 'kegg' as evidence, n_genes from {lead} join {n_of} using (scaffold) where ties = 1
    union all select scaffold, taxid, 'kegg', n_genes from {settled} where turn > 0""", IN_ORDER, recursive=True)
register("assign_scaffolds_prebin", prebinned, "select * from {assigned}", PREBIN, recursive=True)
SPECIES_RULE = {
    **ASSIGN,
    "total": "select scaffold, sum(cast(pct_iden * aln_len as decimal(38,12))) as t from {gene} join {tops} on query = orf_id "
             "group by scaffold",
    "sp": "select scaffold, species_ti, sum(s) as s, arg_min(taxid, (-s, taxid)) as taxid from {score} join {lin} using (taxid) "
          "group by scaffold, species_ti",
    "firsts": "select *, count(*) over (partition by scaffold) as n from {sp} "
              "qualify row_number() over (partition by scaffold order by s desc, species_ti) = 1",
}
register("assign_scaffolds_species",
         lambda v: an.assign_scaffolds(gene_ids(v), best(v), v.clstr, rule="species", lineage=lin(v)), """
    select f.scaffold, f.taxid, 'kegg' as evidence, n_genes from {firsts} f join {total} t on t.scaffold = f.scaffold
      join {n_of} c on c.scaffold = f.scaffold where f.n = 1 or f.s > 0.5 * t.t""", SPECIES_RULE, recursive=True)

_NAMES = [*RANKS[:-1]]
TAXON = ("case when a.taxid is null then 'Unknown' else cast(l.species_ti as varchar) end as species_ti, "
         "case when a.taxid is null then 'Unknown' else cast(a.taxid as varchar) end as taxid, "
         + ", ".join(f"case when a.taxid is null then 'Unknown' else l.\"{r}\" end as \"{r}\"" for r in _NAMES)
         + ", case when a.taxid is null then 'Unknown' else l.toprank end as genome")
TABLES = {
    **PREBIN,
    "cdepth": """select c.contig, case when n > 0 then n * 150 / length else 1 end as depth
        from {contig} c left join (select contig, count(*) as n from {contig_aln} group by contig) a on a.contig = c.contig""",
    "genes_ann": f"""select {TAXON}, g.scaffold, g.orf_id, cast(g.g * 9 + 1 as varchar) as "start",
          cast(g.g * 9 + 600 as varchar) as "end", case when g.p % 2 = 0 then '-1' else '2' end as frame,
          case when t.query is null then '-' else cast(t.pct_iden as varchar) || '%' end as iden,
          case when t.query is not null then
              trunc(t.aln_len / cast(regexp_extract(t.subject, 'len\\|(\\d+)', 1) as int) * 10000) / 10000
            when a.taxid is not null then 1.0 end as frac,
          coalesce(c.ko, '') as ko, coalesce(c.descr, 'hypothetical protein') as descr, d.depth,
          coalesce(a.evidence, 'None') as evidence
        from {{gene}} g left join {{tops}} t on t.query = g.orf_id left join {{clstr}} c on c.ref_id = t.subject
          left join {{assigned}} a on a.scaffold = g.scaffold left join {{lin}} l on l.taxid = a.taxid
          left join {{cdepth}} d on d.contig = g.scaffold""",
    "scaffolds": f"""select {TAXON}, b.contig as scaffold, length, coalesce(n.n_genes, 0) as n_genes, d.depth,
          coalesce(a.evidence, 'None') as evidence, a.taxid as t
        from {{housed}} b left join {{n_of}} n on n.scaffold = b.contig left join {{assigned}} a on a.scaffold = b.contig
          left join {{lin}} l on l.taxid = a.taxid left join {{cdepth}} d on d.contig = b.contig
        where b.taxid not in ('Host', 'contaminant')""",
}


def depth_of_contigs(v):
    return contig_depth(v.contig_aln.withColumnRenamed("contig", "ref_id"), v.contig)


register("orf_annotation", lambda v: an.orf_annotation(genes(v), best(v), v.clstr, assigned_prebin(v), lin(v),
                                                       depth_of_contigs(v), host_bins(v), _listed(v)), """
    select * replace (round(frac, 6) as frac, round(depth, 6) as depth) from {genes_ann}
    where taxid <> '200000001' and scaffold not in
      (select contig from {housed} where taxid in ('Host', 'contaminant'))""", TABLES, recursive=True)


def scaffold_tables(v, operator, **options):
    return operator(host_bins(v), genes(v), assigned_prebin(v), depth_of_contigs(v), lin(v), **options)


def _listed(v):
    return v.supplier.where("s_suppkey = 1").selectExpr("200000000 + s_suppkey as taxid")


_SCA = "species_ti, taxid, " + ", ".join(f'"{r}"' for r in _NAMES) + ", genome"
register("scaffold_annotation", lambda v: scaffold_tables(v, an.scaffold_annotation, contaminants=_listed(v)),
         f"select {_SCA}, scaffold, length, n_genes, round(depth, 6) as depth, evidence from {{scaffolds}} "
         "where t is distinct from 200000001", TABLES, recursive=True)
register("contaminant_scaffolds",
         lambda v: scaffold_tables(v, an.scaffold_annotation, contaminants=_listed(v), listed=True),
         f"select {_SCA}, scaffold, length, n_genes, round(depth, 6) as depth, evidence from {{scaffolds}} "
         "where t = 200000001", TABLES, recursive=True)
register("taxon_summary", lambda v: scaffold_tables(v, an.taxon_summary), f"""
    select {_SCA}, cast(sum(case when t is not null or n_genes > 0 then 1 else 0 end) as bigint) as n_scaffolds,
      cast(sum(n_genes) as bigint) as n_genes, round(sum(length * depth), 6) as sum_depth
    from {{scaffolds}} group by {_SCA}""", TABLES, recursive=True)

# ---- hierarchy -----------------------------------------------------------------------------------

KEG = {
    "leaf": """select p_brand as file, row_number() over (partition by p_brand order by p_type, split_part(p_name, ' ', 1),
          p_size, p_partkey) - 1 as leaf_ord, 'D' as level, 'K' || lpad(cast(p_partkey % 300 as varchar), 5, '0') as ko,
          'gene ' || cast(p_partkey % 300 as varchar) as descr, p_type as "A", split_part(p_name, ' ', 1) as "B",
          'ko' || lpad(cast(p_size as varchar), 5, '0') as "C", cast(null as varchar) as "D", cast(null as varchar) as "E"
        from {part}""",
    "node": """select file, 'A' as level, "A" as node, cast(null as varchar) as descr, cast(null as varchar) as "A",
          cast(null as varchar) as "B", cast(null as varchar) as "C", cast(null as varchar) as "D", max("A") as o
        from {leaf} group by file, "A"
        union all select file, 'B', "B", null, max("A"), null, null, null, max("A" || '/' || "B") from {leaf} group by file, "B"
        union all select file, 'C', "C", 'Path ' || cast(cast(substr("C", 3) as int) as varchar), arg_max("A", "A" || '/' || "B"),
          arg_max("B", "A" || '/' || "B"), null, null, max("A" || '/' || "B" || '/' || substr("C", 3))
        from {leaf} group by file, "C" """,
    "refs": """select distinct 'K' || lpad(cast(p_partkey % 300 as varchar), 5, '0') as ko from {part} where p_size <= 4""",
    "scope": "select distinct ko, descr from {leaf}",
    "ann": """select a.*, case when frac > 0 then frac else 1.0 end as fr, case when d.depth <> 0 then d.depth else 1.0 end as dp
        from {gene_ann} a left join {gene_depth} d on d.orf_id = a.orf_id where ko <> ''""",
}


def leaves(v):
    return hi.flatten_brite(v.keg)


def refs(v):
    return hi.single_copy_kos(v.ref_kos)


register("flatten_brite", leaves, "select * from {leaf}", KEG)
register("brite_nodes", lambda v: hi.brite_nodes(v.keg).withColumnRenamed("node_ord", "o"), "select * from {node}", KEG)
register("single_copy_kos", refs, "select ko from {refs}", KEG)


def _ko(by: str = "") -> dict[str, str]:
    """KO sums, totals and reference means, optionally within `by`."""
    k = f"{by}, " if by else ""
    on = f"using ({by})" if by else "on true"
    g = f"group by {by}" if by else ""
    return {
        **KEG,
        "per": f"select {k}ko, sum(cast(fr as decimal(38,12)))::double as d, sum(cast(fr * dp as decimal(38,12)))::double as da from {{ann}} group by {k}ko",
        "inside": "select p.*, s.descr from {per} p join {scope} s on s.ko = p.ko",
        "sums": f"select {k}sum(d) as sd, sum(da) as sda from {{inside}} {g}",
        "refsum": f"""select {k}sum(d) / (select count(*) from {{refs}}) as r, sum(da) / (select count(*) from {{refs}}) as ra
            from {{per}} where ko in (select ko from {{refs}}) {g}""",
        "ko": f"""select {k}ko, d as depth, da as depth_adj, trunc(d / sd * 1000000) / 1000000 as abundance,
              trunc(da / sda * 1000000) / 1000000 as abundance_adj,
              case when r > 0 then trunc(d / r * 1000) / 1000 else 0 end as r_depth,
              case when r > 0 then trunc(da / ra * 1000000) / 1000000 else 0 end as r_depth_adj, descr,
              coalesce(r, 0) as ref_mean, coalesce(ra, 0) as ref_mean_adj
            from {{inside}} join {{sums}} {on} left join {{refsum}} {on}""",
    }


_KO_COLUMNS = ", ".join(["ko"] + [f"round({c}, 6) as {c}" for c in (
    "depth", "depth_adj", "abundance", "abundance_adj", "r_depth", "r_depth_adj", "ref_mean", "ref_mean_adj")] + ["descr"])


def ko(v, source=None):
    return hi.ko_abundance(v.gene_ann, hi.ko_scope(leaves(v) if source is None else source), v.gene_depth, refs(v))


register("ko_abundance", ko, f"select {_KO_COLUMNS} from {{ko}}", _ko())
LEVEL = {
    **_ko(),
    "members": """select file, 'A' as level, "A" as node, ko from {leaf} union all select file, 'B', "B", ko from {leaf}
        union all select file, 'C', "C", ko from {leaf}""",
    "agg": """select m.file, m.level, m.node, count(*) as members, count(k.ko) as found,
          coalesce(sum(cast(k.depth as decimal(38,12))), 0)::double / count(*) as d,
          coalesce(sum(cast(k.depth_adj as decimal(38,12))), 0)::double / count(*) as da
        from {members} m left join {ko} k on k.ko = m.ko group by m.file, m.level, m.node""",
}
_ROLL = """select a.file, a.level, a.node, n.descr, n."A", n."B", n."C", n.o as node_order, members, found,
      trunc(found / members * 1000) / 1000 as coverage, round(a.d, 6) as depth, round(a.da, 6) as depth_adj,
      round(trunc(a.d / r * 1000) / 1000, 6) as r_depth, round(trunc(a.da / ra * 1000000) / 1000000, 6) as r_depth_adj
    from {agg} a join {node} n on n.file = a.file and n.level = a.level and n.node = a.node join {refsum} on true"""
for _level in "ABC":
    register(f"level_rollup_{_level}",
             lambda v, x=_level: hi.level_rollup(ko(v), leaves(v), hi.brite_nodes(v.keg), [x])
             .withColumnRenamed("node_ord", "node_order"), _ROLL + f" where a.level = '{_level}'", LEVEL)
register("level_rollup_D", lambda v: hi.level_rollup(ko(v), hi.flatten_brite(v.module_keg), hi.brite_nodes(v.module_keg), ["D"])
         .select("file", "level", "node", "descr", "members", "found", "coverage", "depth", "depth_adj"), """
    select file, 'D' as level, node, 'Module ' || cast(cast(substr(node, 2) as int) as varchar) as descr, members, found,
      round(trunc(found / members * 1000) / 1000, 6) as coverage, round(d, 6) as depth, round(da, 6) as depth_adj from {agg}""", {
    **LEVEL, "members": """select p_brand as file, 'D' as level, 'M' || lpad(cast(p_partkey % 7 as varchar), 5, '0') as node,
        'K' || lpad(cast(p_partkey % 300 as varchar), 5, '0') as ko from {part}"""})
register("full_listing", lambda v: hi.full_listing(leaves(v), ko(v)), """
    select file, leaf_ord + 1000001 as id, "A", "B", "C", "D", l.ko, l.descr,
      """ + ", ".join(f"round(coalesce(k.{c}, 0.0), 6) as {c}" for c in (
    "depth", "depth_adj", "abundance", "abundance_adj", "r_depth", "r_depth_adj")) + """
    from {leaf} l left join {ko} k on k.ko = l.ko""", _ko())
PER_TAXON = {
    **_ko("species"),
    "ann": KEG["ann"].replace("where ko <> ''", "where ko <> '' and not contains(species, 'Unknown')"),
    "shown": """select species from {ann} where ko in (select ko from {refs}) group by species
        having count(distinct ko) >= 0.3 * (select count(*) from {refs})""",
}
register("per_taxon_profiles",
         lambda v: hi.per_taxon_profiles(v.gene_ann, hi.ko_scope(leaves(v)), refs(v), depth=v.gene_depth),
         f"select species, {_KO_COLUMNS} from {{ko}} where species in (select species from {{shown}})", PER_TAXON)


def per_taxon_levels(v):
    profile = hi.per_taxon_profiles(v.gene_ann, hi.ko_scope(leaves(v)), refs(v), depth=v.gene_depth)
    return (hi.level_rollup(profile, leaves(v), hi.brite_nodes(v.keg), ["A", "B"], by=["species"])
            .select("species", "file", "level", "node", "members", "found", "coverage", "depth", "depth_adj"))


register("per_taxon_levels", per_taxon_levels, """
    select s.species, m.file, m.level, m.node, count(*) as members, count(k.ko) as found,
      trunc(count(k.ko) / count(*) * 1000) / 1000 as coverage, 
      round(coalesce(sum(cast(k.depth as decimal(38,12))), 0)::double / count(*), 6) as depth,
      round(coalesce(sum(cast(k.depth_adj as decimal(38,12))), 0)::double / count(*), 6) as depth_adj
    from {shown} s join {members} m on m.level in ('A', 'B') left join {ko} k on k.ko = m.ko and k.species = s.species
    group by s.species, m.file, m.level, m.node""", {**PER_TAXON, "members": LEVEL["members"]})
register("ko_abundance_of_annotation", lambda v: hi.ko_abundance(
    v.stage("annotation", lambda w: an.orf_annotation(genes(w), best(w), w.clstr, assigned_prebin(w), lin(w))),
    hi.ko_scope(leaves(v)), None, refs(v)),
         f"select {_KO_COLUMNS} from {{ko}}",
         {**TABLES, **_ko(), "ann": "select orf_id, ko, case when frac > 0 then frac else 1.0 end as fr, 1.0 as dp "
                                    "from {genes_ann} where ko <> ''"}, recursive=True)
