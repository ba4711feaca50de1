"""Alignment selection, counting, abundance, taxonomy and binning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from seqtally.catalog.registry import register
from seqtally.operators import alignments as al
from seqtally.operators import binning as bn
from seqtally.operators import taxonomy as tx
from seqtally.operators.taxonomy import PROFILE_RANKS, RANKS
from seqtally.plans import profiles as pf
from seqtally.plans.report import report_matrices, report_table

ALN = "read_id, flag, ref_id, taxid, pos, mate_ref, score"

# ---- choosing alignments -------------------------------------------------------------------------

MATES = """
    select k.*, row_number() over (partition by read_id, m order by ord) as rn
    from (select *, case when flag & 64 <> 0 then 1 when flag & 128 <> 0 then 2 end as m from {kept}) k
    where m is not null"""
PAIRS = """
    select a.read_id, a.ord as o1, b.ord as o2,
      coalesce(a.ref_id = b.ref_id and a.mate_ref = '=' and b.mate_ref = '=', false) as ok
    from (select * from {mates} where m = 1 and rn = 1) a full join (select * from {mates} where m = 2 and rn = 1) b
      on a.read_id = b.read_id"""
PAIRS = PAIRS.replace("select a.read_id", "select coalesce(a.read_id, b.read_id) as read_id")

KEPT_STRICT = """select * from {aln} where ref_id <> '*' and score >= 40 and flag & 1 <> 0 and flag & 2 <> 0
    and flag & 4 = 0 and flag & 8 = 0"""
KEPT_PROPER = """select * from {aln} where ref_id <> '*' and score >= 40 and (flag & 1 = 0 or flag & 2 <> 0)"""
KEPT_ANY = """select * from {aln} where ref_id <> '*' and score >= 40"""


def _emit(first: str, second: str) -> str:
    return f"""select {', '.join('k.' + c for c in ALN.split(', '))} from {{kept}} k join {{pairs}} p on k.read_id = p.read_id
        where (k.ord = p.o1 and {first}) or (k.ord = p.o2 and {second})"""


def _pairs(kept: str) -> dict[str, str]:
    return {"kept": kept, "mates": MATES, "pairs": PAIRS}


register("align_top_pair", lambda v: al.top_pair(v.aln, 40), _emit("ok", "ok"), _pairs(KEPT_STRICT))
_KEEP = "(ok or o1 is null or o2 is null)"
register("align_top_pair_or_single", lambda v: al.top_pair_or_single(v.aln, 40), _emit(_KEEP, _KEEP),
         _pairs(KEPT_PROPER))
register("align_top_pair_or_single_f0", lambda v: al.top_pair_or_single(v.aln, 40, proper=False),
         _emit("true", _KEEP), _pairs(KEPT_ANY))
register("align_kept_read_ids", lambda v: al.kept_read_ids(v.aln, 40),
         f"select read_id from {{pairs}} where {_KEEP}", _pairs(KEPT_PROPER))

register("align_top_scored", lambda v: al.top_scored(v.aln, 40), f"""
    select {ALN} from {{kept}} k where not r2row and not (select s.pe from {{state}} s where s.read_id = k.read_id)
      and score = (select max(score) from {{kept}} x where x.read_id = k.read_id and not x.r2row)
    union all
    select {', '.join('k.' + c for c in ALN.split(', '))} from {{kept}} k join {{pick}} p
      on k.read_id = p.read_id and k.ref_id = p.ref_id
    where (k.ord = p.o1 and p.src <> 'R2') or (k.ord = p.o2 and p.src <> 'R1')""", {
    "kept": """select *, (flag & 1 <> 0 and flag & 128 <> 0) as r2row from {aln} where ref_id <> '*' and score >= 40""",
    "state": """select read_id, (flag & 1 <> 0) as pe from {kept}
        qualify row_number() over (partition by read_id order by ord desc) = 1""",
    "best": """select * from {kept}
        qualify row_number() over (partition by read_id, ref_id, r2row order by score desc, ord) = 1""",
    "couples": """select coalesce(a.read_id, b.read_id) as read_id, coalesce(a.ref_id, b.ref_id) as ref_id, a.ord as o1,
          b.ord as o2, coalesce(a.score, 0) as s1, coalesce(b.score, 0) as s2,
          case when b.ord is not null then b.mate_ref else a.mate_ref end as mate
        from (select * from {best} where not r2row) a full join (select * from {best} where r2row) b
          on a.read_id = b.read_id and a.ref_id = b.ref_id""",
    "scored": """select *, case when mate = '=' and s1 > 0 and s2 > 0 then s1 + s2 else greatest(s1, s2) end as s,
          case when mate = '=' and s1 > 0 and s2 > 0 then 'R12' when s1 > s2 then 'R1' else 'R2' end as src from {couples}""",
    "pick": """select c.* from {scored} c join {state} t on c.read_id = t.read_id and t.pe
        qualify s = max(s) over (partition by c.read_id)"""})

register("align_drop_host_groups", lambda v: al.drop_host_groups(v.aln, 95), f"""
    select {ALN} from {{aln}} where flag & 1 <> 0 and read_id not in
      (select read_id from {{aln}} where flag & 1 <> 0 and score >= 95)""")

# ---- counting and abundance ----------------------------------------------------------------------


def _shared(target: str) -> dict[str, str]:
    return {
        "per": f"""select read_id, {target} as target, count(*) as c from {{aln}}
            where flag & 1 <> 0 and flag & 2 <> 0 and ref_id <> '*' group by read_id, {target}""",
        "top": "select * from {per} qualify c = max(c) over (partition by read_id)",
        "share": "select *, 1.0 / count(*) over (partition by read_id) as w from {top}",
        "counts": f"select target as {target}, sum(cast(w as double)) as reads from {{share}} group by target",
    }


BY_REF, BY_TAXID = _shared("ref_id"), _shared("taxid")
DEPTH = {"dep": """select c.ref_id, c.reads, 300 * c.reads / r.length as depth, r.length, r.descr
    from {counts} c join {ref} r on c.ref_id = r.ref_id"""}

register("fractional_counts", lambda v: al.fractional_counts(v.aln),
         "select ref_id, round(reads, 6) as reads from {counts}", BY_REF)
register("reference_depth", lambda v: al.reference_depth(al.fractional_counts(v.aln), v.ref),
         "select ref_id, round(reads, 6) as reads, round(depth, 6) as depth, length, descr from {dep}",
         {**BY_REF, **DEPTH})
register("reference_abundance",
         lambda v: al.reference_abundance(al.fractional_counts(v.aln), v.ref, covered=v.covered), """
    select d.ref_id, length, descr, round(reads, 6) as reads, round(depth, 6) as depth,
      round(depth / (select sum(depth) from {dep}), 6) as abundance,
      coalesce(trunc(covered_bp / length * 100000) / 100000, 0.0) as fraction
    from {dep} d left join {covered} c on c.ref_id = d.ref_id
    where depth / (select sum(depth) from {dep}) >= 1e-4""", {**BY_REF, **DEPTH})
register("contig_depth",
         lambda v: al.contig_depth(v.contig_aln.withColumnRenamed("contig", "ref_id"), v.contig), """
    select c.contig, round(case when n > 0 then n * 150 / length else 1 end, 6) as depth
    from {contig} c left join (select contig, count(*) as n from {contig_aln} group by contig) a on a.contig = c.contig""")

# ---- taxonomy ------------------------------------------------------------------------------------

LINEAGE = {
    "tree": """select taxid, parent, name,
        case when parent = 10239 and rank = 'norank' then 'phylum' else rank end as rank from {nodes}""",
    "climb": """select taxid as leaf, taxid as place from {leaves}
        union all select c.leaf, t.parent from climb c join {tree} t on t.taxid = c.place where t.parent > 1""",
    "ranks_of": "select leaf as taxid, " + ", ".join(
        f"max(case when rank = '{r}' then place end) as {r}_ti" for r in RANKS[:-1])
    + ", leaf as toprank_ti from {climb} join {tree} on {tree}.taxid = place group by leaf",
    "lin": "select l.taxid, " + ", ".join(
        f"(select name from {{tree}} t where t.taxid = l.{r}_ti) as \"{r}\", l.{r}_ti" for r in RANKS) + " from {ranks_of} l",
}


def lin(v):
    return v.stage("lineage", lambda w: tx.lineage(w.nodes, w.leaves, w.nodes))


register("lineage", lambda v: tx.lineage(v.nodes, v.leaves, v.nodes), "select * from {lin}", LINEAGE, recursive=True)


def _rank_rows() -> str:
    parts = []
    for i, r in enumerate(RANKS):
        above = list(reversed(RANKS[:i]))
        nearest = f"coalesce({', '.join(a + '_ti' for a in above)})" if above else "cast(null as bigint)"
        rank_of = "case " + " ".join(f"when {a}_ti is not null then '{a}'" for a in above) + " end" if above else "null"
        depth_of = "case " + " ".join(f"when {a}_ti is not null then {RANKS.index(a)}" for a in above) + " end" \
            if above else "null"
        parts.append(f"""select distinct '{r}' as rank, coalesce({r}_ti, -{nearest}, -1) as taxid,
            case when {r}_ti is null then {rank_of} end as above,
            case when {r}_ti is not null then {i} else {depth_of} end as depth, """
                     + ", ".join(f"case when (case when {r}_ti is not null then {i} else {depth_of} end) >= {j} "
                                 f"then {q}_ti end as {q}_ti" for j, q in enumerate(RANKS[:-1])) + " from {lin}")
    return " union all ".join(parts)


register("rank_table", lambda v: tx.rank_table(lin(v), v.nodes), """
    select e.taxid, e.rank, case when e.taxid = -1 then 'unknown' when e.taxid < 0 then
        'Unnamed ' || e.rank || ' in ' || (select name from {tree} t where t.taxid = -e.taxid) || ' ' || e.above
      else (select name from {tree} t where t.taxid = e.taxid) end as name,
      """ + ", ".join(f"(select name from {{tree}} t where t.taxid = e.{r}_ti) as \"{r}\", e.{r}_ti" for r in RANKS[:-1])
         + """, (select name from {tree} t where t.taxid = l.taxid) as toprank, l.taxid as toprank_ti
    from {rank_rows} e left join {leaves} l on l.taxid = abs(e.taxid)""",
         {**LINEAGE, "rank_rows": _rank_rows()}, recursive=True)

_SK = """
    select s.taxid, s.superkingdom, cast(floor(coalesce(r.reads, 0) + 1e-9) as bigint) as reads
    from (values (cast(2 as bigint), 'Bacteria'), (2157, 'Archaea'), (2759, 'Eukaryota'), (10239, 'Viruses'))
      s(taxid, superkingdom)
    left join (select superkingdom_ti, sum(reads) as reads from {counts} join {lin} using (taxid) group by 1) r
      on r.superkingdom_ti = s.taxid"""
register("superkingdom_reads",
         lambda v: tx.superkingdom_reads(al.fractional_counts(v.aln, "taxid"), lin(v), total=10_000_000),
         _SK + """ union all select -1, 'unmaped', cast(10000000 - round((select sum(reads) from {counts})) as bigint)""",
         {**BY_TAXID, **LINEAGE}, recursive=True)


def _abundance(read_len: str, cutoff: str) -> dict[str, str]:
    return {
        "tdep": f"""select c.taxid, c.reads, l.superkingdom_ti as sk, {read_len} / g.length as depth
            from {{counts}} c join {{len}} g on g.taxid = c.taxid join {{lin}} l on l.taxid = c.taxid""",
        "raw": """select taxid, reads, depth, trunc(depth / (sum(depth) over (partition by sk))
              * ((sum(reads) over (partition by sk)) / round((select sum(reads) from {mapped}))) * 100000000) / 100000000 as a
            from {tdep}""",
        "abund": f"""select taxid, reads, depth, a / (select sum(a) from {{raw}} where a >= {cutoff}) as abundance
            from {{raw}} where a >= {cutoff}""",
        "entries": " union all ".join(
            f"select '{r}' as rank, {RANKS.index(r)} as d, coalesce({', '.join(q + '_ti' for q in RANKS[RANKS.index(r):])}) "
            "as rank_taxid, a.*, " + ", ".join(f'l."{q}"' for q in RANKS)
            + " from {abund} a join {lin} l on l.taxid = a.taxid" for r in PROFILE_RANKS),
        "rolled": "select rank, rank_taxid, " + ", ".join(
            f"case when d >= {i} then arg_min(coalesce(\"{q}\", ''), taxid) end as \"{q}\"" for i, q in enumerate(RANKS))
        + ", sum(abundance) as abundance, sum(depth) as depth, sum(reads) as reads from {entries} group by rank, d, rank_taxid",
    }


def _rolled(columns: list[str], where: str = "") -> str:
    names = ", ".join(f"nullif(\"{c}\", '') as \"{c}\"" if c in RANKS else c for c in columns)
    return (f"select {names}, round(abundance, 6) as abundance, round(depth, 6) as depth, round(reads, 6) as reads "
            f"from {{rolled}} {where}")


ALN_ABUND = {**BY_TAXID, **LINEAGE, **_abundance("300 * c.reads", "1e-9"), "len": "select taxid, length from {ref}",
             "mapped": "select * from {counts}"}


def aln_abundance(v):
    return tx.taxon_abundance(al.fractional_counts(v.aln, "taxid"), v.ref, lin(v))


def aln_rank(v, rank):
    return tx.rank_rollup(aln_abundance(v), lin(v), rank)


register("taxon_abundance", aln_abundance, """
    select taxid, round(reads, 6) as reads, round(depth, 6) as depth, round(abundance, 6) as abundance from {abund}""",
         ALN_ABUND, recursive=True)
for _rank in PROFILE_RANKS:
    register(f"rank_rollup_{_rank}", lambda v, r=_rank: aln_rank(v, r),
             _rolled(["rank_taxid", *RANKS[:RANKS.index(_rank) + 1]], f"where rank = '{_rank}'"), ALN_ABUND,
             recursive=True)
register("alignment_profile", lambda v: pf.alignment_profile(v.aln, v.ref, lin(v)),
         _rolled(["rank", "rank_taxid", *RANKS]), ALN_ABUND, recursive=True)

# ---- classifier ----------------------------------------------------------------------------------

EXCLUDED = "200000003,junk"
CLS = {
    **LINEAGE,
    "len": "select taxid, sum(length) as length from {acc} group by taxid",
    "usable": """select * from {cls} where hit_len >= 60 and taxid in (select taxid from {report})
        and taxid in (select taxid from {leaves}) and taxid <> 200000003""",
    "pairs": """select read_id, taxid, count(*) over (partition by read_id) as n, q from
        (select read_id, taxid, arg_min(query_len, ord) as q0, min(ord) as o from {usable} group by read_id, taxid) a
        join (select read_id as r2, arg_min(query_len, ord) as q from {usable} group by read_id) b on r2 = read_id""",
    "counts": """select taxid, sum(cast(1.0 / n as double)) as reads, sum(cast(q as double) / n) as bases
        from {pairs} group by taxid""",
    "obs": """select a.taxid, sum(least(300 * n, length)) as covered, arg_max(a.acc, 300 * n / length) as top_acc
        from {acc} a join (select seq_id, count(*) as n from {usable} group by seq_id) u on u.seq_id = a.acc group by a.taxid""",
    "even": """select c.taxid, c.reads, 300 * c.reads / l.length as depth, 1 - exp(-(300 * c.reads / l.length)) as expected,
          coalesce(covered, 0) / l.length as observed, top_acc
        from {counts} c join {len} l on l.taxid = c.taxid left join {obs} o on o.taxid = c.taxid""",
    "failed": "select * from {even} where observed / expected < 0.1",
    "mapped": "select * from {counts}",
    "passed": "select * from {counts} where taxid not in (select taxid from {failed})",
}


def profile(v):
    return pf.classifier_profile(v.cls, v.acc, lin(v), v.report, EXCLUDED)


register("classifier_counts", lambda v: profile(v)["counts"],
         "select taxid, round(reads, 6) as reads, round(bases, 6) as bases from {counts}", CLS, recursive=True)
register("exclude_taxa", lambda v: tx.exclude_taxa(v.cls, v.report, EXCLUDED), """
    select read_id, taxid, seq_id, hit_len, query_len from {cls}
    where taxid not in (select taxid from {report}) and taxid <> 200000003""")
register("evenness_filter", lambda v: profile(v)["failed"].select(
    "taxid", "reads", "depth", "expected", "observed", "deepest_acc"), """
    select taxid, round(reads, 6) as reads, round(depth, 6) as depth, round(expected, 6) as expected,
      round(observed, 6) as observed, top_acc as deepest_acc from {failed}""", CLS, recursive=True)


def evenness_all(v):
    p = profile(v)
    return tx.evenness(p["usable"], v.acc, p["counts"]).select("taxid", "reads", "depth", "expected", "observed")


register("evenness", evenness_all, """
    select taxid, round(reads, 6) as reads, round(depth, 6) as depth, round(expected, 6) as expected,
      round(observed, 6) as observed from {even}""", CLS, recursive=True)


def mapped_reads(v):
    p = profile(v)
    return tx.mapped_reads(p["usable"], p["failed"])


register("mapped_reads", mapped_reads, """
    select read_id, string_agg(cast(taxid as varchar), '|' order by taxid) as taxids from {pairs}
    where taxid not in (select taxid from {failed}) group by read_id""", CLS, recursive=True)
CLS_ABUND = {**CLS, **{k: s.replace("{counts} c", "{passed} c") for k, s in _abundance("300 * c.reads", "1e-6").items()}}
register("classifier_profile", lambda v: profile(v)["ranks"], _rolled(["rank", "rank_taxid", *RANKS]), CLS_ABUND,
         recursive=True)
register("classifier_superkingdoms", lambda v: profile(v)["superkingdoms"],
         _SK.replace("{counts}", "{passed}"), CLS, recursive=True)

# ---- all samples at once -------------------------------------------------------------------------


def _sampled(ctes: dict[str, str]) -> dict[str, str]:
    """The classifier checks with every step taken within a sample."""
    out = {
        **ctes,
        "usable": CLS["usable"].replace("select *", "select *, 'S' || cast(read_id % 5 as varchar) as sample"),
        "pairs": """select p.*, u.sample from (""" + CLS["pairs"] + """) p join (select distinct read_id as r, sample from {usable}) u
            on u.r = p.read_id""",
        "counts": CLS["counts"].replace("select taxid", "select sample, taxid").replace("group by taxid", "group by sample, taxid"),
        "obs": """select u.sample, a.taxid, sum(least(300 * n, length)) as covered, max(a.acc) as top_acc
            from {acc} a join (select sample, seq_id, count(*) as n from {usable} group by 1, 2) u on u.seq_id = a.acc group by 1, 2""",
        "even": CLS["even"].replace("select c.taxid", "select c.sample, c.taxid").replace(
            "on o.taxid = c.taxid", "on o.taxid = c.taxid and o.sample = c.sample"),
        "passed": "select c.* from {counts} c anti join {failed} f on f.sample = c.sample and f.taxid = c.taxid",
        "n_map": "select sample, round(sum(reads)) as n from {counts} group by sample",
        "tdep": ctes["tdep"].replace("select c.taxid", "select c.sample, c.taxid"),
        "raw": """select t.sample, taxid, reads, depth, trunc(depth / (sum(depth) over (partition by t.sample, sk))
              * ((sum(reads) over (partition by t.sample, sk)) / n) * 100000000) / 100000000 as a
            from {tdep} t join {n_map} m on m.sample = t.sample""",
        "abund": """select sample, taxid, reads, depth, a / sum(a) over (partition by sample) as abundance
            from {raw} where a >= 1e-6""",
        "rolled": ctes["rolled"].replace("select rank,", "select sample, rank,").replace("group by rank,", "group by sample, rank,"),
    }
    return out


def sample_profile(v):
    cls = v.cls.withColumn("sample", F.concat(F.lit("S"), (F.col("read_id") % 5).cast("string")))
    return pf.classifier_profile(cls, v.acc, lin(v), v.report, EXCLUDED, by=["sample"])


SAMPLED = _sampled(CLS_ABUND)
register("classifier_profile_by_sample", lambda v: sample_profile(v)["ranks"],
         _rolled(["sample", "rank", "rank_taxid", *RANKS]), SAMPLED, recursive=True)
register("classifier_superkingdoms_by_sample", lambda v: sample_profile(v)["superkingdoms"], """
    select g.sample, s.taxid, s.superkingdom, cast(floor(coalesce(r.reads, 0) + 1e-9) as bigint) as reads
    from (values (cast(2 as bigint), 'Bacteria'), (2157, 'Archaea'), (2759, 'Eukaryota'), (10239, 'Viruses'))
      s(taxid, superkingdom) cross join (select distinct sample from {counts}) g
    left join (select sample, superkingdom_ti, sum(reads) as reads from {passed} join {lin} using (taxid) group by 1, 2) r
      on r.superkingdom_ti = s.taxid and r.sample = g.sample""", SAMPLED, recursive=True)


def taxon_matrix(v):
    ranks = sample_profile(v)["ranks"].withColumn("ord", F.col("rank_taxid"))
    return report_matrices({"ranks": ranks}, FIVE)["taxon-phylum"]


FIVE = [f"S{i}" for i in range(5)]
register("taxon_matrix", taxon_matrix, """
    select rank_taxid, nullif(any_value(superkingdom), '') as superkingdom, nullif(any_value(kingdom), '') as kingdom,
      nullif(any_value(phylum), '') as phylum, """ + ", ".join(
    f"round(coalesce(max(case when sample = '{s}' then abundance end), 0), 6) as \"{s}\"" for s in FIVE) + """
    from {rolled} where rank = 'phylum' and abundance >= 1e-4 group by rank_taxid""", SAMPLED, recursive=True)

# ---- binning -------------------------------------------------------------------------------------


def _bins(first_only: bool) -> dict[str, str]:
    only = "where flag & 64 <> 0" if first_only else ""
    return {
        **LINEAGE,
        "creads": f"select contig, read_id from {{contig_aln}} {only}",
        "total": "select contig, count(*) as n_reads from {creads} group by contig",
        "taxa": f"select read_id, taxid, count(*) over (partition by read_id) as n from "
                f"(select distinct read_id, taxid from {{contig_ref}} {only}) x qualify n <= 3",
        "support": """select contig, taxid, sum(cast(cast(c as double) / n as decimal(38,12))) as s from
            (select contig, taxid, n, count(*) as c from {creads} join {taxa} using (read_id) group by contig, taxid, n) x
            group by contig, taxid""",
        "best": "select * from {support} qualify row_number() over (partition by contig order by s desc, taxid) = 1",
    }


register("bin_contigs", lambda v: bn.bin_contigs(v.contig_aln, v.contig_ref, v.contig, max_taxa=3), """
    select c.contig, case when s / n_reads >= 0.5 then cast(taxid as varchar) else 'Unknown' end as taxid,
      round(case when s / n_reads >= 0.5 then cast(s as double) / n_reads else 1 end, 6) as p,
      coalesce(n_reads, 0) as n_reads, length
    from {contig} c left join {total} t on t.contig = c.contig left join {best} b on b.contig = c.contig""", _bins(True))

SPECIES_BINS = {
    **_bins(False),
    "per_t": "select contig, species_ti, species, taxid, toprank, s from {support} join {lin} using (taxid)",
    "per_s": """select contig, species_ti, sum(s) as sp from {per_t} group by contig, species_ti
        qualify row_number() over (partition by contig order by sum(s) desc, species_ti) = 1""",
    "pick": """select t.*, p.sp from {per_t} t join {per_s} p on p.contig = t.contig and p.species_ti = t.species_ti
        qualify row_number() over (partition by t.contig order by s desc, taxid) = 1""",
    "bad": f"select {200_000_000} + s_suppkey as taxid from {{supplier}} where s_nationkey >= 20 or s_suppkey = 2",
    "bins": """select c.contig, coalesce(sp / n_reads >= 0.5, false) as ok, taxid in (select taxid from {bad}) as bad,
          species_ti, species, taxid, toprank, cast(sp as double) / n_reads as share, coalesce(n_reads, 0) as n_reads, length
        from {contig} c left join {total} t on t.contig = c.contig left join {pick} b on b.contig = c.contig""",
    "named": """select contig,
          case when ok and bad then 'contaminant' when ok then cast(species_ti as varchar) else 'Unknown' end as species_taxid,
          case when ok and bad then 'sptid:' || cast(species_ti as varchar) when ok then species else 'Unknown' end as species,
          case when ok and bad then 'contaminant' when ok then cast(taxid as varchar) else 'Unknown' end as taxid,
          case when ok and bad then 'taxid:' || cast(taxid as varchar) when ok then toprank else 'Unknown' end as strain,
          round(case when ok then share else 1 end, 6) as p, n_reads, length from {bins}""",
}


def species_bins(v):
    bad = v.supplier.where("s_nationkey >= 20 or s_suppkey = 2").selectExpr("200000000 + s_suppkey as taxid")
    return bn.bin_contigs_species(v.by_read("contig_aln"), v.by_read("contig_ref"), v.contig, lin(v), bad, max_taxa=3)


register("bin_contigs_species", species_bins, "select * from {named}", SPECIES_BINS, recursive=True)


def host_bins(v):
    return v.stage("host_bins", lambda w: bn.bin_host(
        w.stage("species_bins", species_bins), w.by_read("contig_aln"), w.by_read("contig_ref").where("taxid = 200000001"),
        min_share=0.3))


HOST_BINS = {
    **SPECIES_BINS,
    "host": "select distinct read_id from {contig_ref} where taxid = 200000001 and score >= 75 and flag & 64 <> 0",
    "hshare": """select contig, count(*) as n, avg(case when read_id in (select read_id from {host}) then 1.0 else 0.0 end) as h
        from {contig_aln} where flag & 64 <> 0 group by contig""",
    "hbins": """select b.*, coalesce(b.taxid = 'Unknown' and s.h >= 0.3, false) as host, s.h, s.n
        from {named} b left join {hshare} s on s.contig = b.contig""",
    "housed": """select contig, """ + ", ".join(
        f"case when host then 'Host' else {c} end as {c}" for c in ("species_taxid", "species", "taxid", "strain"))
    + """, round(case when host then h else p end, 6) as p, case when host then n else n_reads end as n_reads, length
        from {hbins}""",
}
register("bin_host", host_bins, "select * from {housed}", HOST_BINS, recursive=True)
register("bin_contigs_paf", lambda v: bn.bin_contigs_paf(v.paf, v.contig, lin(v)), """
    select c.contig, case when ok then cast(species_ti as varchar) else 'Unknown' end as species_taxid,
      case when ok then species else 'Unknown' end as species, case when ok then cast(b.taxid as varchar) else 'Unknown' end as taxid,
      case when ok then toprank else 'Unknown' end as strain, round(case when ok then p else 1 end, 6) as p,
      coalesce(t, 0) as matched_bases, length
    from {contig} c left join (select contig, taxid, m / t as p, t, m / t >= 0.5 as ok from
        (select contig, taxid, sum(matches)::bigint as m, (sum(sum(matches)) over (partition by contig))::bigint as t from {paf}
         group by contig, taxid) x qualify row_number() over (partition by contig order by m desc, taxid) = 1) b
      on b.contig = c.contig left join {lin} l on l.taxid = b.taxid""", LINEAGE, recursive=True)


def taxon_report(v):
    """All taxonomic matrices of the report, each upstream table read once."""
    p = sample_profile(v)
    tables = {"ranks": p["ranks"].withColumn("ord", F.col("rank_taxid")),
              "superkingdoms": p["superkingdoms"].withColumn("ord", F.col("taxid"))}
    return report_table(tables, FIVE).select("matrix", F.array_join("ids", "|").alias("ids"), F.array_join("ann", "|").alias("ann"),
                                             *[F.col(s).alias(s) for s in FIVE])


_METRICS = [("taxon", "abundance", "1e-4"), ("taxon-depth", "depth", "1e-4"), ("taxon-reads", "reads", "1")]
register("report_taxa", taxon_report, f"""
    select matrix, ids, any_value(ann) as ann, {", ".join(f"coalesce(max(case when sample = '{s}' then round(value, 6) end), 0.0) as {s}" for s in FIVE)}
    from (
      {" union all ".join(f"""select '{name}-' || rank as matrix, cast(rank_taxid as varchar) as ids, sample, {value} as value,
        concat_ws('|', {", ".join(f"nullif(\"{r}\", '')" for r in RANKS)}) as ann from {{rolled}} where {value} >= {least}""" for name, value, least in _METRICS)}
      union all select 'taxon-superkingdom', cast(s.taxid as varchar), g.sample, floor(coalesce(r.reads, 0) + 1e-9), s.superkingdom
      from (values (cast(2 as bigint), 'Bacteria'), (2157, 'Archaea'), (2759, 'Eukaryota'), (10239, 'Viruses'))
        s(taxid, superkingdom) cross join (select distinct sample from {{counts}}) g
      left join (select sample, superkingdom_ti, sum(reads) as reads from {{passed}} join {{lin}} using (taxid) group by 1, 2) r
        on r.superkingdom_ti = s.taxid and r.sample = g.sample) x
    group by matrix, ids""", SAMPLED, recursive=True)
