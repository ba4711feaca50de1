"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from seqtally.llm.chat_format import MARK
from seqtally.llm.license_scan import BASE, LONG, LONG_VOTES, TEMPLATES

NEAR_DUPLICATES = """
with recursive v as (
  select vec_id, list_transform(embedding, lambda x: x::double) as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
u as (select vec_id, list_transform(e, lambda x: x / sqrt(list_inner_product(e, e))) as e from v),
links as (select a.vec_id as a, b.vec_id as b from u a join u b on a.vec_id <> b.vec_id
  where list_inner_product(a.e, b.e) >= 0.95),
reach(a, b) as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a)
select e.vec_id, (select count(*) from links where a = e.vec_id) as n_links,
  least(e.vec_id, coalesce((select min(b) from reach where a = e.vec_id), e.vec_id)) as component_id,
  e.vec_id = least(e.vec_id, coalesce((select min(b) from reach where a = e.vec_id), e.vec_id)) as kept
from embeddings e
"""

TOP_K = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint as score
  from v q join v c on c.vec_id <> q.vec_id where q.vec_id % 100 = 0)
select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank, vec_id, score
from scored qualify rank <= 10
"""

JACCARD = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct doc_id, array_to_string(w[i:i + 4], ' ') as s
  from w, unnest(range(1, greatest(len(w) - 3, 2))) t(i) where len(w) > 0),
n as (select doc_id, count(*) as n from s group by doc_id),
met as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.s = b.s and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id),
links as (select a, b from met join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)),
reach(a, b) as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a),
least_of as (select a, min(b) as m from reach group by a)
select d.doc_id, coalesce(n.n, 0) as n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) as component_id
from documents d left join n using (doc_id) left join least_of on a = d.doc_id
"""

REPEATS = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
n as (select *, length(h) // 2 as n from d),
w as (select doc_id, p, md5_number(substring(h, (2 * p + 1)::bigint, 400)) as k from n, unnest(range(n - 199)) t(p)),
twice as (select k from w group by k having count(*) > 1),
r as (select doc_id, p, p - coalesce(lag(p) over (partition by doc_id order by p), -1000) > 200 as new
  from w join twice using (k)),
i as (select doc_id, p, sum(new::int) over (partition by doc_id order by p) as run from r),
spans as (select doc_id, run, min(p) as b, max(p) + 200 as e from i group by doc_id, run),
gaps as (select doc_id, coalesce(lag(e) over (partition by doc_id order by b), 0) as b, b as e from spans
  union all select doc_id, max(e), null from spans group by doc_id),
kept as (select doc_id, string_agg(substring(h, (2 * b + 1)::bigint, (2 * (coalesce(e, n) - b))::bigint), '' order by b) as k
  from gaps join n using (doc_id) group by doc_id),
sizes as (select doc_id, sum(e - b) as removed, count(*) as n_spans from spans group by doc_id)
select doc_id, n as n_bytes, coalesce(removed, 0)::bigint as n_removed, coalesce(n_spans, 0) as n_spans,
  sha256(unhex(coalesce(k, h))) as kept_sha256
from n left join sizes using (doc_id) left join kept using (doc_id)
"""


def _templates() -> str:
    rows = []
    for number, (text, label) in enumerate([*BASE, *TEMPLATES]):
        words = text.split()
        rows += [f"({number}, '{label}', {number < len(BASE)}, {len(words) - 1}, {at}, '{w}', '{v}')"
                 for at, (w, v) in enumerate(zip(words, words[1:]))]
    return ", ".join(rows)


LICENSES = rf"""
with t(template, label, is_base, n_pairs, t_pos, w, v) as (values {_templates()}),
d as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as words from documents),
p as (select doc_id, i - 1 as pos, words[i] as w, words[i + 1] as v from d, unnest(range(1, len(words))) x(i)),
all_votes as (select doc_id, template, label, is_base, n_pairs, pos - t_pos as diagonal, pos, t_pos
  from p join t on p.w = t.w and p.v = t.v),
votes as (select * from all_votes
  qualify n_pairs < {LONG} or count(*) over (partition by doc_id, template, pos - t_pos) >= {LONG_VOTES}),
apart as (select *, diagonal - lag(diagonal) over (partition by doc_id, template order by diagonal) > 3 as new from votes),
runs as (select *, case when is_base then diagonal
  else sum(coalesce(new, false)::int) over (partition by doc_id, template order by diagonal) end as run from apart),
spans as (select doc_id, template, label, is_base, n_pairs, run, count(distinct t_pos) / n_pairs as shown, min(pos) as b,
  max(pos) + 2 as e
  from runs group by doc_id, template, label, is_base, n_pairs, run),
found as (select * from spans where shown >= case when is_base then 1.0 else 0.8 end and e - b <= 1.5 * (n_pairs + 1)),
out as (select doc_id, count(*) filter (is_base) as n_base, min(b) filter (is_base) as first_word,
  max(b) filter (is_base) as last_word,
  array_to_string(list_sort(list(distinct label) filter (is_base)), ',') as base_labels,
  array_to_string(list_sort(list(distinct label)), ',') as labels, max(shown) as score from found group by doc_id)
select doc_id, len(words) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0.0)::double as score
from d left join out using (doc_id)
"""

RANKED = r"""
with t as (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as t from documents),
q as (select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as t from benchmark),
n as (select doc_id, count(*) as n from t group by doc_id),
all_of as (select count(*)::bigint as docs, sum(n)::bigint as terms from n),
tf as (select doc_id, t, count(*) as tf from t where t in (select t from q) group by doc_id, t),
w as (select t, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w
  from tf cross join all_of group by t, docs),
i as (select tf.doc_id, t, w.w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * docs) // terms)))) as impact
  from tf join w using (t) join n on n.doc_id = tf.doc_id cross join all_of),
scored as (select item_id, doc_id, sum(impact)::bigint as score from q join i using (t) group by item_id, doc_id)
select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int as rank, doc_id, score
from scored where score > 0 qualify rank <= 20
"""

RUNS = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
  xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint)),
    lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)), lambda b, k: xor(b >> 1, (b & 1) * 3988292384)))) as h
  from documents),
g as (select *, h // 10 as g, len(w) as n from d),
a as (select *, case when n > 0 then g % n end as a from g),
p as (select *, 1 + (n - a) // (3 + g % 8) as p from a),
words as (select doc_id, i, case when h % 10 = 0 and i >= a then w[1 + a + (i - a) % p] else w[1 + i] end as w
  from p, unnest(range(n)) x(i)),
three as (select doc_id, i, w || ' ' || lead(w) over o || ' ' || lead(w, 2) over o as k from words
  window o as (partition by doc_id order by i)),
met as (select x.doc_id, y.i - x.i as p, x.i from three x join three y on x.doc_id = y.doc_id and x.k = y.k and y.i > x.i),
islands as (select doc_id, p, i, i - row_number() over (partition by doc_id, p order by i) as island from met),
found as (select doc_id, p, min(i) as b, max(i) + 3 + p as e from islands group by doc_id, p, island),
runs as (select doc_id, b, e - b as len, min(p) as p from found where e - b >= greatest(12, 2 * p) group by doc_id, b, e),
listed as (select doc_id, count(*) as n_runs, string_agg(concat(b, ',', len, ',', p, chr(10)), '' order by b, p) as listed,
  max(struct_pack(len := len, b := -b, p := -p)) as best from runs group by doc_id),
dropped as (select distinct doc_id, i from runs, unnest(range(b + p, b + len)) x(i)),
kept as (select doc_id, string_agg(w, ' ' order by i) as kept from words anti join dropped using (doc_id, i) group by doc_id)
select d.doc_id, coalesce(n_runs, 0) as n_runs, -best.b as start, best.len as length, -best.p as period,
  floor(1000 * best.len / -best.p)::bigint as exponent_milli, sha256(coalesce(listed, '')) as runs_sha256,
  sha256(coalesce(kept, '')) as collapsed_sha256
from d left join listed using (doc_id) left join kept using (doc_id)
"""

CHAT = rf"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, t, r, '</s>[INST] ok [/INST]' from (values (0, 'user'), (1, 'assistant')) x(t, r)),
f as (select *, length(regexp_replace(text, '(\\*)({MARK})', '\1\1\\\2', 'g')) + case role
  when 'user' then 15 when 'assistant' then 11 when 'system' then 13 else 17 + length(url_encode(role)) end as chars
  from c)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(chars)::bigint as formatted_chars
from f group by conv_id
"""

SQL = {
    "op1_cross_polytope_dedup": NEAR_DUPLICATES,
    "op3_block_pruned_top_k": TOP_K,
    "op5_voronoi_jaccard_join": JACCARD,
    "op6_suffix_array_dedup": REPEATS,
    "op8_license_scan": LICENSES,
    "op11_pair_bound_search": RANKED,
    "op12_periodic_runs": RUNS,
    "op13_chat_round_trip": CHAT,
}
