"""DuckDB SQL of the queries that SQL can express, written apart from the Spark code."""

from __future__ import annotations

from .license_scan import NOTICES

CURRICULUM_MIX = r"""
with d as (
  select doc_id, source, md5(coalesce(cast(doc_id as varchar), '')) as k,
    cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size
  from documents),
s as (
  select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source asc nulls last) - 1 as place
  from d group by source),
w as (select *, [3, 1, 2][1 + place % 3] as w, 2 * source_size as cap, sum(source_size) over () as total from s),
r as (
  select *, (3 * total - 2 * coalesce(sum(cap) over (o rows between unbounded preceding and 1 preceding), 0)) as rest,
    sum(w) over (o rows between current row and unbounded following) as w_rest
  from w window o as (order by cap * (6 // w), place)),
c as (select *, rest * w > 2 * cap * w_rest as capped from r),
f as (
  select *, sum(case when capped then cap else 0 end) over () as caps, sum(case when capped then 0 else w end) over () as ws
  from c),
t as (
  select source, place, source_size,
    case when capped or ws = 0 then cast(cap as double)
         else cast((3 * total - 2 * caps) * w as double) / cast(2 * ws as double) end as target from f),
b as (
  select d.doc_id, d.size, t.place, t.source_size, t.target, cast(floor(t.target) as bigint) as quota,
    cast(coalesce(sum(d.size) over (partition by d.source order by d.k, d.doc_id, d.size
      rows between unbounded preceding and 1 preceding), 0) as bigint) as c
  from d join t on d.source is not distinct from t.source),
e as (
  select *, greatest(0, least(size, quota - c)) + greatest(0, least(size, quota - c - source_size)) as taken from b),
p as (select *, cast(c as double) / cast(quota as double) as x from e)
select doc_id, size, source_size, target, cast(taken as bigint) as taken,
  case when taken > 0 then
    case place % 3 when 0 then (sqrt(2.25 + (0.25 - 2.25) * x) - 1.5) / -1.0
                   when 1 then (sqrt(0.25 + (2.25 - 0.25) * x) - 0.5) / 1.0
                   else x end end as position
from p
"""


EXACT_TOPK = r"""
with e as (
  select vec_id, [floor(64 * cast(x as double)) for x in embedding] as v from embeddings
  where vec_id is not null and len(embedding) > 0
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
d as (select vec_id, min(v) as v from e group by vec_id),
s as (
  select q.vec_id as query_id, d.vec_id, cast(list_inner_product(q.v, d.v) as bigint) as score
  from d q join d on q.vec_id <> d.vec_id and len(q.v) = len(d.v) where q.vec_id % 20 = 0),
r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s)
select query_id, rank, vec_id, score from r where rank <= 20
"""


WARC = r"""
with p as (select page_id, url, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages),
o as (select *, max(page_id) over (partition by h) as owner from p),
r as (select *, case when page_id is null or page_id < owner then owner end as refers_to from o)
select page_id, cast(strlen(html) as bigint) as payload_bytes, url, refers_to,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + cast((cast('0x' || substr(h, cast(1 + 5 * (i // 4) as int), 5) as bigint) >> cast(15 - 5 * (i % 4) as bigint)) & 31 as int), 1)
    for i in range(32)], '') as payload_digest,
  case when refers_to is null then 'response' else 'revisit' end as record_type
from r
"""


JACCARD_JOIN = r"""
with recursive d as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x20\x09-\x0D]+') as ws from documents),
s as materialized (
  select r, doc_id, list_distinct(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
    else [array_to_string(ws[i:i + 4], ' ') for i in range(1, len(ws) - 3)] end) as shingles from d),
u as materialized (select r, unnest(shingles) as x from s),
pairs as (select a.r as ra, b.r as rb, count(*) as o from u a join u b on a.x = b.x and a.r < b.r group by a.r, b.r),
links as materialized (
  select ra, rb from pairs join s a on a.r = ra join s b on b.r = rb
  where 100 * o >= 75 * (len(a.shingles) + len(b.shingles) - o)),
edges as materialized (select ra as a, rb as b from links union all select rb, ra from links),
reach(a, b) as (
  select r, r from s
  union
  select reach.a, edges.b from reach join edges on reach.b = edges.a)
select s.doc_id, cast(len(s.shingles) as bigint) as n_shingles, min(t.doc_id) as component_id
from s join reach on reach.a = s.r join s t on t.r = reach.b
group by s.r, s.doc_id, len(s.shingles)
"""

MINHASH_FOREST = r"""
with recursive d as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x20\x09-\x0D]+') as ws from documents),
s as materialized (
  select r, doc_id, list_distinct(case when len(ws) = 0 then [] when len(ws) < 3 then [array_to_string(ws, ' ')]
    else [array_to_string(ws[i:i + 2], ' ') for i in range(1, len(ws) - 1)] end) as shingles from d),
u as materialized (select r, unnest(shingles) as x from s),
pairs as (select a.r as ra, b.r as rb, count(*) as o from u a join u b on a.x = b.x and a.r < b.r group by a.r, b.r),
links as materialized (
  select ra, rb from pairs join s a on a.r = ra join s b on b.r = rb
  where 100 * o >= 85 * (len(a.shingles) + len(b.shingles) - o)),
edges as materialized (select ra as a, rb as b from links union all select rb, ra from links),
reach(a, b) as (
  select r, r from s
  union
  select reach.a, edges.b from reach join edges on reach.b = edges.a),
g as (
  select s.r, s.doc_id, len(s.shingles) as n, min(t.doc_id) as component_id
  from s join reach on reach.a = s.r join s t on t.r = reach.b group by s.r, s.doc_id, len(s.shingles))
select doc_id, cast(n as bigint) as n_shingles, component_id, doc_id is not distinct from component_id as kept from g
"""


HARD_NEGATIVES = r"""
with e as (
  select vec_id, [floor(256 * cast(x as double)) for x in embedding] as v,
    cast(case when vec_id % 7 = 0 then (label + 1) % 10 else label end as bigint) as label from embeddings
  where vec_id is not null and label is not null and len(embedding) > 0
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
d as (select vec_id, min({'v': v, 'label': label}) as r from e group by vec_id),
x as materialized (select vec_id, r.v as v, r.label as label from d),
s as materialized (
  select a.vec_id as a, b.vec_id as b, a.label = b.label as same, cast(list_inner_product(a.v, b.v) as bigint) as score
  from x a join x b on a.vec_id <> b.vec_id and len(a.v) = len(b.v) where a.vec_id % 50 = 0),
p as (
  select a, b, score, row_number() over (partition by a order by score desc, b) as place from s where same
  qualify place <= 5),
h as (
  select p.a as anchor_id, p.b as positive_id, s.b as negative_id, p.score as positive_score, s.score as negative_score,
    cast(p.place as integer) as positive_rank,
    cast(row_number() over (partition by p.a, p.place order by s.score desc, s.b) as integer) as rank
  from p join s on s.a = p.a and not s.same and 50 * p.score <= 100 * s.score and 100 * s.score <= 95 * p.score)
select * from h where rank <= 3
"""


LICENSE_SCAN = r"""
with notices as (
  select label, words as line, string_split(words, ' ') as listed, list_distinct(string_split(words, ' ')) as words, in_order,
    len(string_split(words, ' ')) as length, cast(ceil(len(list_distinct(string_split(words, ' '))) * part / whole) as int) as need
  from (values
{NOTICES}) as v(label, words, part, whole, in_order)),
d as (
  select row_number() over () as r, doc_id,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as low from documents),
w as materialized (select r, doc_id, low, regexp_extract_all(low, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from d),
p as (
  select r, doc_id, len(ws) as n_words,
    [i - 1 for i in range(1, len(ws)) if ws[i] = 'cc' and ws[i + 1] = 'by'] as cc,
    [i - 1 for i in range(1, len(ws) - 1) if ws[i] = 'general' and ws[i + 1] = 'public' and ws[i + 2] = 'license'] as gpl,
    [i - 1 for i in range(1, len(ws) - 1) if ws[i] = 'all' and ws[i + 1] = 'rights' and ws[i + 2] = 'reserved'] as res
  from w),
c as materialized (
  select r, ws, low, n.* from w join notices n on not in_order and len(list_intersect(ws, n.words)) >= need),
b as (
  select r, label, words, need, regexp_extract_all(block, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as held
  from (select r, label, words, need,
      unnest(string_split_regex(regexp_replace(low, '([.!?])[ \t]+', '\1' || chr(10), 'g'), '[\n\r]+')) as block from c)
  union all
  select r, label, words, need, ws[i:i + 2 * length - 1]
  from (select r, label, words, need, length, ws, unnest(range(1, len(ws) + 1, length)) as i from c)),
h as (
  select r, label, max(len(list_intersect(list_distinct(held), words)) / len(words)) as share from b
  where len(list_intersect(list_distinct(held), words)) >= need group by r, label
  union all
  select distinct r, label, 1.0::double
  from w join notices n on in_order and contains(' ' || array_to_string(ws, ' ') || ' ', ' ' || n.line || ' ')),
m as (select r, list(label) as own, max(share) as share from h group by r),
q as (
  select p.*, cc || gpl || res as places, coalesce(own, []) as own, share,
    case when len(cc) > 0 then ['cc-by'] else [] end || case when len(gpl) > 0 then ['gpl'] else [] end
      || case when len(res) > 0 then ['reserved'] else [] end as base
  from p left join m using (r))
select doc_id, cast(n_words as bigint) as n_words, cast(len(places) as bigint) as n_base,
  cast(list_min(places) as bigint) as first_word, cast(list_max(places) as bigint) as last_word,
  array_to_string(list_sort(base), ',') as base_labels, array_to_string(list_sort(list_distinct(base || own)), ',') as labels,
  case when len(places) > 0 then 1.0::double else coalesce(share, 0)::double end as score
from q
"""


def license_scan_sql() -> str:
    """The statement with the notices of the query as a table of values."""
    rows = [f"    ('{n.label}', '{n.text}', {n.share[0]}, {n.share[1]}, {str(n.in_order).lower()})" for n in NOTICES]
    return LICENSE_SCAN.replace("{NOTICES}", ",\n".join(rows))


def oracle_sql() -> dict[str, str]:
    return {
        "op1_jaccard_join": JACCARD_JOIN,
        "op2_warc": WARC,
        "op3_exact_topk": EXACT_TOPK,
        "op7_license_scan": license_scan_sql(),
        "op10_curriculum_mix": CURRICULUM_MIX,
        "op11_minhash_forest": MINHASH_FOREST,
        "op13_hard_negatives": HARD_NEGATIVES,
    }
