"""The same results as SQL over the registered tables, where SQL can express them."""

from __future__ import annotations

OP7 = r"""
with docs as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         coalesce('s' || source, 'n') as key
  from documents),
sums as (select key, any_value(source) as source, sum(size)::bigint as source_size from docs group by key),
weighted as (
  select *, case (row_number() over (order by source is null, encode(source)) - 1) % 3 when 0 then 3 when 1 then 1 else 2 end as weight
  from sums),
tried as (
  select *,
         (3 * sum(source_size) over () - 2 * coalesce(sum(2 * source_size) over (rising rows between unbounded preceding and 1 preceding), 0))::double
         / (2 * sum(weight) over (rising rows between current row and unbounded following))::double as level
  from weighted window rising as (order by (2 * source_size)::double / weight, source is null, encode(source))),
targets as (
  select key, source_size, least((2 * source_size)::double, weight * max(case when level * weight <= 2 * source_size then level end) over ()) as target
  from tried),
placed as (
  select d.doc_id, d.size, d.key,
         (d.size >> greatest(0, length(bin(d.size)) - 11)) << greatest(0, length(bin(d.size)) - 11) as class,
         ('0x' || substr(md5(coalesce(d.doc_id::varchar, '')), 1, 8))::bigint % (1 + (select count(*) from docs) // 65536) as chunk
  from docs d),
ranked as (
  select *, row_number() over (partition by key order by class, chunk, size, doc_id) as place from placed),
expected as (
  select r.*, t.source_size, t.target,
         case when t.source_size > 0 then t.target / t.source_size::double else 0.0::double end as e,
         ('0x' || substr(md5('mix' || r.key), 1, 8))::bigint::double / 4294967296.0::double as o
  from ranked r join targets t using (key))
select doc_id, size, source_size, target,
       least(floor(o + e * place) - floor(o + e * (place - 1)), 2)::bigint * size as taken
from expected
"""

OP9 = """
with usable as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
parts as (select vec_id, generate_subscripts(v, 1) as d, unnest(v) as x from usable),
scores as (
  select q.vec_id as query_id, c.vec_id, sum(q.x * c.x)::bigint as score
  from parts q join parts c using (d)
  where q.vec_id % 100 = 0 and q.vec_id <> c.vec_id
  group by 1, 2),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scores)
select query_id, rank::integer as rank, vec_id, score from ranked where rank <= 10
"""

OP10 = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
shingles as (
  select distinct doc_id, array_to_string(w[k : k + 3], ' ') as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) as k from words where len(w) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
pairs as (
  select a.doc_id as a, b.doc_id as b, count(*) as common
  from shingles a join shingles b using (s) where a.doc_id < b.doc_id group by 1, 2),
links as (
  select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * common >= 85 * (x.n + y.n - common)),
edges as (select a, b from links union all select b, a from links),
reach(doc_id, other) as (
  select doc_id, doc_id from documents union select r.doc_id, e.b from reach r join edges e on e.a = r.other)
select d.doc_id, coalesce(s.n, 0)::bigint as n_shingles, c.component_id
from documents d
left join sizes s using (doc_id)
join (select doc_id, min(other) as component_id from reach group by doc_id) c using (doc_id)
"""

OP12 = r"""
with words as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents),
fails as (
  select doc_id, part, len(w) < 100 as a, 100 * len(list_distinct(w)) < 80 * len(w) as b,
         100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) as c,
         regexp_matches(t, '[#$%&*|]') as d,
         coalesce(doc_id, -9223372036854775808) > min(coalesce(doc_id, -9223372036854775808)) over (partition by t) as e
  from words),
known as (select doc_id, max((quality = 1)::integer) as good, max((toxic = 1)::integer) as toxic from labels group by doc_id),
patterns as (
  select part, a, b, c, d, e, count(*) as n, coalesce(sum(good), 0) as good, coalesce(sum(toxic), 0) as toxic
  from fails left join known using (doc_id) group by all),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as l),
orders as (
  select v.l || w.l || x.l || y.l || z.l as filter_order
  from letters v, letters w, letters x, letters y, letters z
  where len(list_distinct([v.l, w.l, x.l, y.l, z.l])) = 5),
steps as (
  select p.*, o.filter_order, s.step, substr(o.filter_order, s.step, 1) as filter,
         least(case when a then instr(o.filter_order, 'A') else 6 end, case when b then instr(o.filter_order, 'B') else 6 end,
               case when c then instr(o.filter_order, 'C') else 6 end, case when d then instr(o.filter_order, 'D') else 6 end,
               case when e then instr(o.filter_order, 'E') else 6 end) as first,
         a::integer + b::integer + c::integer + d::integer + e::integer as failed
  from patterns p, orders o, (select unnest(range(1, 6)) as step) s),
judged as (
  select *, case filter when 'A' then a when 'B' then b when 'C' then c when 'D' then d else e end as fails_here from steps),
sums as (
  select part, filter_order, step, filter,
         coalesce(sum(n) filter (first > step), 0)::bigint as kept,
         coalesce(sum(n) filter (first = step), 0)::bigint as removed,
         coalesce(sum(n) filter (fails_here and first < step), 0)::bigint as redundant,
         coalesce(sum(n) filter (fails_here and failed = 1), 0)::bigint as unique_fails,
         coalesce(sum(good) filter (first = step), 0)::bigint as good_lost,
         coalesce(sum(toxic) filter (first = step), 0)::bigint as toxic_lost
  from judged group by all)
select part, filter_order, step::integer as step, filter, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) over (partition by part, filter))::bigint as shapley
from sums
"""

SQL = {"op7_mixing": OP7, "op9_search": OP9, "op10_jaccard": OP10, "op12_filter_audit": OP12}
