"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

OP12 = r"""
with d as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t from documents),
w as (
  select doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws,
    doc_id > min(doc_id) over (partition by t) as copied from d),
said as (
  select doc_id, max(coalesce(quality = 1, false)) as good, max(coalesce(toxic = 1, false)) as toxic
  from labels where doc_id is not null group by doc_id),
f as (
  select w.part, coalesce(said.good, false) as good, coalesce(said.toxic, false) as toxic,
    (case when len(ws) < 200 then 1 else 0 end)
    | (case when 100 * len(list_distinct(ws)) < 50 * len(ws) then 2 else 0 end)
    | (case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) then 4 else 0 end)
    | (case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end)
    | (case when coalesce(copied, false) then 16 else 0 end) as fails
  from w left join said on w.doc_id = said.doc_id),
c as (
  select part, fails, count(*) as n, count(*) filter (where good) as n_good, count(*) filter (where toxic) as n_toxic
  from f group by part, fails),
l as (select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) x(letter, bit)),
orders as (
  select a.letter || b.letter || c.letter || d.letter || e.letter as filter_order,
    [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
  from l a join l b on b.bit <> a.bit join l c on c.bit not in (a.bit, b.bit)
    join l d on d.bit not in (a.bit, b.bit, c.bit) join l e on e.bit not in (a.bit, b.bit, c.bit, d.bit)),
steps as (
  select filter_order, step, bits[step] as bit, coalesce(list_sum(bits[1:step - 1]), 0)::int as earlier
  from orders, (select unnest([1, 2, 3, 4, 5]) as step)),
counted as (
  select part, filter_order, step, bit,
    sum(case when fails & (earlier | bit) = 0 then n else 0 end)::bigint as kept,
    sum(case when fails & bit <> 0 and fails & earlier = 0 then n else 0 end)::bigint as removed,
    sum(case when fails & bit <> 0 and fails & earlier <> 0 then n else 0 end)::bigint as redundant,
    sum(case when fails = bit then n else 0 end)::bigint as unique_fails,
    sum(case when fails & bit <> 0 and fails & earlier = 0 then n_good else 0 end)::bigint as good_lost,
    sum(case when fails & bit <> 0 and fails & earlier = 0 then n_toxic else 0 end)::bigint as toxic_lost
  from c, steps group by part, filter_order, step, bit)
select part, filter_order, step::int as step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) over (partition by part, bit))::bigint as shapley
from counted
"""

# Base32 of the SHA-1: five hex digits (20 bits) give four letters.
OP6 = r"""
with p as (
  select page_id, strlen(coalesce(html, '')) as size, sha1(coalesce(html, '')) as sha from pages),
f as (
  select page_id, size, sha, min(page_id) over (partition by sha, size) as first, count(*) over (partition by sha, size) as n from p),
d as (
  select *, n > 1 and first is not null and page_id is distinct from first as revisit,
    list_transform(range(8), lambda i: ('0x' || substring(sha, (5 * i + 1)::int, 5))::int) as v from f)
select page_id, size::bigint as payload_bytes,
  array_to_string(list_transform(v, lambda x: list_aggregate(list_transform([15, 10, 5, 0],
    lambda b: substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> b) & 31) + 1, 1)), 'string_agg', '')), '') as payload_digest,
  case when revisit then 'revisit' else 'response' end as record_type, case when revisit then first end as refers_to
from d
"""

ORACLES: dict[str, str] = {"op6_warc": OP6, "op12_filter_audit": OP12}
