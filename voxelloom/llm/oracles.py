"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DEDUP = rf"""
with recursive d as (select row_number() over () as rid, doc_id, regexp_extract_all({_FOLDED}, '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct rid, array_to_string(w[i : i + 4], ' ') as sh from (select rid, w, unnest(range(1, greatest(2, len(w) - 3))) as i from d where len(w) > 0)),
n as (select rid, count(*) as n, md5(string_agg(sh, chr(10) order by sh)) as k from s group by rid),
l as (select a.rid as a, b.rid as b from s a join s b on a.sh = b.sh and a.rid <> b.rid join n x on x.rid = a.rid join n y on y.rid = b.rid group by a.rid, b.rid, x.n, y.n having 100 * count(*) >= 85 * (x.n + y.n - count(*))),
r(a, b) as (select rid, rid from n union select r.a, l.b from r join l on l.a = r.b),
c as (select r.a as rid, min(d.doc_id) as component_id from r join d on d.rid = r.b group by r.a),
z as (select k, count(*) as class_size from n group by k)
select d.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, coalesce(c.component_id, d.doc_id) as component_id, d.doc_id = coalesce(c.component_id, d.doc_id) as kept, cast(coalesce(z.class_size, 1) as bigint) as class_size
from d left join n using (rid) left join c using (rid) left join z using (k)
"""

DECONTAMINATE = rf"""
with d as (select row_number() over () as rid, doc_id, regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select row_number() over () as bid, item_id, regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
q as (select item_id, bid, i as o, least(10, len(w)) as n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') as g from (select item_id, bid, w, unnest(range(1, greatest(2, len(w) - 8))) as i from b where len(w) > 0)),
p as (select rid, n, i, array_to_string(w[i : i + n - 1], ' ') as g from (select rid, w, n, unnest(range(1, len(w) - n + 2)) as i from d, (select distinct n from q) where len(w) >= n)),
h as (select p.rid, p.i, p.n, q.item_id, q.bid, q.o from p join q on p.n = q.n and p.g = q.g),
c as (select rid, count(distinct j) as n_hit from (select rid, unnest(range(i, i + n)) as j from h) group by rid),
m as (select rid, count(distinct item_id) as n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids from h group by rid),
g as (select rid, max(e) as longest from (select rid, max(i + n) - min(i) as e from (select rid, i, n, bid, o, i - row_number() over (partition by rid, bid, i - o order by i) as run from h) group by rid, bid, i - o, run) group by rid)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(c.n_hit, 0) as bigint) as n_hit, cast(coalesce(m.n_items, 0) as bigint) as n_items, sha256(coalesce(m.ids, '')) as items_sha256, coalesce(c.n_hit, 0) > 0 as contaminated, cast(coalesce(g.longest, 0) as bigint) as longest_match
from d left join c using (rid) left join m using (rid) left join g using (rid)
"""

QUALITY_RULES = r"""
with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as ls from documents),
r as (select rid, i, count(*) over (partition by rid, g) as k from (select rid, i, array_to_string(w[i : i + 2], ' ') as g from (select rid, w, unnest(range(1, len(w) - 1)) as i from d where len(w) >= 3))),
c as (select rid, count(distinct j) as n_repeat from (select rid, unnest(range(i, i + 3)) as j from r where k > 1) group by rid),
f as (select d.*, len(w) as n, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) as wc, length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) as sy, len(ls) - len(list_distinct(ls)) as dup, coalesce(n_repeat, 0) as rep from d left join c using (rid)),
v as (select *, n < 50 or 100 * rep > 50 * n as failed from f)
select doc_id, cast(n as bigint) as n_words, cast(wc as bigint) as word_chars, cast(sy as bigint) as n_symbols, cast(dup as bigint) as n_dup_lines, cast(rep as bigint) as n_repeat_words, failed as base_failed,
not failed and not (100 * sy > 10 * wc or (dup >= 3 and 100 * dup > 30 * len(ls)) or wc < 2 * n or wc > 15 * n or 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 50 * wc
  or 100 * length(regexp_replace(text, '[^\pL]+', '', 'g')) < 50 * wc or 100 * length(regexp_replace(text, '[^0-9]+', '', 'g')) > 30 * wc) as kept
from v
"""
