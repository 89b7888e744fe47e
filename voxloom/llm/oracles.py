"""DuckDB SQL for the queries that SQL can express."""

OP1 = r"""
with w as (
  select doc_id, row_number() over () rid,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws
  from documents),
b as (
  select item_id::varchar item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws
  from benchmark),
bl as (select item_id, ws, least(13, len(ws)) l from b where len(ws) > 0),
bi as (select item_id, ws, l, unnest(range(1, len(ws) - l + 2)) i from bl),
bw as (select distinct item_id, l, array_to_string(ws[i:i + l - 1], ' ') win from bi),
ls as (select distinct l from bw),
di as (select rid, ws, l, unnest(range(1, len(ws) - l + 2)) i from w, ls where len(ws) >= l),
dw as (select rid, l, i, array_to_string(ws[i:i + l - 1], ' ') win from di),
m as (select rid, item_id, dw.l, i from dw join bw on dw.l = bw.l and dw.win = bw.win),
p as (select rid, unnest(range(i, i + l)) pos from (select distinct rid, l, i from m)),
h as (select rid, count(distinct pos) n_hit from p group by rid),
t as (select rid, list_sort(list(distinct item_id) filter (item_id is not null)) items from m group by rid)
select doc_id, len(ws)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(len(items), 0)::bigint n_items,
       sha256(coalesce(array_to_string(items, ','), '')) items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(ws) contaminated
from w left join h using (rid) left join t using (rid)
"""

OP3 = r"""
with w as (
  select doc_id, row_number() over () rid,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws
  from documents),
p as (
  select rid, i, ws[i] a, case when i > 1 then ws[i - 1] end b, case when i > 2 then ws[i - 2] end c
  from (select rid, ws, unnest(range(1, len(ws) + 1)) i from w)),
n1 as (select a, count(*) n from p group by a),
n2 as (select b, a, count(*) n from p where b is not null group by b, a),
n3 as (select c, b, a, count(*) n from p where c is not null group by c, b, a),
t as (select count(*)::double n from p),
s as (
  select rid,
    case when p.c is not null and n3.n >= 1 then log10(n3.n::double / x2.n)
         else case when p.c is not null then log10(0.4::double) else 0 end
            + case when p.b is not null and n2.n >= 1 then log10(n2.n::double / x1.n)
                   else case when p.b is not null then log10(0.4::double) else 0 end + log10(n1.n::double / t.n) end end l
  from p join n1 on p.a = n1.a cross join t
  left join n2 on p.b = n2.b and p.a = n2.a
  left join n3 on p.c = n3.c and p.b = n3.b and p.a = n3.a
  left join n2 x2 on p.c = x2.b and p.b = x2.a
  left join n1 x1 on p.b = x1.a),
g as (select rid, round(sum(l), 4) l from s group by rid)
select doc_id, len(ws)::bigint n_words, coalesce(l, 0.0::double) log10_score from w left join g using (rid)
"""

OP9 = r"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint size,
         substr(md5(case when text is null and doc_id is null then 'mix'
                         when text is null then 'mix:' || doc_id
                         when doc_id is null then 'mix:' || md5(text)
                         else 'mix:' || doc_id || ':' || md5(text) end), 1, 16) k
  from documents),
s as (
  select source, sum(size)::bigint source_size,
         case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 3 when 1 then 1 else 2 end::double w
  from d group by source),
l as (
  select *, 2.0::double * source_size::double most, 2.0::double * source_size::double / w lev,
         1.5::double * (sum(source_size) over ())::double total, sum(w) over () ws
  from s),
f as (
  select *, coalesce(sum(most) over b, 0) mb, coalesce(sum(w) over b, 0) wb
  from l window b as (order by lev, source nulls last rows between unbounded preceding and 1 preceding)),
c as (select *, lev <= (total - mb) / (ws - wb) as is_full from f),
t as (
  select source, source_size,
         case when is_full then most
              else (total - sum(case when is_full then most else 0 end) over ())
                   / nullif(sum(case when is_full then 0 else w end) over (), 0) * w end target
  from c),
p as (
  select d.doc_id, d.size, t.source_size, t.target, floor(t.target + 0.5::double)::bigint lim,
         coalesce(sum(d.size) over (partition by d.source order by d.k, d.doc_id, d.size
                                    rows between unbounded preceding and 1 preceding), 0)::bigint pre
  from d join t on d.source is not distinct from t.source),
q as (select *, coalesce(lim // nullif(source_size, 0), 0)::bigint ep from p)
select doc_id, size, source_size, target,
       (ep * size + greatest(0, least(size, lim - ep * source_size - pre)))::bigint taken
from q
"""

OP6 = r"""
with u as (
  select page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') path
  from pages),
o as (
  select doc_id page_id, count(*) n, sum(case when quality = 0 or toxic = 1 then 1 else 0 end) bad
  from labels where doc_id is not null and (quality is not null or toxic is not null) group by doc_id),
h0 as (
  select host, coalesce(sum(n), 0)::double n, coalesce(sum(bad), 0)::double bad
  from u left join o using (page_id) group by host),
h1 as (
  select *, string_split(host, '.') parts, len(string_split(host, '.')) np from h0),
h2 as (
  select host, n, bad, array_to_string(parts[greatest(np - 1, 1):np], '.') two,
         array_to_string(parts[greatest(np - 2, 1):np], '.') three, parts[np] last from h1),
h as (
  select host, n, bad, case when long then three else two end dom, case when long then two else last end suf
  from (select *, regexp_full_match(two, '(ac|co|com|edu|go|gob|gov|ltd|mil|ne|net|nom|or|org|plc|sch)[.][a-z][a-z]') long from h2)),
d as (select dom, suf, sum(n) n, sum(bad) bad from h group by dom, suf),
s as (select suf, sum(n) n, sum(bad) bad from d group by suf),
r as (select (coalesce(sum(bad), 0) + 1.0::double) / (coalesce(sum(n), 0) + 2.0::double) m from s),
ks as (
  select 1 / greatest(0.002::double, least(0.5::double, coalesce(
    sum((bad - n * m) ** 2 - n * m * (1 - m)) / nullif(sum((n - 1) * n * m * (1 - m)), 0), 0.002::double))) - 1 k
  from s, r),
sp as (select suf, (bad + k * m) / (n + k) m from s, r, ks),
dm as (select d.*, sp.m from d join sp using (suf)),
kd as (
  select 1 / greatest(0.002::double, least(0.5::double, coalesce(
    sum((bad - n * m) ** 2 - n * m * (1 - m)) / nullif(sum((n - 1) * n * m * (1 - m)), 0), 0.002::double))) - 1 k
  from dm),
dp as (select dom, (bad + k * m) / (n + k) m from dm, kd),
hm as (select h.host, h.n, h.bad, dp.m from h join dp using (dom)),
kh as (
  select 1 / greatest(0.002::double, least(0.5::double, coalesce(
    sum((bad - n * m) ** 2 - n * m * (1 - m)) / nullif(sum((n - 1) * n * m * (1 - m)), 0), 0.002::double))) - 1 k
  from hm),
hp as (select host, (bad + k * m) / (n + k) mean, n + k + 1 sz from hm, kh),
v as (select host, case when mean - 1.645::double * sqrt(mean * (1 - mean) / sz) > 0.5::double then 'block' else 'allow' end v from hp),
j as (
  select page_id, host, path, v,
    case when (host = 'www.example.com' or ends_with(host, '.www.example.com')) and starts_with(path, '/en/') then 'www.example.com/en/'
         when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/en/') then 'example.com/en/'
         when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/fr/') then 'net/fr/'
         when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/es/') then 'net/es/'
         when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/') then 'com/' end rule
  from u join v using (host))
select page_id, host, path, rule,
       case when rule in ('com/', 'www.example.com/en/') then 'allow' when rule is not null then 'block' else v end verdict
from j
"""

ORACLE_SQL = {"op1_prefix_decontamination": OP1, "op3_stupid_backoff": OP3, "op6_host_reputation": OP6, "op9_source_mix": OP9}
