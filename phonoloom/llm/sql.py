"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

P6_FOUND = """
with lim as (select cast(round(max_size * 1000) as bigint) lim from size_limits where item = 'segment'),
seg as (
  select distinct seg_id, sid, try_cast(round(start_s * 1000) as bigint) s, try_cast(round(end_s * 1000) as bigint) e
  from segments where seg_id is not null and start_s is not null and end_s is not null and not isnan(start_s) and not isnan(end_s)),
big as (select seg.* from seg, lim where e - s > lim),
br as (select distinct sid, try_cast(round(lo * 1000) as bigint) lo, try_cast(round(hi * 1000) as bigint) hi from breaks where lo is not null and hi is not null and hi >= lo),
ins as (select b.seg_id, lo, hi from big b join br on br.sid = b.sid and lo >= s and hi <= e),
pts as (select seg_id, s lo, s hi from big union all select seg_id, e, e from big union all select * from ins),
gap as (select seg_id, lo - max(hi) over (partition by seg_id order by lo, hi rows between unbounded preceding and 1 preceding) d from pts)
select seg_id, cast(max(case when d > lim then 1 else 0 end) as int) as forced_cut from gap, lim group by seg_id
"""

# what the pieces of each long segment must come to
P6_CHECKED = P6_FOUND.replace("select seg_id, cast(max(case when d > lim then 1 else 0 end) as int) as forced_cut from gap, lim group by seg_id", """,
f as (select seg_id, cast(max(case when d > lim then 1 else 0 end) as int) as forced_cut from gap, lim group by seg_id)
select seg_id, s as start_ms, e as end_ms, cast(1 as int) as within_limit, cast(1 as int) as overlaps, cast(1 as int) as "natural", forced_cut from big join f using (seg_id)""")

# windows of 8 words or 20 characters as strings, marked where the same string began before in the text
P2_FOUND = """
with t as (
  select 'segments' as tbl, cast(seg_id as varchar) as row_key, any_value(text) as text from segments where text is not null group by seg_id
  union all select 'seg_texts', cast(fact_id as varchar), any_value(text) from seg_texts where text is not null group by fact_id
  union all select 'documents', cast(doc_id as varchar), any_value(text) from documents where text is not null group by doc_id),
k as (select tbl, row_key, lower(text) as l from t),
c as (select *, length(regexp_replace(l, '[^\u0e00-\u0e7f\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff]', '', 'g')) * 2 > length(replace(l, ' ', '')) as by_char from k),
w as (select tbl, row_key, by_char, case when by_char then regexp_extract_all(l, '[\\p{L}\\p{N}]') else regexp_extract_all(l, '[\\p{L}\\p{N}][\\p{L}\\p{N}\\p{M}]*') end as us from c),
x as (select tbl, row_key, by_char, len(us) as m, unnest(us) as x, generate_subscripts(us, 1) as i from w),
g as (
  select *, string_agg(x, '|') over (partition by tbl, row_key order by i rows between current row and 7 following) as gram, 8 as n from x where not by_char
  union all select *, string_agg(x, '|') over (partition by tbl, row_key order by i rows between current row and 19 following), 20 from x where by_char),
a as (select *, case when i <= m - n + 1 and row_number() over (partition by tbl, row_key, gram, i <= m - n + 1 order by i) > 1 then 1 else 0 end as again from g),
v as (select *, case when by_char then max(again) over (partition by tbl, row_key order by i rows between 19 preceding and current row) else max(again) over (partition by tbl, row_key order by i rows between 7 preceding and current row) end as hit from a)
select tbl, row_key from v group by tbl, row_key having sum(hit * length(x)) >= sum(length(x)) / 3.0 - 1e-9
"""

# full reach from every record over shared ties, for the small tables of the comparison
P4_FOUND = """
with recursive ids as (select distinct id from dialogue_records where id is not null),
vo as (select id, unnest(map_values(speakers)).speaker as n from dialogue_records where id is not null),
sq as (select id, 'v' as k, lower(regexp_replace(n, '[^\\p{L}\\p{M}\\p{N}]', '', 'g')) as n from vo
  union all select sid, 'a', lower(regexp_replace(author, '[^\\p{L}\\p{M}\\p{N}]', '', 'g')) from recordings),
nm as (select sid as id, 'p' as k, trim(regexp_replace(regexp_replace(lower(replace(replace(speaker, '_', ' '), chr(160), ' ')), '\\s*(\\(.*\\)|\\[.*\\]|- [a-z]+|:)\\s*$', ''), '\\s+', ' ', 'g')) as n from segments),
tie as (select distinct id, k, n from sq where n not in ('', 'na', 'unknown', 'anonymous') and not (k = 'v' and regexp_full_match(n, 'speaker[0-9]+'))
  union select distinct id, k, n from nm where regexp_full_match(n, '[a-z]+ [a-z]+')),
own as (select tie.* from tie join ids using (id)),
hd as (select k, n, min(id) as h from own group by k, n),
ed as (select distinct own.id as u, hd.h as v from own join hd on hd.k = own.k and hd.n = own.n where own.id <> hd.h),
bo as (select u, v from ed union select v, u from ed),
reach as (select id as a, id as b from ids union select reach.a, bo.v from reach join bo on bo.u = reach.b),
gr as (select a as id, min(b) as group_id from reach group by a)
select group_id, id from gr where id <> group_id
"""


P4_CHECKED = P4_FOUND.replace("select group_id, id from gr where id <> group_id", "select id, group_id, cast(1 as int) as together from gr")
P7_CHECKED = 'select doc_id, cast(1 as int) as "within", cast(1 as int) as complete from documents where text is not null'
P8_CHECKED = "select distinct source, cast(1 as int) as within_repeats, cast(1 as int) as within_budget, cast(1 as int) as met from mix_targets where source is not null"
P9_CHECKED = """select doc_id, cast(1 as int) as "within", cast(1 as int) as trimmed, cast(1 as int) as covered from documents
where regexp_matches(regexp_replace(text, '\\[S\\d{1,4}\\]', '', 'g'), '[^\\s\\p{Z}]')"""


# TESTDATA keeps these cases far from the limit for any common tokenizer, so bytes stand for tokens (about 3.4 to one)
P7_FOUND = "select doc_id from documents, size_limits where item = 'container' and strlen(text) / 3.4 > max_size"
P8_FOUND = """
with t as (select sum(strlen(text)) as total from documents), s as (select source, sum(strlen(text)) as size from documents group by source)
select m.source from mix_targets m cross join t left join s on s.source = m.source where coalesce(s.size, 0) * m.max_repeats < m.target_share * t.total
"""
P2_EXACT = P2_FOUND.replace("select tbl, row_key from v group by tbl, row_key having sum(hit * length(x)) >= sum(length(x)) / 3.0 - 1e-9", """,
h as (select tbl, row_key, round(sum(hit * length(x)) / sum(length(x)), 6) as share from v group by tbl, row_key)
select t.tbl, t.row_key, coalesce(share, 0.0) as share from t left join h on h.tbl = t.tbl and h.row_key = t.row_key""")


def oracle_sql() -> dict[str, str]:
    return {"p2_found": P2_FOUND, "p2_exact": P2_EXACT, "p7_found": P7_FOUND, "p8_found": P8_FOUND, "p4_found": P4_FOUND, "p4_checked": P4_CHECKED, "p7_checked": P7_CHECKED, "p8_checked": P8_CHECKED, "p9_checked": P9_CHECKED, "p6_found": P6_FOUND, "p6_checked": P6_CHECKED}
