"""DuckDB SQL for the queries of ``workflows``: what must be there in the end, from the tables alone."""

from __future__ import annotations

from lemmaflow.functions import patterns as R
from lemmaflow.plans.oracle import _SECTIONS, _strip

_DOCS = "d as (select doc_id, coalesce(text, '') as t, lang from documents), l as (select doc_id, max(quality) as quality, max(toxic) as toxic from labels group by doc_id)"

_STORE = f"""with {_DOCS}
select d.doc_id, cast(case when toxic = 1 or quality = 0 then 0 when quality = 1 then -length(t) else length(t) end as bigint) as n_chars, case when l.doc_id is null then lang else '-' end as note
from d left join l using (doc_id)"""

_STREAM = f"""with {_DOCS},
c as (select doc_id, sha256(t) as digest, l.doc_id is null as newest from d left join l using (doc_id) union all select doc_id, sha256(t || '!'), true from d join l using (doc_id)),
e as (select *, substr(digest, 1, 1) in ('0', '1') as fails from c)
select doc_id, digest, cast(case when fails then 0 else 1 end as bigint) as n_converted, case when not newest then '-' when fails then 'blocked' else 'done' end as status from e"""


def _piece(a: str, b: str) -> str:
    begin = f"greatest(1, least(n_lines, coalesce({a}, 1)))"
    end = f"greatest({begin}, least(n_lines, coalesce({b}, 1)))"
    return _strip(f"array_to_string(ls[{begin}:{end}], chr(10))")


def _joined(*pieces: str) -> str:
    return f"coalesce(array_to_string(list_filter([{', '.join(pieces)}], lambda x: x <> ''), chr(10) || chr(10)), '')"


_MATTER = f"""with d as (select doc_id, string_split(coalesce(text, ''), chr(10)) as raw from documents),
s as (select doc_id, case when raw[-1] = '' then raw[:-2] else raw end as ls from d), n as (select *, len(ls) as n_lines, doc_id % 6 as first from s),
m as (select doc_id, ls, first,
  case when n_lines > 0 and doc_id % 3 > 0 then {_joined(_piece("doc_id % 7 - 2", "doc_id % 11"), _piece("3", "1"), _piece("doc_id % 5", "doc_id % 9"))} else '' end as front,
  case when n_lines > 0 and doc_id % 4 > 0 then {_joined(_piece("doc_id % 40", "doc_id % 50 + 5"), _piece("1000000", "2"), _piece("null", "doc_id % 3"))} else '' end as back from n)
select doc_id, sha256(case when front = '' and first > 1 then {_strip("array_to_string(ls[1:first - 1], chr(10))")} else front end) as front_sha256, sha256(back) as back_sha256 from m"""

_FAULTS = """with f as (select * from (values
  (1, '$', 'not JSON', true), (2, '$', 'is array', true), (3, '$.sections', 'missing', true), (4, '$.sections[0]', 'is bigint', true), (4, '$.sections[1].start_line', 'is string', true), (4, '$.sections[1].end_line', 'missing', true),
  (5, '$.sections[0].section_title', 'is bigint', false), (5, '$.chapter_number', 'is bigint', false), (5, '$.back_matter_ranges[0].start_line', 'is decimal', false), (5, '$.back_matter_ranges[1]', 'is bigint', false), (6, '$.sections', 'is object', true)
) as f(k, path, fault, fatal))
select doc_id, path, fault, fatal from documents join f on doc_id % 7 = k"""

_PLANS = """select doc_id, cast(0 as bigint) as position, case when doc_id % 7 = 0 then 1 else doc_id end as start_line, case when doc_id % 7 = 0 then doc_id else 2 end as end_line,
  case when doc_id % 7 = 0 then '1' else '(none)' end as section_number, case when doc_id % 7 = 0 then 'T' else '7' end as section_title, case when doc_id % 7 = 0 then 'C' else '(none)' end as chapter, '' as chapter_number, coalesce(lang, '(none)') as fallback_chapter
from documents where doc_id % 7 in (0, 5)"""

# the scripted client's turns: built at once; listed, searched, built; listed, thought twice, built; listed, thought, never built
_LOOP = f"""with d as (select doc_id, coalesce(text, '') as t, doc_id % 4 as k from documents),
e as (select *, string_split(t, chr(10))[1] as line, substr(t, 5, 2) as q from d),
f as (select *, {_strip("line")} as content, case when k = 0 then 1 when k = 1 then 3 else 4 end as n_turns, k < 3 as built from e)
select doc_id, cast(n_turns as bigint) as n_turns, cast(case k when 0 then 1 when 1 then 3 when 2 then 2 else 1 end as bigint) as n_calls,
  cast(case when k = 1 and q <> '' then least(2, len(string_split(t, q)) - 1) else 0 end as bigint) as n_matches, cast(10 * n_turns as bigint) as input_tokens,
  cast(case when built then 1 else 0 end as bigint) as n_items, case when built then sha256(content) else '-' end as content_sha256, case when built then '-' else '{R.TOOL_NO_RESULT}' end as error,
  sha256(case when built then 'kept' || chr(10) || chr(10) || 'Source-span validation warnings:' || chr(10) || '- no content span: ' || '{R.SPAN_START_MISSING.replace("'", "''")}' || chr(1) || ' nowhere''' else '-' end) as audit_sha256
from f"""

_REUSED = f"""with {_DOCS},
c as (select d.doc_id, case when quality = 0 then coalesce(b.t, '') when quality = 1 then d.t || '!' else d.t end as t from d left join l using (doc_id) left join d b on b.doc_id = d.doc_id - 1)
select doc_id, t in (select t from d) as reused, cast(length(t) as bigint) as input_tokens, sha256('[{{"label": "L", "env": "thm", "content": ' || to_json(substr(t, 1, 20)) || '}}]') as response_sha256 from c"""

_WARNED = f"""with p as (select l_orderkey as doc_id, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey) as position, l_partkey % 60 as s0, greatest(1, least(50, l_partkey % 60)) as s, l_partkey % 60 + l_suppkey % 25 - 9 as e0 from lineitem where l_orderkey % 7 > 0),
q as (select *, greatest(s, least(50, e0)) as e, row_number() over (partition by doc_id order by s0, position, e0) as i from p),
r as (select *, least(50, i + max(e - i) over (partition by doc_id order by i rows unbounded preceding)) as new_end from q),
x as (select *, coalesce(lag(new_end) over (partition by doc_id order by i), 0) as before from r),
o as (select distinct l_orderkey as doc_id from lineitem),
w as (
  select doc_id, 0 as k, 0 as place, 'told' as warning from o where doc_id % 5 = 0 and doc_id % 7 > 0
  union all select distinct doc_id, 1, 0, '{R.WARN_PLAN_ORDER}' from (select doc_id, s0, max(s0) over (partition by doc_id order by position rows between unbounded preceding and 1 preceding) as m from p) where s0 < m
  union all select doc_id, 2, i * 2, printf('{R.WARN_PLAN_MOVED}', i) from x where s <= before
  union all select doc_id, 2, i * 2 + 1, printf('{R.WARN_PLAN_END}', i) from x where e < case when s <= before then least(before + 1, 50) else s end
  union all select doc_id, 0, 0, 'hard' from o where doc_id % 7 = 0 and doc_id % 2 = 0 union all select doc_id, 1, 0, '{R.WARN_PLAN_EMPTY}' from o where doc_id % 7 = 0
)
select doc_id, row_number() over (partition by doc_id order by k, place) - 1 as position, warning from w"""

_JOBS = """with recursive e as (
  select user_id as id, event_id as seq, ts, ['create', 'status', 'status', 'status', 'complete', 'resume', 'delete', 'progress', 'access'][event_id % 9 + 1] as kind,
    case when event_id % 5 < 3 then 'running' when event_id % 5 = 3 then 'failed' else 'queued' end as wanted from events
), m as (select *, row_number() over (partition by id order by seq) as rn from e where kind not in ('progress', 'access')),
s(id, rn, status, born) as (
  select distinct id, cast(0 as bigint), 'none', cast(-1 as bigint) from e
  union all select id, rn, coalesce(new, status), case when new is not null and kind = 'create' then seq else born end from (
    select s.id, m.rn, s.status, s.born, m.kind, m.seq, case when kind = 'create' and status = 'none' then 'queued' when kind = 'delete' and status <> 'none' then 'none' when kind = 'complete' and status = 'running' then 'succeeded'
      when kind = 'resume' and status = 'failed' then 'queued' when kind = 'status' and wanted = 'running' and status = 'queued' then 'running' when kind = 'status' and wanted = 'failed' and status in ('queued', 'running') then 'failed'
      when kind = 'status' and wanted = 'queued' and status in ('running', 'queued') then 'queued' end as new
    from s join m on m.id = s.id and m.rn = s.rn + 1)
), last as (select id, arg_max(status, rn) as status, arg_max(born, rn) as born from s group by id),
p as (select l.id, max(e.seq) as seq from last l join e on e.id = l.id and e.kind = 'progress' and e.seq > l.born group by l.id)
select l.id, status, epoch_us(b.ts) // 1000000 as created_at, cast(coalesce(p.seq % 1000 * 2, -1) as bigint) as sections_total, cast(coalesce(p.seq % 1000, 0) as bigint) as sections_completed
from last l join e b on b.id = l.id and b.seq = l.born left join p on p.id = l.id where status <> 'none'"""

_PAGES = """with recursive f as (select doc_id // 16 as doc_id, list(octet_length(encode(coalesce(text, ''))) order by doc_id) as sizes from documents group by 1),
r(doc_id, sizes, a, b) as (
  select doc_id, sizes, a, least(a + 6, len(sizes)) from (select doc_id, sizes, unnest(range(0, len(sizes), 6)) as a from f)
  union all select doc_id, sizes, unnest([a, a + (b - a) // 2]), unnest([a + (b - a) // 2, b]) from r where b - a > 1 and 100 + list_sum(sizes[a + 1:b]) > 8000
), x as (select doc_id, a, b, cast(100 + list_sum(sizes[a + 1:b]) as bigint) as bytes from r)
select doc_id, row_number() over (partition by doc_id order by a) as chunk, a as start_page, b as end_page, bytes, bytes > 8000 as too_large from x where bytes <= 8000 or b - a = 1"""

_COLLECTION = """with j as (
  select case when o_orderkey % 2 = 0 then 'markdown' else 'full' end as kind, cast(o_orderkey as varchar) as id, case when o_orderstatus = 'F' then 'succeeded' when o_orderkey % 3 = 0 then 'failed' else 'running' end as status,
    timestamp '1997-01-01 00:00:00' - cast(o_orderdate as timestamp) as age, o_orderkey in (select doc_id from labels) as saved, o_orderkey % 10 = 0 as debug from orders
)
select kind, id, '/jobs/' || id as path, status || case when saved then ' with annotation, older than 180 days' when status = 'failed' then ', older than 7 days' else ', older than 14 days' end as reason from j
where status <> 'running' and age >= to_days(case when saved then 180 when status = 'failed' then 7 else 14 end)
union all select 'debug', '/debug/' || id, '/debug/' || id, 'older than 1 days' from j where debug and age >= to_days(1)"""

ORACLES = {
    "conversion_progress": f"with {_SECTIONS}, n as (select count(distinct doc_id) as documents, count(*) as sections from sections) select phase, documents, sections from n, (values ('committed'), ('completed'), ('stored')) p(phase)",
    "job_log_states": _JOBS, "page_ranges": _PAGES, "collection_plan": _COLLECTION,
    "store_snapshot": _STORE, "folder_stream": _STREAM, "plan_matter": _MATTER, "planner_faults": _FAULTS, "planner_plans": _PLANS, "tool_loop_sections": _LOOP, "answers_reused": _REUSED, "plan_warnings": _WARNED,
}
