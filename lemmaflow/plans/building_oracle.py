"""DuckDB SQL for the queries of ``building`` and for others that once had none, computed from the rows that their inputs derive from."""

from __future__ import annotations

from lemmaflow.functions import patterns as R
from lemmaflow.functions import profiles as P
from lemmaflow.plans.oracle import _CHAPTER_REST, _KIND, _LETTER_REST, _LINES, _NORMAL, _SECTIONS, _WARNINGS, _X, _clean, _is, _part, _re, _strip

_TEXT = "coalesce(text, '')"
_RAW = _strip(_part("s", R.HEADING, 2))
_PARSED = f"""parsed as (
  select *, {_KIND} as kind from (
    select *, case when level > 0 then {_clean(_RAW)} else {_clean("s")} end as title, case when level > 0 then {_RAW} else s end as words
    from (select doc_id, line_no, {_X} as s, length({_part(_X, R.HEADING, 1)}) as level from lines))
)"""
_REST = _clean(_strip(_part("s", R.BARE_NUMBERED, 2)))
_BARE = f"""(level = 0 and {_is("s", R.BARE_NUMBERED)} and not {_is("s", R.ITEM_HEADING)} and kind is not null and {_REST} <> '' and length({_REST}) <= 110 and not regexp_matches({_REST}, '[.。;；,，]$')
  and (contains({_part("s", R.BARE_NUMBERED, 1)}, '.') or not {_is(_REST, R.MATHY)}) and not (length({_REST}) > 55 and regexp_matches({_REST}, '[，,;；:：。.!?？]')))"""
_MARK = f"""case kind when 'appendix' then {_part("title", R.APPENDIX_SECTION, 1)} when 'numeric' then {_part("title", R.NUMERIC_SECTION, 1)} else {_part("title", R.LETTER_SECTION, 1)} end"""
_OWN_APPENDIX = _strip(_part("title", R.APPENDIX_SECTION, 2))
_NAME = f"""case kind when 'appendix' then case when {_OWN_APPENDIX} <> '' then {_OWN_APPENDIX} else 'Appendix ' || {_part("title", R.APPENDIX_SECTION, 1)} end when 'numeric' then {_strip(_part("title", R.NUMERIC_SECTION, 2))} else {_LETTER_REST} end"""

_PLAN = f"""{_SECTIONS}, {_PARSED}, firsts as (
  select doc_id, arg_min(chapter, section_index) as hard_chapter, arg_min(chapter_number, section_index) as hard_number from sections group by doc_id
), named as (
  select p.*, {_is("title", R.CHAPTER)} as is_chapter, {_part("title", R.CHAPTER, 1)} as own_number, 'Chapter ' || {_part("title", R.CHAPTER, 1)} || case when {_CHAPTER_REST} <> '' then '. ' || {_CHAPTER_REST} else '' end as own_title, f.hard_chapter, f.hard_number
  from parsed p join firsts f using (doc_id)
), placed as (
  select *, coalesce(last_value(case when is_chapter then own_number end ignore nulls) over (partition by doc_id order by line_no rows between unbounded preceding and current row), hard_number) as number from named
), chapters as (
  select doc_id, arg_max(own_number, line_no) filter (where is_chapter) as last_number, arg_max(own_title, line_no) filter (where is_chapter) as last_title, max(line_no) as n_lines from placed group by doc_id
), plan_starts as (
  select doc_id, line_no, case when kind = 'letter' and number <> '' then number || '.' else '' end || {_MARK} as section_number, {_NAME} as section_title
  from placed where not is_chapter and (level > 0 or {_BARE}) and kind is not null
), ranked as (
  select *, row_number() over w as place, first_value(section_number) over w as top from plan_starts window w as (partition by doc_id order by line_no)
), kept as (
  select * from (select *, bool_and(place = 1 or starts_with(section_number, top || '.')) over (partition by doc_id) as collapsed from ranked) where place = 1 or not collapsed
), plan as (
  select k.doc_id, k.place - 1 as position, k.line_no as start_line, coalesce(lead(k.line_no) over (partition by k.doc_id order by k.line_no) - 1, c.n_lines) as end_line, k.section_number, k.section_title, coalesce(c.last_title, f.hard_chapter) as chapter, coalesce(c.last_number, f.hard_number) as chapter_number
  from kept k join chapters c using (doc_id) join firsts f using (doc_id)
  union all
  select doc_id, section_index - 1, start_line, end_line, section_number, section, chapter, chapter_number from sections where doc_id not in (select doc_id from plan_starts)
)"""

# ---- spans of the texts of documents: t, an anchor a with its end b (null: to the end; its n-th place), whether the anchor is in the span, and from where it may begin
_PLACES = """, {0}_at as (
  select *, case when a <> '' and contains(t, a) then instr(t, a) - 1 end as a_at,
    case when b is null then length(t) when b = '' then null when nth = 1 then case when contains(t, b) then instr(t, b) - 1 end when len(string_split(t, b)) > 2 then length(string_split(t, b)[1]) + length(string_split(t, b)[2]) + length(b) end as b_at from {0}
), {0}_found as (
  select *, a_at + case when inside then 0 else length(a) end as s, b_at as e,
    case when a is null then 'none' when a = '' then 'empty start_anchor' when a_at is null then 'start_anchor not found: ''' || a || '''' when a_at < low then 'start_anchor occurrence resolved before search_start'
      when b = '' then 'empty end_anchor' when b_at is null then 'end_anchor occurrence not found: ''' || b || '''' when b_at < a_at + case when inside then 0 else length(a) end then 'end anchor resolved before start anchor' end as bad from {0}_at
)"""

_ITEMS = f"""with contents as (
  select doc_id, {_TEXT} as t, 1 as position, '1' as name, substr({_TEXT}, 5, 3) as a, case when doc_id % 2 = 0 then substr({_TEXT}, 20, 2) end as b, 2 as nth, false as inside, 0 as low, true as asked from documents
  union all
  select doc_id, {_TEXT}, 2, 'Lemma 2', substr({_TEXT}, 1, 3), substr({_TEXT}, 9, 4), 1, true, 0, doc_id % 5 > 0 from documents
){_PLACES.format("contents")}, proofs as (
  select doc_id, t, position, right(t, 3) as a, null as b, 1 as nth, true as inside, e as low from contents_found where position = 2 and asked and bad is null and doc_id % 3 = 0
){_PLACES.format("proofs")}, judged as (
  select c.doc_id, c.position, {_strip("substr(c.t, c.s + 1, c.e - c.s)")} as content, nullif({_strip("substr(p.t, p.s + 1, p.e - p.s)")}, '') as proof,
    case when not asked then 'Extractor item ' || name || ' missing content_span.' when c.bad is not null then 'Could not extract content span for ' || name || ': ' || c.bad when p.bad is not null then 'Could not extract proof span for ' || name || ': ' || p.bad
      when {_strip("substr(c.t, c.s + 1, c.e - c.s)")} = '' then 'Extractor item ' || name || ' produced an empty content span.' end as error
  from contents_found c left join proofs_found p on c.doc_id = p.doc_id and c.position = p.position
), ended as (select *, min(position) filter (where error is not null) over (partition by doc_id) as failed_at from judged)
select cast(doc_id as varchar) as doc_id, cast(position as bigint) as position, coalesce(error, '') as error, cast(coalesce(failed_at, -1) as bigint) as failed_at, case when error is null then sha256(content) else '' end as content_sha256, case when error is null then sha256(coalesce(proof, '-')) else '' end as proof_sha256
from ended where failed_at is null or position <= failed_at"""

_ANCHOR = _strip(f"substr({_TEXT}, 5, 3)")
_REPAIRED = f"""with asked as (
  select doc_id, {_TEXT} as t, substr({_TEXT}, 5, 3) as a, case when doc_id % 2 = 0 then substr({_TEXT}, 20, 2) end as b, 2 as nth, false as inside, 0 as low from documents where doc_id % 3 = 0
){_PLACES.format("asked")}, blocks as (
  select doc_id, case when {_ANCHOR} <> '' and contains({_TEXT}, {_ANCHOR}) then {_strip(f"regexp_split_to_array({_strip(f'substr({_TEXT}, instr({_TEXT}, {_ANCHOR}))')}, {_re(R.PROOF_BOUNDARY)})[1]")} end as content from documents where doc_id % 3 = 2
), found as (
  select doc_id, 'span' as content_source, bad is null as accepted, {_strip("substr(t, s + 1, e - s)")} as content from asked_found
  union all select doc_id, 'current', true, {_strip(f"string_split({_TEXT}, chr(10))[1]")} from documents where doc_id % 3 = 1
  union all select doc_id, case when content <> '' then 'declared_anchor_span' else 'none' end, coalesce(content <> '', false), content from blocks
)
select cast(doc_id as varchar) as doc_id, accepted, case when doc_id % 2 = 0 then 'thm' else 'lemma' end as env, 'a' as dependencies, content_source, sha256(case when accepted then content else '-' end) as content_sha256, cast(case when accepted then 1 else -1 end as bigint) as item_index from found"""

_LAST = f"string_split({_TEXT}, chr(10))[-1]"
_BEFORE = "substr(t, 1, instr(t, own) - 1)"
_CLEAN_NAME = f"regexp_replace(trim(regexp_replace(replace(string_split({_TEXT}, chr(10))[1], '/', '-') || '.pdf', '(.)\\.[^.]*$', '\\1')), '[^\\p{{L}}\\p{{N}}._\\- ]', '_', 'g')"


def _any(x: str, words: list[str]) -> str:
    return "(" + " or ".join(f"contains({x}, '{w}')" for w in words) + ")"


_BOUND = f"""{_NORMAL.replace(_SECTIONS, _WARNINGS, 1)}, blocks as (
  select r.doc_id, r.line_no, (select min(s.line_no) from starts s where s.doc_id = r.doc_id and s.line_no > r.line_no) as next_line, row_number() over (partition by r.doc_id order by r.line_no) as place, r.doc_id in (select doc_id from starts) as sectioned
  from roles r where role = 'back'
), texts as (
  select b.doc_id, b.line_no, {_strip("string_agg(l.line, chr(10) order by l.line_no)")} as block from blocks b join lines l on l.doc_id = b.doc_id and l.line_no >= b.line_no and l.line_no < coalesce(b.next_line, l.n_lines + 1) where sectioned or place = 1 group by b.doc_id, b.line_no
), backs as (select doc_id, string_agg(block, chr(10) || chr(10) order by line_no) as t from texts where block <> '' group by doc_id),
fronts as (
  select l.doc_id, {_strip("string_agg(l.line, chr(10) order by l.line_no)")} as t from lines l join first_starts f on l.doc_id = f.doc_id and l.line_no < f.line_no where l.doc_id not in (select doc_id from front where marker) group by l.doc_id
)"""

ORACLES = {
    "conversion_summaries": f"""with {_BOUND} select s.doc_id, count(*) as sections_written, (select count(*) from items i where i.doc_id = s.doc_id) as items_total, 'book' || s.doc_id || '.md' as source_file, coalesce((select length(t) from fronts f where f.doc_id = s.doc_id), 0) as front_matter_chars,
  coalesce((select length(t) from backs b where b.doc_id = s.doc_id), 0) as back_matter_chars, (select count(*) from split_warnings w where w.doc_id = s.doc_id) as n_warnings, string_agg(section_number, ',' order by section_index) as section_numbers from sections s group by s.doc_id""",
    "heuristic_plans": f"with {_PLAN} select doc_id, position, start_line, end_line, section_number, section_title, chapter, chapter_number from plan",
    "planned_sections": f"""with {_PLAN}, sized as (select p.*, z.n_lines from plan p join (select doc_id, any_value(n_lines) as n_lines from lines group by doc_id) z using (doc_id)),
p as (select *, greatest(1, least(n_lines, start_line)) as s, greatest(greatest(1, least(n_lines, start_line)), least(n_lines, end_line)) as e, row_number() over (partition by doc_id order by start_line, position, end_line) as i from sized),
q as (select *, least(n_lines, i + max(e - i) over (partition by doc_id order by i rows unbounded preceding)) as new_end from p),
r as (select *, coalesce(lag(new_end) over (partition by doc_id order by i), 0) as before from q),
u as (select doc_id, i as section_index, case when s > before then s else least(before + 1, n_lines) end as start_line, new_end as end_line, chapter, {_strip("chapter_number")} as chapter_number, {_strip("section_title")} as given,
  case when section_number <> '' and {_strip("chapter_number")} <> '' and section_number <> {_strip("chapter_number")} and not starts_with(section_number, {_strip("chapter_number")} || '.') and regexp_matches(section_number, '^\\d+(?:\\.\\d+)*$') then {_strip("chapter_number")} || '.' else '' end || section_number as section_number from r),
v as (select u.*, coalesce(nullif(given, ''), section_number) as name, arg_min(l.line, l.line_no) as line, string_agg(l.line, chr(10) order by l.line_no) as body from u join lines l on l.doc_id = u.doc_id and l.line_no between u.start_line and u.end_line group by all)
select doc_id, section_index, section_number, {_strip("section_number || '. ' || name")} as section, chapter, chapter_number, case when {_is("line", R.HEADING)} then length({_part("line", R.HEADING, 1)}) else -1 end as heading_level,
  case when {_is("line", R.HEADING)} then {_clean(_part("line", R.HEADING, 2))} when {_X} <> '' then {_X} else name end as source_heading, start_line, end_line, sha256({_strip("body")}) as text_sha256 from v""",
    "structure_candidates": f"""with {_LINES}, {_PARSED}, f as (
  select *, last_value(nullif(substr(s, 1, 300), '') ignore nulls) over (partition by doc_id order by line_no rows between unbounded preceding and 1 preceding) as prev,
    first_value(nullif(substr(s, 1, 300), '') ignore nulls) over (partition by doc_id order by line_no rows between 1 following and unbounded following) as next,
    case when level > 0 then 'markdown_h' || level || case when {_is("title", R.CHAPTER)} then '_chapter' when {_is("title", R.BACK_MATTER)} then '_back_matter' when {_is("words", R.ITEM_HEADING)} then '_item_or_activity' when kind is not null then '_section_candidate' else '_heading' end
      when {_is("title", R.CHAPTER)} then 'bare_chapter_candidate' when {_is("title", R.BACK_MATTER)} then 'bare_back_matter_candidate' when {_is("words", R.ITEM_HEADING)} then 'item_or_activity_candidate' when {_BARE} then 'bare_section_candidate' end as candidate from parsed)
select doc_id, line_no, candidate as kind, sha256(substr(s, 1, 500)) as text_sha256, sha256(coalesce(prev, '')) as prev_sha256, sha256(coalesce(next, '')) as next_sha256 from f where candidate is not null and s <> ''""",
    "planner_needed": f"""with {_WARNINGS}, {_PARSED}, numbers as (select doc_id, arg_min(chapter_number, section_index) as number from sections group by doc_id),
bare as (select p.doc_id, p.line_no, case when kind = 'letter' and number <> '' then number || '.' else '' end || {_MARK} as section_number from parsed p join numbers using (doc_id) where {_BARE}),
missed as (select doc_id from bare b where not exists (select 1 from sections s where s.doc_id = b.doc_id and (s.start_line = b.line_no or s.section_number = b.section_number))),
levels as (select doc_id, max(level) filter (where kind is not null) as section_level, min(level) filter (where kind is null and {_is("title", R.ITEM_HEADING)}) as item_level from parsed where level > 0 group by doc_id)
select doc_id, doc_id in (select doc_id from split_warnings) or doc_id in (select doc_id from missed) or doc_id in (select doc_id from levels where item_level < section_level) as needed from numbers""",
    "prompt_profile": f"""with {_SECTIONS}, shown as (select *, concat_ws(chr(10), chapter, section, source_heading, substr(text, 1, 4000)) as t from sections)
select doc_id, section_index, case when len(regexp_extract_all(t, {_re(R.CJK)})) >= 20 or {_any("t", P.CHINESE_MARKS)} then 'chinese_math'
  when coalesce(chapter_number, '') = '' and regexp_matches(section_number, '^(?:\\d+(?:\\.\\d+)*|[A-Z])$') or {_any("lower(t)", P.PAPER_MARKS)} or {_any("lower(section)", P.PAPER_TITLES)} then 'paper' else 'textbook' end as profile from shown""",
    "stream_ingest_state": """with recursive seen as (
  select user_id as path, cast(event_id // 40 as varchar) as digest, epoch(ts) as sec, value > 20 as ok, row_number() over (partition by user_id order by ts, cast(event_id // 40 as varchar), case when value > 20 then 'ok' else 'error' end) as i from events
), state as (
  select path, cast(0 as bigint) as i, cast(null as varchar) as digest, '' as status, 0 as failures, cast(0 as double) as sec, '' as action from (select distinct path from seen)
  union all
  select path, i, digest, case when action = 'converted' then 'done' when action in ('failed', 'blocked') then action else status end, case when action = 'converted' then 0 when action in ('failed', 'blocked') then failures + 1 else failures end,
    case when action in ('converted', 'failed', 'blocked') then now else sec end, action
  from (
    select *, case when status in ('done', 'blocked') then 'skip_' || status when status = 'failed' and now - sec < 3600 then 'skip_cooling' when ok then 'converted' when failures + 1 >= 3 then 'blocked' else 'failed' end as action
    from (select n.path, n.i, n.digest, n.ok, n.sec as now, case when n.digest = s.digest then s.status else '' end as status, case when n.digest = s.digest then s.failures else 0 end as failures, case when n.digest = s.digest then s.sec else 0 end as sec from state s join seen n on n.path = s.path and n.i = s.i + 1)
  )
) select action, count(*) as n from state where i > 0 group by action""",
    "source_backed": f"""with {_LINES}, b as (select doc_id, {_clean("string_agg(line, chr(10) order by line_no)")} as t from lines group by doc_id), v as (select doc_id as document, {_clean(f"string_split({_TEXT}, chr(10))[1]")} as x from documents),
pairs as (select document, x, cast(document // 16 as varchar) as doc_id from v union all select document, x, cast(document // 16 - 1 as varchar) from v)
select doc_id, document, x = '' or contains(t, x) as backed from b join pairs using (doc_id)""",
    "dependency_rewrite": """with items as (select doc_id // 4 as s, doc_id % 4 + 1 as p, case when doc_id % 3 > 0 then cast(doc_id % 7 as varchar) end as number from documents),
named as (select *, row_number() over w as item_index, 'Theorem ' || coalesce(number, '9.' || s || '-extra-' || sum(cast(number is null as int)) over (w rows unbounded preceding)) as label from items window w as (partition by s order by p))
select 's' || n.s as doc_id, n.item_index, n.label, coalesce(b.label, 'Theorem -' || n.s || '-' || (n.p - 1)) || '|Lemma of nobody' as dependencies from named n left join named b on b.s = n.s and b.p = n.p - 1""",
    "span_clip_next": f"""with rows_ as (select doc_id, {_TEXT} as t, doc_id % 9 > 0 as found, doc_id % 50 as s, doc_id % 50 + doc_id % 31 as e, doc_id % 4 > 0 as has_next, kind from documents, (select unnest(['content', 'proof']) as kind)),
marked as (select *, found and has_next and s >= 40 as late, found and has_next and s < 40 and e > 40 as cut from rows_)
select doc_id, kind, found and not (late and kind = 'content') as found, case when cut then 40 else e end as char_end, case when late then kind || ' starts at or after the next item' when cut then kind || ' clipped at the next item' else '' end as warning,
  sha256(substr(t, s + 1, case when cut then 40 else e end - s)) as span_sha256 from marked""",
    "span_items": _ITEMS,
    "repaired_items": _REPAIRED,
    "items_as_spans": f"""with t as (select doc_id, {_TEXT} as t, {_LAST} as own from documents)
select cast(doc_id as varchar) as doc_id, cast(case when own = '' then -1 else (length({_BEFORE}) - length(replace({_BEFORE}, own, ''))) // length(own) + 1 end as bigint) as occurrence, sha256(case when own = '' then '-' else own end) as anchor_sha256,
  case when own = '' then '{R.ERROR_EMPTY_TEXT}' else '' end as error from t""",
    "declared_labels": f"""with t as (select doc_id, {_TEXT} as t, substr({_TEXT}, 5, 2) as q from documents), x as (select *, case when q = '' then [] else string_split(t, q) end as x from t),
m as (select *, list_transform(range(1, least(len(x) - 1, 5) + 1), lambda i: cast(list_sum(list_transform(x[1:i], lambda y: length(y))) + (i - 1) * length(q) as bigint)) as places from x)
select cast(doc_id as varchar) as doc_id, cast(1 as bigint) as place, 'L' || doc_id as label, case when doc_id % 2 = 0 then 'thm' else '' end as env, '1.2' as number, len(places) > 0 as anchor_found, array_to_string(places, ',') as offsets from m""",
    "tool_actions": "select o_orderkey as doc_id, cast(1 as bigint) as place, case o_orderkey % 3 when 0 then 'delete' when 1 then 'update' else 'add' end as action, case when o_orderkey % 2 = 0 then o_orderstatus else '' end as target_label, case when o_orderkey % 5 = 0 then 'after' else '' end as anchor_position, o_orderpriority as reason from orders",
    "tool_summaries": f"""select doc_id, concat_ws(',', case when doc_id % 5 = 0 then 'error' end, case when doc_id % 3 > 0 then 'found' end, case when doc_id % 4 = 0 then 'matches' end, case when doc_id % 3 > 0 then 'text' end) as keys,
  case when doc_id % 4 = 0 then doc_id % 6 + 1 else -1 end as matches_count, doc_id % 3 > 0 and doc_id % 2 = 0 as found, case when doc_id % 3 > 0 then length({_TEXT}) else -1 end as chars, case when doc_id % 5 = 0 then 'bad' else '' end as error from documents""",
    "annotation_fields": f"""select doc_id, sha256(case when doc_id % 4 > 0 then {_TEXT} else coalesce(lang, '') end) as statement_sha256, case when doc_id % 2 = 0 and coalesce(source, '') <> '' then source else 'C' end as chapter_title, case when doc_id % 3 > 0 then cast(doc_id % 3 as varchar) else '' end as section_number,
  case when doc_id % 2 = 0 then 'T' || doc_id else 'name' end || case when doc_id % 3 = 0 then ':item_1:true' else '::false' end || '|open::false' as dependencies, case doc_id % 5 when 0 then cast(doc_id % 7 as varchar) when 1 then doc_id % 3 || ',12' else '' end as pages,
  'b1' as block_ids, cast(1 as bigint) as n_boxes, 'p.png' as image_path, doc_id % 6 = 0 as modified from documents""",
    "annotation_errors": f"""select doc_id, case when doc_id % 23 = 0 then '{R.BAD_OBJECT}' when doc_id % 7 = 0 then '{R.BAD_VERSION}' when doc_id % 11 = 0 then '{R.BAD_SOURCE}' when doc_id % 13 = 0 then '{R.BAD_SOURCE_TYPE}' when doc_id % 17 = 0 then '{R.BAD_ITEMS}'
  when doc_id % 5 = 0 then '{R.BAD_DUPLICATE}a' when doc_id % 5 = 1 then '{R.BAD_ITEM}2{R.BAD_ITEM_ID}' when doc_id % 19 = 0 then '{R.BAD_QUALITY}' else '' end as error from documents""",
    "annotations_saved": """with ids as (select doc_id as id, true as sent from documents union all select doc_id, false from labels), each as (select id, bool_or(sent) and id % 4 > 0 as good, bool_or(not sent) as stored from ids group by id)
select id, cast(case when good and id % 3 > 0 then 20 when stored then 10 else 5 end as bigint) as updated_at, cast(case when good and (id % 3 > 0 or not stored) then id % 5 + 2 else 1 end as bigint) as item_count from each where good or stored""",
    "usage_merged": """with t as (select conv_id, turn, length(coalesce(text, '')) as n from conversations where turn % 5 < 4), m as (select *, max(case when turn % 3 = 0 then turn end) over (partition by conv_id) as said from t)
select conv_id, 'tokens' as name, cast(sum(n) as varchar) as value from t group by conv_id
union all
select conv_id, 'tier', case when max(turn) = max(said) then 't' || max(said) else cast(sum(turn * 2) filter (where said is null or turn > said) as varchar) end from m group by conv_id""",
    "image_answers": f"""with t as (select doc_id, {_TEXT} as t, regexp_matches({_TEXT}, '\\S') as filled, list_filter(string_split({_TEXT}, chr(10)), lambda x: regexp_matches(x, '\\S')) as full_lines from documents)
select doc_id, sha256(case when doc_id % 6 = 4 then '-' when doc_id % 6 = 5 or not filled then '' when doc_id % 6 = 1 then regexp_replace(t, '\\s+$', '') when doc_id % 6 = 2 then array_to_string(full_lines, chr(10)) else t end) as markdown_sha256 from t""",
    "export_names": f"""with n as (select doc_id, coalesce(nullif(trim(case when x = '' then 'output' else x end, ' ._'), ''), 'output') as w from (select doc_id, {_CLEAN_NAME} as x from documents))
select doc_id, case when strlen(w) <= {R.EXPORT_NAME_BYTES} then w else coalesce(nullif(rtrim(substr(w, 1, list_max(list_filter(range(0, {R.EXPORT_NAME_BYTES} + 1), lambda k: strlen(substr(w, 1, k)) <= {R.EXPORT_NAME_BYTES}))), ' ._'), ''), 'output') end as name from n""",
}
