"""DuckDB SQL for the registered queries; RE2 has no look-around and its classes are ASCII, which is enough for the tables."""

from __future__ import annotations

from lemmaflow.functions import patterns as R


def _re(pattern: str) -> str:
    """A pattern of ours in RE2's syntax, as an SQL literal."""
    flags, rest = pattern.split(")", 1) if pattern.startswith("(?d") else ("", pattern)
    keep = "".join(f for f in "im" if f in flags[2:])
    return "'" + (f"(?{keep})" if keep else "") + rest.replace("'", "''") + "'"


def _is(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {_re(pattern)})"


def _part(x: str, pattern: str, group: int) -> str:
    return f"regexp_extract({x}, {_re(pattern)}, {group})"


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _clean(x: str) -> str:
    return rf"regexp_replace({_strip(x)}, '\s+', ' ', 'g')"


_SPLIT_DOCS = "select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as x, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos from documents"

_LINES = f"""
all_lines as (
  select book as doc_id, n as line_no, case
    when n % 60 = 1 then '# Chapter ' || (n // 60 + 1) || ' ' || x
    when (n - 1) % 12 = 0 then '## ' || k || ' ' || substr(x, 1, 40)
    when (n - 1) % 12 = 3 then 'Definition ' || case when k % 5 = 0 then k - 1 else k end || '.1. ' || x
    when (n - 1) % 12 = 6 then 'Theorem ' || k || '.2. ' || x
    when (n - 1) % 12 = 7 then 'Proof. ' || x
    when (n - 1) % 12 = 9 then 'Remark. ' || x
    when (n - 1) % 12 = 10 and k % 3 = 0 then 'Proof of Theorem ' || k || '.2. ' || x
    when (n - 1) % 12 = 11 and k % 7 = 0 then '## References'
    else x end as line, max(n) over (partition by book) as last_n
  from (select cast(doc_id // 16 as varchar) as book, x, row_number() over (partition by doc_id // 16 order by doc_id, pos) as n, (row_number() over (partition by doc_id // 16 order by doc_id, pos) - 1) // 12 + 1 as k from ({_SPLIT_DOCS}))
), lines as (
  select doc_id, line_no, line, max(line_no) over (partition by doc_id) as n_lines from all_lines where not (line_no = last_n and line = '')
)"""

_LETTER_REST = _strip(_part("title", R.LETTER_SECTION, 2))
_KIND = f"""case when title = '' or {_is("title", R.BACK_MATTER)} or {_is("title", R.RESULT_HEADING)} then null
    when {_is("title", R.APPENDIX_SECTION)} then 'appendix'
    when {_is("title", R.NUMERIC_SECTION)} then case when not {_is(_strip(_part("title", R.NUMERIC_SECTION, 2)), R.RESULT_HEADING)} then 'numeric' end
    when {_is("title", R.LETTER_SECTION)} and not (regexp_matches(title, '[.?!;:]$') and length(title) > 80)
      then case when not ({_is(_LETTER_REST, R.RESULT_HEADING)} and ({_is(_LETTER_REST, R.NUMBERED_ITEM)} or {_is(_LETTER_REST, R.PROOF_HEADING)})) or starts_with(lower({_LETTER_REST}), 'proof of') then 'letter' end end"""
_CHAPTER_REST = _strip(_part("title", R.CHAPTER, 2))

_HEADINGS = f"""{_LINES}, headings as (
  select doc_id, line_no, length({_part("line", R.HEADING, 1)}) as level, {_clean(_part("line", R.HEADING, 2))} as title from lines where {_is("line", R.HEADING)}
)"""

_ROLES = f"""{_HEADINGS}, kinds as (
  select *, {_KIND} as kind, case when {_is("title", R.BACK_MATTER)} then 'back' when {_is("title", R.CHAPTER)} then 'chapter' when {_is("title", R.FRONT_MATTER)} then 'front' when {_KIND} is not null then 'section' else 'none' end as role from headings
), roles as (
  select *,
    coalesce(last_value(case when role = 'chapter' then 'Chapter ' || {_part("title", R.CHAPTER, 1)} || case when {_CHAPTER_REST} <> '' then '. ' || {_CHAPTER_REST} else '' end end ignore nulls) over so_far,
      first_value(case when role = 'none' and level = 1 then title end ignore nulls) over (partition by doc_id order by line_no rows between unbounded preceding and unbounded following), 'book' || doc_id) as chapter,
    coalesce(last_value(case when role = 'chapter' then {_part("title", R.CHAPTER, 1)} end ignore nulls) over so_far, '') as chapter_number
  from kinds window so_far as (partition by doc_id order by line_no rows between unbounded preceding and current row)
)"""

_PLAIN = _strip("regexp_replace(" + _strip("line") + ", '^#+', '')")
_SECTIONS = f"""{_ROLES}, own_starts as (
  select doc_id, line_no, level, chapter, chapter_number, title as source_heading, false as synthetic,
    case kind when 'appendix' then {_part("title", R.APPENDIX_SECTION, 1)} when 'numeric' then {_part("title", R.NUMERIC_SECTION, 1)} else case when chapter_number <> '' then chapter_number || '.' else '' end || {_part("title", R.LETTER_SECTION, 1)} end as section_number,
    case kind when 'appendix' then case when {_part("title", R.APPENDIX_SECTION, 2)} <> '' then {_strip(_part("title", R.APPENDIX_SECTION, 2))} else 'Appendix ' || {_part("title", R.APPENDIX_SECTION, 1)} end when 'numeric' then {_strip(_part("title", R.NUMERIC_SECTION, 2))} else {_LETTER_REST} end as start_title
  from roles where role = 'section'
), first_starts as (
  select doc_id, min(line_no) as line_no, arg_min(section_number, line_no) as section_number, arg_min(chapter, line_no) as chapter, arg_min(chapter_number, line_no) as chapter_number from own_starts group by doc_id
), front as (
  select l.doc_id, bool_or({_is(_PLAIN, R.NUMBERED_ITEM)} or {_is(_PLAIN, R.RESULT_HEADING)}) as marker,
    arg_min(regexp_replace({_part(_PLAIN, R.NUMBERED_ITEM, 1)}, '\\.[^.]*$', ''), l.line_no) filter (where contains({_part(_PLAIN, R.NUMBERED_ITEM, 1)}, '.')) as inferred
  from lines l join first_starts f on l.doc_id = f.doc_id and l.line_no < f.line_no group by l.doc_id
), starts as (
  select doc_id, line_no, level, chapter, chapter_number, source_heading, synthetic, section_number, start_title from own_starts
  union all
  select doc_id, cast(1 as bigint), null, chapter, chapter_number, number || '. Inferred pre-section material', true, number, number || '. Inferred pre-section material'
  from (select f.*, coalesce(inferred, case when regexp_matches(section_number, '^\\d+$') and try_cast(section_number as int) > 1 then cast(try_cast(section_number as int) - 1 as varchar) end, 'pre') as number from front join first_starts f using (doc_id) where marker)
), lone as (
  select doc_id, 1 as line_no, null as level, chapter, chapter_number, chapter as source_heading, cast(null as boolean) as synthetic, case when chapter_number <> '' then chapter_number else '1' end as section_number, chapter as start_title
  from (select d.doc_id, coalesce(arg_max(r.chapter, r.line_no), 'book' || d.doc_id) as chapter, coalesce(arg_max(r.chapter_number, r.line_no), '') as chapter_number
    from (select distinct doc_id from all_lines) d left join roles r using (doc_id) where d.doc_id not in (select doc_id from starts) group by d.doc_id)
), marks as (
  select doc_id, line_no, true as is_start from starts union all select doc_id, line_no, true from lone union all select doc_id, line_no, false from roles where role = 'back'
), next_marks as (
  select doc_id, line_no, is_start, min(line_no) over (partition by doc_id order by line_no range between 1 following and unbounded following) as next_line from marks
), bounded as (
  select s.*, coalesce(m.next_line, z.n_lines + 1) as next_line, z.n_lines, row_number() over (partition by s.doc_id order by s.line_no) as section_index
  from (select * from starts union all select * from lone) s
  join (select distinct doc_id, line_no, next_line from next_marks where is_start) m on s.doc_id = m.doc_id and s.line_no = m.line_no
  join (select d.doc_id, coalesce(max(l.n_lines), 0) as n_lines from (select distinct doc_id from all_lines) d left join lines l using (doc_id) group by d.doc_id) z on s.doc_id = z.doc_id
), sections as (
  select b.doc_id, b.section_index, any_value(b.section_number) as section_number, any_value(case when coalesce(synthetic, true) then start_title else {_strip("section_number || '. ' || start_title")} end) as section,
    any_value(chapter) as chapter, any_value(chapter_number) as chapter_number, any_value(source_heading) as source_heading, any_value(b.line_no) as start_line, any_value(b.next_line) as next_line,
    any_value(case when synthetic is null then least(next_line - 1, b.n_lines) else coalesce(last_filled, b.line_no - 1) end) as end_line,
    coalesce(any_value(synthetic), false) as synthetic, bool_or(synthetic is null) as lone, any_value({_strip("coalesce(body, '')")}) as text
  from bounded b left join (
    select c.doc_id, c.section_index, max(l.line_no) filter (where {_strip("l.line")} <> '') as last_filled, string_agg(l.line, chr(10) order by l.line_no) as body
    from bounded c join lines l on l.doc_id = c.doc_id and l.line_no >= c.line_no and l.line_no < c.next_line group by c.doc_id, c.section_index
  ) t on t.doc_id = b.doc_id and t.section_index = b.section_index
  group by b.doc_id, b.section_index
)"""

_WARNINGS = f"""{_SECTIONS}, split_warnings as (
  select doc_id, section_index * 10 + k as position, warning from (
    select doc_id, section_index, 0 as k, '{R.WARN_NO_SECTIONS}' as warning from sections where lone
    union all select doc_id, section_index, 0, '{R.WARN_SYNTHETIC}' from sections where synthetic
    union all select doc_id, section_index, 1, 'duplicate section number detected: ' || section_number from (select *, row_number() over (partition by doc_id, section_number order by section_index) as rn from sections) where rn > 1 and not lone
    union all select doc_id, section_index, 2, format('section {{:02d}} is very long ({{}} chars); consider smaller chunks', section_index, length(text)) from sections where length(text) > {R.LONG_SECTION} and not lone
  ))"""

_X = _strip("line")
_KIND_CASE = "case " + " ".join(f"when contains(lower(word), '{w}') then '{k}'" for w, k in R.TITLE_KINDS) + " else 'remark' end"
_DISPLAY_CASE = "case env " + " ".join(f"when '{k}' then '{v}'" for k, v in R.DISPLAY.items()) + " end"


def _unmarked(x: str) -> str:
    once = _strip(f"regexp_replace({_strip(x)}, {_re(R.PROOF)}, '\\2')")
    return _strip(f"regexp_replace({once}, {_re(R.CONSTRUCTION)}, '\\1')")


_ITEMS = f"""{_SECTIONS}, section_lines as (
  select s.doc_id, s.section_index, l.line_no, l.line, {_is(_X, R.ITEM_START)} as is_item, {_is(_X, R.PROOF)} as is_proof, {_is(_X, R.CONSTRUCTION)} as is_construction, {_part(_X, R.PROOF, 1)} as proof_number,
    sum(cast({_is(_X, R.ITEM_START)} as int)) over (partition by s.doc_id, s.section_index order by l.line_no) as block
  from sections s join lines l on l.doc_id = s.doc_id and l.line_no >= s.start_line and l.line_no < s.next_line
), heads as (
  select doc_id, section_index, block, coalesce(nullif({_part(_X, R.ITEM_START, 2)}, ''), nullif({_part(_X, R.ITEM_START, 4)}, ''), {_part(_X, R.ITEM_START, 5)}) as number,
    coalesce(nullif({_part(_X, R.ITEM_START, 1)}, ''), nullif({_part(_X, R.ITEM_START, 3)}, ''), {_part(_X, R.ITEM_START, 6)}) as word
  from section_lines where is_item
), proofs as (
  select doc_id, section_index, block, min(line_no) as first_line, arg_min(case when is_proof then proof_number else '' end, line_no) as first_number
  from section_lines where block > 0 and (is_proof or is_construction) group by all
), cuts as (
  select h.*, p.first_line, coalesce(p.first_number <> '' and h.number <> '' and p.first_number <> h.number, false) as foreign_,
    (select min(l.line_no) from section_lines l where l.doc_id = h.doc_id and l.section_index = h.section_index and l.block = h.block and l.line_no > p.first_line and l.is_proof and l.proof_number <> '' and l.proof_number <> h.number) as cut
  from heads h left join proofs p using (doc_id, section_index, block)
), parts as (
  select c.doc_id, c.section_index, c.block, any_value(c.number) as number, any_value(c.word) as word, bool_or(c.foreign_) as foreign_, bool_or(c.first_line is not null) as has_proof,
    coalesce(string_agg(l.line, chr(10) order by l.line_no) filter (where c.first_line is null or l.line_no < c.first_line), '') as content,
    coalesce(string_agg(l.line, chr(10) order by l.line_no) filter (where l.line_no >= c.first_line and (c.cut is null or l.line_no < c.cut)), '') as proof
  from cuts c join section_lines l using (doc_id, section_index, block) group by c.doc_id, c.section_index, c.block
), owners as (
  select doc_id, section_index, number, max(block) as block from heads where number <> '' group by all
), delayed_rows as (
  select d.doc_id, d.section_index, d.block as from_block, d.line_no, o.block,
    {_strip(f"regexp_replace({_strip('string_agg(l.line, chr(10) order by l.line_no)')}, {_re(R.PROOF)}, '\\2')")} as text
  from (select * from section_lines where is_proof and not is_item and proof_number <> '') d
  join owners o on o.doc_id = d.doc_id and o.section_index = d.section_index and o.number = d.proof_number and o.block <> d.block
  join section_lines l on l.doc_id = d.doc_id and l.section_index = d.section_index and l.block = d.block and l.line_no >= d.line_no
  group by d.doc_id, d.section_index, d.block, d.line_no, o.block
), delayed as (
  select doc_id, section_index, block, string_agg(text, chr(10) || chr(10) order by from_block, line_no) as delayed from delayed_rows where text <> '' group by all
), raw_items as (
  select doc_id, section_index, cast(block as bigint) as position, {_KIND_CASE} as env, number, {_strip("regexp_replace(" + _strip("content") + ", '(?m)^#{1,6}\\s+', '', 'g')")} as content,
    case when has_proof and not foreign_ and {_unmarked("proof")} <> '' then case when delayed is not null then {_strip(_unmarked("proof") + " || chr(10) || chr(10) || delayed")} else {_unmarked("proof")} end else delayed end as proof
  from parts left join delayed using (doc_id, section_index, block)
  union all
  select doc_id, section_index, cast(1 as bigint), 'remark', '', {_strip("text")}, null from sections s
  where not exists (select 1 from heads h where h.doc_id = s.doc_id and h.section_index = s.section_index)
    and (contains(lower(source_heading || ' ' || section), 'proof of') or len(list_filter(string_split(text, chr(10))[1:5], lambda x: {_is(_strip("x"), R.PROOF)})) > 0)
), local_items as (select * from raw_items where content <> '')"""

_FIRST = "regexp_replace(string_split(content, chr(10))[1], '^\\s*(?:#{1,6}\\s*)?[*_`]+', '')"
_NAMES = "Remarks|Remark|注记|注"
_INFER = "'(?i)^\\s*(?:" + _NAMES + ")(\\s*)([:：.]?)(\\s*)" + R.SOURCE_NUMBER + "(?:[\\s.:：)）(]|$)'"

_NORMAL = f"""{_ITEMS}, numbered as (
  select doc_id, section_index, position, env, content, proof, case when number <> '' then number
    when env = 'remark' and regexp_matches({_FIRST}, {_INFER}) and (regexp_extract({_FIRST}, {_INFER}, 1) || regexp_extract({_FIRST}, {_INFER}, 2) || regexp_extract({_FIRST}, {_INFER}, 3) <> '' or regexp_matches(regexp_extract({_FIRST}, {_INFER}, 4), '^\\d'))
      and not (regexp_extract({_FIRST}, {_INFER}, 2) = '.' and regexp_matches(regexp_extract({_FIRST}, {_INFER}, 4), '^[A-Za-z]$')) then regexp_extract({_FIRST}, {_INFER}, 4) else '' end as number
  from local_items
), counted as (
  select *, row_number() over w as item_index, sum(cast(number = '' as int)) over (w rows between unbounded preceding and current row) as extra from numbered window w as (partition by doc_id, section_index order by position)
), items as (
  select c.doc_id, c.section_index, item_index, row_number() over (partition by c.doc_id order by c.section_index, item_index) as global_index,
    {_DISPLAY_CASE} || ' ' || case when number <> '' then number else coalesce(nullif(s.section_number, ''), nullif(s.chapter_number, ''), 'section') || '-extra-' || extra end as label,
    env, content, proof, s.chapter, s.chapter_number
  from counted c join sections s using (doc_id, section_index)
)"""

_STANDALONE = "(contains(lower(source_heading || ' ' || section), 'proof of') or contains(lower(source_heading || ' ' || section), '证明'))"
# only ASCII marks are looked for here, as \b of RE2 is ASCII
_SOURCE_ITEM = R.SOURCE_ITEM.replace(f"|{R.CN14}", "")
_PROOF_MARKER = R.PROOF_MARKER.replace("|证明", "")

_QUALITY = f"""{_NORMAL}, marked as (
  select *, len(regexp_extract_all(text, {_re(_SOURCE_ITEM)})) as n_item_markers, len(regexp_extract_all(text, {_re(_PROOF_MARKER)})) as n_proof_markers, {_STANDALONE} as standalone from sections
), item_warnings as (
  select i.doc_id, i.section_index, item_index, 0 as k, label || ': content appears truncated' as warning from items i where {_is("content", R.TRUNCATED)}
  union all
  select i.doc_id, i.section_index, item_index, 1, label || ': proof marker remains in content while proof is null' from items i join marked m using (doc_id, section_index) where proof is null and {_is("content", _PROOF_MARKER)} and not standalone
), totals as (
  select doc_id, section_index, count(*) as n_items, count(*) filter (where coalesce(proof, '') <> '') as n_proofs, count(*) filter (where env = 'remark') as n_remarks from items group by all
), counts as (
  select m.*, coalesce(n_items, 0) as n_items, coalesce(n_proofs, 0) as n_proofs, coalesce(n_remarks, 0) as n_remarks from marked m left join totals using (doc_id, section_index)
), all_warnings as (
  select doc_id, section_index, item_index * 10 + k as place, warning from item_warnings
  union all select doc_id, section_index, 1000000001, 'source has theorem-like markers but extractor returned no items' from counts where n_item_markers > 0 and n_items = 0
  union all select doc_id, section_index, 1000000002, 'source has ' || n_item_markers || ' theorem-like markers but only ' || n_items || ' extracted item(s)' from counts where n_item_markers >= 3 and n_items <= 1
  union all select doc_id, section_index, 1000000003, 'all extracted items are remark despite multiple theorem-like source markers' from counts where n_items > 0 and n_remarks = n_items and n_item_markers >= 2
  union all select doc_id, section_index, 1000000004, 'source has explicit proof markers but no item has a proof field' from counts where n_proof_markers > 0 and n_proofs = 0 and not standalone
), section_warnings as (select doc_id, section_index, warning, min(place) as place from all_warnings group by all),
global_warnings as (
  select distinct doc_id, warning from split_warnings
  union select doc_id, 'duplicate labels: ' || array_to_string(list_sort(list(label))[1:20], ', ') from (select doc_id, label from items group by all having count(*) > 1) group by doc_id
  union select doc_id, 'all extracted items are remark' from items group by doc_id having bool_and(env = 'remark')
)"""
_QUALITY = _QUALITY.replace(_SECTIONS, _WARNINGS, 1)

_ISSUES = f"""issues as (
  select doc_id, global_index, printf('item_%06d', global_index) as item_id, 'error' as severity, 'empty_statement' as code, '{R.ISSUE_EMPTY}' as message from items where {_strip("content")} = ''
  union all
  select doc_id, global_index, printf('item_%06d', global_index), 'warning', 'duplicate_label', '{R.ISSUE_DUPLICATE}' || label from (select *, count(*) over (partition by doc_id, label) as many from items) where many > 1
)"""

_JOBS = "jobs as (select o_orderkey as id, case when o_orderstatus = 'F' then 'succeeded' when o_orderkey % 3 = 0 then 'failed' when o_orderkey % 3 = 1 then 'queued' else 'running' end as status, o_orderdate as updated_at from orders)"
_PHASES = "['structure', 'extract', 'audit', 'mock_structure', 'mock_extract', 'mock_audit']"
_USAGE = f"""traces as (
  select {_PHASES}[conv_id % 4 + 1] as phase, turn, length(coalesce(text, '')) as n from conversations where role <> 'system'
), usage as (
  select p.phase, count(t.phase) as requests, cast(coalesce(sum(case when turn % 2 = 0 and n <> 0 then n else 7 end) filter (where t.phase is not null), 0) as bigint) as input_tokens,
    cast(coalesce(sum(case when n % 100 <> 0 then n % 100 else 3 end) filter (where t.phase is not null), 0) as bigint) as output_tokens, cast(coalesce(sum(n), 0) as bigint) as total_tokens, round(cast(coalesce(sum(turn * 0.25), 0) as double), 6) as elapsed_seconds
  from (select unnest({_PHASES}) as phase) p left join traces t on p.phase = t.phase group by p.phase
)"""
_LATEST = "latest as (select * exclude (rn) from (select user_id, ts, event_id, event_type, value, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) where rn = 1)"
_STEM = "'doc' || doc_id"
_PAGES = rf"pages_ as (select doc_id // 16 as doc_id, doc_id % 16 as page_idx, coalesce(text, '') as md, regexp_replace(coalesce(text, ''), '\s+$', '') as body from documents)"

_AUDITS = "a as (select d.doc_id // 6 as doc_id, d.doc_id as doc, d.doc_id % 6 + 1 as i, d.lang, 'section' || lpad(cast(d.doc_id % 6 + 1 as varchar), 2, '0') || '_' || d.source as id, l.doc_id is not null as audited, l.quality, coalesce(l.quality = 0, false) as acts, l.toxic from documents d left join labels l using (doc_id))"

ORACLES = {
    "section_item_counts": f"with {_NORMAL} select doc_id, section_index, env, count(*) as n_items from items group by all",
    "lines_explode": f"with {_LINES} select doc_id, count(*) as n_lines, cast(count(*) filter (where {_X} = '') as bigint) as n_blank, cast(sum(length(line)) as bigint) as n_chars from lines group by doc_id",
    "heading_scan": f"with {_HEADINGS} select doc_id, line_no, level, title from headings",
    "chapter_carry_forward": f"with {_ROLES} select doc_id, line_no, role, chapter, chapter_number from roles",
    "section_bounds": f"with {_SECTIONS} select doc_id, section_index, section_number, chapter_number, start_line, end_line, synthetic from sections",
    "section_text_stats": f"with {_SECTIONS} select doc_id, section_index, section, length(text) as n_chars, sha256(text) as text_sha256 from sections",
    "back_matter_blocks": f"""with {_SECTIONS}, blocks as (
  select r.doc_id, r.line_no, (select min(s.line_no) from starts s where s.doc_id = r.doc_id and s.line_no > r.line_no) as next_line, row_number() over (partition by r.doc_id order by r.line_no) as place, r.doc_id in (select doc_id from starts) as sectioned
  from roles r where role = 'back'
), texts as (
  select b.doc_id, b.line_no, {_strip("string_agg(l.line, chr(10) order by l.line_no)")} as block from blocks b join lines l on l.doc_id = b.doc_id and l.line_no >= b.line_no and l.line_no < coalesce(b.next_line, l.n_lines + 1) where sectioned or place = 1 group by b.doc_id, b.line_no
), joined as (select doc_id, string_agg(block, chr(10) || chr(10) order by line_no) as t from texts where block <> '' group by doc_id)
select doc_id, length(t) as n_chars, sha256(t) as text_sha256 from joined""",
    "split_warnings": f"with {_WARNINGS} select doc_id, position, warning from split_warnings",
    "no_heading_documents": f"""with l as ({_SPLIT_DOCS}), h as (
  select doc_id, pos, {_clean(_part("x", R.HEADING, 2))} as title, length({_part("x", R.HEADING, 1)}) as level from l where {_is("x", R.HEADING)}
), k as (select *, {_KIND} as kind from h)
select doc_id, '1' as section_number, {_STEM} as section, cast(1 as bigint) as start_line, len(string_split(t, chr(10))) - case when ends_with(t, chr(10)) or t = '' then 1 else 0 end as end_line, length({_strip("t")}) as n_chars
from (select doc_id, coalesce(text, '') as t from documents) where doc_id not in (select doc_id from k where kind is not null or {_is("title", R.BACK_MATTER)} or {_is("title", R.CHAPTER)} or level = 1)""",
    "local_items": f"with {_ITEMS} select doc_id, section_index, position, env, number, sha256(content) as content_sha256, sha256(coalesce(proof, '-')) as proof_sha256 from local_items",
    "normalized_labels": f"with {_NORMAL} select doc_id, section_index, item_index, global_index, label, env from items",
    "duplicate_labels": f"with {_NORMAL} select doc_id, label, count(*) as n_items from items group by all having count(*) > 1",
    "quality_sections": f"with {_QUALITY} select c.doc_id, c.section_index, length(c.text) as source_chars, n_item_markers, n_proof_markers, n_items, n_proofs, coalesce(string_agg(w.warning, '|' order by w.place), '') as warnings from counts c left join section_warnings w using (doc_id, section_index) group by all",
    "quality_documents": f"""with {_QUALITY} select s.doc_id, count(*) as sections_total, cast(sum(n_items) as bigint) as items_total,
  (select count(*) from (select label from items i where i.doc_id = s.doc_id group by label having count(*) > 1)) as n_duplicate_labels, (select count(*) from global_warnings g where g.doc_id = s.doc_id) as n_global_warnings from counts s group by s.doc_id""",
    "annotation_issues": f"with {_NORMAL}, {_ISSUES} select doc_id, global_index, item_id, severity, code, message from issues",
    "annotation_chapters": f"with {_NORMAL} select doc_id, row_number() over (partition by doc_id order by first) as place, chapter_number as number, chapter as title from (select doc_id, chapter_number, chapter, min(global_index) as first from items where chapter <> '' or chapter_number <> '' group by all)",
    "annotation_quality": f"""with {_QUALITY}, {_ISSUES}, every as (
  select distinct doc_id, severity, code, message, item_id from issues union all select doc_id, 'warning', 'global_warning', warning, null from global_warnings union all select distinct doc_id, 'warning', 'section_warning', warning, null from section_warnings
) select d.doc_id, count(*) filter (where severity = 'error') as error_count, count(*) filter (where severity = 'warning') as warning_count from (select distinct doc_id from all_lines) d left join every using (doc_id) group by d.doc_id""",
    "annotation_documents": f"""with {_QUALITY}, {_ISSUES}, said as (
  select doc_id, 0 as part, global_index as a, case code when 'empty_statement' then 0 else 1 end as b, severity, code, message, item_id from issues
  union all select doc_id, 1, 0, position, 'warning', 'global_warning', warning, null from split_warnings
  union all select doc_id, 1, 0, 1000000001, 'warning', 'global_warning', warning, null from global_warnings where starts_with(warning, '{R.WARN_LABELS}')
  union all select doc_id, 1, 0, 1000000002, 'warning', 'global_warning', warning, null from global_warnings where warning = '{R.WARN_ALL_REMARKS}'
  union all select doc_id, 2, section_index, place, 'warning', 'section_warning', warning, null from section_warnings
), placed as (select *, row_number() over (partition by doc_id, severity, code, message, item_id order by part, a, b) as again from said),
every as (
  select doc_id, count(*) filter (where severity = 'error') as error_count, count(*) filter (where severity = 'warning') as warning_count, string_agg(severity || '|' || code || '|' || message || '|' || coalesce(item_id, '-'), chr(10) order by part, a, b) as t
  from placed where again = 1 group by doc_id
), listed as (
  select i.doc_id, count(*) as n, string_agg(printf('item_%06d', global_index) || '|' || global_index || '|' || label || '|' || env || '|' || sha256(content) || '|' || sha256(coalesce(proof, '')) || '|' || s.section_number || '|' || s.section || '|' || s.chapter_number || '|'
    || (select count(*) from issues q where q.doc_id = i.doc_id and q.global_index = i.global_index) || '|' || env, chr(10) order by global_index) as t
  from items i join sections s using (doc_id, section_index) group by i.doc_id
), shown as (select doc_id, chapter_number, chapter, min(global_index) as first from items where chapter <> '' or chapter_number <> '' group by all)
select d.doc_id, 'book' || d.doc_id || '.md' as filename, 'text/markdown' as mime_type, coalesce((select min_by(chapter, first) from shown x where x.doc_id = d.doc_id and chapter <> ''), '') as title,
  coalesce((select string_agg(chapter_number || '|' || chapter, chr(10) order by first) from shown x where x.doc_id = d.doc_id), '') as chapters, coalesce(l.n, 0) as n_items, coalesce(error_count, 0) as error_count,
  coalesce(warning_count, 0) as warning_count, sha256(coalesce(l.t, '')) as items_sha256, sha256(coalesce(e.t, '')) as issues_sha256
from (select distinct doc_id from all_lines) d left join listed l using (doc_id) left join every e using (doc_id)""",
    "plan_clip_overlaps": """with plan as (select l_orderkey as doc_id, cast(l_linenumber as bigint) as position, cast(l_partkey % 60 as int) as s0, greatest(1, least(50, l_partkey % 60)) as s, l_partkey % 60 + l_suppkey % 25 as e0 from lineitem),
p as (select *, greatest(s, least(50, e0)) as e, row_number() over (partition by doc_id order by s0, position, e0) as i from plan),
q as (select *, least(50, i + max(e - i) over (partition by doc_id order by i rows unbounded preceding)) as end_line from p),
r as (select *, coalesce(lag(end_line) over (partition by doc_id order by i), 0) as before from q)
select doc_id, position, i as section_index, case when s > before then s else least(before + 1, 50) end as start_line, end_line from r""",
    "span_nth_occurrence": """with t as (select doc_id, coalesce(text, '') as t, substr(coalesce(text, ''), 1, 2) as a from documents)
select doc_id, case when a <> '' and len(string_split(t, a)) > 2 then length(string_split(t, a)[1]) + length(string_split(t, a)[2]) + length(a) else -1 end as position from t""",
    "span_resolve": """with t as (select doc_id, coalesce(text, '') as t, substr(coalesce(text, ''), 5, 3) as a, case when doc_id % 3 > 0 then substr(coalesce(text, ''), 20, 2) end as b, doc_id % 2 = 0 as inc_a, doc_id % 5 = 0 as inc_b from documents),
p as (select *, case when a <> '' and contains(t, a) then instr(t, a) - 1 end as a_at, case when b is null then length(t) when b <> '' and len(string_split(t, b)) > 2 then length(string_split(t, b)[1]) + length(string_split(t, b)[2]) + length(b) end as b_at from t),
q as (select *, case when inc_a then a_at else a_at + length(a) end as s, case when b is null then length(t) when inc_b then b_at + length(b) else b_at end as e from p),
r as (select *, coalesce(a <> '' and a_at is not null and b_at is not null and e >= s, false) as found from q)
select doc_id, found, case when found then s else -1 end as char_start, case when found then e else -1 end as char_end, case when found then 1 + length(substr(t, 1, s)) - length(replace(substr(t, 1, s), chr(10), '')) else -1 end as line_start, case when found then sha256(substr(t, s + 1, e - s)) else sha256('') end as span_sha256 from r""",
    "source_search": """with t as (select doc_id, coalesce(text, '') as t, substr(coalesce(text, ''), 5, 2) as q from documents),
p as (select doc_id, t, q, string_split(t, q) as x from t where q <> ''),
m as (select doc_id, t, q, cast(list_sum(list_transform(x[1:i], lambda y: length(y))) + (i - 1) * length(q) as bigint) as pos from (select *, unnest(range(1, least(len(x) - 1, 3) + 1)) as i from p))
select doc_id, pos as position, 1 + length(substr(t, 1, pos)) - length(replace(substr(t, 1, pos), chr(10), '')) as line, sha256(substr(t, greatest(pos - 240, 0) + 1, pos - greatest(pos - 240, 0) + length(q) + 240)) as snippet_sha256 from m""",
    "audit_report": f"""with {_AUDITS} select doc_id, '# Consolidated LLM Audit Report' || chr(10) || chr(10) || string_agg('## section' || lpad(cast(i as varchar), 2, '0') || '.json ' || lang || chr(10) || chr(10) || case when audited then 'Quality ' || quality else 'Audit unavailable.' end || chr(10), chr(10) order by i) as markdown from a group by doc_id""",
    "patch_candidates": f"""with {_AUDITS} select doc_id, case when bool_or(acts) then 'localized repair' else 'no change' end as overall_assessment, coalesce(string_agg(id, ',' order by i) filter (where audited and not acts), '') as no_change,
  coalesce(string_agg('{{"id":' || doc || '}}', ',' order by i) filter (where acts), '') as sections, coalesce(string_agg(id || ':' || case when audited then 'keep?' else 'audit result unavailable' end, ',' order by i) filter (where not audited or toxic = 1), '') as defer from a group by doc_id""",
    "usage_by_phase": f"with {_USAGE} select * from usage",
    "usage_total": f"with {_USAGE} select cast(sum(requests) as bigint) as requests, cast(sum(input_tokens) as bigint) as input_tokens, cast(sum(output_tokens) as bigint) as output_tokens, cast(sum(total_tokens) as bigint) as total_tokens, round(sum(elapsed_seconds), 6) as llm_elapsed_seconds from usage",
    "jobs_latest_state": f"with {_LATEST} select user_id, ts, event_id, event_type, value from latest",
    "jobs_unfinished": f"with {_JOBS} select * from jobs where status in ('queued', 'running')",
    "jobs_recent_topk": f"with {_JOBS} select * from jobs where status = 'succeeded' order by updated_at desc, id desc limit 50",
    "jobs_union_list": f"with {_JOBS}, {_LATEST} select * from (select 'md_' || id as id, status, updated_at from jobs union all select 'full_' || user_id, event_type, ts from latest) order by updated_at desc, id desc limit 100",
    "retention_expired": f"with {_JOBS} select j.* from jobs j where status in ('failed', 'succeeded') and updated_at <= timestamp '2024-06-01 00:00:00' - to_days(case when status = 'failed' then 7 when id in (select doc_id from labels) then 90 else 30 end)",
    "saved_annotation_preferred": "select d.doc_id, cast(coalesce(l.quality, -1) as bigint) as quality, case when l.quality is not null then 'saved' else 'generated' end as origin from documents d left join labels l using (doc_id)",
    "ingest_pending": """select o_orderkey as path, o_custkey as digest from orders where o_orderdate <= timestamp '1997-01-01 00:00:00' - interval 30 second
  and not (o_orderkey % 4 > 0 and o_orderkey % 8 <> 1 and (o_orderkey % 4 = 1 or o_orderkey % 5 >= 3 or o_orderdate > timestamp '1997-01-01 00:00:00' - interval 3600 second))""",
    "pages_to_markdown": f"with {_PAGES}, t as (select doc_id, coalesce(string_agg(body, chr(10) || chr(10) order by page_idx) filter (where body <> ''), '') as t from pages_ group by doc_id) select doc_id, length(t) as n_chars, sha256(t) as text_sha256 from t",
    "chunk_page_offset": f"with {_PAGES} select doc_id, page_idx, length(md) as n_chars from pages_",
}
