"""DuckDB SQL for the queries of this package that SQL can express."""

_LINE_MARKED = r"""
with lines as (
  select doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i from documents)
), owners as (
  select key, min(doc_id) as owner from lines where length(key) >= 10 group by key having count(distinct doc_id) >= 2
), marked as (
  select l.doc_id, l.i, l.line, coalesce(o.owner <> l.doc_id, false) as dropped from lines l left join owners o on l.key = o.key
)
"""

_LINE_DEDUP = r"""
select doc_id, count(*) as n_lines, cast(count(*) filter (where dropped) as bigint) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not dropped), '')) as kept_sha256
from marked group by doc_id
"""

_QUALITY_BITS = r"""
with split as (
  select doc_id, coalesce(text, '') as t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents
), windows as (
  select doc_id, i, array_to_string(words[i:i + 4], ' ') as w from (select doc_id, words, unnest(range(1, len(words) - 3)) as i from split)
), repeated as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, w) as n from windows) where n > 1
), covered as (
  select doc_id, sum(n) as n from (select doc_id, least(5, coalesce(lead(i) over (partition by doc_id order by i) - i, 5)) as n from repeated) group by doc_id
), measured as (
  select s.doc_id, cast(len(words) as bigint) as n_words, cast(length(translate(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) as bigint) as word_chars,
    cast(length(t) - length(translate(t, '#*$%&|<>', '')) as bigint) as n_symbols, len(lines) as n_lines,
    cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines, cast(coalesce(c.n, 0) as bigint) as n_repeat_words,
    length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) as n_upper
  from split s left join covered c on s.doc_id = c.doc_id
), bits as (
  select *, cast(case when n_words < 10 then 1 else 0 end + case when 100 * n_repeat_words > 20 * n_words then 2 else 0 end
    + case when 100 * n_symbols > 25 * n_words then 4 else 0 end + case when n_lines >= 4 and 100 * n_dup_lines > 40 * n_lines then 8 else 0 end
    + case when n_words >= 10 and 100 * n_upper > 60 * word_chars then 16 else 0 end
    + case when n_words >= 10 and (word_chars < 2 * n_words or word_chars > 20 * n_words) then 32 else 0 end as bigint) as fail_bits
  from measured
)
"""

_QUALITY_LEDGER = r"""
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 as base_failed, fail_bits = 0 as kept, fail_bits from bits
"""

_ABLATIONS = """
, rules as (select unnest(['few_words', 'repeated_words', 'symbols', 'repeated_lines', 'upper_case', 'word_length']) as rule, unnest([1, 2, 4, 8, 16, 32]) as bit)
select rule, count(*) filter (where fail_bits & bit <> 0) as n_failed, count(*) filter (where fail_bits = bit) as n_only_this,
  count(*) filter (where fail_bits = 0 or fail_bits = bit) as n_kept_without, count(*) as n_documents
from bits cross join rules group by rule
"""

_WARC = """
with p as (select page_id, coalesce(html, '') as html, min(page_id) over (partition by coalesce(html, '')) as first from pages),
q as (select *, octet_length(encode(html)) >= 100 and page_id <> first as again from p)
select page_id, cast(octet_length(encode(html)) as bigint) as payload_bytes, sha256(html) as payload_digest, case when again then 'revisit' else 'response' end as record_type, case when again then first end as refers_to from q
"""

# all pairs by their shared shingles, and the closure of the links
_LINKS = r"""
with recursive w as (select doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}\p{M}]+') as ws from documents),
d as (select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')] else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) end) as g from w),
n as (select doc_id, count(*) as n from d group by doc_id),
pairs as (select a.doc_id as x, b.doc_id as y, count(*) as c from d a join d b on a.g = b.g and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id),
links as (select x, y from pairs join n nx on nx.doc_id = x join n ny on ny.doc_id = y where 5 * c >= 4 * (nx.n + ny.n - c)),
reach(x, y) as (select x, y from links union select r.x, l.y from reach r join links l on r.y = l.x),
classes as (select x as doc_id, least(x, min(y)) as class_id from reach group by x)
"""

_JACCARD = """
select w.doc_id, coalesce(c.class_id, w.doc_id) as class_id, coalesce((select count(*) from links l where l.x = w.doc_id), 0) as n_links,
  case when len(ws) = 0 then w.doc_id else min(w.doc_id) over (partition by array_to_string(ws, ' ')) end as copy_of
from w left join classes c on c.doc_id = w.doc_id
"""

_EITHER_CASE = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))


def _spans(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    p = "'" + pattern.replace("'", "''") + "'"
    return f"""select doc_id, '{kind}' as kind, {rank} as rank, coalesce(list_sum(list_transform(parts[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) as start, length(m[i]) as size
  from (select *, unnest(range(1, len(m) + 1)) as i from (select doc_id, string_split_regex(t, {p}) as parts, regexp_extract_all(t, {p}, 0) as m, regexp_extract_all(t, {p}, {group}) as g from t where regexp_matches(t, {p}))) where length(g[i]) >= {least}"""


_SECRETS_BASE = f"""
with t as (select doc_id, coalesce(text, '') as t from documents), spans as (
  {_spans("assign", 0, "(" + _EITHER_CASE + ")" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12)}
  union all {_spans("access", 1, "AKIA[A-Z0-9]+", 0, 18)}
  union all {_spans("hex", 2, "[0-9a-f]+", 0, 16)}
)
select t.doc_id, count(*) filter (where kind = 'assign') as n_assign, count(*) filter (where kind = 'access') as n_access, count(*) filter (where kind = 'hex') as n_hex,
  sha256(coalesce(string_agg(kind || ':' || cast(start as bigint) || ':' || cast(start + size as bigint), ',' order by start, rank), '')) as base_sha256
from t left join spans s on t.doc_id = s.doc_id group by t.doc_id
"""

_URL_RULES = r"""
with r as (select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
p as (select page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from r),
rules as (select unnest(['net', 'example.net', 'example.com', 'org']) as own, unnest(['/', '/en/', '/de/', '/fr/']) as below)
select page_id, host, path, (select arg_max(own || below, length(own || below)) from rules where (host = own or ends_with(host, '.' || own)) and starts_with(path, below)) as rule from p
"""

#: What the first three stages of the pipeline keep.
PIPELINE_KEPT = (
    _QUALITY_BITS.replace("with split", "with recursive split", 1)
    + ", d1 as (select d.* from documents d join bits b on d.doc_id = b.doc_id where fail_bits = 0)"
    + _LINE_MARKED.replace("\nwith lines", ", lines", 1).replace("from documents", "from d1")
    + ", d2 as (select doc_id, coalesce(string_agg(line, chr(10) order by i) filter (where not dropped), '') as text from marked group by doc_id)"
    + _LINKS.replace("\nwith recursive w", ", w", 1).replace("from documents", "from d2")
    + "select d2.doc_id, sha256(text) as text_sha256 from d2 left join classes c on c.doc_id = d2.doc_id where coalesce(c.class_id, d2.doc_id) = d2.doc_id"
)

# all strings of 200 bytes, as 400 hexadecimal digits; gaps and islands of the covered bytes
_REPEATS = """
with h as (select doc_id, hex(encode(coalesce(text, ''))) as x from documents),
places as (select doc_id, x, unnest(range(octet_length(encode(x)) // 2 - 199)) as i from h where octet_length(encode(x)) >= 400),
windows as (select doc_id, i, md5_number(substr(x, 2 * i + 1, 400)) as w from places),
again as (select w from windows group by w having count(*) > 1),
hits as (select distinct doc_id, i from windows where w in (select w from again)),
marked as (select doc_id, i, case when i <= lag(i) over (partition by doc_id order by i) + 200 then 0 else 1 end as new from hits),
numbered as (select doc_id, i, sum(new) over (partition by doc_id order by i) as k from marked),
spans as (select doc_id, k, min(i) as a, max(i) + 200 as b from numbered group by doc_id, k),
pieces as (select doc_id, lag(b, 1, 0) over (partition by doc_id order by a) as f, a as t from spans union all select doc_id, max(b), null from spans group by doc_id),
kept as (select doc_id, string_agg(substr(x, 2 * f + 1, coalesce(2 * (t - f), length(x))), '' order by f) as y from pieces join h using (doc_id) group by doc_id),
removed as (select doc_id, cast(sum(b - a) as bigint) as n_removed, count(*) as n_spans from spans group by doc_id)
select h.doc_id, cast(length(x) // 2 as bigint) as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(y, x))) as kept_sha256
from h left join kept using (doc_id) left join removed using (doc_id)
"""

# crc32 is linear: every byte adds what it becomes through the bytes after it; near words share a mask (a code point replaced by _) or a gap (_ put in)
_SPELLING = """
with recursive steps(b, v, i) as (
  select cast(b as bigint), cast(b as bigint), 0 from (select unnest(range(256)) as b)
  union all select b, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end, i + 1 from steps where i < 8
), crc as materialized (select b, v from steps where i = 8),
runs as materialized (
  select doc_id, run, coalesce(cast(doc_id as varchar), '') || ':' || run as message, count(*) as n
  from (select doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run from documents) group by doc_id, run
), longest as (select max(octet_length(encode(message))) as n from runs),
moved(m, b, v) as (
  select 0, b, v from crc union all select m + 1, z.b, xor(t.v, z.v >> 8) from moved z join crc t on t.b = z.v & 255 where m < (select n from longest)
), begun(m, v) as (
  select 0, cast(4294967295 as bigint) union all select m + 1, xor(t.v, z.v >> 8) from begun z join crc t on t.b = z.v & 255 where m < (select n from longest)
), bytes as (
  select message, size, size - 1 - i as m, cast('0x' || substr(hexed, 2 * i + 1, 2) as bigint) as b from (
    select message, hexed, length(hexed) // 2 as size, unnest(range(length(hexed) // 2)) as i from (select distinct message, hex(encode(message)) as hexed from runs)
  )
), hashed as (
  select message, xor(xor(bit_xor(z.v), any_value(s.v)), 4294967295) as h from bytes y join moved z on z.m = y.m and z.b = y.b join begun s on s.m = size group by message
), changed as (
  select case when h % 199 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, n from runs join hashed using (message)
), words as materialized (
  select word, cast(sum(n) as bigint) as n from changed where length(word) >= 6 group by word having sum(n) >= 5
), masks as materialized (
  select word, n, substr(word, 1, i) || '_' || substr(word, i + 2) as mask from (select word, n, unnest(range(length(word))) as i from words)
), gaps as materialized (
  select word, n, substr(word, 1, i) || '_' || substr(word, i + 1) as mask from (select word, n, unnest(range(length(word) + 1)) as i from words)
), pairs as materialized (
  select a.word, a.n, b.word as near, b.n as near_n from masks a join masks b on a.mask = b.mask and a.word <> b.word
  union select a.word, a.n, b.word, b.n from masks a join gaps b on a.mask = b.mask
  union select a.word, a.n, b.word, b.n from gaps a join masks b on a.mask = b.mask
), best as (select word, n, count(*) as n_near, arg_min(near, (-near_n, near)) as near, max(near_n) as near_n from pairs group by word, n),
forms as materialized (select w.word, w.n, coalesce(n_near, 0) as n_near, case when near_n >= 5 * w.n then near end as form, case when near_n >= 5 * w.n then near_n end as form_n from words w left join best b on b.word = w.word),
chains(word, place, depth) as (select word, word, 0 from forms union all select c.word, f.form, depth + 1 from chains c join forms f on f.word = c.place where f.form is not null)
select f.word, f.n, f.form, c.root, f.n_near, f.form_n from forms f join (select word, arg_max(place, depth) as root from chains group by word) c on c.word = f.word
"""

# six rounds of assignment and means; every step is a table, as the next one reads it twice
_CODES_START = """
with kept as materialized (
  select vec_id, label, list_transform(embedding, lambda x: cast(floor(4096 * cast(x as double)) as bigint)) as v from embeddings
  where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), parts as materialized (
  select vec_id, label, p, v[p * (len(v) // 8) + 1:(p + 1) * (len(v) // 8)] as x from kept cross join (select unnest(range(8)) as p)
), books0 as materialized (
  select p, e, x as c from parts join (select vec_id, row_number() over (order by vec_id) - 1 as e from kept order by vec_id limit 16) using (vec_id)
)"""
_CODES_NEAREST = """, {name} as materialized (
  select vec_id, label, p, arg_min(e, (d, e)) as e, min(d) as d, any_value(x) as x from (
    select vec_id, label, p, e, x, cast(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as bigint) as d from parts join {books} using (p)
  ) group by vec_id, label, p
)"""
_CODES_ROUND = """, books{next} as materialized (
  select p, e, coalesce(m.c, b.c) as c from books{this} b left join (
    select p, e, list(cast(floor_mean as bigint) order by i) as c from (
      select p, e, i, (sum(y) - ((sum(y) % count(*)) + count(*)) % count(*)) // count(*) as floor_mean from (select p, e, unnest(x) as y, unnest(range(len(x))) as i from near{this}) group by p, e, i
    ) group by p, e
  ) m using (p, e)
)"""
_CODES = (
    _CODES_START
    + "".join(_CODES_NEAREST.format(name=f"near{i}", books=f"books{i}") + _CODES_ROUND.format(this=i, next=i + 1) for i in range(6))
    + _CODES_NEAREST.format(name="final", books="books6")
    + """, coded as (select vec_id, label, string_agg(printf('%02x', e), '' order by p) as code, cast(sum(d) as bigint) as error from final group by vec_id, label)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, (select sha256(string_agg(array_to_string(c, ','), ',' order by p, e)) from books6) as codebooks_sha256 from coded
"""
)

ORACLES = {"op2_line_dedup": _LINE_MARKED + _LINE_DEDUP, "op4_warc": _WARC, "op7_ngram_jaccard": _LINKS + _JACCARD, "op8_quality_rules": _QUALITY_BITS + _QUALITY_LEDGER, "secrets_base": _SECRETS_BASE, "url_rules": _URL_RULES, "quality_rules_ablations": _QUALITY_BITS + _ABLATIONS, "op11_suffix_dedup": _REPEATS, "op12_spelling_variants": _SPELLING, "op13_vector_codes": _CODES}
