"""Patterns and word lists, in Java's regular expression syntax.

Flags: ``d`` makes only a line feed end a line, ``U`` gives classes and word boundaries their Unicode meaning,
``iu`` ignores case in all scripts.
"""

from __future__ import annotations

# ---- fixed values: they must be as they are for right results

EN15 = "Definition|Theorem|Corollary|Proposition|Lemma|Example|Exercise|Remark|Algorithm|Assumption|Claim|Conjecture|Problem|Question|Notation"
EN8 = "Definition|Theorem|Corollary|Proposition|Lemma|Example|Exercise|Remark"
CN14 = "定义|定理|命题|引理|推论|例|练习|注记|算法|假设|断言|猜想|问题|记号"
RESULT_WORDS = "Definition|Theorem|Corollary|Proposition|Lemma|Example|Exercise|Remark|Algorithm|Assumption|Claim|Conjecture|Notation|Proof|定义|定理|命题|引理|推论|例|练习|注记|算法|假设|断言|猜想|记号|证明"

CASE, ANY = "(?dU)", "(?diuU)"
HEADING = CASE + r"^\s{0,3}(#{1,6})\s+(.+?)\s*$"
CHAPTER = ANY + r"^(?:chapter|part)\s+([A-Za-z0-9IVXLCDM]+)(?:[\.:])?\s*(.*?)\s*$"
CHAPTER_CN = CASE + r"^第([一二三四五六七八九十百零〇两\d]+)章\s*(.*?)\s*$"
NUMERIC_SECTION = CASE + r"^(\d+(?:\.\d+)*)(?:[\.)])?\s+(.+?)\s*$"
LETTER_SECTION = CASE + r"^([A-Z])(?:[\.)])?\s+(.+?)\s*$"
APPENDIX_SECTION = ANY + r"^Appendix\s+([A-Z])(?:[\.:])?\s*(.*?)\s*$"
NUMBERED_ITEM = ANY + rf"^(?:(?:{EN15})|{CN14})\s*([A-Z]?\d+(?:\.\d+)*)"
RESULT_HEADING = ANY + rf"^(?:{RESULT_WORDS})\b"
PROOF_HEADING = ANY + r"^(?:Proof|证明)\b"
BACK_MATTER = ANY + r"^(?:references|bibliography|acknowledgements?|funding|author contributions?|data availability|conflict of interest|competing interests|index|subject index)\b"
FRONT_MATTER = ANY + r"^(?:abstract|contents|table of contents|preface|foreword)\b"
BARE_NUMBERED = CASE + r"^\s*(\d+(?:\.\d+)*|[A-Z])(?:[\.)])?\s+(.+?)\s*$"
#: What a stripped line's first three characters are, if it is a heading or has BARE_NUMBERED.
MAY_HEAD = CASE + r"^(?:#|\d|[A-Z][\.)]?\s)"
MATHY = CASE + r"(?:\\\(|\\\[|\$|\\[A-Za-z]+|[{}_^=<>])"
ITEM_HEADING = ANY + rf"^\s*(?:#{{1,6}}\s+)?(?:{EN15}|Proof|Try it|Investigate|{CN14}|证明)\b"
ITEM_START = ANY + rf"^(?:#{{1,6}}\s+)?(?:({EN15})\s*([A-Z]?\d+(?:\.\d+)*)?\.?|({CN14})\s*(\d+(?:\.\d+)*)?|(\d+(?:\.\d+)+)\.?\s+({EN8}))\b"
#: What a stripped line's first three characters are, if it has ITEM_START.
ITEM_BEGINS = ANY + rf"^(?:#|\d|{'|'.join(dict.fromkeys(w[:3] for w in EN15.split('|')))}|[{''.join(dict.fromkeys(w[0] for w in CN14.split('|')))}])"
PROOF = ANY + r"^(?:Proof(?:\s+of(?:\s+Theorem)?\s+([A-Z]?\d+(?:\.\d+)*))?[.;:]?|证明)\s*(.*)$"
#: How a line begins that has PROOF, and one that has CONSTRUCTION.
PROOF_BEGINS, CONSTRUCTION_BEGINS = ANY + r"^(?:Proof|证明)", ANY + r"^Construction\."
CONSTRUCTION = ANY + r"^Construction\.\s*(.*)$"
PROOF_OF = ANY + r"Proof of\s+(Theorem|Lemma|Proposition|Corollary|Claim)\s+([A-Z]?\d+(?:\.\d+)*)"
SOURCE_ITEM = "(?dmiuU)" + rf"^\s{{0,3}}(?:#{{1,6}}\s+)?(?:{EN15}|{CN14})\b"
PROOF_MARKER = r"(?dmiuU)^\s{0,3}(?:Proof(?:\s+of\b.*?)?[.;:]?|证明)\b"
TRUNCATED = ANY + r"\[(?:mock )?excerpt truncated\]|\.\.\.\s*$"
PROOF_BOUNDARY = r"(?dmiuU)^\s*(?:Proof|证明)\s*[.:：]?\s*"
CJK = r"[\x{4e00}-\x{9fff}]"

#: Words in a title, in order, and the kind of item that they show.
TITLE_KINDS = [
    ("definition", "def"), ("定义", "def"), ("theorem", "thm"), ("定理", "thm"), ("corollary", "cor"), ("推论", "cor"),
    ("proposition", "prop"), ("命题", "prop"), ("lemma", "lemma"), ("引理", "lemma"), ("example", "example"), ("例", "example"),
    ("exercise", "exercise"), ("练习", "exercise"), ("algorithm", "algorithm"), ("算法", "algorithm"), ("assumption", "assumption"),
    ("claim", "claim"), ("conjecture", "conjecture"), ("problem", "problem"), ("question", "question"), ("notation", "notation"),
    ("remark", "remark"), ("注记", "remark"),
]

#: Kinds of items, with the name that labels show.
DISPLAY = {
    "def": "Definition", "thm": "Theorem", "prop": "Proposition", "lemma": "Lemma", "cor": "Corollary", "remark": "Remark", "example": "Example", "exercise": "Exercise",
    "algorithm": "Algorithm", "assumption": "Assumption", "claim": "Claim", "conjecture": "Conjecture", "problem": "Problem", "question": "Question", "notation": "Notation",
}

#: Other names of the kinds.
ALIASES = {
    "def": "def", "defn": "def", "definition": "def", "definitions": "def", "定义": "def", "thm": "thm", "theorem": "thm", "定理": "thm",
    "prop": "prop", "proposition": "prop", "命题": "prop", "lemma": "lemma", "引理": "lemma", "cor": "cor", "corollary": "cor", "推论": "cor",
    "remark": "remark", "remarks": "remark", "注": "remark", "注记": "remark", "example": "example", "examples": "example", "例": "example",
    "exercise": "exercise", "exercises": "exercise", "练习": "exercise", "algorithm": "algorithm", "算法": "algorithm", "assumption": "assumption", "假设": "assumption",
    "claim": "claim", "断言": "claim", "conjecture": "conjecture", "猜想": "conjecture", "problem": "problem", "问题": "problem", "question": "question",
    "notation": "notation", "记号": "notation",
}

#: How sources name each kind before a number.
SOURCE_NAMES = {
    "def": ("Definition", "Definitions", "Def.", "Def", "定义"), "thm": ("Theorem", "Thm.", "Thm", "定理"), "prop": ("Proposition", "Prop.", "Prop", "命题"),
    "lemma": ("Lemma", "引理"), "cor": ("Corollary", "Cor.", "Cor", "推论"), "remark": ("Remark", "Remarks", "注", "注记"), "example": ("Example", "例"),
    "exercise": ("Exercise", "Exercises", "练习"), "algorithm": ("Algorithm", "算法"), "assumption": ("Assumption", "假设"), "claim": ("Claim", "断言"),
    "conjecture": ("Conjecture", "猜想"), "problem": ("Problem", "问题"), "question": ("Question",), "notation": ("Notation", "记号"),
}
SOURCE_NUMBER = r"((?:[IVXLCDM]+|\d+[A-Za-z]?|[A-Z])(?:\.(?:[IVXLCDM]+|\d+[A-Za-z]?|[A-Z]))*)"

#: Types of annotated items, and other names of some.
TYPES = ["def", "thm", "prop", "lemma", "cor", "remark", "example", "exercise", "algorithm", "assumption", "claim", "conjecture", "problem", "question", "notation", "heading", "paragraph", "proof", "figure", "table", "unknown"]
TYPE_ALIASES = {"defn": "def", "definition": "def", "theorem": "thm", "proposition": "prop", "corollary": "cor", "remarks": "remark", "examples": "example", "exercises": "exercise"}

CHINESE_DIGITS = {"零": 0, "〇": 0, "一": 1, "二": 2, "两": 2, "三": 3, "四": 4, "五": 5, "六": 6, "七": 7, "八": 8, "九": 9}
LONG_SECTION = 45_000
SCHEMA_VERSION = "md2json.annotation.v1"
WARN_NO_SECTIONS = "no explicit section headings found; converted the body as one section"
WARN_SYNTHETIC = "created a synthetic first section from material before the first explicit section heading"
ISSUE_EMPTY, ISSUE_NO_LABEL = "该条目内容为空", "该条目缺少编号或名称"
ISSUE_DUPLICATE, ISSUE_DEPENDENCY = "编号或名称重复：", ("引用 ", "，但未找到对应条目")

#: What the span builder says of raw items.
ERROR_ITEM, ERROR_NO_SPAN, ERROR_EMPTY = "Extractor item ", " missing content_span.", " produced an empty content span."
ERROR_CONTENT, ERROR_PROOF = "Could not extract content span for ", "Could not extract proof span for "
ERROR_EMPTY_TEXT, ERROR_NOT_IN_SOURCE = "Mock API item cannot build an empty source span.", "Mock API item text is not present in the source: "
#: What a repair's actions may be.
ACTIONS, ANCHOR_POSITIONS = ("add", "update", "delete"), ("before", "after", "replace")
NO_AUDIT = ("\n\nShort verdict: no change\n\nCurrent JSON summary: ", " item(s).\n\nFindings: mock audit did not perform semantic review.\n\nCompact action summary: no actions.")
#: What is wrong with a submitted annotation.
BAD_OBJECT, BAD_VERSION = "Annotation payload must be a JSON object.", f"Only schema_version={SCHEMA_VERSION} is accepted."
BAD_SOURCE, BAD_SOURCE_TYPE = "Annotation payload must include source object.", "Annotation source.source_type does not match the conversion job."
BAD_ITEMS, BAD_QUALITY = "Annotation payload must include items array.", "Annotation quality must be an object when provided."
BAD_ITEM, BAD_ITEM_OBJECT, BAD_ITEM_ID, BAD_DUPLICATE = "Annotation item at index ", " must be an object.", " must include a non-empty id.", "Duplicate annotation item id: "
#: Fields of an OCR answer that may have Markdown, in order.
OCR_TEXTS, OCR_LINES, OCR_LINE_TEXTS = ("md", "markdown", "text", "content"), ("texLines", "lines", "blocks"), ("md", "markdown", "text", "content", "latex", "line")
EXPORT_NAME_BYTES = 50

#: Warnings of splitting, quality and spans, and texts of audit reports.
WARN_TRUNCATED = ": content appears truncated"
WARN_PROOF_LEFT = ": proof marker remains in content while proof is null"
WARN_NO_ITEMS = "source has theorem-like markers but extractor returned no items"
WARN_FEW_ITEMS = "source has %d theorem-like markers but only %d extracted item(s)"
WARN_REMARKS_ONLY = "all extracted items are remark despite multiple theorem-like source markers"
WARN_NO_PROOFS = "source has explicit proof markers but no item has a proof field"
WARN_LABELS = "duplicate labels: "
WARN_ALL_REMARKS = "all extracted items are remark"
WARN_SECTION_NUMBER = "duplicate section number detected: "
WARN_LONG_SECTION = "section %02d is very long (%d chars); consider smaller chunks"
WARN_PLAN_EMPTY = "LLM structure plan had no sections; used hard splitter fallback"
WARN_PLAN_ORDER = "LLM structure sections were not sorted; sorted by start_line"
WARN_PLAN_MOVED = "Adjusted overlapping section start for section %d."
WARN_PLAN_END = "Adjusted invalid end_line for section %d."
SPAN_NO_START = "empty start_anchor"
SPAN_START_MISSING = "start_anchor not found: '"
SPAN_START_EARLY = "start_anchor occurrence resolved before search_start"
SPAN_NO_END = "empty end_anchor"
SPAN_END_MISSING = "end_anchor occurrence not found: '"
SPAN_END_EARLY = "end anchor resolved before start anchor"
AUDIT_MISSING = "Audit unavailable."
AUDIT_TITLE = "# Consolidated LLM Audit Report\n\n"
AUDIT_DEFERRED = "audit result unavailable"
PATCH_SOME = "localized repair"
PATCH_NONE = "no change"
#: Folders of kinds of jobs.
JOB_FOLDERS = ("doc2x", "full")
ERROR_PAGE_SIZE = "Single PDF page exceeds Doc2X upload byte limit: page=%d bytes=%d"
COLLECTED = ("markdown", "full", "annotation", "debug")
TOOLS = ("list_source_item_labels", "search_source", "extract_source_span", "build_repaired_items")
TOOL_NOTE = "Labels are model-declared; the tool only checked literal anchors."
TOOL_UNKNOWN = "Unknown audit source tool: "
TOOL_WARNINGS = "\n\nSource-span validation warnings:\n"
TOOL_NO_AUDIT = ": audit repaired with source span tools."
TOOL_NO_RESULT = "Audit tool workflow ended without build_repaired_items."

# ---- what a model is told between turns, in words of our own
TOOL_CONTINUE = "Go on with the source tools; when the evidence is there, build the final items, all of them."
TOOL_MUST_BUILD = "Build the final items now: all that stay, unchanged ones by their current label, others by spans of the source."
