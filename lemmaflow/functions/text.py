"""Column functions over titles, lines and numbers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_
from typing import ClassVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lemmaflow.functions import patterns as R


#: What ``\s`` matches in all scripts.
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: An end of a line.
LINE_END = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
#: The ends of lines but the line feed.
OTHER_ENDS = "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, wherever it is named."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(x: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.btrim(x, F.lit(SPACES))


def clean(x: Column) -> Column:
    """Stripped, with every run of white space as one space."""
    return F.regexp_replace(strip(x), r"(?U)\s\s+|[\s&&[^ ]]", " ")


def matches(x: Column, pattern: str) -> Column:
    return F.rlike(x, F.lit(pattern))


def part(x: Column, pattern: str, group: int) -> Column:
    """A group of the first match; empty without one."""
    return F.regexp_extract(x, pattern, group)


def lookup(x: Column, table: dict) -> Column:
    """The value of x in a small table, else null."""
    return F.element_at(F.create_map(*(F.lit(y) for kv in table.items() for y in kv)), x)


def split_lines(text: Column) -> Column:
    """Lines as Python's splitlines gives them: all line ends count, the last one makes no empty line, the empty text has none."""
    # the pattern goes through a text by its characters, so it is for the few that need it
    other = lambda x: reduce(or_, (F.contains(x, F.lit(c)) for c in OTHER_ENDS))
    one_end = let(F.coalesce(text, F.lit("")), lambda x: F.when(other(x), F.regexp_replace(x, "[\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029](?:(?<=\r)\n)?", "\n")).otherwise(x))
    # a generator computes what it is given as often as it is named
    return let(F.split(one_end, "\n", -1), lambda found: F.when(F.element_at(found, -1) == "", F.slice(found, 1, F.size(found) - 1)).otherwise(found))


def first_lines(text: Column, n: int) -> Column:
    """The first ``n`` lines at most, of which the last one may be an empty one that ``split_lines`` doesn't have; the rest of the text isn't cut."""
    # as many lines end at the n-th line feed at the latest
    return F.slice(F.split(F.substring_index(F.coalesce(text, F.lit("")), "\n", n), LINE_END, n + 1), 1, n)


def join_lines(lines: Column, start: Column, end: Column) -> Column:
    """Lines from ``start`` (from 1) to before ``end``, clamped."""
    first = F.greatest(start, F.lit(1))
    return F.array_join(F.slice(lines, first, F.greatest(F.least(end, F.size(lines) + 1) - first, F.lit(0))), "\n")


def chinese_number(x: Column) -> Column:
    """A numeral below one hundred in digits; digits and what else there is stay as they are."""
    left, right = F.substring_index(x, "十", 1), F.substring(x, F.instr(x, "十") + 1, F.length(x))
    digit = lambda c: lookup(c, R.CHINESE_DIGITS)
    tens = F.when(left == "", 1).otherwise(F.coalesce(digit(left), F.lit(1)))
    return F.when(matches(x, r"^\d+$"), x).when(x == "十", "10").when(F.contains(x, F.lit("十")), (tens * 10 + F.coalesce(digit(right), F.lit(0))).cast("string")).otherwise(F.coalesce(digit(x).cast("string"), x))


@dataclass(frozen=True)
class Title:
    """A title and, for each pattern, its two groups, the second one stripped. A first group has a character at least, so an empty one is no match."""

    text: Column
    parts: dict[str, tuple[Column, Column]]

    PATTERNS: ClassVar[dict[str, str]] = {"chapter": R.CHAPTER, "chinese": R.CHAPTER_CN, "appendix": R.APPENDIX_SECTION, "numeric": R.NUMERIC_SECTION, "letter": R.LETTER_SECTION}

    @classmethod
    def of(cls, title: Column) -> Title:
        return cls(title, {n: (part(title, p, 1), strip(part(title, p, 2))) for n, p in cls.PATTERNS.items()})

    def has(self, name: str) -> Column:
        return self.parts[name][0] != ""

    def chapter_number(self) -> Column:
        """The number of a chapter heading, else null."""
        return F.when(self.has("chapter"), self.parts["chapter"][0]).when(self.has("chinese"), chinese_number(self.parts["chinese"][0]))

    def chapter_title(self, number: Column) -> Column:
        """``Chapter N. rest`` of a chapter heading, else null."""
        rest = F.when(self.has("chapter"), self.parts["chapter"][1]).otherwise(self.parts["chinese"][1])
        return F.concat(F.lit("Chapter "), number, F.when(rest != "", F.concat(F.lit(". "), rest)).otherwise(""))

    def kind(self) -> Column:
        """appendix, numeric or letter for a cleaned title that heads a section, else null."""
        rest = self.parts["letter"][1]
        item = matches(rest, R.RESULT_HEADING) & (matches(rest, R.NUMBERED_ITEM) | matches(rest, R.PROOF_HEADING))
        sentence = matches(self.text, r"[.?!;:]$") & (F.length(self.text) > 80)
        none = F.lit(None).cast("string")
        return (
            F.when((self.text == "") | matches(self.text, R.BACK_MATTER) | matches(self.text, R.RESULT_HEADING), none)
            .when(self.has("appendix"), "appendix")
            .when(self.has("numeric"), F.when(~matches(self.parts["numeric"][1], R.RESULT_HEADING), "numeric"))
            .when(self.has("letter") & ~sentence, F.when(~item | F.startswith(F.lower(rest), F.lit("proof of")), "letter"))
        )

    def mark(self, kind: Column) -> Column:
        """A section's own number or letter."""
        return F.when(kind == "appendix", self.parts["appendix"][0]).when(kind == "numeric", self.parts["numeric"][0]).when(kind == "letter", self.parts["letter"][0])

    def name(self, kind: Column) -> Column:
        """A section's title without its number."""
        letter, own = self.parts["appendix"]
        return F.when(kind == "appendix", F.when(own != "", own).otherwise(F.concat(F.lit("Appendix "), letter))).when(kind == "numeric", self.parts["numeric"][1]).when(kind == "letter", self.parts["letter"][1])


def with_title(df: DataFrame, title: Column) -> DataFrame:
    """Adds what a cleaned title shows, each pattern matched once: title, kind, mark, name (of a section), own_chapter and own_number (of a chapter).

    The steps are columns of their own, which later expressions only name; filters on them belong behind a shuffle, or they are
    put before it with all of this once more.
    """
    names = [f"__lf_{n}{g}" for n in Title.PATTERNS for g in (1, 2)]
    own = Title(F.col("title"), {n: (F.col(f"__lf_{n}1"), F.col(f"__lf_{n}2")) for n in Title.PATTERNS})
    parsed = Title.of(F.col("title")).parts
    step = df.withColumn("title", title).withColumns({f"__lf_{n}{g}": parsed[n][g - 1] for n in Title.PATTERNS for g in (1, 2)})
    step = step.withColumns({"kind": own.kind(), "own_number": own.chapter_number()})
    return step.withColumns({"mark": own.mark(F.col("kind")), "name": own.name(F.col("kind")), "own_chapter": own.chapter_title(F.col("own_number"))}).drop(*names)


def chapter_number(title: Column) -> Column:
    return Title.of(title).chapter_number()


def section_kind(title: Column) -> Column:
    return Title.of(title).kind()


def section_number(kind: Column, mark: Column, chapter: Column) -> Column:
    """A section's number; letters follow their chapter's."""
    return F.when((kind == "letter") & (chapter != ""), F.concat(chapter, F.lit("."), mark)).otherwise(mark)


def is_back_matter(title: Column) -> Column:
    return matches(clean(title), R.BACK_MATTER)


def heading_like(text: Column, math: Column | bool) -> Column:
    """A short text that doesn't end as a sentence; formulas only where ``math`` allows them."""
    x = clean(text)
    plain = F.lit(math) if isinstance(math, bool) else math
    return (x != "") & (F.length(x) <= 110) & ~matches(x, r"[.。;；,，]$") & (plain | ~matches(x, R.MATHY)) & ~((F.length(x) > 55) & matches(x, r"[，,;；:：。.!?？]"))


def previous_number(number: Column) -> Column:
    """The number before in its last place, if that is over 0; else null."""
    last = F.element_at(F.split(number, r"\."), -1)
    lower = F.when(matches(last, r"^\d+$"), last.cast("decimal(38,0)") - 1)
    head = F.when(F.contains(number, F.lit(".")), F.regexp_replace(number, r"[^.]*$", "")).otherwise("")
    return F.when(lower > 0, F.concat(head, lower.cast("string")))


def qualified_number(number: Column, chapter: Column) -> Column:
    has = (number != "") & (chapter != "") & (number != chapter) & ~F.startswith(number, F.concat(chapter, F.lit(".")))
    return F.when(has & matches(number, r"^\d+(?:\.\d+)*$"), F.concat(chapter, F.lit("."), number)).otherwise(number)


def item_kind(title: Column) -> Column:
    """The kind of item that a title's words show; the first rule that fits wins."""

    def kind_of(low: Column) -> Column:
        out = F.when(F.contains(low, F.lit(R.TITLE_KINDS[0][0])), R.TITLE_KINDS[0][1])
        for word, kind in R.TITLE_KINDS[1:]:
            out = out.when(F.contains(low, F.lit(word)), kind)
        return out.otherwise("remark")

    # each rule would lower the title anew
    return let(F.lower(title), kind_of)


def normal_kind(raw: Column) -> Column:
    """One of the 15 kinds: the name itself, or an alias in any case, else remark."""
    x = strip(F.coalesce(raw, F.lit("")))
    return F.when(x.isin(*R.DISPLAY), x).otherwise(F.coalesce(lookup(F.lower(x), R.ALIASES), F.lit("remark")))


def item_type(raw: Column) -> Column:
    x = F.lower(strip(F.when(F.coalesce(raw, F.lit("")) == "", "unknown").otherwise(raw)))
    x = F.coalesce(lookup(x, R.TYPE_ALIASES), x)
    return F.when(x.isin(*R.TYPES), x).otherwise("unknown")


def _first_line_number() -> str:
    words = sorted((w for names in R.SOURCE_NAMES.values() for w in names), key=len, reverse=True)
    return R.ANY + rf"^\s*({'|'.join(w.replace('.', chr(92) + '.') for w in words)})(?![A-Za-z])\s*([:：.]?)\s*{R.SOURCE_NUMBER}(?=[\s.:：)）(]|$)"


def inferred_number(first: Column, kind: Column) -> Column:
    """The number that an item's first line shows after its kind's name, as components; else none. ``first``: see ``first_line``.

    One pattern has the names of all kinds, no two of which share a name.
    """
    pattern, kinds = _first_line_number(), {w.lower(): k for k, names in R.SOURCE_NAMES.items() for w in names}
    word = F.translate(F.lower(part(first, pattern, 1)), "ſ", "s")
    parts = F.filter(F.split(part(first, pattern, 3), r"\."), lambda p: p != "")
    lone = (part(first, pattern, 2) == ".") & (F.size(parts) == 1) & matches(F.get(parts, F.lit(0)), r"^[A-Za-z]$")
    return F.when((lookup(word, kinds) == kind) & ~lone, parts).otherwise(F.array().cast("array<string>"))


def first_line(content: Column) -> Column:
    """An item's first line without heading marks and emphasis before its words."""
    return F.regexp_replace(F.coalesce(F.get(first_lines(content, 1), F.lit(0)), F.lit("")), r"(?U)^\s*(?:#{1,6}\s*)?[*_`]+", "")


def nth_position(text: Column, anchor: Column, n: Column) -> Column:
    """Where (from 0) the n-th non-overlapping occurrence of ``anchor`` begins, in code points; null if there is none.

    The text between the start and the n-th match is what ``split`` by the quoted anchor gives before it, joined again.
    """
    pieces = F.split(text, F.concat(F.lit(r"\Q"), F.regexp_replace(anchor, r"\\E", r"\\E\\\\E\\Q"), F.lit(r"\E")), -1)
    before = F.aggregate(F.slice(pieces, 1, n), F.lit(0), lambda a, x: a + F.length(x))
    return F.when((anchor != "") & (F.size(pieces) > n), before + (n - 1) * F.length(anchor))


def positions(text: Column, query: Column, most: int) -> Column:
    """Where (from 0) the first ``most`` non-overlapping occurrences of ``query`` begin, in code points; none for an empty query."""
    pieces = F.split(text, F.concat(F.lit(r"\Q"), F.regexp_replace(query, r"\\E", r"\\E\\\\E\\Q"), F.lit(r"\E")), most + 1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("found"))

    def step(acc: Column, piece: Column) -> Column:
        at = acc["at"] + F.length(piece)
        return F.struct((at + F.length(query)).alias("at"), F.concat(acc["found"], F.array(at)).alias("found"))

    return F.when(query != "", F.aggregate(F.slice(pieces, 1, F.size(pieces) - 1), start, step)["found"]).otherwise(F.array().cast("array<int>"))


def mime_type(name: Column, source: Column) -> Column:
    ends = lambda *xs: F.rlike(F.lower(name), F.lit(r"\.(" + "|".join(xs) + ")$"))
    return F.when((source == "pdf") | ends("pdf"), "application/pdf").when(ends("md"), "text/markdown").when(ends("jpe?g"), "image/jpeg").when(ends("png"), "image/png").otherwise("application/octet-stream")
