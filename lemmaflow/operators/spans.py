"""Literal source spans: anchors to positions, clipping at the next item, source-backed text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lemmaflow.functions import text as T
from lemmaflow.functions import patterns as R


def resolved(rows: DataFrame, search_start: Column | None = None) -> DataFrame:
    """Rows with a ``text``, its ``start_line`` and a span (start_anchor, end_anchor or null, start_occurrence, end_occurrence, include_start, include_end)
    get found, error, char_start, char_end (from 0), line_start, line_end and span_text. Occurrences count from the start of the text, without overlaps."""
    text, a, b = F.col("text"), F.coalesce("start_anchor", F.lit("")), F.col("end_anchor")
    times = lambda c: F.greatest(F.lit(1), F.coalesce(c, F.lit(1)))
    low = F.greatest(F.lit(0), F.least(F.length(text), search_start if search_start is not None else F.lit(0)))
    out = rows.withColumns({"a_at": T.nth_position(text, a, times("start_occurrence")), "b_at": F.when(b.isNull(), F.length(text)).otherwise(T.nth_position(text, b, times("end_occurrence")))})
    begin = F.when(F.coalesce("include_start", F.lit(False)), F.col("a_at")).otherwise(F.col("a_at") + F.length(a))
    end = F.when(b.isNull(), F.length(text)).when(F.coalesce("include_end", F.lit(False)), F.col("b_at") + F.length(b)).otherwise(F.col("b_at"))
    out = out.withColumns({"begin": begin, "end": end})
    error = (
        F.when(a == "", R.SPAN_NO_START).when(F.col("a_at").isNull(), F.concat(F.lit(R.SPAN_START_MISSING), F.substring(a, 1, 80), F.lit("'"))).when(F.col("a_at") < low, R.SPAN_START_EARLY)
        .when(b == "", R.SPAN_NO_END).when(F.col("b_at").isNull(), F.concat(F.lit(R.SPAN_END_MISSING), F.substring(b, 1, 80), F.lit("'"))).when(F.col("end") < F.col("begin"), R.SPAN_END_EARLY)
    )
    line = lambda at: F.col("start_line") + F.length(F.substring(text, F.lit(1), at)) - F.length(F.replace(F.substring(text, F.lit(1), at), F.lit("\n"), F.lit("")))
    good = F.col("error").isNull()
    done = out.withColumn("error", error).withColumns({
        "found": good, "char_start": F.when(good, F.col("begin")), "char_end": F.when(good, F.col("end")), "line_start": F.when(good, line(F.col("begin"))), "line_end": F.when(good, line(F.greatest(F.col("begin"), F.col("end") - 1))),
        "span_text": F.when(good, F.substring(text, F.col("begin") + 1, F.col("end") - F.col("begin"))),
    })
    return done.drop("a_at", "b_at", "begin", "end")


def searched(rows: DataFrame, most: int | Column = 5, around: int = 240) -> DataFrame:
    """A row for each of the first ``most`` (1 at least) literal, non-overlapping matches of ``query`` in ``text``: offset (from 0), line and
    snippet, which has ``around`` code points on both sides, besides the rows' own columns. Null texts and queries are empty; an empty query has no matches."""
    text, query = F.coalesce("text", F.lit("")), F.coalesce("query", F.lit(""))
    at, low = F.col("offset"), F.greatest(F.lit(0), F.col("offset") - around)
    head = F.substring(text, F.lit(1), at)
    found = rows.select("*", F.explode(T.positions(text, query, F.greatest(F.lit(1), F.lit(most)))).alias("offset"))
    line = F.col("start_line") + F.length(head) - F.length(F.replace(head, F.lit("\n"), F.lit("")))
    return found.withColumns({"line": line, "snippet": F.substring(text, low + 1, at - low + F.length(query) + around)})


def clipped_to_next(rows: DataFrame, kind: str) -> DataFrame:
    """Spans (found, char_start, char_end, next_anchor, text) cut at the next item's anchor; adds ``warning``.

    A span that starts at or after it: content is no longer found, a proof stays with a warning.
    """
    late = F.col("found") & (F.col("char_start") >= F.col("next_anchor"))
    cut = F.col("found") & ~late & (F.col("char_end") > F.col("next_anchor"))
    late, cut = F.coalesce(late, F.lit(False)), F.coalesce(cut, F.lit(False))
    warning = F.when(late, f"{kind} starts at or after the next item").when(cut, f"{kind} clipped at the next item")
    end = F.when(cut, F.col("next_anchor")).otherwise(F.col("char_end"))
    return rows.withColumns({"warning": warning, "found": F.col("found") & ~(late & F.lit(kind == "content")), "char_end": end, "span_text": F.substring("text", F.col("char_start") + 1, end - F.col("char_start"))})


def source_backed(text: Column, value: Column, clean: bool = False) -> Column:
    """Whether the source has a value, white space aside; null and blank values count as backed. ``clean``: the text is cleaned already."""
    x = T.clean(F.coalesce(value, F.lit("")))
    return (x == "") | F.contains(text if clean else T.clean(text), x)


def statement_and_proof(block: Column) -> tuple[Column, Column]:
    """A block's parts before the first proof mark at a line's start and after it; the proof is null without a mark or text."""
    parts = F.split(block, R.PROOF_BOUNDARY, 2)
    return T.strip(F.get(parts, F.lit(0))), F.nullif(T.strip(F.get(parts, F.lit(1))), F.lit(""))
