"""Structure candidates, the test whether a planner is needed, and the clipping of planned sections."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lemmaflow.functions import patterns as R
from lemmaflow.functions import text as T
from lemmaflow.operators.split import by_line, with_own_lines
from lemmaflow.scratch import staged


def parsed(lines: DataFrame) -> DataFrame:
    """(doc_id, line_no, x, level, item, back, bare and what ``text.with_title`` adds) of all lines: what each may be in its document's structure.

    ``x``: the stripped line; ``level``: of a heading, else 0; the title is a heading's or the line; ``bare``: no heading, but may head a section.
    """
    marks, own = T.part(F.col("x"), R.HEADING, 1), T.strip(T.part(F.col("x"), R.HEADING, 2))
    rows = lines.select("doc_id", "line_no", T.strip(F.col("line")).alias("x")).withColumn("level", F.length(marks)).withColumn("words", F.when(F.col("level") > 0, own).otherwise(F.col("x")))
    rows = T.with_title(rows, T.clean(F.col("words"))).withColumns({"item": T.matches(F.col("words"), R.ITEM_HEADING), "back": T.matches(F.col("title"), R.BACK_MATTER), "marker": T.part(F.col("x"), R.BARE_NUMBERED, 1), "rest": T.strip(T.part(F.col("x"), R.BARE_NUMBERED, 2))})
    bare = (F.col("level") == 0) & (F.col("marker") != "") & ~F.col("item") & F.col("kind").isNotNull() & T.heading_like(F.col("rest"), F.contains("marker", F.lit(".")))
    return rows.withColumn("bare", bare).drop("words", "marker", "rest")


def candidates(lines: DataFrame, most: int = 5000) -> DataFrame:
    """(doc_id, line_no, kind, text, prev, next): the first ``most`` candidates of each document, with the nearest lines that aren't blank.

    The kind is the first that fits.
    """
    level = F.concat(F.lit("markdown_h"), F.col("level").cast("string"))
    chapter, section = F.col("own_number").isNotNull(), F.col("kind").isNotNull()
    marked = F.concat(level, F.when(chapter, "_chapter").when(F.col("back"), "_back_matter").when(F.col("item"), "_item_or_activity").when(section, "_section_candidate").otherwise("_heading"))
    plain = F.when(chapter, "bare_chapter_candidate").when(F.col("back"), "bare_back_matter_candidate").when(F.col("item"), "item_or_activity_candidate").when(F.col("bare"), "bare_section_candidate")
    rows = parsed(lines).select("doc_id", "line_no", F.substring("x", 1, 500).alias("text"), F.when(F.col("level") > 0, marked).otherwise(plain).alias("kind"))
    filled = F.nullif(F.substring("text", 1, 300), F.lit(""))
    before = F.last(filled, ignorenulls=True).over(by_line().rowsBetween(Window.unboundedPreceding, -1))
    after = F.first(filled, ignorenulls=True).over(by_line().rowsBetween(1, Window.unboundedFollowing))
    found = rows.withColumns({"prev": F.coalesce(before, F.lit("")), "next": F.coalesce(after, F.lit(""))}).filter("kind is not null and text <> ''")
    return found.withColumn("place", F.row_number().over(by_line())).filter(F.col("place") <= most).select("doc_id", "line_no", "kind", "text", "prev", "next")


def planner_needed(lines: DataFrame, sections: DataFrame, split_warnings: DataFrame) -> DataFrame:
    """(doc_id, needed): warnings of the splitter, a bare section that it missed, or items above sections."""
    number = sections.groupBy("doc_id").agg(F.min_by("chapter_number", "section_index").alias("number"))
    # headings and bare sections are few: lines that don't begin as one aren't parsed
    begins = T.matches(F.substring(F.ltrim("line", F.lit(T.SPACES)), 1, 3), R.MAY_HEAD)
    rows = staged(parsed(lines.filter(begins)).select("doc_id", "line_no", "level", "kind", "mark", T.matches(F.col("title"), R.ITEM_HEADING).alias("item"), "bare"), "parsed").filter("bare or level > 0")
    bare = rows.filter("bare").join(number, "doc_id").select("doc_id", F.col("line_no").alias("start_line"), T.section_number(F.col("kind"), F.col("mark"), F.col("number")).alias("section_number"))
    missed = bare.join(sections.select("doc_id", "start_line"), ["doc_id", "start_line"], "left_anti").join(sections.select("doc_id", "section_number"), ["doc_id", "section_number"], "left_anti")
    section = F.col("kind").isNotNull()
    levels = rows.filter("level > 0").groupBy("doc_id").agg(F.max(F.when(section, F.col("level"))).alias("section_level"), F.min(F.when(~section & F.col("item"), F.col("level"))).alias("item_level"))
    reasons = split_warnings.select("doc_id").unionByName(missed.select("doc_id")).unionByName(levels.filter("item_level < section_level").select("doc_id")).distinct()
    return number.select("doc_id").join(reasons.withColumn("hit", F.lit(True)), "doc_id", "left").select("doc_id", F.coalesce("hit", F.lit(False)).alias("needed"))


#: About how many rows of plans a task sorts.
ROWS_A_TASK = 1 << 20


def clipped(plan: DataFrame, n_rows: int | None = None) -> DataFrame:
    """Planned sections (doc_id, position, start_line, end_line, n_lines) sorted, clamped and clipped so that none overlaps the one before.

    A section begins after the end of those before it, and at the last line at most; an end is never before its start. In closed form:
    the end is the least of the last line and the row's number plus the greatest of (end less row number) so far. ``n_rows``: how many
    sections there are, if known; large plans are then dealt out so that the memory of a task doesn't grow with them.
    """
    parts = ceil((n_rows or 0) / ROWS_A_TASK)
    if parts > int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        plan = plan.repartition(parts, "doc_id")
    start = F.greatest(F.lit(1), F.least("n_lines", F.coalesce("start_line", F.lit(1))))
    end = F.greatest(start, F.least("n_lines", F.coalesce("end_line", F.lit(1))))
    order = Window.partitionBy("doc_id").orderBy(F.coalesce("start_line", F.lit(0)), "position", "end_line")
    rows = plan.withColumns({"i": F.row_number().over(order), "s": start, "e": end})
    ends = rows.withColumn("new_end", F.least(F.col("n_lines"), F.col("i") + F.max(F.col("e") - F.col("i")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    before = F.coalesce(F.lag("new_end").over(order), F.lit(0))
    moved = F.col("s") <= F.col("before")
    begin = F.when(moved, F.least(F.col("before") + 1, "n_lines")).otherwise(F.col("s"))
    return ends.withColumn("before", before).select("doc_id", "position", F.col("i").alias("section_index"), begin.alias("start_line"), F.col("new_end").alias("end_line"), moved.alias("moved"), (F.col("e") < begin).alias("stretched"))


def ranges_text(lines: Column, ranges: Column) -> Column:
    """The text of ranges of lines (start_line, end_line), joined by blank lines: starts are clamped to the lines, ends to the start and the last line, a missing number is
    the least allowed one. Blank pieces go; null ranges, and ranges of a text without lines, are empty. Ranges that overlap repeat their text."""
    n = F.size(lines)
    begin = lambda r: F.greatest(F.lit(1), F.least(n, F.coalesce(r["start_line"], F.lit(1))))
    end = lambda r: F.greatest(begin(r), F.least(n, F.coalesce(r["end_line"], F.lit(1))))
    pieces = F.transform(ranges, lambda r: T.strip(F.array_join(F.slice(lines, begin(r), end(r) - begin(r) + 1), "\n")))
    return F.coalesce(F.when(n > 0, F.array_join(F.filter(pieces, lambda x: x != ""), "\n\n")), F.lit(""))


def plan_matter(heads: DataFrame, sections: DataFrame, documents: DataFrame) -> DataFrame:
    """(doc_id, front_matter, back_matter) of documents with a plan (``heads``: doc_id, front_matter_ranges, back_matter_ranges), in one pass over each text.

    Without front matter in the plan it is what stands before the first section (``sections``: doc_id, start_line).
    """
    first = sections.groupBy("doc_id").agg(F.min("start_line").alias("first"))
    rows = documents.join(heads.select("doc_id", "front_matter_ranges", "back_matter_ranges"), "doc_id").join(first, "doc_id", "left").withColumn("lines", T.split_lines(F.col("text")))
    front = ranges_text(F.col("lines"), F.col("front_matter_ranges"))
    before = F.when(F.col("first") > 1, T.strip(F.array_join(F.slice("lines", 1, F.col("first") - 1), "\n")))
    return rows.select("doc_id", F.coalesce(F.nullif(front, F.lit("")), before, F.lit("")).alias("front_matter"), ranges_text(F.col("lines"), F.col("back_matter_ranges")).alias("back_matter"))


def plan_warnings(heads: DataFrame, plans: DataFrame, documents: DataFrame, hard: DataFrame) -> DataFrame:
    """(doc_id, position, warning) of documents with a plan: the plan's own (``heads``: doc_id, warnings; blank ones go), sections out of order, adjusted starts and ends.

    A plan without sections leaves the hard splitter's warnings (``hard``: doc_id, position, warning) and says so. ``plans``: as ``planned_sections`` takes them.
    """
    told = heads.select("doc_id", F.posexplode(F.filter(F.transform("warnings", T.strip), lambda w: w != "")).alias("position", "warning")).withColumn("k", F.lit(0))
    whole = plans.select("doc_id").distinct()
    own = told.join(whole, "doc_id", "left_semi")
    later = F.col("start") < F.max("start").over(Window.partitionBy("doc_id").orderBy("position").rowsBetween(Window.unboundedPreceding, -1))
    order = plans.withColumn("start", F.coalesce("start_line", F.lit(0))).withColumn("later", later).groupBy("doc_id").agg(F.bool_or("later").alias("later")).filter("later").select("doc_id", F.lit(0).alias("position"), F.lit(R.WARN_PLAN_ORDER).alias("warning"), F.lit(1).alias("k"))
    size = documents.select("doc_id", F.size(T.split_lines(F.col("text"))).alias("n_lines"))
    said = F.array_compact(F.array(F.when(F.col("moved"), F.format_string(R.WARN_PLAN_MOVED, "section_index")), F.when(F.col("stretched"), F.format_string(R.WARN_PLAN_END, "section_index"))))
    adjusted = clipped(plans.join(size, "doc_id"), plans.count()).select("doc_id", "section_index", F.posexplode(said).alias("i", "warning")).select("doc_id", (F.col("section_index") * 2 + F.col("i")).alias("position"), "warning", F.lit(2).alias("k"))
    empty = heads.select("doc_id").join(whole, "doc_id", "left_anti")
    old = hard.join(empty, "doc_id", "left_semi").select("doc_id", "position", "warning", F.lit(0).alias("k")).unionByName(empty.select("doc_id", F.lit(0).alias("position"), F.lit(R.WARN_PLAN_EMPTY).alias("warning"), F.lit(1).alias("k")))
    rows = own.select("doc_id", "position", "warning", "k").unionByName(order).unionByName(adjusted).unionByName(old)
    return rows.select("doc_id", (F.row_number().over(Window.partitionBy("doc_id").orderBy("k", "position")) - 1).alias("position"), "warning")


def planned_sections(plans: DataFrame, documents: DataFrame) -> DataFrame:
    """Sections as a plan has them: sorted, clamped, clipped, with qualified numbers and their text.

    ``plans``: doc_id, position, start_line, end_line, section_number, section_title, and the section's or else the plan's chapter and
    chapter_number (null where the plan has none, empty where it says so), with fallback_chapter and fallback_number from the hard splitter.
    """
    size = documents.select("doc_id", F.size(T.split_lines(F.col("text"))).alias("n_lines"))
    placed = clipped(plans.join(size, "doc_id")).withColumn("next_line", F.col("end_line") + 1)
    named = with_own_lines(plans.drop("start_line", "end_line").join(placed, ["doc_id", "position"]), documents, "start_line", "next_line")
    chapter_number = F.coalesce(T.strip(F.col("chapter_number")), F.col("fallback_number"), F.lit(""))
    named = named.withColumns({
        "chapter": F.coalesce(F.nullif(T.strip(F.col("chapter")), F.lit("")), F.col("fallback_chapter")), "chapter_number": chapter_number,
        "own_number": F.coalesce(F.nullif(T.strip(F.col("section_number")), F.lit("")), F.col("section_index").cast("string")),
        "line": F.coalesce(F.get("own", F.lit(0)), F.lit("")), "text": T.strip(F.array_join("own", "\n")),
    })
    named = named.withColumns({"section_number": T.qualified_number(F.col("own_number"), F.col("chapter_number")), "level": F.length(T.part(F.col("line"), R.HEADING, 1)), "line": T.strip(F.col("line")), "heading": T.clean(T.part(F.col("line"), R.HEADING, 2))})
    named = named.withColumn("section_title", F.coalesce(F.nullif(T.strip(F.col("section_title")), F.lit("")), F.col("section_number")))
    heading = F.col("level") > 0
    source = F.when(heading, F.col("heading")).when(F.col("line") != "", F.col("line")).otherwise(F.col("section_title"))
    return named.select(
        "doc_id", "section_index", "section_number", T.strip(F.concat("section_number", F.lit(". "), "section_title")).alias("section"), "chapter", "chapter_number", F.when(heading, F.col("level")).alias("heading_level"),
        source.alias("source_heading"), "start_line", "end_line", "text",
    )


def heuristic_plans(lines: DataFrame, sections: DataFrame) -> DataFrame:
    """Plans without a model, as ``planned_sections`` takes them: headings and bare lines that head sections, each up to the next one.

    All sections of a document get its last chapter. A document whose later sections all lie within its first one keeps that one alone;
    without any start the hard splitter's sections are the plan.
    """
    first = sections.groupBy("doc_id").agg(F.min_by(F.struct("chapter", "chapter_number"), "section_index").alias("h")).select("doc_id", F.col("h.chapter").alias("hard_chapter"), F.col("h.chapter_number").alias("hard_number"))
    so_far = by_line().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    heads = F.col("kind").isNotNull() & ((F.col("level") > 0) | F.col("bare"))
    # every line is parsed once; few have anything but their number
    rows = staged(parsed(lines).withColumn("heads", heads).select("doc_id", "line_no", *(F.when(F.col("heads"), F.col(c)).alias(c) for c in ("kind", "mark", "name")), "own_number", "own_chapter"), "parsed")
    chapters = rows.groupBy("doc_id").agg(F.max("line_no").alias("n_lines"))
    rows = rows.filter("own_number is not null or kind is not null")
    rows = rows.withColumn("number", F.last("own_number", ignorenulls=True).over(so_far)).join(first, "doc_id").withColumn("number", F.coalesce("number", "hard_number"))
    of_chapter = F.when(F.col("own_number").isNotNull(), F.col("line_no"))
    chapters = chapters.join(rows.groupBy("doc_id").agg(F.max_by("own_number", of_chapter).alias("last_number"), F.max_by("own_chapter", of_chapter).alias("last_title")), "doc_id", "left")
    starts = rows.filter(F.col("own_number").isNull() & F.col("kind").isNotNull()).select("doc_id", "line_no", T.section_number(F.col("kind"), F.col("mark"), F.col("number")).alias("section_number"), F.col("name").alias("section_title"))
    whole = by_line().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    top = F.first("section_number").over(whole)
    starts = starts.withColumn("top", top).withColumn("place", F.row_number().over(by_line())).withColumn("inside", (F.col("place") == 1) | F.startswith("section_number", F.concat("top", F.lit("."))))
    starts = starts.withColumn("collapsed", F.min(F.col("inside")).over(Window.partitionBy("doc_id"))).filter("place = 1 or not collapsed")
    ends = starts.withColumn("end_line", F.lead("line_no").over(by_line()) - 1).join(chapters, "doc_id").join(first, "doc_id")
    own = ends.select(
        "doc_id", (F.col("place") - 1).alias("position"), F.col("line_no").alias("start_line"), F.coalesce("end_line", "n_lines").alias("end_line"), "section_number", "section_title",
        F.coalesce("last_title", "hard_chapter").alias("chapter"), F.coalesce("last_number", "hard_number").alias("chapter_number"),
    )
    hard = sections.join(starts.select("doc_id").distinct(), "doc_id", "left_anti").select("doc_id", (F.col("section_index") - 1).alias("position"), "start_line", "end_line", "section_number", F.col("section").alias("section_title"), "chapter", "chapter_number")
    return own.unionByName(hard).join(first, "doc_id").withColumnsRenamed({"hard_chapter": "fallback_chapter", "hard_number": "fallback_number"})
