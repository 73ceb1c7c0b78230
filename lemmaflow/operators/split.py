"""Documents to lines, headings and sections. A document is a book or paper: its lines are one window partition, documents are spread."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lemmaflow.functions import patterns as R
from lemmaflow.functions import text as T

UP_TO_HERE = (Window.unboundedPreceding, Window.currentRow)


def by_line() -> Window:
    return Window.partitionBy("doc_id").orderBy("line_no")


def lines(documents: DataFrame) -> DataFrame:
    """(doc_id, line_no, line) of documents (doc_id, text)."""
    return documents.select("doc_id", F.posexplode(T.split_lines(F.col("text"))).alias("pos", "line")).select("doc_id", (F.col("pos") + 1).alias("line_no"), "line")


def headings(lines_: DataFrame) -> DataFrame:
    """(doc_id, line_no, level, title) of heading lines, and what other columns they have; code fences aren't told apart."""
    found = lines_.filter(T.matches(F.col("line"), R.HEADING))
    others = [c for c in lines_.columns if c not in ("doc_id", "line_no", "line")]
    return found.select("doc_id", "line_no", F.length(T.part(F.col("line"), R.HEADING, 1)).alias("level"), T.clean(T.part(F.col("line"), R.HEADING, 2)).alias("title"), *others)


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"(.)\.[^.]*$", "$1")


def classified(headings_: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Adds role (back, chapter, front, section or none), chapter and chapter_number (as of the heading) and the section's number and title.

    ``names``: (doc_id, source_name), unless headings have their document's source_name. The chapter before the first one is the document's title: its first plain heading of level 1, else the file's stem.
    """
    title = F.col("title")
    role = F.when(T.matches(title, R.BACK_MATTER), "back").when(F.col("own_number").isNotNull(), "chapter").when(T.matches(title, R.FRONT_MATTER), "front").when(F.col("kind").isNotNull(), "section").otherwise("none")
    own = T.with_title(headings_, title).withColumn("role", role).select("doc_id", "line_no", "level", "title", F.col("kind").alias("section_kind"), "mark", "name", "own_chapter", "own_number", "role", *([] if names is not None else [stem(F.col("source_name")).alias("stem")]))
    plain = F.when((F.col("role") == "none") & (F.col("level") == 1), title)
    everywhere = by_line().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = by_line().rowsBetween(*UP_TO_HERE)
    chapter, section = F.col("role") == "chapter", F.col("role") == "section"
    own = own.withColumns({
        "doc_title": F.first(plain, ignorenulls=True).over(everywhere),
        "chapter": F.last(F.when(chapter, F.col("own_chapter")), ignorenulls=True).over(so_far),
        "chapter_number": F.coalesce(F.last(F.when(chapter, F.col("own_number")), ignorenulls=True).over(so_far), F.lit("")),
    })
    if names is not None:
        own = own.join(names.select("doc_id", stem(F.col("source_name")).alias("stem")), "doc_id", "left")
    return own.withColumn("doc_title", F.coalesce("doc_title", "stem")).withColumns({
        "chapter": F.coalesce("chapter", "doc_title"),
        "section_number": F.when(section, T.section_number(F.col("section_kind"), F.col("mark"), F.col("chapter_number"))),
        "section_title": F.when(section, F.col("name")),
    }).drop("stem", "mark", "name", "own_chapter", "own_number")


def with_own_lines(rows: DataFrame, documents: DataFrame, start: str, end: str) -> DataFrame:
    """Rows with ``own``, their document's lines from line ``start`` to before line ``end`` (null: to the last), and n_lines, the document's.

    A document's rows, which are few, are cut from its one array of lines; no row meets the whole document.
    """
    names = rows.columns
    grouped = rows.groupBy("doc_id").agg(F.collect_list(F.struct(*names)).alias("rows"))
    whole = documents.select("doc_id", T.split_lines(F.col("text")).alias("lines")).withColumn("n_lines", F.size("lines"))
    after = F.col("n_lines") + 1

    def cut(r: Column) -> Column:
        first = F.greatest(r[start], F.lit(1))
        size = F.greatest(F.least(F.coalesce(r[end], after), after) - first, F.lit(0))
        return F.struct(*(r[c].alias(c) for c in names), F.col("n_lines").alias("n_lines"), F.slice("lines", first, size).alias("own"))

    return grouped.join(whole, "doc_id").select(F.inline(F.transform("rows", cut)))


def heading_lines(documents: DataFrame) -> DataFrame:
    """(doc_id, source_name, line_no, line) of documents (doc_id, source_name, text): the lines that may be headings; no others are made rows."""
    numbered = F.transform(T.split_lines(F.col("text")), lambda x, i: F.when(F.contains(x, F.lit("#")), F.struct((i + 1).alias("line_no"), x.alias("line"))))
    return documents.select("doc_id", "source_name", F.inline(F.array_compact(numbered)))


def _front_marks(rows: DataFrame) -> DataFrame:
    """Adds marker (whether what stands before the first section, ``front``, has items) and inferred (their section's number:
    that of the first numbered item with several components, without the last)."""
    rows = rows.withColumn("bare", F.transform("front", lambda x: T.strip(F.regexp_replace(T.strip(x), "^#+", ""))))
    rows = rows.withColumn("numbers", F.filter(F.transform("bare", lambda x: T.part(x, R.NUMBERED_ITEM, 1)), lambda n: n != ""))
    upper = F.get(F.filter("numbers", lambda n: F.contains(n, F.lit("."))), F.lit(0))
    return rows.withColumns({
        "marker": F.coalesce((F.size("numbers") > 0) | F.exists("bare", lambda x: T.matches(x, R.RESULT_HEADING)), F.lit(False)), "inferred": F.regexp_replace(upper, r"\.[^.]*$", ""),
    }).drop("bare", "numbers")


def outlined(documents: DataFrame) -> DataFrame:
    """A row a document: its lines, n_lines, front (those before the first section), marker, sections and backs, whose texts are still to be cut from the lines.

    Headings are classified in rows of their own, which are few; a document's come back to it as arrays, so that its text moves once,
    and not at all where documents have just been grouped by id: both sides begin alike, so that Spark shuffles what they are made of once for both. A synthetic section stands at line 1 where
    items stand before the first heading; a document without section headings is one section, up to its back matter.
    """
    documents = documents.filter("doc_id is not null")
    roles = classified(headings(heading_lines(documents)))
    section, back = F.col("role") == "section", F.col("role") == "back"
    # from the last heading to the first, each sees those behind it
    behind = Window.partitionBy("doc_id").orderBy(F.desc("line_no")).rowsBetween(Window.unboundedPreceding, -1)
    roles = roles.withColumns({"next_line": F.min(F.when(section | back, F.col("line_no"))).over(behind), "next_start": F.min(F.when(section, F.col("line_no"))).over(behind)})
    fields = {
        "line_no": F.col("line_no"), "next_line": F.col("next_line"), "section_number": F.col("section_number"), "start_title": F.col("section_title"), "chapter": F.col("chapter"),
        "chapter_number": F.col("chapter_number"), "level": F.col("level"), "source_heading": F.col("title"), "synthetic": F.lit(False),
    }
    one = lambda values: F.struct(*(v.alias(n) for n, v in values.items()))
    found = roles.groupBy("doc_id").agg(
        F.array_sort(F.collect_list(F.when(section, one(fields)))).alias("starts"), F.array_sort(F.collect_list(F.when(back, F.struct("line_no", F.col("next_start").alias("next_line"))))).alias("backs"),
        F.max_by(F.struct("chapter", "chapter_number"), "line_no").alias("last"), F.min(F.when((section | back) & (F.col("line_no") > 1), F.col("line_no"))).alias("second"),
    )
    rows = documents.select("doc_id", stem(F.col("source_name")).alias("stem"), T.split_lines(F.col("text")).alias("lines")).join(found, "doc_id", "left")
    first = F.get("starts", F.lit(0))
    rows = _front_marks(rows.withColumns({"n_lines": F.size("lines"), "first": first, "front": F.when(first.isNotNull(), F.slice("lines", 1, first["line_no"] - 1))}))
    inferred = F.coalesce("inferred", T.previous_number(F.col("first.section_number")), F.lit("pre"))
    at_1 = {"line_no": F.lit(1), "next_line": F.col("second"), "level": F.lit(None).cast("int")}
    title = F.concat(inferred, F.lit(". Inferred pre-section material"))
    made = at_1 | {"section_number": inferred, "start_title": title, "chapter": F.col("first.chapter"), "chapter_number": F.col("first.chapter_number"), "source_heading": title, "synthetic": F.lit(True)}
    chapter, number = F.coalesce("last.chapter", "stem"), F.coalesce("last.chapter_number", F.lit(""))
    lone = at_1 | {"section_number": F.when(number != "", number).otherwise("1"), "start_title": chapter, "chapter": chapter, "chapter_number": number, "source_heading": chapter, "synthetic": F.lit(None).cast("boolean")}
    in_order = lambda values: one({n: values[n] for n in fields})
    sections_ = F.when(F.col("first").isNull(), F.array(in_order(lone))).when(F.col("marker"), F.concat(F.array(in_order(made)), "starts")).otherwise(F.col("starts"))
    return rows.select("doc_id", "lines", "n_lines", "front", "marker", sections_.alias("sections"), F.when(F.col("first").isNull(), F.slice("backs", 1, 1)).otherwise(F.col("backs")).alias("backs"))


def _cut(r: Column) -> Column:
    """The lines of one of ``outlined``'s parts: from its own to before the next one, or to the last."""
    end = F.coalesce(r["next_line"], F.col("n_lines") + 1)
    return F.slice("lines", r["line_no"], F.greatest(F.least(end, F.col("n_lines") + 1) - r["line_no"], F.lit(0)))


def sections(documents: DataFrame) -> DataFrame:
    """Flat sections of documents (doc_id, source_name, text): each ends at the next start or back matter of any level.

    Columns: doc_id, section_index, section_number, section, chapter, chapter_number, heading_level, source_heading, start_line,
    end_line (without trailing blank lines), synthetic, text. A document without section headings is one section, up to its back matter.
    """
    return _sections(outlined(documents))


def _sections(outlined_: DataFrame) -> DataFrame:
    names = ["line_no", "next_line", "section_number", "start_title", "chapter", "chapter_number", "level", "source_heading", "synthetic"]
    # each takes its own lines along, not the document's
    cut = F.transform("sections", lambda r, i: F.struct(*(r[n].alias(n) for n in names), (i + 1).alias("section_index"), F.col("n_lines").alias("n_lines"), _cut(r).alias("own")))
    cut = outlined_.select("doc_id", F.inline(cut))
    # trailing blank lines are no part of a section
    filled = F.array_max(F.transform("own", lambda x, i: F.when(T.strip(x) != "", i + 1).otherwise(0)))
    next_line = F.coalesce("next_line", F.col("n_lines") + 1)
    end = F.when(F.col("synthetic").isNull(), F.least(next_line - 1, "n_lines")).otherwise(F.col("line_no") + F.coalesce(filled, F.lit(0)) - 1)
    titled = F.when(F.coalesce("synthetic", F.lit(True)), F.col("start_title")).otherwise(T.strip(F.concat("section_number", F.lit(". "), "start_title")))
    return cut.select(
        "doc_id", "section_index", "section_number", titled.alias("section"), "chapter", "chapter_number", F.col("level").alias("heading_level"), "source_heading", F.col("line_no").alias("start_line"), end.alias("end_line"),
        F.coalesce("synthetic", F.lit(False)).alias("synthetic"), F.col("synthetic").isNull().alias("lone"), T.strip(F.array_join("own", "\n")).alias("text"),
    )


def front_matter(documents: DataFrame) -> DataFrame:
    """(doc_id, front_matter): what stands before a document's first section; none where a section was made from it, or where there are no sections."""
    return _front_matter(outlined(documents))


def _front_matter(outlined_: DataFrame) -> DataFrame:
    return outlined_.filter("front is not null and not marker").select("doc_id", T.strip(F.array_join("front", "\n")).alias("front_matter")).filter("front_matter <> ''")


def back_matter(documents: DataFrame) -> DataFrame:
    """(doc_id, back_matter): every excluded heading's block up to the next section, joined by blank lines; a second heading in a block repeats its text.

    A document without sections has one block, from its first back matter on.
    """
    return _back_matter(outlined(documents))


def _back_matter(outlined_: DataFrame) -> DataFrame:
    blocks = F.filter(F.transform("backs", lambda r: T.strip(F.array_join(_cut(r), "\n"))), lambda x: x != "")
    return outlined_.filter("size(backs) > 0").select("doc_id", F.array_join(blocks, "\n\n").alias("back_matter")).filter("back_matter <> ''")


def parts(outlined_: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sections, front and back matter of documents that have been outlined (and staged, or each outlines them again)."""
    return _sections(outlined_), _front_matter(outlined_), _back_matter(outlined_)


def split_warnings(sections_: DataFrame) -> DataFrame:
    """(doc_id, position, warning): no headings, a synthetic section, repeated section numbers, long sections; in order."""
    again = F.row_number().over(Window.partitionBy("doc_id", "section_number").orderBy("section_index")) > 1
    # texts stay where they are
    narrow = sections_.select("doc_id", "section_index", "section_number", "lone", "synthetic", F.length("text").alias("n_chars"))
    marked = narrow.withColumn("again", again).select("doc_id", "section_index", F.explode(F.array_compact(F.array(
        F.when(F.col("lone"), F.struct(F.lit(0).alias("k"), F.lit(R.WARN_NO_SECTIONS).alias("warning"))),
        F.when(F.col("synthetic"), F.struct(F.lit(0).alias("k"), F.lit(R.WARN_SYNTHETIC).alias("warning"))),
        F.when(F.col("again") & ~F.col("lone"), F.struct(F.lit(1).alias("k"), F.concat(F.lit(R.WARN_SECTION_NUMBER), "section_number").alias("warning"))),
        F.when((F.col("n_chars") > R.LONG_SECTION) & ~F.col("lone"), F.struct(F.lit(2).alias("k"), F.format_string(R.WARN_LONG_SECTION, "section_index", "n_chars").alias("warning"))),
    ))).alias("w"))
    return marked.select("doc_id", (F.col("section_index") * 10 + F.col("w.k")).alias("position"), "w.warning")
