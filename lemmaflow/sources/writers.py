"""Results as JSON and Markdown, a row a document; written by Spark's own commit, partitioned where a reader looks up documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lemmaflow.functions import patterns as R


def items_json(items: DataFrame) -> DataFrame:
    """(doc_id, items_json): all items of a document in order."""
    context = F.struct("chapter", "section", "chapter_number", "section_number")
    item = F.struct(F.col("global_index").alias("index"), "label", "env", "number_components", context.alias("context"), "content", "dependencies", "proof")
    return items.groupBy("doc_id").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("global_index", item.alias("item")))), lambda x: x["item"]), {"ignoreNullFields": "false"}).alias("items_json"))


def section_items_json(items: DataFrame, sections: DataFrame) -> DataFrame:
    """(doc_id, section_index, items_json): the items of each section in order; an empty list for a section without any."""
    context = F.struct("chapter", "section", "chapter_number", "section_number")
    item = F.struct(F.col("global_index").alias("index"), "label", "env", "number_components", context.alias("context"), "content", "dependencies", "proof")
    own = items.groupBy("doc_id", "section_index").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("global_index", item.alias("item")))), lambda x: x["item"]), {"ignoreNullFields": "false"}).alias("items_json"))
    return sections.select("doc_id", "section_index").join(own, ["doc_id", "section_index"], "left").fillna("[]", "items_json")


def candidates_json(candidates: DataFrame, plans: DataFrame | None = None) -> DataFrame:
    """(doc_id, candidates_json, used): a document's structure candidates in order, and whether a plan was used for it."""
    one = F.struct("line_no", "kind", "text", "prev", "next")
    rows = candidates.groupBy("doc_id").agg(F.to_json(F.array_sort(F.collect_list(one))).alias("candidates_json"))
    if plans is None:
        return rows.withColumn("used", F.lit(False))
    return rows.join(plans.select("doc_id").distinct().withColumn("used", F.lit(True)), "doc_id", "left").withColumn("used", F.coalesce("used", F.lit(False)))


def summary_json(documents: DataFrame, sections: DataFrame, reports: DataFrame, warnings: DataFrame, front: DataFrame, back: DataFrame, usage: DataFrame | None, audited: bool) -> DataFrame:
    """(doc_id, summary_json): totals, characters of front and back matter, the splitter's warnings, usage, and an entry for each section."""
    one = F.struct("section_index", "chapter_number", "section_number", "chapter", "section", F.array("start_line", "end_line").alias("line_range"), "heading_level", "source_heading")
    files = sections.groupBy("doc_id").agg(F.array_sort(F.collect_list(one)).alias("files"))
    said = warnings.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "warning"))), lambda x: x["warning"]).alias("split_warnings"))
    used = usage if usage is not None else documents.select("doc_id", F.lit(None).cast("string").alias("usage_json"))
    rows = documents.select("doc_id", "source_name").join(reports.select("doc_id", "sections_total", "items_total"), "doc_id", "left").join(files, "doc_id", "left").join(said, "doc_id", "left")
    rows = rows.join(front, "doc_id", "left").join(back, "doc_id", "left").join(used.select("doc_id", "usage_json"), "doc_id", "left")
    chars = lambda c: F.length(F.coalesce(c, F.lit("")))
    body = F.struct(
        F.col("sections_total").alias("sections_written"), "items_total", F.col("source_name").alias("source_file"), chars("front_matter").alias("front_matter_chars"), chars("back_matter").alias("back_matter_chars"),
        F.coalesce("split_warnings", F.array().cast("array<string>")).alias("split_warnings"), F.lit(audited).alias("audit_enabled"), F.try_parse_json("usage_json").alias("usage_summary"), "files",
    )
    return rows.select("doc_id", F.to_json(body, {"ignoreNullFields": "false"}).alias("summary_json"))


def annotation_json(documents: DataFrame) -> DataFrame:
    """(doc_id, annotation_json) of annotation documents, as ``annotate.assembled`` makes them."""
    parts = F.struct("schema_version", "source", "document", "items", "quality")
    return documents.select("doc_id", F.to_json(parts, {"ignoreNullFields": "false"}).alias("annotation_json"))


def structure_index(sections: DataFrame, reports: DataFrame) -> DataFrame:
    """(doc_id, structure_json): the sections with lines, headings and numbers of items."""
    rows = sections.join(reports.select("doc_id", "section_index", F.col("n_items").alias("items")), ["doc_id", "section_index"], "left")
    one = F.struct("chapter", "chapter_number", "section", "section_number", F.col("start_line").alias("line_start"), F.col("end_line").alias("line_end"), "heading_level", "source_heading", F.coalesce("items", F.lit(0)).alias("items"))
    return rows.groupBy("doc_id").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("section_index", one.alias("s")))), lambda x: x["s"]), {"ignoreNullFields": "false"}).alias("structure_json"))


def index_markdown(reports: DataFrame, names: DataFrame) -> DataFrame:
    """(doc_id, markdown): a table of the sections; pipe characters in titles are escaped."""
    line = F.format_string("| section%02d | %d-%d | %s | %d |", "section_index", "start_line", "end_line", F.replace("section", F.lit("|"), F.lit("\\|")), "n_items")
    rows = reports.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("section_index", line.alias("line")))), lambda x: x["line"]), "\n").alias("rows"), F.sum("n_items").alias("total"))
    head = F.concat(F.lit("# "), "source_name", F.lit("\n\n| file | lines | section | items |\n|---|---:|---|---:|\n"))
    return rows.join(names.select("doc_id", "source_name"), "doc_id").select("doc_id", F.concat(head, "rows", F.lit("\n\nTotal items: "), F.col("total").cast("string"), F.lit("\n")).alias("markdown"))


def quality_markdown(documents: DataFrame, reports: DataFrame) -> DataFrame:
    """(doc_id, markdown): totals, the document's warnings and those of each section."""
    bullets = lambda c: F.array_join(F.transform(c, lambda w: F.concat(F.lit("- "), w)), "\n")
    part = F.concat(F.format_string("### section%02d %s\n", "section_index", "section"), bullets(F.col("warnings")))
    own = reports.filter(F.size("warnings") > 0).groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("section_index", part.alias("part")))), lambda x: x["part"]), "\n\n").alias("parts"))
    whole = F.when(F.size("global_warnings") > 0, bullets(F.col("global_warnings"))).otherwise("- none")
    return documents.join(own, "doc_id", "left").select(
        "doc_id",
        F.concat(F.format_string("# Quality Report\n\nsections_total: %d\nitems_total: %d\n\n## Global Warnings\n\n", "sections_total", "items_total"), whole, F.lit("\n\n## Section Warnings\n\n"), F.coalesce("parts", F.lit("")), F.lit("\n")).alias("markdown"),
    )


def _with_audits(sections: DataFrame, audits: DataFrame) -> DataFrame:
    """Sections in a left join with their audits: doc_id, section_index, audit_markdown, actions, open_questions, patch_json."""
    own = audits.select("doc_id", "section_index", F.lit(True).alias("audited"), *(c for c in ("audit_markdown", "actions", "open_questions", "patch_json") if c in audits.columns))
    return sections.select("doc_id", "section_index", "section", "section_number").join(own, ["doc_id", "section_index"], "left").withColumn("audited", F.coalesce("audited", F.lit(False)))


def audit_markdown(sections: DataFrame, audits: DataFrame) -> DataFrame:
    """(doc_id, markdown): the audits of all sections in order; a section without one says so, an audit without text is empty."""
    body = F.when(F.col("audited"), F.regexp_replace(F.coalesce("audit_markdown", F.lit("")), r"(?U)\s+\z", "")).otherwise(R.AUDIT_MISSING)
    part = F.concat(F.format_string("## section%02d.json ", "section_index"), F.coalesce("section", F.lit("")), F.lit("\n\n"), body, F.lit("\n"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("section_index", part.alias("part")))), lambda x: x["part"])
    return _with_audits(sections, audits).groupBy("doc_id").agg(F.concat(F.lit(R.AUDIT_TITLE), F.array_join(parts, "\n")).alias("markdown"))


def patch_candidates(sections: DataFrame, audits: DataFrame) -> DataFrame:
    """A row a document: overall_assessment, no_change (ids of sections without actions), sections (the patches of the others) and
    defer (sections without an audit, and open questions; blank ones go), each in the order of the sections."""
    name = F.concat(F.format_string("section%02d_", "section_index"), F.coalesce("section_number", F.lit("")))
    acts = F.coalesce(F.size("actions") > 0, F.lit(False))
    asked = F.filter(F.coalesce("open_questions", F.array().cast("array<string>")), lambda q: F.coalesce(q, F.lit("")) != "")
    reasons = F.when(F.col("audited"), asked).otherwise(F.array(F.lit(R.AUDIT_DEFERRED)))
    rows = _with_audits(sections, audits).select(
        "doc_id", "section_index", F.when(F.col("audited") & ~acts, name).alias("same"), F.when(F.col("audited") & acts, F.col("patch_json")).alias("patch"),
        F.transform(reasons, lambda r: F.struct(name.alias("section_id"), r.alias("reason"))).alias("later"),
    )
    listed = rows.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("section_index", "same", "patch", "later"))).alias("s"))

    def some(field: str):
        return F.filter(F.transform("s", lambda x: x[field]), lambda v: v.isNotNull())

    out = listed.select("doc_id", some("same").alias("no_change"), some("patch").alias("sections"), F.flatten(some("later")).alias("defer"))
    return out.withColumn("overall_assessment", F.when(F.size("sections") > 0, R.PATCH_SOME).otherwise(R.PATCH_NONE))


def section_audits(audits: DataFrame) -> DataFrame:
    """(doc_id, section_index, markdown, patch_json): each section's audit, ended by one line end, and its patch."""
    body = F.concat(F.regexp_replace(F.coalesce("audit_markdown", F.lit("")), r"(?U)\s+\z", ""), F.lit("\n"))
    return audits.select("doc_id", "section_index", body.alias("markdown"), "patch_json")


def quality_json(documents: DataFrame, reports: DataFrame) -> DataFrame:
    """(doc_id, quality_json): the whole report and those of the sections, in order."""
    one = F.struct(*(c for c in reports.columns if c not in ("doc_id", "source_name")))
    own = reports.groupBy("doc_id").agg(F.array_sort(F.collect_list(one), lambda x, y: x["section_index"] - y["section_index"]).alias("sections"))  # maps have no order
    rows = documents.join(own, "doc_id", "left")
    return rows.select("doc_id", F.to_json(F.struct(*(c for c in rows.columns if c != "doc_id")), {"ignoreNullFields": "false"}).alias("quality_json"))


def plans_json(heads: DataFrame, plans: DataFrame) -> DataFrame:
    """(doc_id, plan_json): the plans that were used, with their sections in order."""
    fields = [c for c in plans.columns if c not in ("doc_id", "position", "fallback_chapter", "fallback_number")]
    own = plans.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("position", F.struct(*fields).alias("s")))), lambda x: x["s"]).alias("sections"))
    rows = heads.join(own, "doc_id")
    return rows.select("doc_id", F.to_json(F.struct(*(c for c in rows.columns if c != "doc_id"))).alias("plan_json"))
