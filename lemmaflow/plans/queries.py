"""Registered queries of the document structuring operators, over the derived corpus of books and the job-like tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lemmaflow.functions import text as T
from lemmaflow.operators import annotate, extract, jobs, normalize, quality, spans, split, structure
from lemmaflow.plans import building, building_oracle, workflows, workflows_oracle
from lemmaflow.plans.corpus import books
from lemmaflow.plans.oracle import ORACLES
from lemmaflow.scratch import staged
from lemmaflow.sources import readers, writers

NOW = "timestamp'2024-06-01 00:00:00'"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _roles(b: DataFrame) -> DataFrame:
    return split.classified(split.headings(split.lines(b)), b.select("doc_id", "source_name"))


def _items(b: DataFrame) -> tuple[DataFrame, DataFrame]:
    sections = staged(split.sections(staged(b, "books")), "sections")
    return sections, staged(normalize.normalized(extract.local_items(sections), sections), "items")


def _annotated(b: DataFrame) -> DataFrame:
    """Annotated items for one reader: nothing is staged, books, sections and items stay where the documents were grouped."""
    sections = split.sections(b)
    return annotate.annotated(normalize.normalized(extract.local_items(sections), sections, together=True), together=True)


def section_item_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many items of each kind each section has: the flagship."""
    _, items = _items(books(spark, sf_dir))
    return quality.env_counts(items)


def lines_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = split.lines(books(spark, sf_dir))
    return rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(T.strip(F.col("line")) == "").alias("n_blank"), F.sum(F.length("line")).alias("n_chars"))


def heading_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.headings(split.lines(books(spark, sf_dir)))


def chapter_carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _roles(books(spark, sf_dir)).select("doc_id", "line_no", "role", "chapter", "chapter_number")


def section_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.sections(staged(books(spark, sf_dir), "books")).select("doc_id", "section_index", "section_number", "chapter_number", "start_line", "end_line", "synthetic")


def section_text_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.sections(staged(books(spark, sf_dir), "books")).select("doc_id", "section_index", "section", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


def back_matter_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.back_matter(staged(books(spark, sf_dir), "books")).select("doc_id", F.length("back_matter").cast("long").alias("n_chars"), F.sha2("back_matter", 256).alias("text_sha256"))


def split_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_warnings(staged(split.sections(staged(books(spark, sf_dir), "books")), "sections")).select("doc_id", "position", "warning")


def no_heading_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as they are: one section each."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("doc"), F.col("doc_id").cast("string"), F.lit(".md")).alias("source_name"), "text")
    return split.sections(docs).filter("lone").select("doc_id", "section_number", "section", "start_line", "end_line", F.length("text").cast("long").alias("n_chars"))


def local_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = extract.local_items(staged(split.sections(staged(books(spark, sf_dir), "books")), "sections"))
    return rows.select("doc_id", "section_index", "position", "env", F.array_join("number_components", ".").alias("number"), F.sha2("content", 256).alias("content_sha256"), F.sha2(F.coalesce("proof", F.lit("-")), 256).alias("proof_sha256"))


def normalized_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _items(books(spark, sf_dir))[1].select("doc_id", "section_index", "item_index", "global_index", "label", "env")


def duplicate_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_labels(_items(books(spark, sf_dir))[1])


def quality_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    sections, items = _items(books(spark, sf_dir))
    return quality.section_reports(sections, items).select("doc_id", "section_index", "source_chars", "n_item_markers", "n_proof_markers", "n_items", "n_proofs", F.array_join("warnings", "|").alias("warnings"))


def quality_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    sections, items = _items(books(spark, sf_dir))
    return quality.document_reports(sections, items, split.split_warnings(sections)).select("doc_id", "sections_total", "items_total", F.size("duplicate_labels").cast("long").alias("n_duplicate_labels"), F.size("global_warnings").cast("long").alias("n_global_warnings"))


def annotation_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate.issues(_annotated(books(spark, sf_dir))).select("doc_id", "global_index", "item_id", "severity", "code", "message")


def annotation_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate.chapters(_annotated(books(spark, sf_dir)))


def annotation_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    sections, items = _items(books(spark, sf_dir))
    reports = staged(quality.section_reports(sections, items), "reports")
    documents = quality.document_reports(sections, items, split.split_warnings(sections))
    return annotate.quality_summary(annotate.annotated(items), documents, reports)


def annotation_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The annotation document of each book: its source and title, and digests of its items and issues in order."""
    b = staged(books(spark, sf_dir), "books")
    sections, items = _items(b)
    reports = staged(quality.section_reports(sections, items), "reports")
    documents = quality.document_reports(sections, items, split.split_warnings(sections))
    out = annotate.assembled(annotate.annotated(items), documents, reports, b)
    shown = lambda i: F.concat_ws("|", i["id"], i["order_index"].cast("string"), i["label"], i["type"], F.sha2(i["statement"], 256), F.sha2(i["proof"], 256), i["context"]["section_number"], i["context"]["section_title"], i["context"]["chapter_number"], F.size(i["audit"]["issues"]).cast("string"), i["raw"]["env"])
    said = lambda x: F.concat_ws("|", x["severity"], x["code"], x["message"], F.coalesce(x["item_id"], F.lit("-")))
    digest = lambda array, f: F.sha2(F.array_join(F.transform(array, f), "\n"), 256)
    return out.select(
        "doc_id", "source.filename", F.col("source.original_mime_type").alias("mime_type"), "document.title", F.array_join(F.transform("document.chapters", lambda c: F.concat_ws("|", c["number"], c["title"])), "\n").alias("chapters"),
        F.size("items").alias("n_items"), "quality.error_count", "quality.warning_count", digest("items", shown).alias("items_sha256"), digest("quality.issues", said).alias("issues_sha256"),
    )


def structure_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of every kind."""
    rows = structure.candidates(split.lines(books(spark, sf_dir)))
    return rows.select("doc_id", "line_no", "kind", F.sha2("text", 256).alias("text_sha256"), F.sha2("prev", 256).alias("prev_sha256"), F.sha2("next", 256).alias("next_sha256"))


def planner_needed(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = staged(books(spark, sf_dir), "books")
    sections = staged(split.sections(b), "sections")
    return structure.planner_needed(split.lines(b), sections, split.split_warnings(sections))


def plan_clip_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned sections stand-ins: an order's lines, with starts and ends from part and supplier keys."""
    plan = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("position"), (F.col("l_partkey") % 60).cast("int").alias("start_line"), (F.col("l_partkey") % 60 + F.col("l_suppkey") % 25).cast("int").alias("end_line"), F.lit(50).alias("n_lines"))
    return structure.clipped(plan, plan.count()).drop("moved", "stretched")


def span_nth_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the second occurrence of each document's first two characters is."""
    text = F.coalesce("text", F.lit(""))
    return _table(spark, sf_dir, "documents").select("doc_id", F.coalesce(T.nth_position(text, F.substring(text, 1, 2), F.lit(2)), F.lit(-1)).cast("long").alias("position"))


def span_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.lit(1).alias("start_line"))
    rows = docs.select(
        "*", F.substring("text", 5, 3).alias("start_anchor"), F.when(F.col("doc_id") % 3 > 0, F.substring("text", 20, 2)).alias("end_anchor"), F.lit(1).alias("start_occurrence"),
        F.lit(2).alias("end_occurrence"), (F.col("doc_id") % 2 == 0).alias("include_start"), (F.col("doc_id") % 5 == 0).alias("include_end"),
    )
    return spans.resolved(rows).select("doc_id", "found", *(F.coalesce(c, F.lit(-1)).cast("long").alias(c) for c in ("char_start", "char_end", "line_start")), F.sha2(F.coalesce("span_text", F.lit("")), 256).alias("span_sha256"))


def source_backed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the first line of every document is in its own book, and in the book before, if there is one."""
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("document"), F.substring_index("text", "\n", 1).alias("value"), F.explode(F.expr("array(cast(doc_id div 16 as string), cast(doc_id div 16 - 1 as string))")).alias("doc_id"))
    values = docs.groupBy("doc_id").agg(F.collect_list(F.struct("document", "value")).alias("values"))  # 32 a book
    rows = books(spark, sf_dir).select("doc_id", T.clean(F.col("text")).alias("text")).join(values, "doc_id")
    return rows.select("doc_id", "text", F.inline("values")).select("doc_id", "document", spans.source_backed(F.col("text"), F.col("value"), clean=True).alias("backed"))


def source_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three places in each document of its characters 5 to 6."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.lit(1).alias("start_line"))
    return spans.searched(docs.withColumn("query", F.substring("text", 5, 2)), 3).select("doc_id", F.col("offset").alias("position"), "line", F.sha2("snippet", 256).alias("snippet_sha256"))


def _audits(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Documents of six as sections, with audits made of labels: quality 0 has an action, toxic 1 an open question."""
    docs = _table(spark, sf_dir, "documents").select(F.expr("doc_id div 6").alias("doc_id"), F.expr("cast(doc_id % 6 + 1 as int)").alias("section_index"), F.col("lang").alias("section"), F.col("source").alias("section_number"))
    made = _table(spark, sf_dir, "labels").select(
        F.expr("doc_id div 6").alias("doc_id"), F.expr("cast(doc_id % 6 + 1 as int)").alias("section_index"), F.concat(F.lit("Quality "), F.col("quality").cast("string"), F.lit(" \n")).alias("audit_markdown"),
        F.when(F.col("quality") == 0, F.array(F.lit("update"))).otherwise(F.array().cast("array<string>")).alias("actions"), F.when(F.col("toxic") == 1, F.array(F.lit("keep?"), F.lit(""))).alias("open_questions"), F.format_string("{\"id\":%d}", F.col("doc_id")).alias("patch_json"),
    )
    return docs, made


def audit_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return writers.audit_markdown(*_audits(spark, sf_dir))


def patch_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = writers.patch_candidates(*_audits(spark, sf_dir))
    defer = F.array_join(F.transform("defer", lambda x: F.concat_ws(":", x["section_id"], x["reason"])), ",")
    return found.select("doc_id", "overall_assessment", F.array_join("no_change", ",").alias("no_change"), F.array_join("sections", ",").alias("sections"), defer.alias("defer"))


def prompt_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lemmaflow.functions.profiles import profile

    return split.sections(staged(books(spark, sf_dir), "books")).select("doc_id", "section_index", profile().alias("profile"))


def _traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "conversations")
    phase = F.element_at(F.lit(jobs.PHASES[:4]), (F.pmod(F.col("conv_id"), F.lit(4)) + 1).cast("int"))
    n = F.length(F.coalesce("text", F.lit(""))).cast("long")
    return c.select(
        phase.alias("phase"), F.when(F.col("turn") % 2 == 0, n).alias("input_tokens"), F.lit(7).cast("long").alias("prompt_tokens"), (n % 100).alias("output_tokens"),
        F.lit(3).cast("long").alias("completion_tokens"), n.alias("total_tokens"), (F.col("turn") * 0.25).cast("double").alias("elapsed_seconds"),
        (F.col("role") != "system").alias("has_usage"),
    )


def usage_by_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.usage_by_phase(_traces(spark, sf_dir))


def usage_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.usage_total(jobs.usage_by_phase(_traces(spark, sf_dir)))


def jobs_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return jobs.latest(events, "user_id", F.col("ts"), F.col("event_id"))


def _jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as jobs."""
    status = F.when(F.col("o_orderstatus") == "F", "succeeded").when(F.col("o_orderkey") % 3 == 0, "failed").when(F.col("o_orderkey") % 3 == 1, "queued").otherwise("running")
    return _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), status.alias("status"), F.col("o_orderdate").alias("updated_at"))


def jobs_unfinished(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.unfinished(_jobs(spark, sf_dir))


def jobs_recent_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty newest succeeded jobs; the limit is the report's."""
    return jobs.top_jobs(_jobs(spark, sf_dir), 50, "succeeded")


def jobs_union_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs of both kinds under public ids, the hundred newest."""
    md = _jobs(spark, sf_dir).select(F.concat(F.lit("md_"), F.col("id").cast("string")).alias("id"), "status", "updated_at")
    users = jobs.latest(_table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type"), "user_id", F.col("ts"), F.col("event_id"))
    full = users.select(F.concat(F.lit("full_"), F.col("user_id").cast("string")).alias("id"), F.col("event_type").alias("status"), F.col("ts").alias("updated_at"))
    return jobs.top_jobs(md.unionByName(full), 100)


def retention_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    saved = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    return jobs.expired(_jobs(spark, sf_dir), saved, F.expr(NOW))


def saved_annotation_preferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.lit(-1).alias("quality"))
    saved = _table(spark, sf_dir, "labels").select("doc_id", "quality")
    return jobs.preferred(docs, saved, "doc_id", "quality").select("doc_id", F.col("quality").cast("int").alias("quality"), "origin")


def ingest_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    files = orders.select(F.col("o_orderkey").alias("path"), F.col("o_custkey").alias("digest"), F.col("o_orderdate").alias("modified_at"))
    state = orders.filter("o_orderkey % 4 > 0").select(
        F.col("o_orderkey").alias("path"), F.when(F.col("o_orderkey") % 8 == 1, -1).otherwise(F.col("o_custkey")).alias("digest"),
        F.when(F.col("o_orderkey") % 4 == 1, "done").otherwise("failed").alias("status"), (F.col("o_orderkey") % 5).alias("failure_count"), F.col("o_orderdate").alias("updated_at"),
    )
    return jobs.pending(files, state, F.expr("timestamp'1997-01-01 00:00:00'")).select("path", "digest")


def pages_to_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Books from OCR-like pages: each document is a page."""
    rows = _chunks(spark, sf_dir)
    return readers.merged_chunks(rows).select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


def chunk_page_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = readers.merged_chunks(_chunks(spark, sf_dir))
    return merged.select("doc_id", F.explode("pages").alias("p")).select("doc_id", F.col("p.page_idx").cast("long").alias("page_idx"), F.length("p.md").cast("long").alias("n_chars"))


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    rows = docs.select(F.expr("doc_id div 16").alias("doc_id"), F.expr("(doc_id % 16) div 4").alias("chunk_index"), F.struct((F.col("doc_id") % 4).cast("int").alias("page_idx"), F.col("text").alias("md")).alias("p"))
    return rows.groupBy("doc_id", "chunk_index").agg(F.array_sort(F.collect_list("p")).alias("pages")).withColumn("start_page", (F.col("chunk_index") * 4).cast("int"))


def stream_ingest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lemmaflow.streaming.ingest import replayed

    return replayed(spark, sf_dir)


_QUERIES = [
    section_item_counts, lines_explode, heading_scan, chapter_carry_forward, section_bounds, section_text_stats, back_matter_blocks, split_warnings, no_heading_documents, local_items,
    normalized_labels, duplicate_labels, quality_sections, quality_documents, annotation_issues, annotation_chapters, annotation_quality, annotation_documents, structure_candidates,
    planner_needed, plan_clip_overlaps, span_nth_occurrence, span_resolve, source_search, source_backed, audit_report, patch_candidates, prompt_profile, usage_by_phase,
    usage_total, jobs_latest_state, jobs_unfinished, jobs_recent_topk, jobs_union_list, retention_expired, saved_annotation_preferred, ingest_pending, pages_to_markdown, chunk_page_offset,
    stream_ingest_state,
]


def _long(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query with all integer columns as long, as its SQL has them."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = f(spark, sf_dir)
        return df.withColumns({c: F.col(c).cast("long") for c, kind in df.dtypes if kind == "int"})

    query.__doc__ = f.__doc__
    return query


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: _long(f) for f in [*_QUERIES, *building.QUERIES, *workflows.QUERIES]}


def oracle_sql() -> dict[str, str]:
    return ORACLES | building_oracle.ORACLES | workflows_oracle.ORACLES
