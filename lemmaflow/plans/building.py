"""Registered queries of the operators on plans, spans, repairs, annotations and payloads, over rows derived from the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lemmaflow.functions import patterns as R
from lemmaflow.operators import annotate, build, jobs, normalize, repair, spans, split, structure
from lemmaflow.plans import convert
from lemmaflow.plans.corpus import books
from lemmaflow.scratch import staged
from lemmaflow.sources import readers


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _long(c: str | Column) -> Column:
    return F.coalesce(c, F.lit(-1)).cast("long")


def _plans(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    b = staged(books(spark, sf_dir), "books")
    sections = staged(split.sections(b), "sections")
    return b, staged(structure.heuristic_plans(split.lines(b), sections), "plans")


def heuristic_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, plans = _plans(spark, sf_dir)
    return plans.select("doc_id", "position", "start_line", "end_line", "section_number", "section_title", "chapter", "chapter_number")


def planned_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, plans = _plans(spark, sf_dir)
    rows = structure.planned_sections(plans, b)
    return rows.select("doc_id", "section_index", "section_number", "section", "chapter", "chapter_number", _long("heading_level").alias("heading_level"), "source_heading", "start_line", "end_line", F.sha2("text", 256).alias("text_sha256"))


def dependency_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of four as raw items of a section; each depends on the one before, by its raw label, and on a label that nothing has."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.expr("doc_id div 4").alias("s"), F.expr("doc_id % 4 + 1").cast("int").alias("p"))
    label = lambda p: F.concat(F.lit("Theorem -"), F.col("s").cast("string"), F.lit("-"), p.cast("string"))
    numbers = F.when(F.col("doc_id") % 3 > 0, F.array((F.col("doc_id") % 7).cast("string"))).otherwise(F.array().cast("array<string>"))
    raw = docs.select(
        F.lit("all").alias("doc_id"), F.col("s").cast("int").alias("section_index"), F.col("p").alias("position"), F.lit("thm").alias("env"), label(F.col("p")).alias("label"), numbers.alias("number_components"),
        F.concat(F.lit("Text "), F.col("doc_id").cast("string")).alias("content"), F.array(label(F.col("p") - 1), F.lit("Lemma of nobody")).alias("dependencies"), F.lit(None).cast("string").alias("proof"),
    )
    sections = docs.select("s").distinct().select(F.lit("all").alias("doc_id"), F.col("s").cast("int").alias("section_index"), F.concat(F.lit("9."), F.col("s").cast("string")).alias("section_number"), F.lit("9").alias("chapter_number"), F.lit("S").alias("section"), F.lit("C").alias("chapter"))
    # a section is a book of its own here, so that no window holds the whole table
    apart = lambda df: df.withColumn("doc_id", F.concat(F.lit("s"), F.col("section_index").cast("string")))
    out = normalize.normalized(apart(raw), apart(sections))
    return out.select("doc_id", "item_index", "label", F.array_join("dependencies", "|").alias("dependencies"))


def span_clip_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans in the texts of documents, cut at a next item that begins at character 40; contents and proofs."""
    text = F.coalesce("text", F.lit(""))
    rows = _table(spark, sf_dir, "documents").select(
        "doc_id", text.alias("text"), (F.col("doc_id") % 9 > 0).alias("found"), (F.col("doc_id") % 50).cast("int").alias("char_start"),
        (F.col("doc_id") % 50 + F.col("doc_id") % 31).cast("int").alias("char_end"), F.when(F.col("doc_id") % 4 > 0, 40).alias("next_anchor"),
    )
    out = [spans.clipped_to_next(rows, k).withColumn("kind", F.lit(k)) for k in ("content", "proof")]
    return out[0].unionByName(out[1]).select("doc_id", "kind", "found", "char_end", F.coalesce("warning", F.lit("")).alias("warning"), F.sha2("span_text", 256).alias("span_sha256"))


def _span(start: Column, end: Column | None, nth: int = 1, inside: bool = True) -> Column:
    end = F.lit(None).cast("string") if end is None else end
    return F.struct(start.alias("start_anchor"), end.alias("end_anchor"), F.lit(1).alias("start_occurrence"), F.lit(nth).alias("end_occurrence"), F.lit(inside).alias("include_start"), F.lit(False).alias("include_end"))


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as a section."""
    return _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), F.lit(1).alias("section_index"), F.coalesce("text", F.lit("")).alias("text"), F.lit(1).alias("start_line"), F.col("doc_id").alias("n"))


def span_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two raw items a document: from its characters 5 to 7 up to the second occurrence of 20 to 21, and the rest from its first three on,
    with a proof from its last three characters on in every third document."""
    docs = _texts(spark, sf_dir)
    text, n = F.col("text"), F.col("n")
    proof = F.when(n % 3 == 0, _span(F.substring(text, -3, 3), None))
    none = F.lit(None).cast(docs.select(proof.alias("p")).schema["p"].dataType)
    items = F.array(
        F.struct(F.lit(1).alias("position"), F.lit("").alias("label"), _span(F.substring(text, 5, 3), F.when(n % 2 == 0, F.substring(text, 20, 2)), 2, False).alias("content_span"), none.alias("proof_span")),
        F.struct(F.lit(2).alias("position"), F.lit(" Lemma 2 ").alias("label"), F.when(n % 5 > 0, _span(F.substring(text, 1, 3), F.substring(text, 9, 4))).alias("content_span"), proof.alias("proof_span")),
    )
    out = build.built(docs.select("doc_id", "section_index", F.inline(items)), docs)
    sha = lambda c: F.sha2(F.coalesce(c, F.lit("-")), 256)
    return out.select(
        "doc_id", "position", F.coalesce("error", F.lit("")).alias("error"), _long("failed_at").alias("failed_at"),
        F.when(F.col("error").isNull(), sha(F.col("content"))).otherwise("").alias("content_sha256"), F.when(F.col("error").isNull(), sha(F.col("proof"))).otherwise("").alias("proof_sha256"),
    )


def repaired_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request a document: a span, the current item (its first line), or the block from an anchor (characters 5 to 7) on, as its id has it."""
    docs = _texts(spark, sf_dir)
    text, n = F.col("text"), F.col("n")
    requests = docs.select(
        "doc_id", "section_index", F.lit(1).alias("place"), F.lit("Theorem 1").alias("label"), F.lit(None).cast("string").alias("preserve_current_label"), F.when(n % 2 == 0, "thm").otherwise("nothing").alias("env"), F.array(F.lit("1")).alias("number_components"),
        F.array(F.lit(" a "), F.lit("")).alias("dependencies"), F.when(n % 3 == 2, F.substring(text, 5, 3)).alias("source_order_anchor"), F.lit(1).alias("source_order_occurrence"),
        F.when(n % 3 == 0, _span(F.substring(text, 5, 3), F.when(n % 2 == 0, F.substring(text, 20, 2)), 2, False)).alias("content_span"), F.when(n < -1, _span(F.lit("x"), None)).alias("proof_span"),
    )
    line = F.substring_index(text, "\n", 1)
    current = docs.select("doc_id", "section_index", F.lit(4).alias("item_index"), F.lit("Theorem 1").alias("label"), F.lit("lemma").alias("env"), F.when(n % 3 == 1, line).otherwise(F.lit("\u0001 nowhere")).alias("content"), F.lit(None).cast("string").alias("proof"))
    out = repair.repaired_items(requests, current, docs)
    return out.select("doc_id", "accepted", "env", F.array_join("dependencies", "|").alias("dependencies"), "content_source", F.sha2(F.coalesce("content", F.lit("-")), 256).alias("content_sha256"), _long("item_index").alias("item_index"))


def items_as_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last line of each document as a local item."""
    docs = _texts(spark, sf_dir)
    items = docs.select("doc_id", "section_index", F.lit(1).alias("position"), F.substring_index("text", "\n", -1).alias("content"), F.lit(None).cast("string").alias("proof"))
    out = build.as_spans(items, docs)
    return out.select("doc_id", _long("content_span.start_occurrence").alias("occurrence"), F.sha2(F.coalesce("content_span.start_anchor", F.lit("-")), 256).alias("anchor_sha256"), F.coalesce("error", F.lit("")).alias("error"))


def declared_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels with anchors that are each document's characters 5 to 6, and one entry that is none."""
    docs = _texts(spark, sf_dir)
    one = F.struct(F.concat(F.lit("L"), F.col("doc_id")).alias("label"), F.when(F.col("n") % 2 == 0, "thm").otherwise("odd").alias("env"), F.array(F.lit(1), F.lit(2)).alias("number_components"), F.substring("text", 5, 2).alias("anchor_text"))
    calls = docs.select("doc_id", "section_index", F.concat(F.lit('{"items":["none",'), F.to_json(one), F.lit("]}")).alias("arguments"))
    out = build.declared_labels(calls, docs)
    return out.select("doc_id", "place", "label", F.coalesce("env", F.lit("")).alias("env"), F.array_join("number_components", ".").alias("number"), "anchor_found", F.array_join(F.transform("anchor_offsets", lambda x: x.cast("string")), ",").alias("offsets"))


def tool_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as actions: some of kinds and places that don't exist."""
    o = _table(spark, sf_dir, "orders")
    one = F.struct(
        F.when(F.col("o_orderkey") % 3 == 0, "delete").when(F.col("o_orderkey") % 3 == 1, "rename").otherwise("add").alias("action"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).alias("target_label"), F.when(F.col("o_orderkey") % 5 == 0, "after").otherwise("inside").alias("anchor_position"),
        F.col("o_orderpriority").alias("reason"),
    )
    calls = o.select(F.col("o_orderkey").alias("doc_id"), F.lit(1).alias("section_index"), F.concat(F.lit("[1,"), F.to_json(one), F.lit(",null]")).alias("actions"))
    return build.tool_actions(calls).select("doc_id", "place", "action", F.coalesce("target_label", F.lit("")).alias("target_label"), F.coalesce("anchor_position", F.lit("")).alias("anchor_position"), "reason")


def tool_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as results of tool calls."""
    d = _table(spark, sf_dir, "documents")
    text = F.when(F.col("doc_id") % 3 > 0, F.coalesce("text", F.lit("")))
    found = F.to_json(F.struct(text.alias("text"), F.when(text.isNotNull(), F.col("doc_id") % 2 == 0).alias("found"), F.when(F.col("doc_id") % 4 == 0, F.sequence(F.lit(0), F.col("doc_id") % 6)).alias("matches"), F.when(F.col("doc_id") % 5 == 0, "bad").alias("error")))
    s = build.tool_summary(F.col("r"))
    rows = d.select("doc_id", found.alias("r")).select("doc_id", s.alias("s"))
    return rows.select("doc_id", F.array_join("s.keys", ",").alias("keys"), _long("s.matches_count").alias("matches_count"), F.coalesce("s.found", F.lit(False)).alias("found"), _long("s.chars").alias("chars"), F.coalesce("s.error", F.lit("")).alias("error"))


def annotation_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as items of an annotation, with pages, boxes, assets and dependencies in the forms that they may have."""
    n = F.col("doc_id")
    item = F.struct(
        F.when(n % 4 > 0, F.coalesce("text", F.lit(""))).alias("content"), F.when(n % 4 == 0, F.col("lang")).alias("statement"), F.struct(F.when(n % 2 == 0, F.col("source")).alias("chapter_title"), F.lit("C").alias("chapter"), (n % 3).alias("section_number")).alias("context"),
        F.when(n % 5 == 0, n % 7).alias("page"), F.when(n % 5 == 1, F.array((n % 3).cast("string"), F.lit("x"), F.lit("12"))).alias("pages"), F.struct(F.array(F.lit("b1"), F.lit(None)).alias("block_ids")).alias("source"),
        F.array(F.struct(F.lit(3).alias("page"), F.array(F.lit(1.5), F.lit(2.0), F.lit(3.0), F.lit(4.0)).alias("bbox")), F.struct(F.lit(4).alias("page"), F.array(F.lit(1.5)).alias("bbox"))).alias("bbox_refs"),
        F.array(F.struct(F.when(n % 2 == 0, F.concat(F.lit("T"), n.cast("string"))).alias("label"), F.lit("name").alias("name"), F.when(n % 3 == 0, "item_1").alias("target_id"))).alias("references"), F.array(F.lit("open")).alias("unresolved_references"),
        F.struct((n % 6 == 0).alias("any")).alias("modified"), F.struct(F.lit("p.png").alias("path")).alias("image"),
    )
    rows = _table(spark, sf_dir, "documents").select("doc_id", F.to_json(item).alias("payload")).select("doc_id", annotate.fields(F.col("payload")).alias("f"))
    depends = F.array_join(F.transform("f.dependencies", lambda d: F.concat(d["label"], F.lit(":"), F.coalesce(d["target_id"], F.lit("")), F.lit(":"), d["resolved"].cast("string"))), "|")
    return rows.select(
        "doc_id", F.sha2("f.statement", 256).alias("statement_sha256"), "f.context.chapter_title", "f.context.section_number", depends.alias("dependencies"), F.array_join(F.transform("f.source_refs.pages", lambda x: x.cast("string")), ",").alias("pages"),
        F.array_join("f.source_refs.block_ids", ",").alias("block_ids"), F.size("f.source_refs.bbox_refs").alias("n_boxes"), "f.assets.image_path", "f.modified",
    )


def annotation_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as submitted annotations, of which most have something wrong."""
    n = F.col("doc_id")
    items = F.when(n % 5 == 0, F.array(F.lit("a"), F.lit("b"), F.lit("a"))).when(n % 5 == 1, F.array(F.lit("a"), F.lit(""))).otherwise(F.array(F.lit("a"), F.lit("b")))
    whole = F.struct(
        F.when(n % 7 > 0, R.SCHEMA_VERSION).otherwise("v0").alias("schema_version"),
        F.when(n % 11 > 0, F.struct(F.when(n % 13 == 0, "pdf").otherwise("markdown").alias("source_type"))).alias("source"),
        F.when(n % 17 > 0, F.transform(items, lambda i: F.struct(i.alias("id")))).alias("items"), F.when(n % 19 == 0, "good").alias("quality"),
    )
    payload = F.when(n % 23 == 0, "[]").otherwise(F.to_json(whole))
    return _table(spark, sf_dir, "documents").select("doc_id", F.coalesce(annotate.payload_error(payload, F.lit("markdown")), F.lit("")).alias("error"))


def annotations_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as stored annotations and documents as submissions, every fourth one invalid: what is kept of each id."""
    made = lambda version, ids: F.to_json(F.struct(version.alias("schema_version"), F.struct(F.lit("markdown").alias("source_type")).alias("source"), F.transform(ids, lambda i: F.struct(i.cast("string").alias("id"))).alias("items")))
    good = F.lit(R.SCHEMA_VERSION)
    stored = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), made(good, F.array(F.lit(1))).alias("payload"), F.lit(10).alias("updated_at"))
    sent = _table(spark, sf_dir, "documents").filter(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").alias("id"), made(F.when(F.col("doc_id") % 4 > 0, good).otherwise("v0"), F.sequence(F.lit(1), F.col("doc_id") % 5 + 2)).alias("payload"),
        F.when(F.col("doc_id") % 3 > 0, 20).otherwise(5).alias("updated_at"),
    )
    return annotate.saved(stored, sent).select("id", "updated_at", "item_count")


def usage_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations as usage reports, with a number, and a value that is text in every third turn."""
    c = _table(spark, sf_dir, "conversations")
    n = F.length(F.coalesce("text", F.lit(""))).cast("long")
    tier = F.when(F.col("turn") % 3 == 0, F.concat(F.lit('"t'), F.col("turn").cast("string"), F.lit('"'))).otherwise((F.col("turn") * 2).cast("string"))
    turns = c.select("conv_id", "turn", F.when(F.col("turn") % 5 < 4, F.concat(F.lit('{"tokens":'), n.cast("string"), F.lit(',"tier":'), tier, F.lit("}"))).alias("usage"))
    out = jobs.merged_usage(turns, "conv_id")
    return out.select("conv_id", "name", F.regexp_replace("value", r"\.0$", "").alias("value"))


def image_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as OCR answers: text, pages, lines, failures, or nothing."""
    n, text = F.col("doc_id"), F.coalesce("text", F.lit(""))
    lines = F.split(text, "\n", -1)
    body = (
        F.when(n % 6 == 0, F.to_json(F.struct(F.lit(" ").alias("md"), text.alias("text")))).when(n % 6 == 1, F.to_json(F.struct(F.array(F.struct(text.alias("md")), F.struct(F.lit(" ").alias("md"))).alias("pages"))))
        .when(n % 6 == 2, F.to_json(F.struct(F.transform(lines, lambda x: F.struct(F.lit("").alias("md"), x.alias("latex"))).alias("lines")))).when(n % 6 == 3, F.to_json(F.struct(F.struct(F.struct(lines.alias("blocks")).alias("result")).alias("data"))))
        .when(n % 6 == 4, F.to_json(F.struct(F.lit("failed").alias("code"), text.alias("md")))).otherwise("{}")
    )
    return _table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.coalesce(readers.image_markdown(body), F.lit("-")), 256).alias("markdown_sha256"))


def export_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of exports from the first line of each document."""
    name = F.concat(F.lit("in/"), F.replace(F.substring_index(F.coalesce("text", F.lit("")), "\n", 1), F.lit("/"), F.lit("-")), F.lit(".pdf"))
    return _table(spark, sf_dir, "documents").select("doc_id", readers.export_name(name).alias("name"))


def conversion_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals from the summaries of a conversion of all books."""
    summary = convert.artefacts(staged(books(spark, sf_dir), "books"))["summary"]
    one = F.from_json("summary_json", "sections_written long, items_total long, source_file string, front_matter_chars long, back_matter_chars long, split_warnings array<string>, files array<struct<section_number:string>>")
    rows = summary.select("doc_id", one.alias("s"))
    return rows.select("doc_id", "s.sections_written", "s.items_total", "s.source_file", "s.front_matter_chars", "s.back_matter_chars", F.size("s.split_warnings").alias("n_warnings"), F.array_join("s.files.section_number", ",").alias("section_numbers"))


QUERIES = [
    conversion_summaries,
    heuristic_plans, planned_sections, dependency_rewrite, span_clip_next, span_items, repaired_items, items_as_spans, declared_labels, tool_actions, tool_summaries, annotation_fields, annotation_errors, annotations_saved, usage_merged, image_answers,
    export_names,
]
