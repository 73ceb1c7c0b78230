"""Raw items of a model to items: literal spans with diagnostics, local items as spans, and the tables of a repair's tool calls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lemmaflow.functions import patterns as R
from lemmaflow.functions import text as T
from lemmaflow.functions import values as V
from lemmaflow.operators.repair import resolve

KEY = ["doc_id", "section_index"]


def built(raw: DataFrame, sections: DataFrame) -> DataFrame:
    """A row for each raw item, with content and proof cut from its section's source, and what went wrong.

    ``raw``: doc_id, section_index, position, label, content_span and proof_span (structs as ``repair.SPAN``; a null proof span is none), and columns
    that are kept. Adds content, proof, content_result, proof_result, error, failed_at (the section's first item with an error, else null)
    and built. A section with an error has no items, and items after the failing one aren't looked at. A proof begins at the content's end at the earliest.
    """
    rows = resolve(raw.join(sections.select(*KEY, "text", "start_line"), KEY), "content_span")
    rows = resolve(rows, "proof_span", F.coalesce(F.when(F.col("content_span_result.found"), F.col("content_span_result.char_end")), F.lit(0)))
    content, proof = F.col("content_span_result"), F.col("proof_span_result")
    cut = lambda r: T.strip(F.substring("text", r["char_start"] + 1, r["char_end"] - r["char_start"]))
    label = T.strip(F.coalesce("label", F.lit("")))
    name = F.when(label != "", label).otherwise(F.col("position").cast("string"))
    rows = rows.withColumns({"name": name, "content": cut(content), "proof": F.nullif(cut(proof), F.lit(""))})
    said = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    error = (
        F.when(F.col("content_span").isNull(), said(R.ERROR_ITEM, F.col("name"), R.ERROR_NO_SPAN))
        .when(~content["found"], said(R.ERROR_CONTENT, F.col("name"), ": ", content["error"]))
        .when(~proof["found"], said(R.ERROR_PROOF, F.col("name"), ": ", proof["error"]))
        .when(F.col("content") == "", said(R.ERROR_ITEM, F.col("name"), R.ERROR_EMPTY))
    )
    rows = rows.withColumn("error", error)
    failed = F.min(F.when(F.col("error").isNotNull(), F.col("position"))).over(Window.partitionBy(*KEY))
    own = [c for c in raw.columns if c not in ("content", "proof")]
    out = rows.withColumn("failed_at", failed).filter("failed_at is null or position <= failed_at")
    return out.select(*own, "content", "proof", F.col("content_span_result").alias("content_result"), F.col("proof_span_result").alias("proof_result"), "error", "failed_at", F.col("failed_at").isNull().alias("built"))


def _whole_span(text: Column, own: Column, occurrence: Column | None = None) -> Column:
    """A span that is all of ``own``, by its occurrence in the source; null if the source hasn't got it."""
    at = F.instr(text, own)
    before = F.substring(text, F.lit(1), at - 1)
    nth = F.lit(1) if occurrence is not None else ((F.length(before) - F.length(F.replace(before, own, F.lit("")))) / F.length(own)).cast("int") + 1
    span = F.struct(own.alias("start_anchor"), own.alias("end_anchor"), nth.alias("start_occurrence"), nth.alias("end_occurrence"), F.lit(True).alias("include_start"), F.lit(True).alias("include_end"))
    return F.when((own != "") & (at > 0), span)


def as_spans(items: DataFrame, sections: DataFrame) -> DataFrame:
    """Local items as a model would give them: content and proof as spans of the source. ``error`` tells of texts that aren't in one piece there."""
    rows = items.join(sections.select(*KEY, "text"), KEY)
    text, content, proof = F.col("text"), F.coalesce("content", F.lit("")), F.col("proof")
    spans = {"content_span": _whole_span(text, content), "proof_span": _whole_span(text, F.coalesce(proof, F.lit("")), F.lit(1))}
    missing = F.when(F.col("content_span").isNull(), content).when(proof.isNotNull() & F.col("proof_span").isNull(), proof)
    return rows.withColumns(spans).withColumns({"source_order_anchor": content, "error": F.when(missing == "", R.ERROR_EMPTY_TEXT).otherwise(F.concat(F.lit(R.ERROR_NOT_IN_SOURCE), F.substring(missing, 1, 80)))}).drop("text")


def declared_labels(calls: DataFrame, sections: DataFrame, most: int = 5) -> DataFrame:
    """Labels that a model declared, with the first places of their anchors in the section: a row a label.

    ``calls``: doc_id, section_index and arguments (JSON with ``items``). Entries that are no objects go.
    """
    rows = calls.join(sections.select(*KEY, "text"), KEY)
    items = F.filter(V.listed(V.field(V.parsed(F.col("arguments")), "items")), V.is_object)
    each = rows.select(*KEY, "text", F.posexplode(items).alias("place", "i"))
    i, env = F.col("i"), V.nullable_text(F.col("i"), "env")
    each = each.select(
        *KEY, "text", (F.col("place") + 1).alias("place"), V.first_text(i, "label").alias("label"), F.when(env.isin(*R.DISPLAY), env).alias("env"), V.text_list(V.field(i, "number_components")).alias("number_components"), V.first_text(i, "anchor_text").alias("anchor_text"),
        V.first_text(i, "reason").alias("reason"),
    )
    found = each.withColumn("anchor_offsets", T.positions(F.col("text"), F.col("anchor_text"), most))
    return found.withColumn("anchor_found", F.size("anchor_offsets") > 0).drop("text")


def tool_actions(calls: DataFrame) -> DataFrame:
    """Actions of a model in their normal form, a row an action. ``calls``: doc_id, section_index and actions (a JSON list); entries that are no objects go."""
    a = F.col("a")
    name = lambda n: V.nullable_text(a, n)
    rows = calls.select(*KEY, F.posexplode(F.filter(V.listed(V.parsed(F.col("actions"))), V.is_object)).alias("place", "a"))
    return rows.select(
        *KEY, (F.col("place") + 1).alias("place"), F.when(name("action").isin(*R.ACTIONS), name("action")).otherwise("update").alias("action"), name("target_label").alias("target_label"),
        F.when(name("anchor_position").isin(*R.ANCHOR_POSITIONS), name("anchor_position")).alias("anchor_position"), name("anchor_target_label").alias("anchor_target_label"), name("provisional_label").alias("provisional_label"),
        F.when(name("env").isin(*R.DISPLAY), name("env")).alias("env"), V.first_text(a, "reason").alias("reason"), name("content_excerpt").alias("content_excerpt"), name("field_updates_note").alias("field_updates_note"),
    )


def tool_summary(result: Column) -> Column:
    """What a tool call's result (JSON) holds: its keys, and the numbers and signs that are there; null for what isn't an object."""
    v = V.parsed(result)
    size = lambda n: F.when(V.field(v, n).isNotNull(), F.coalesce(F.size(V.listed(V.field(v, n))), F.lit(0)))
    has_text = V.field(v, "text").isNotNull()
    return F.when(V.is_object(v), F.struct(
        F.array_sort(F.map_keys(F.try_variant_get(v, "$", "map<string,variant>"))).alias("keys"), size("declared_labels").alias("declared_labels_count"), size("matches").alias("matches_count"),
        F.when(has_text, F.try_variant_get(v, "$.found", "boolean")).alias("found"), F.when(has_text, F.length(V.first_text(v, "text"))).alias("chars"), size("repaired_items").alias("repaired_items_count"), V.nullable_text(v, "error").alias("error"),
    ))


def unaudited(sections: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, section_index, audit_markdown, actions, open_questions, patch_json): an audit that changes nothing, for runs without a model."""
    n = items.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
    name = F.concat(F.format_string("section%02d_", "section_index"), "section_number")
    said = F.concat(F.lit("Section "), name, F.lit(": "), "section", F.lit(R.NO_AUDIT[0]), F.coalesce("n", F.lit(0)).cast("string"), F.lit(R.NO_AUDIT[1]))
    none = F.array().cast("array<string>")
    patch = F.to_json(F.struct(name.alias("section_id"), F.lit("no change").alias("overall_assessment"), none.alias("actions"), none.alias("open_questions")))
    return sections.join(n, KEY, "left").select(*KEY, said.alias("audit_markdown"), none.alias("actions"), none.alias("open_questions"), patch.alias("patch_json"))
