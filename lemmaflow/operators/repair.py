"""Repair requests against a section's source: every repaired item is a literal span, a source-backed current item or a block between anchors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lemmaflow.functions import patterns as R
from lemmaflow.functions import text as T
from lemmaflow.operators import spans

KEY = ["doc_id", "section_index"]
SPAN = ["start_anchor", "end_anchor", "start_occurrence", "end_occurrence", "include_start", "include_end"]
FAR = 10**12


def resolve(rows: DataFrame, span: str, search_start: Column | None = None) -> DataFrame:
    """Adds the resolved span as a struct ``<span>_result``; null where no span was asked for."""
    own = rows.withColumns({f"r_{c}": F.col(f"{span}.{c}") for c in SPAN})
    names = rows.columns
    flat = own.select(*names, *(F.col(f"r_{c}").alias(c) for c in SPAN), *([] if search_start is None else [search_start.alias("low")]))
    done = spans.resolved(flat, F.col("low") if search_start is not None else None)
    result = F.struct(F.col("found").alias("found"), F.col("error").alias("error"), F.col("char_start").alias("char_start"), F.col("char_end").alias("char_end"))
    return done.select(*names, F.when(F.col(span).isNotNull(), result).alias(f"{span}_result"))


def repaired_items(requests: DataFrame, current: DataFrame, sections: DataFrame) -> DataFrame:
    """A row a request: whether it was accepted, and the item with content, proof, warnings and new number.

    ``requests``: doc_id, section_index, place, label, preserve_current_label, env, number_components, dependencies, source_order_anchor,
    source_order_occurrence, content_span and proof_span (structs of SPAN; null if none). ``current``: doc_id, section_index, item_index, label, env, content, proof.

    Content: the span, else the current item's if the source has it, else the block from the request's anchor to the next one. A content span that fails, or
    begins at or after the next item's anchor, rejects the item. Accepted items are ordered by where they stand, then by their current number.
    """
    latest = current.groupBy(*KEY, "label").agg(F.max_by(F.struct("item_index", "env", "content", "proof"), "item_index").alias("cur")).withColumnRenamed("label", "cur_label")
    label = T.strip(F.coalesce("label", F.lit("")))
    rows = requests.join(sections.select(*KEY, "text", "start_line"), KEY).withColumns({"label": label, "cur_label": F.coalesce(F.nullif(T.strip(F.col("preserve_current_label")), F.lit("")), label), "anchor": T.strip(F.coalesce("source_order_anchor", F.lit("")))})
    rows = rows.withColumn("anchor_at", T.nth_position(F.col("text"), F.col("anchor"), F.greatest(F.lit(1), F.coalesce("source_order_occurrence", F.lit(1))))).join(latest, [*KEY, "cur_label"], "left")
    following = Window.partitionBy(*KEY).orderBy("place").rowsBetween(1, Window.unboundedFollowing)
    rows = rows.withColumn("later", F.collect_list("anchor_at").over(following))  # in order; a section's requests are few
    rows = resolve(rows, "content_span")
    rows = resolve(rows, "proof_span", F.coalesce(F.when(F.col("content_span_result.found"), F.col("content_span_result.char_end")), F.lit(0)))

    text, c, p = F.col("text"), F.col("content_span_result"), F.col("proof_span_result")
    backed = lambda x: spans.source_backed(text, x)
    has_current = F.col("cur").isNotNull()
    wants_fallback = c.isNull() & has_current & ~(backed(F.col("cur.content")) & backed(F.col("cur.proof")))
    stop = F.coalesce(F.get(F.filter("later", lambda x: x >= F.col("anchor_at") + F.greatest(F.lit(1), F.length("anchor"))), F.lit(0)), F.length(text))
    block = T.strip(F.substring(text, F.col("anchor_at") + 1, stop - F.col("anchor_at")))
    statement, proof = spans.statement_and_proof(block)
    fallback = F.when(wants_fallback & F.col("anchor_at").isNotNull() & (stop > F.col("anchor_at")) & (statement != ""), F.struct(statement.alias("content"), proof.alias("proof"), F.col("anchor_at").alias("at")))
    rows = rows.withColumn("fallback", fallback)
    item_start = F.coalesce(F.when(c["found"], c["char_start"]), F.col("anchor_at"), F.col("fallback.at"), F.lit(0))
    rows = rows.withColumn("next_at", F.array_min(F.filter("later", lambda x: x >= item_start + 1)))

    next_at = F.col("next_at")
    good_c, good_p = F.coalesce(c["found"], F.lit(False)), F.coalesce(p["found"], F.lit(False))
    late_c, late_p = F.coalesce(good_c & (c["char_start"] >= next_at), F.lit(False)), F.coalesce(good_p & (p["char_start"] >= next_at), F.lit(False))
    cut = lambda s, late: F.when(~late & (s["char_end"] > next_at), next_at).otherwise(s["char_end"])
    piece = lambda s, late: T.strip(F.substring(text, s["char_start"] + 1, cut(s, late) - s["char_start"]))
    crossed = lambda s, good, late: F.coalesce(good & ~late & (s["char_end"] > next_at), F.lit(False))
    current_content = has_current & backed(F.col("cur.content"))
    failed = c.isNotNull() & (~good_c | late_c)
    content = F.when(c.isNotNull(), piece(c, late_c)).when(current_content, T.strip(F.coalesce("cur.content", F.lit("")))).otherwise(F.col("fallback.content"))
    source = F.when(c.isNotNull(), "span").when(current_content, "current").when(F.col("fallback").isNotNull(), "declared_anchor_span").otherwise("none")
    final_proof = F.when(good_p, F.nullif(piece(p, late_p), F.lit(""))).when(F.col("fallback").isNotNull(), F.col("fallback.proof")).when(has_current & backed(F.col("cur.proof")), F.col("cur.proof"))
    first_line = T.strip(F.get(T.split_lines(content), F.lit(0)))
    located = F.when((source == "current") & (first_line != ""), F.nullif(F.instr(text, first_line), F.lit(0)) - 1)
    order = F.least(F.coalesce("anchor_at", F.lit(FAR)), F.coalesce(F.when(good_c, c["char_start"]), F.lit(FAR)), F.coalesce("fallback.at", F.lit(FAR)), F.coalesce(located, F.lit(FAR)))
    warnings = F.array_compact(F.array(
        F.when(late_c, F.lit("content span starts at or after the next item's anchor")), F.when(crossed(c, good_c, late_c), F.lit("content span clipped at the next item's anchor")),
        F.when(late_p, F.lit("proof span starts at or after the next item's anchor; kept as a delayed proof")), F.when(crossed(p, good_p, late_p), F.lit("proof span clipped at the next item's anchor")),
        F.when(p.isNotNull() & ~good_p, F.concat(F.lit("no proof span: "), p["error"])),
        F.when(c.isNotNull() & ~good_c, F.concat(F.lit("no content span: "), c["error"])), F.when(c.isNull() & (source == "none"), F.lit("no source-backed content")),
    ))
    env = F.when(F.col("env").isin(*R.DISPLAY), F.col("env")).otherwise(F.coalesce("cur.env", F.lit("remark")))
    depends = F.filter(F.transform(F.coalesce("dependencies", F.array().cast("array<string>")), lambda d: T.strip(d)), lambda d: d != "")
    out = rows.select(
        *KEY, "place", "label", env.alias("env"), F.coalesce("number_components", F.array().cast("array<string>")).alias("number_components"), depends.alias("dependencies"),
        (~failed & (source != "none")).alias("accepted"), content.alias("content"), final_proof.alias("proof"), source.alias("content_source"), order.cast("long").alias("order_position"),
        F.coalesce("cur.item_index", F.lit(0)).alias("current_index"), warnings.alias("warnings"),
    )
    number = F.row_number().over(Window.partitionBy(*KEY, "accepted").orderBy("order_position", "current_index", "place"))
    return out.withColumn("item_index", F.when(F.col("accepted"), number)).withColumns({c: F.when(F.col("accepted"), F.col(c)) for c in ("content", "proof")})
