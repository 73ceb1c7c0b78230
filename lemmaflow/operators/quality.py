"""Quality reports: counts and warnings of sections and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lemmaflow.functions import patterns as R
from lemmaflow.operators.extract import standalone_heading

KEY = ["doc_id", "section_index"]


def env_counts(items: DataFrame) -> DataFrame:
    return items.groupBy(*KEY, "env").agg(F.count(F.lit(1)).alias("n_items"))


def duplicate_labels(items: DataFrame) -> DataFrame:
    """(doc_id, label, n_items) of labels that occur more than once in a document."""
    return items.groupBy("doc_id", "label").agg(F.count(F.lit(1)).alias("n_items")).filter("n_items > 1")


def section_reports(sections: DataFrame, items: DataFrame) -> DataFrame:
    """A row a section: source_chars, marker counts, items, proofs, env_counts (a map) and warnings, in order and once each."""
    marked = sections.select(
        *KEY, "section", "section_number", "start_line", "end_line", F.length("text").alias("source_chars"), F.regexp_count("text", F.lit(R.SOURCE_ITEM)).alias("n_item_markers"),
        F.regexp_count("text", F.lit(R.PROOF_MARKER)).alias("n_proof_markers"), standalone_heading().alias("standalone"),
    )
    checks = F.filter(F.array(
        F.when(F.col("truncated"), F.concat("label", F.lit(R.WARN_TRUNCATED))), F.when(F.col("proof_left") & ~F.col("standalone"), F.concat("label", F.lit(R.WARN_PROOF_LEFT))),
    ), lambda x: x.isNotNull())
    # contents are looked at where they are and don't move
    may_be = F.contains("content", F.lit("[")) | F.contains("content", F.lit("..."))
    looked = items.select(*KEY, "item_index", "label", "env", (F.coalesce(F.col("proof"), F.lit("")) != "").alias("has_proof"), (may_be & F.rlike("content", F.lit(R.TRUNCATED))).alias("truncated"), (F.col("proof").isNull() & F.rlike("content", F.lit(R.PROOF_MARKER))).alias("proof_left"))
    each = looked.join(marked.select(*KEY, "standalone"), KEY)
    kinds = env_counts(items).groupBy(*KEY).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("env", F.col("n_items").cast("int"))))).alias("env_counts"))
    own = each.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n_items"), F.count_if("has_proof").alias("n_proofs"), F.count_if(F.col("env") == "remark").alias("n_remarks"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("item_index", checks.alias("w")))), lambda x: x["w"])).alias("item_warnings"),
    )
    out = marked.join(own, KEY, "left").join(kinds, KEY, "left").withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_items", "n_proofs", "n_remarks")})
    n, markers = F.col("n_items"), F.col("n_item_markers")
    rules = F.array_compact(F.array(
        F.when((markers > 0) & (n == 0), F.lit(R.WARN_NO_ITEMS)),
        F.when((markers >= 3) & (n <= 1), F.format_string(R.WARN_FEW_ITEMS, markers, n)),
        F.when((n > 0) & (F.col("n_remarks") == n) & (markers >= 2), F.lit(R.WARN_REMARKS_ONLY)),
        F.when((F.col("n_proof_markers") > 0) & (F.col("n_proofs") == 0) & ~F.col("standalone"), F.lit(R.WARN_NO_PROOFS)),
    ))
    warnings = F.array_distinct(F.concat(F.coalesce("item_warnings", F.array().cast("array<string>")), rules))
    return out.select(
        *KEY, "section", "section_number", "start_line", "end_line", F.col("source_chars").cast("long").alias("source_chars"), markers.cast("long").alias("n_item_markers"),
        F.col("n_proof_markers").cast("long").alias("n_proof_markers"), "n_items", "n_proofs", "env_counts", warnings.alias("warnings"),
    )


def document_reports(sections: DataFrame, items: DataFrame, split_warnings: DataFrame) -> DataFrame:
    """A row a document: sections_total, items_total, duplicate_labels and global_warnings."""
    total = sections.groupBy("doc_id").agg(F.count(F.lit(1)).alias("sections_total"))
    own = items.groupBy("doc_id").agg(F.count(F.lit(1)).alias("items_total"), F.count_if(F.col("env") == "remark").alias("n_remarks"))
    twice = duplicate_labels(items).groupBy("doc_id").agg(F.sort_array(F.collect_list("label")).alias("duplicate_labels"))
    split = split_warnings.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "warning"))), lambda x: x["warning"]).alias("split"))
    none = F.array().cast("array<string>")
    out = total.join(own, "doc_id", "left").join(twice, "doc_id", "left").join(split, "doc_id", "left").withColumns({"items_total": F.coalesce("items_total", F.lit(0).cast("long")), "duplicate_labels": F.coalesce("duplicate_labels", none)})
    more = F.array_compact(F.array(
        F.when(F.size("duplicate_labels") > 0, F.concat(F.lit(R.WARN_LABELS), F.array_join(F.slice("duplicate_labels", 1, 20), ", "))),
        F.when((F.col("items_total") > 0) & (F.col("n_remarks") == F.col("items_total")), F.lit(R.WARN_ALL_REMARKS)),
    ))
    return out.select("doc_id", "sections_total", "items_total", "duplicate_labels", F.array_distinct(F.concat(F.coalesce("split", none), more)).alias("global_warnings"))
