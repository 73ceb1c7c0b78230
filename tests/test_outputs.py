"""Sinks, prompt profiles and the pluggable model."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from lemmaflow.functions.profiles import profile
from lemmaflow.operators import annotate, extract, models, normalize, quality, spans, split
from lemmaflow.sources import store, writers

BOOK = "# Chapter 1. C\n## 1.1 A | B\nDefinition 1.1. x ...\n## 1.2 Two\nTheorem 1.2. y\nProof. z\n"


def test_results_as_json_and_markdown(spark, tmp_path):
    docs = spark.createDataFrame([("d", "d.md", BOOK)], "doc_id string, source_name string, text string")
    sections = split.sections(docs).cache()
    items = normalize.normalized(models.extracted(sections), sections).cache()
    reports = quality.section_reports(sections, items).cache()
    found = json.loads(writers.items_json(items).first()["items_json"])
    assert [i["label"] for i in found] == ["Definition 1.1", "Theorem 1.2"] and found[0]["proof"] is None and found[1]["context"]["section_number"] == "1.2"
    assert [s["items"] for s in json.loads(writers.structure_index(sections, reports).first()["structure_json"])] == [1, 1]
    index = writers.index_markdown(reports, docs).first()["markdown"]
    assert "1.1. A \\| B" in index and "Total items: 2" in index
    text = writers.quality_markdown(quality.document_reports(sections, items, split.split_warnings(sections)), reports).first()["markdown"]
    assert "- none" in text and "### section01" in text and "content appears truncated" in text
    for d in ("d", "e", "d"):
        store.commit(str(tmp_path / "out"), docs.select(F.lit(d).alias("doc_id")), {"items": items.withColumn("doc_id", F.lit(d))})
    assert {r["doc_id"]: r["n"] for r in store.read(spark, str(tmp_path / "out"), "items").groupBy("doc_id").agg(F.count("*").alias("n")).collect()} == {"d": 2, "e": 2}


def test_model_answers_and_retries(spark):
    sections = spark.createDataFrame([("d", i, "s", "1", "c", "", f"text {i}") for i in (1, 2, 3)], "doc_id string, section_index int, section string, section_number string, chapter string, chapter_number string, text string")

    def make():
        calls = {}

        def client(row):
            n = calls[row["section_index"]] = calls.get(row["section_index"], 0) + 1
            if row["section_index"] == 3 or n == 1:
                raise OSError("busy")
            return [{"label": "L", "env": "thm", "content": row["text"]}], {"input_tokens": 5}

        return client

    out = {r["section_index"]: r for r in models.answers(sections, make, delay=0).collect()}
    assert out[1]["error"] is None and out[1]["input_tokens"] == 5 and out[3]["error"] == "OSError: busy" and out[3]["response"] is None


def test_profiles(spark):
    rows = [
        ("x", "1. A", "1.1", "1", "h", "plain", "textbook"), ("x", "A", "2", "", "h", "plain", "paper"), ("x", "A", "2", "1", "h", "Our Contributions are", "paper"),
        ("x", "A", "2", "1", "h", "定理", "chinese_math"), ("x", "A", "2", "1", "h", "汉" * 20, "chinese_math"), ("x", "A", "2", "1", "h", "y" * 4000 + "abstract", "textbook"),
    ]
    df = spark.createDataFrame(rows, "chapter string, section string, section_number string, chapter_number string, source_heading string, text string, want string")
    assert all(r["got"] == r["want"] for r in df.withColumn("got", profile()).collect())
    assert df.select(profile("paper").alias("p")).first()["p"] == "paper" and df.select(profile("odd").alias("p")).first()["p"] == "textbook"


def test_audits_and_patches(spark):
    sections = spark.createDataFrame([("d", 2, "B", "1.2"), ("d", 1, "A", "1.1"), ("d", 3, "C", None), ("e", 1, None, "1")], "doc_id string, section_index int, section string, section_number string")
    audits = spark.createDataFrame(
        [("d", 1, "fine \n\n", [], ["", None, "why?"], "{}"), ("d", 2, None, ["update"], None, '{"x":1}'), ("z", 1, "stray", None, None, None)],
        "doc_id string, section_index int, audit_markdown string, actions array<string>, open_questions array<string>, patch_json string",
    )
    got = {r["doc_id"]: r["markdown"] for r in writers.audit_markdown(sections, audits).collect()}
    assert got["d"] == "# Consolidated LLM Audit Report\n\n## section01.json A\n\nfine\n\n## section02.json B\n\n\n\n## section03.json C\n\nAudit unavailable.\n"
    assert set(got) == {"d", "e"}
    patch = {r["doc_id"]: r for r in writers.patch_candidates(sections, audits).collect()}
    assert patch["d"]["no_change"] == ["section01_1.1"] and patch["d"]["sections"] == ['{"x":1}'] and patch["d"]["overall_assessment"] == "localized repair"
    assert [tuple(x) for x in patch["d"]["defer"]] == [("section01_1.1", "why?"), ("section03_", "audit result unavailable")]
    assert patch["e"]["overall_assessment"] == "no change" and patch["e"]["no_change"] == [] and len(patch["e"]["defer"]) == 1
    assert writers.patch_candidates(sections.limit(0), audits).count() == 0


def test_search_counts_matches_without_overlaps(spark):
    rows = spark.createDataFrame([(1, "aaaa\nbaa", "aa", 5), (2, "x\\Ey", "\\E", 1), (3, None, "a", 1), (4, "abc", "", 1), (5, "abc", None, 1), (6, "😀.😀.", ".", 1)], "id int, text string, query string, start_line int")
    got = [(r["id"], r["offset"], r["line"], r["snippet"]) for r in spans.searched(rows, most=3, around=1).orderBy("id", "offset").collect()]
    assert got == [(1, 0, 5, "aaa"), (1, 2, 5, "aaa\n"), (1, 6, 6, "baa"), (2, 1, 1, "x\\Ey"), (6, 1, 1, "😀.😀"), (6, 3, 1, "😀.")]
    assert [r["offset"] for r in spans.searched(rows.filter("id = 1"), most=0).collect()] == [0]


def test_annotation_documents_are_whole(spark):
    text = "# Chapter 1 C\n## 1.1 A\nDefinition 1.1. x\n## 1.2 B\nDefinition 1.1. y\nProof of nothing.\n# Chapter 2 D\n## 2.1 E\nTheorem 2.1. z\n"
    docs = spark.createDataFrame([("a", "a.md", text), ("none", "scan.PNG", "plain"), ("e", None, ""), (None, "lost.md", "x")], "doc_id string, source_name string, text string")
    sections = split.sections(docs)
    items = normalize.normalized(extract.local_items(sections), sections)
    reports, whole = quality.section_reports(sections, items), quality.document_reports(sections, items, split.split_warnings(sections))
    out = annotate.assembled(annotate.annotated(items), whole, reports, docs.unionByName(docs.filter("doc_id = 'a'")).withColumn("source_type", F.when(F.col("doc_id") == "none", "pdf")))
    rows = {r["doc_id"]: json.loads(r["annotation_json"]) for r in writers.annotation_json(out).collect()}
    assert set(rows) == {"a", "none", "e"}
    a = rows["a"]
    assert list(a) == ["schema_version", "source", "document", "items", "quality"] and a["source"] == {"filename": "a.md", "source_type": "markdown", "original_mime_type": "text/markdown", "content_hash": None}
    # ids count through the document, not through a section
    assert [(i["id"], i["order_index"], i["type"]) for i in a["items"]] == [("item_000001", 1, "def"), ("item_000002", 2, "def"), ("item_000003", 3, "thm")]
    assert set(a["items"][0]) == {"id", "order_index", "label", "label_raw", "type", "number_components", "statement", "proof", "context", "dependencies", "source_refs", "assets", "audit", "raw"}
    assert a["items"][0]["source_refs"] == {"pages": [], "block_ids": [], "span_ids": [], "bbox_refs": []} and a["items"][2]["proof"] == ""
    assert [c["number"] for c in a["document"]["chapters"]] == ["1", "2"] and a["document"]["title"] == a["document"]["chapters"][0]["title"]
    codes = [(i["code"], i["item_id"]) for i in a["quality"]["issues"]]
    assert codes[:2] == [("duplicate_label", "item_000001"), ("duplicate_label", "item_000002")] and ("global_warning", None) in codes[2:]
    assert a["quality"]["warning_count"] == len(codes) and a["quality"]["error_count"] == 0
    assert rows["none"]["source"]["original_mime_type"] == "application/pdf" and rows["none"]["items"] == [] and rows["none"]["document"]["chapters"] == []
    assert rows["e"]["source"]["filename"] == "input" and rows["e"]["document"] == {"title": "", "language": "", "chapters": []}
    bad = writers.annotation_json(out).filter(annotate.payload_error(F.col("annotation_json")).isNotNull())
    assert bad.count() == 0
    empty = annotate.assembled(annotate.annotated(items.limit(0)), whole.limit(0), reports.limit(0), docs.limit(0))
    assert empty.count() == 0
