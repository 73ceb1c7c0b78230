"""Conversions that come again: nothing stale, whatever the second one lacks, and nothing lost when one dies."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from lemmaflow.plans.convert import artefacts, convert, read
from lemmaflow.sources import store

BOOK = "Foreword\n# Chapter 1 C\n## 1.1 A\nDefinition 1.1. x\n## 1.2 Two\nTheorem 1.2. y\nProof. z\n## References\n[1] none\n"
LONG = "folder/" + "very long name " * 30 + ".md"


def docs(spark, *rows):
    return spark.createDataFrame([(d, "d.md", t) for d, t in rows], "doc_id string, source_name string, text string")


def ids(df):
    return sorted(r["doc_id"] for r in df.collect())


def test_a_second_conversion_leaves_nothing_stale(spark, tmp_path):
    out = str(tmp_path / "out")
    audits = spark.createDataFrame([("007", 1, "Fine.", [], [], "{}")], "doc_id string, section_index int, audit_markdown string, actions array<string>, open_questions array<string>, patch_json string")
    repaired = spark.createDataFrame([("007", 2, 1, "lemma", "L", ["7"], "new", [], None)], "doc_id string, section_index int, position int, env string, label string, number_components array<string>, content string, dependencies array<string>, proof string")
    convert(docs(spark, ("007", BOOK), (LONG, BOOK)), out, audits=audits, repaired=repaired)
    assert ids(read(spark, out, "items")) == ids(read(spark, out, "candidates")) == ["007", LONG] and ids(read(spark, out, "audits")) == ["007", LONG]
    convert(docs(spark, ("007", "plain text"), ("other", BOOK)), out)
    assert ids(read(spark, out, "items")) == ids(read(spark, out, "candidates")) == ids(read(spark, out, "front_matter")) == [LONG, "other"]
    assert ids(read(spark, out, "audits")) == ids(read(spark, out, "patches")) == sorted({r["doc_id"] for r in read(spark, out, "initial_items").collect()}) == [LONG]
    assert ids(read(spark, out, "summary")) == ["007", LONG, "other"]
    assert json.loads(read(spark, out, "summary", ["007"]).first()["summary_json"])["items_total"] == 0
    before = {n: sorted(map(str, read(spark, out, n).collect())) for n in ("items", "summary", "sections", "audits")}
    assert store.vacuum(spark, out, dry_run=True) == []
    store.compact(spark, out)
    assert len(store.runs(spark, out)) == 1
    assert {n: sorted(map(str, read(spark, out, n).collect())) for n in before} == before
    store.remove(out, docs(spark, (LONG, "")).select("doc_id"))
    assert ids(read(spark, out, "items")) == ["other"]


def test_a_run_that_dies_changes_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = spark.createDataFrame([("a", 1), ("b", 1)], "doc_id string, x int")
    store.commit(out, rows, {"one": rows, "two": rows})
    breaks = F.udf(lambda x: 1 // 0, "int")
    with pytest.raises(Exception, match="ZeroDivision"):
        store.commit(out, rows, {"one": rows.withColumn("x", F.lit(2)), "two": rows.withColumn("x", breaks("x"))})
    assert [r["x"] for r in store.read(spark, out, "one").collect()] == [1, 1] and len(store.runs(spark, out)) == 1
    counts = {r["run"]: r["n_current"] for r in store.superseded(spark, out).collect()}
    assert sorted(counts.values(), key=str) == [2, None]
    assert len(store.vacuum(spark, out, uncommitted=True)) == 1 and len(store.superseded(spark, out).collect()) == 1
    store.commit(out, rows, {"one": rows.withColumn("x", F.lit(3))})
    assert [r["x"] for r in store.read(spark, out, "one").collect()] == [3, 3] and store.read(spark, out, "two").collect() == []
    assert len(store.vacuum(spark, out)) == 1 and [r["x"] for r in store.read(spark, out, "one").collect()] == [3, 3]


def test_planned_documents_have_their_plans_matter_and_warnings(spark):
    text = "\n".join(["Title", "", "preface", "# Start", "one", "two", "three", "  ", "index a", "index b"])
    books = docs(spark, ("p", text), ("q", text), ("r", text), ("s", text), ("e", ""))
    span = lambda a, b: {"start_line": a, "end_line": b}
    heads = spark.createDataFrame([
        ("p", [span(1, 1), span(3, 3), span(8, 8), span(1, 1)], [span(9, 99), span(12, 4), span(None, None)], [" odd ", "", None]),
        ("q", None, [], []), ("r", [span(2, 2)], None, None), ("s", [], [], ["unused"]), ("e", [span(1, 1)], [span(1, 2)], []),
    ], "doc_id string, front_matter_ranges array<struct<start_line:int,end_line:int>>, back_matter_ranges array<struct<start_line:int,end_line:int>>, warnings array<string>")
    plan = [("p", 0, 6, 7), ("p", 1, 4, 6), ("q", 0, 4, 8), ("q", 1, 4, 5), ("r", 0, 4, 6), ("e", 0, 1, 1)]
    plans = spark.createDataFrame([(d, i, a, b, str(i + 1), "T", "C", "1", "C", "1") for d, i, a, b in plan], "doc_id string, position int, start_line int, end_line int, section_number string, section_title string, chapter string, chapter_number string, fallback_chapter string, fallback_number string")
    out = artefacts(books, plans=plans, heads=heads)
    front = {r["doc_id"]: r["markdown"] for r in out["front_matter"].collect()}
    back = {r["doc_id"]: r["markdown"] for r in out["back_matter"].collect()}
    assert {d: front.get(d) for d in "pqre"} == {"p": "Title\n\npreface\n\nTitle\n", "q": "Title\n\npreface\n", "r": "Title\n\npreface\n", "e": None}
    assert {d: back.get(d) for d in "pqre"} == {"p": "index a\nindex b\n\nindex b\n\nTitle\n", "q": None, "r": None, "e": None}
    said = {r["doc_id"]: json.loads(r["summary_json"])["split_warnings"] for r in out["summary"].collect()}
    assert said["p"] == ["odd", "LLM structure sections were not sorted; sorted by start_line", "Adjusted overlapping section start for section 2."]
    assert said["q"] == ["Adjusted overlapping section start for section 2.", "Adjusted invalid end_line for section 2."]
    assert said["r"] == [] and said["s"][-1] == "LLM structure plan had no sections; used hard splitter fallback" and len(said["s"]) == 2
    assert ids(out["plan"]) == ["e", "p", "q", "r"]
