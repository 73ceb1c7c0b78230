"""Answers kept by what was asked, resumption, and structure plans with broken answers."""

from __future__ import annotations

import json
import sys
from collections import Counter

from pyspark import cloudpickle
from pyspark.sql import functions as F

from lemmaflow.operators import models, planner, split
from lemmaflow.plans.convert import artefacts

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks can't import the tests


def sections(spark, *rows):
    return spark.createDataFrame([(d, i, s, "1", "c", "", t) for d, i, s, t in rows], "doc_id string, section_index int, section string, section_number string, chapter string, chapter_number string, text string")


def make():
    def client(row):
        if row["text"] == "breaks":
            raise OSError("busy")
        return [{"label": f"{row['section']}:{row['text']}", "env": "thm", "content": row["text"]}], {"input_tokens": 5}

    return client


def test_answers_are_asked_once_for_what_they_depend_on(spark, tmp_path):
    def go(rows, **settings):
        store = models.AnswerStore(spark, str(tmp_path / "answers"), settings or {"model": "m", "effort": "low"})
        return {(r["doc_id"], r["section_index"]): (r["reused"], r["response"] and json.loads(r["response"])[0]["label"], r["error"]) for r in store.answered(sections(spark, *rows), make, attempts=1).collect()}

    first = [("d", 1, "s", "x"), ("d", 2, "s", "y"), ("e", 1, "s", "x"), ("e", 2, "s", "breaks")]
    assert go(first) == {("d", 1): (False, "s:x", None), ("d", 2): (False, "s:y", None), ("e", 1): (False, "s:x", None), ("e", 2): (False, None, "OSError: busy")}
    assert spark.read.parquet(str(tmp_path / "answers")).count() == 3  # equal sections are one question
    # a text and a title change; sections move; a failure is asked again
    second = [("d", 2, "s", "x"), ("d", 1, "s", "z"), ("e", 1, "t", "y"), ("e", 2, "s", "breaks")]
    assert go(second) == {("d", 2): (True, "s:x", None), ("d", 1): (False, "s:z", None), ("e", 1): (False, "t:y", None), ("e", 2): (False, None, "OSError: busy")}
    assert go(second[:1], effort="low", model="m") == {("d", 2): (True, "s:x", None)}
    assert go(second[:1], model="m", effort="high") == {("d", 2): (False, "s:x", None)}
    store = models.AnswerStore(spark, str(tmp_path / "answers"), {"model": "m", "effort": "low"})
    later = store.kept().filter("response like '%s:z%'").select("key", F.lit('[{"label": "later"}]').alias("response"), F.lit(1).cast("long").alias("input_tokens"), F.lit(1).cast("long").alias("output_tokens"), F.lit(0.0).alias("elapsed_seconds"), F.lit(None).cast("string").alias("error"))
    store.append(later)
    got = models.extracted(sections(spark, ("d", 1, "s", "z")), store, make, attempts=1).collect()
    assert [(r["section_index"], r["position"], r["label"]) for r in got] == [(1, 1, "later")]


def test_resumption_is_refused_on_a_mismatch(spark):
    docs = lambda *rows: spark.createDataFrame(rows, "doc_id string, text string")
    old = models.manifest_of(docs(("a", "x"), ("b", "x"), ("n", None)), {"m": 1, "e": "low"})
    state = lambda settings: {r["doc_id"]: r["state"] for r in models.resumable(docs(("a", "x"), ("b", "y"), ("c", "x"), ("n", "")), settings, old).collect()}
    assert state({"e": "low", "m": 1}) == {"a": "resume", "b": "input changed", "c": "new", "n": "resume"}
    assert state({"e": "high", "m": 1}) == {"a": "settings changed", "b": "input changed", "c": "new", "n": "settings changed"}


BOOK = "Title\n# Chapter 2. C\n## 2.1 A\nDefinition 1. x\n1.2 Bare Title\nTheorem 2. y\nindex"


def test_planner_is_asked_and_its_answers_are_checked(spark):
    good = {"chapter": "Plan", "sections": [{"start_line": 3, "end_line": 4, "section_number": "1", "section_title": "A"}, {"start_line": 5, "end_line": 6, "section_number": "2", "section_title": "B", "chapter": " ", "chapter_number": ""}], "back_matter_ranges": [{"start_line": 7, "end_line": 9}], "warnings": ["odd"], "front_matter_ranges": None}
    cases = {
        "good": json.dumps(good), "json": "{", "list": "[1]", "none": None, "missing": '{"chapter": "x"}', "kind": '{"sections": {}}',
        "row": '{"sections": [5, {"start_line": "3", "end_line": null}]}', "soft": '{"sections": [{"start_line": 1, "end_line": 2, "section_title": 7}], "chapter_number": 2, "back_matter_ranges": [{"start_line": 1.5}, 3], "warnings": "w"}',
        "empty": '{"sections": [], "warnings": []}', "raises": None,
    }
    docs = spark.createDataFrame([(d, f"{d}.md", BOOK) for d in cases], "doc_id string, source_name string, text string")

    def client_maker():
        def client(row):
            assert row["n_lines"] == 7 and [s["section_number"] for s in json.loads(row["sections"])] == ["2.1"] and any(c["kind"] == "bare_section_candidate" for c in json.loads(row["candidates"]))
            if row["doc_id"] == "raises":
                raise OSError("down")
            return cases[row["doc_id"]], {"input_tokens": 1}

        return client

    asked = planner.asked(planner.requests(docs, "always"), client_maker, attempts=1).cache()
    assert asked.count() == len(cases) and planner.requests(docs, "never").count() == 0 and planner.requests(docs).count() == len(cases)
    found = planner.faults(asked).collect()
    fatal = {(r["doc_id"], r["path"], r["fault"]) for r in found if r["fatal"]}
    assert fatal == {
        ("json", "$", "not JSON"), ("list", "$", "is array"), ("none", "$", "missing"), ("missing", "$.sections", "missing"), ("kind", "$.sections", "is object"), ("raises", "$", "OSError: down"),
        ("row", "$.sections[0]", "is bigint"), ("row", "$.sections[1].start_line", "is string"), ("row", "$.sections[1].end_line", "missing"),
    }
    soft = {(r["doc_id"], r["path"], r["fault"]) for r in found if not r["fatal"]}
    assert soft == {("soft", "$.sections[0].section_title", "is bigint"), ("soft", "$.chapter_number", "is bigint"), ("soft", "$.back_matter_ranges[0].start_line", "is decimal"), ("soft", "$.back_matter_ranges[1]", "is bigint"), ("soft", "$.warnings", "is string")}
    heads, plans = planner.plans(asked, split.sections(docs))
    assert {r["doc_id"] for r in heads.collect()} == {"good", "soft", "empty"}
    rows = {(r["doc_id"], r["position"]): r for r in plans.collect()}
    assert (rows["good", 0]["chapter"], rows["good", 0]["chapter_number"], rows["good", 0]["fallback_number"]) == ("Plan", None, "2")
    assert (rows["good", 1]["chapter"], rows["good", 1]["chapter_number"]) == ("Plan", "") and (rows["soft", 0]["section_title"], rows["soft", 0]["chapter_number"]) == ("7", "2")
    out = artefacts(docs, plans=plans, heads=heads)
    numbers = Counter((r["doc_id"], f["section_number"]) for r in out["summary"].collect() for f in json.loads(r["summary_json"])["files"])
    assert numbers == Counter({("good", "2.1"): 1, ("good", "2"): 1, ("soft", "2.1"): 1} | {(d, "2.1"): 1 for d in cases if d not in ("good", "soft")})
    said = {r["doc_id"]: json.loads(r["summary_json"])["split_warnings"] for r in out["summary"].collect()}
    assert said["good"] == ["odd"] and said["empty"][-1].startswith("LLM structure plan had no sections") and {r["doc_id"]: r["markdown"] for r in out["back_matter"].collect()}["good"] == "index\n"
