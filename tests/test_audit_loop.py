"""The repair's tool loop with scripted clients, one for each way that it can end."""

from __future__ import annotations

import json
import sys
from collections import Counter

import pytest
from pyspark import cloudpickle

from lemmaflow.functions import patterns as R
from lemmaflow.operators import audit
from lemmaflow.plans.convert import artefacts

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks can't import the tests

TEXT = "Definition 1. A ring is a set.\nTheorem 2. Rings exist.\nProof. Zero is one.\nRemark. End."
LIST, SEARCH, EXTRACT, BUILD = R.TOOLS


def span(start, end=None, **more):
    return {"start_anchor": start, "end_anchor": end, "start_occurrence": 1, "end_occurrence": 1, "include_start": True, "include_end": False} | more


def request(label, anchor, **more):
    return {"label": label, "env": "thm", "number_components": ["2", None], "dependencies": [" Definition 1 ", ""], "source_order_anchor": anchor, "source_order_occurrence": 1, "content_span": None, "proof_span": None} | more


GOOD = {"audit_markdown": " Checked. ", "overall_assessment": "minor repair", "open_questions": ["why?"], "actions": [{"action": "update", "target_label": "Theorem 2", "reason": "span"}, "odd"], "items": [
    request("Theorem 2", "Theorem 2", content_span=span("Theorem 2", "Proof."), proof_span=span("Proof.", "Remark.", include_start=False)),
    request("Definition 1", "Definition 1", preserve_current_label="Definition 1", env="nothing"), "odd",
]}
BAD = {"items": [request("X", "Remark", content_span=span("nowhere")), request("Definition 1", "Definition", content_span=span("Definition 1"))]}


def make():
    def client(row):
        i, messages = row["section_index"], json.loads(row["messages"])
        turn = sum(m["role"] == "assistant" for m in messages)
        assert row["tool_choice"] == (LIST if turn == 0 else BUILD if turn == 7 else "auto") and len(json.loads(row["items"])) == 1
        usage = {"input_tokens": 10, "model": f"m{turn}"}
        if i == 1:
            if turn == 0:
                return None, [("a", LIST, json.dumps({"notes": "n", "items": [{"label": "T", "env": "thm", "anchor_text": "Rings"}, {"label": "U", "env": "odd", "anchor_text": "no"}, 5]}))], usage
            if turn == 1:
                listed = json.loads(messages[1]["content"])
                assert [m["role"] for m in messages] == ["assistant", "tool"] and messages[1]["call"] == "a"
                assert [(x["label"], x["env"], x["anchor_found"], x["anchor_offsets"]) for x in listed["declared_labels"]] == [("T", "thm", True, [TEXT.index("Rings")]), ("U", None, False, [])]
                assert listed["current_labels"] == ["Definition 1"] and listed["notes"] == "n"
                return "looking", [("b", SEARCH, json.dumps({"query": "ing", "max_matches": 2})), ("c", EXTRACT, json.dumps(span("Theorem 2", "Proof."))), ("d", EXTRACT, "{"), ("e", "odd_tool", "{}"), ("f", SEARCH, "[]")], usage
            got = {m["call"]: json.loads(m["content"]) for m in messages if m["role"] == "tool"}
            assert [m["offset"] for m in got["b"]["matches"]] == [TEXT.index("ing"), TEXT.index("ing", TEXT.index("ing") + 1)] and got["f"] == {"matches": []}
            assert got["c"]["found"] and got["c"]["text"] == "Theorem 2. Rings exist.\n" and got["c"]["line_start"] == 12 and got["d"] == {"found": False, "text": "", "error": "empty start_anchor"}
            assert got["e"] == {"error": "Unknown audit source tool: odd_tool"} and messages[-1]["role"] == "user"
            return None, [("z", BUILD, json.dumps(GOOD))], usage
        if i == 2:  # turns used up, then the forced build
            return ("thinking", [], usage) if turn < 7 else (None, [("z", BUILD, json.dumps(GOOD))], usage)
        if i == 3:
            return "never", [], {}
        if i == 4:
            raise OSError("service is down")
        if i == 5:
            return None, [("y", BUILD, "{}"), ("x", LIST, json.dumps({"items": [{"label": "T"}]})), ("z", BUILD, json.dumps(BAD))], usage

    return client


@pytest.fixture(scope="module")
def found(spark):
    sections = spark.createDataFrame([("d", i, TEXT, 11) for i in range(1, 6)], "doc_id string, section_index int, text string, start_line int")
    current = spark.createDataFrame([("d", i, 1, "Definition 1", "def", "A ring is a set.", None) for i in range(1, 6)], "doc_id string, section_index int, item_index int, label string, env string, content string, proof string")
    return audit.tool_loop(sections, current, make, attempts=2, delay=0.0)


def test_every_ending(found):
    assert {r["section_index"]: r["error"] for r in found["errors"].collect()} == {3: R.TOOL_NO_RESULT, 4: "OSError: service is down"}
    turns = Counter(r["section_index"] for r in found["replies"].collect())
    assert turns == {1: 3, 2: 8, 3: 8, 4: 1, 5: 1}
    audits = {r["section_index"]: r for r in found["audits"].collect()}
    assert set(audits) == {1, 2, 5} and audits[1]["audit_markdown"] == "Checked." and audits[1]["actions"] == ["update"] and audits[1]["open_questions"] == ["why?"]
    patch = json.loads(audits[1]["patch_json"])
    assert patch["section_id"] == "section01" and patch["overall_assessment"] == "minor repair" and patch["actions"][0]["target_label"] == "Theorem 2"
    assert audits[5]["audit_markdown"].startswith("Source-span validation warnings:\n- ") and audits[5]["actions"] == []


def test_repaired_items(found):
    rows = {(r["section_index"], r["position"]): r for r in found["repaired"].collect()}
    for i in (1, 2):
        one, two = rows[i, 1], rows[i, 2]
        assert (one["label"], one["env"], one["content"], one["proof"]) == ("Definition 1", "def", "A ring is a set.", None)
        assert (two["label"], two["env"], two["content"], two["proof"], two["number_components"], two["dependencies"]) == ("Theorem 2", "thm", "Theorem 2. Rings exist.", "Zero is one.", ["2"], ["Definition 1"])
    assert rows[5, 1]["label"] == "Definition 1" and (5, 2) not in rows and len(rows) == 5


def test_traces_and_usage(found):
    traces = {(r["section_index"], r["turn"], r["place"]): r for r in found["traces"].collect()}
    assert [traces[1, 1, k]["tool"] for k in range(5)] == [SEARCH, EXTRACT, EXTRACT, "odd_tool", SEARCH] and traces[1, 1, 0]["summary"]["matches_count"] == 2
    assert json.loads(traces[1, 2, 0]["result"])["tool_validation"]["declared_labels_count"] == 2 and json.loads(traces[5, 0, 2]["result"])["tool_validation"]["declared_labels_count"] == 1
    usage = {(r["section_index"], r["name"]): r["value"] for r in found["usage"].collect()}
    assert usage[1, "input_tokens"] == "30.0" and usage[2, "model"] == "m7"


def test_a_conversion_takes_the_results(spark, found):
    docs = spark.createDataFrame([("d", "d.md", "# Chapter 1 C\n## 1.1 A\n" + TEXT)], "doc_id string, source_name string, text string")
    out = artefacts(docs, audits=found["audits"].filter("section_index = 1"), repaired=found["repaired"].filter("section_index = 1"))
    assert [i["label"] for i in json.loads(out["items"].first()["items_json"])] == ["Definition 2", "Theorem 2"]  # numbers come from the request
    assert "Checked." in out["audits"].first()["markdown"]
