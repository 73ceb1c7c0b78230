"""Repair requests and planned sections: the golden cases of span repair."""

from __future__ import annotations

from lemmaflow.operators import repair, split, structure

SPAN = "struct<start_anchor:string,end_anchor:string,start_occurrence:int,end_occurrence:int,include_start:boolean,include_end:boolean>"
REQUEST = f"doc_id string, section_index int, place int, label string, preserve_current_label string, env string, number_components array<string>, dependencies array<string>, source_order_anchor string, source_order_occurrence int, content_span {SPAN}, proof_span {SPAN}"
CURRENT = "doc_id string, section_index int, item_index int, label string, env string, content string, proof string"
TEXT = "Theorem 1. First.\nProof. One.\nTheorem 2. Second.\nProof. Two.\nEnd."


def repaired(spark, requests, current=()):
    section = spark.createDataFrame([("d", 1, TEXT, 1)], "doc_id string, section_index int, text string, start_line int")
    rows = [("d", 1, i, *r) for i, r in enumerate(requests)]
    out = repair.repaired_items(spark.createDataFrame(rows, REQUEST), spark.createDataFrame([("d", 1, *c) for c in current], CURRENT), section)
    return out.orderBy("place").collect()


def ask(label, anchor, content=None, proof=None, keep=None, env="thm"):
    return (label, keep, env, [], [" x ", ""], anchor, 1, content, proof)


def test_spans_occurrences_and_clipping(spark):
    a, b = repaired(spark, [
        ask("T1", "Theorem 1", ("Theorem 1", "Proof.", 1, 1, True, False), ("Proof.", "Proof.", 1, 2, False, False)),
        ask("T2", "Theorem 2", ("Theorem 2", "Proof.", 1, 2, True, False), ("Proof.", "End.", 2, 1, False, False)),
    ])
    assert (a["content"], a["proof"], a["item_index"]) == ("Theorem 1. First.", "One.", 1) and a["dependencies"] == ["x"]
    assert a["warnings"] == ["proof span clipped at the next item's anchor"]
    assert (b["content"], b["proof"], b["item_index"], b["warnings"]) == ("Theorem 2. Second.", "Two.", 2, [])


def test_failed_spans_reject_items_but_not_for_proofs(spark):
    a, b, c = repaired(spark, [
        ask("T1", "Theorem 1", ("nowhere", None, 1, 1, True, True)),
        ask("T2", "Theorem 2", ("Theorem 2", "Proof.", 1, 2, True, False), ("missing", None, 1, 1, True, True), env="?"),
        ask("T3", "", None),
    ])
    assert not a["accepted"] and a["item_index"] is None and a["content"] is None and a["warnings"][0].startswith("no content span")
    assert b["accepted"] and b["proof"] is None and b["warnings"][0].startswith("no proof span") and b["env"] == "remark"
    assert not c["accepted"] and c["warnings"] == ["no source-backed content"]


def test_current_items_and_anchor_blocks(spark):
    current = [(4, "T2", "thm", "Theorem 2.  Second.", None), (5, "T1", "lemma", "not in the source", "neither")]
    a, b = repaired(spark, [ask("New 1", "Theorem 1", keep="T1", env=""), ask("T2", "Theorem 2")], current)
    assert (a["content"], a["proof"], a["content_source"], a["env"]) == ("Theorem 1. First.", "One.", "declared_anchor_span", "lemma")
    assert (b["content"], b["content_source"], b["item_index"]) == ("Theorem 2.  Second.", "current", 2)


def test_delayed_proof_is_kept(spark):
    a, _ = repaired(spark, [ask("T1", "Theorem 1", ("Theorem 1", "Proof.", 1, 1, True, False), ("Two", ".", 1, 8, True, True)), ask("T2", "Theorem 2", ("Theorem 2", "Proof.", 1, 2, True, False))])
    assert a["proof"] == "Two." and a["warnings"] == ["proof span starts at or after the next item's anchor; kept as a delayed proof"]


def test_planned_sections(spark):
    docs = spark.createDataFrame([("d", "# One\na\nb\n## Two\nc\nd")], "doc_id string, text string")
    plan = [("d", 0, 4, 99, "1", "Two", None, "I", "Fall", "9"), ("d", 1, -3, 4, "", " ", "Own", None, "Fall", ""), ("d", 2, 4, 2, "2", "", "", "", "Fall", "9")]
    got = structure.planned_sections(spark.createDataFrame(plan, "doc_id string, position int, start_line int, end_line int, section_number string, section_title string, chapter string, chapter_number string, fallback_chapter string, fallback_number string"), docs).orderBy("section_index").collect()
    assert [(r["section_number"], r["section"], r["chapter"], r["chapter_number"], r["start_line"], r["end_line"]) for r in got] == [("1", "1. 1", "Own", "", 1, 4), ("I.1", "I.1. Two", "Fall", "I", 5, 6), ("2", "2. 2", "Fall", "", 6, 6)]
    assert got[0]["text"] == "# One\na\nb\n## Two" and got[0]["source_heading"] == "One" and got[0]["heading_level"] == 1 and got[1]["source_heading"] == "c" and got[1]["heading_level"] is None


def test_heuristic_plans(spark):
    books = [("a", "a.md", "front\n# Chapter 1. A\n1.1 Bare title\nx\n## 1.2 Marked\ny\n# Chapter 2. B\n## 2.1 Last\nz"), ("b", "b.md", "## 3 Top\nx\n## 3.1 In\ny\n## 3.2 In\nz"), ("c", "c.md", "nothing here")]
    docs = spark.createDataFrame(books, "doc_id string, source_name string, text string")
    plans = structure.heuristic_plans(split.lines(docs), split.sections(docs)).orderBy("doc_id", "position").collect()
    assert [(r["doc_id"], r["section_number"], r["start_line"], r["end_line"]) for r in plans] == [("a", "1.1", 3, 4), ("a", "1.2", 5, 7), ("a", "2.1", 8, 9), ("b", "3", 1, 6), ("c", "1", 1, 1)]
    assert {r["chapter"] for r in plans if r["doc_id"] == "a"} == {"Chapter 2. B"}
    made = structure.planned_sections(structure.heuristic_plans(split.lines(docs), split.sections(docs)), docs)
    assert made.filter("doc_id = 'b'").first()["text"] == books[1][2]
