"""Items from spans, tool results, annotation payloads, OCR answers, names, usage and gates: the cases that tables don't have."""

from __future__ import annotations

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from lemmaflow.functions import options
from lemmaflow.functions import patterns as R
from lemmaflow.functions.profiles import profile
from lemmaflow.operators import annotate, build, jobs, spans
from lemmaflow.sources import readers
from lemmaflow.sources import store
from lemmaflow.streaming.ingest import stable

SECTION = "doc_id string, section_index int, section_number string, section string, text string, start_line int"
SPAN = "struct<start_anchor:string,end_anchor:string,start_occurrence:int,end_occurrence:int,include_start:boolean,include_end:boolean>"
RAW = f"doc_id string, section_index int, position int, label string, content_span {SPAN}, proof_span {SPAN}"
TEXT = "Definition 1. An open set.\nProof. First.\nTheorem 2. A claim.\nProof. Second.\nRemark."


@pytest.fixture(scope="module")
def sections(spark):
    return spark.createDataFrame([("d", i, "1", "S", TEXT, 10) for i in (1, 2, 3)], SECTION)


def test_items_are_cut_from_spans_or_their_section_fails(spark, sections):
    whole = ("Theorem 2.", "Proof.", 1, 2, True, False)
    rows = [
        ("d", 1, 1, " Theorem 2 ", whole, ("Proof.", "Remark", 2, 1, True, False)),
        ("d", 1, 2, "", ("Remark.", None, 1, 1, True, True), None),
        ("d", 2, 1, "Theorem 2", whole, ("Proof.", None, 1, 1, True, True)),  # the proof begins before the content's end
        ("d", 2, 2, "late", ("nowhere", None, 1, 1, True, True), None),
        ("d", 3, 1, "", None, None),
    ]
    got = {(r["section_index"], r["position"]): r for r in build.built(spark.createDataFrame(rows, RAW), sections).collect()}
    assert set(got) == {(1, 1), (1, 2), (2, 1), (3, 1)}
    assert (got[1, 1]["content"], got[1, 1]["proof"], got[1, 1]["built"]) == ("Theorem 2. A claim.", "Proof. Second.", True)
    assert got[1, 2]["content"] == "Remark." and got[1, 2]["proof"] is None
    assert got[2, 1]["error"] == "Could not extract proof span for Theorem 2: start_anchor occurrence resolved before search_start" and not got[2, 1]["built"] and got[2, 1]["failed_at"] == 1
    assert got[3, 1]["error"] == "Extractor item 1 missing content_span."


def test_local_items_as_spans_resolve_to_themselves(spark, sections):
    items = spark.createDataFrame([("d", 1, 1, "Proof.", "Proof."), ("d", 1, 2, "An open set.", None), ("d", 2, 1, "not there", None), ("d", 3, 1, "", None), ("d", 3, 2, "Remark.", "gone")], "doc_id string, section_index int, position int, content string, proof string")
    out = build.as_spans(items, sections).cache()
    errors = {(r["section_index"], r["position"]): r["error"] for r in out.collect()}
    assert errors[1, 1] is None and errors[1, 2] is None and errors[2, 1].endswith("not there") and "empty" in errors[3, 1] and errors[3, 2].endswith("gone")
    good = out.filter("error is null").withColumn("label", F.lit("")).select(*(c.split()[0] for c in RAW.split(", ")[:4]), "content_span", F.lit(None).cast(SPAN).alias("proof_span"))
    assert {r["content"] for r in build.built(good, sections).collect()} == {"Proof.", "An open set."}


def test_tool_calls_of_odd_shapes(spark, sections):
    call = lambda **a: json.dumps(a)
    rows = [("d", 1, call(items=[{"label": None, "env": "thm", "anchor_text": "Proof.", "number_components": [1, "a", None]}, 5, {"anchor_text": ""}])), ("d", 2, "no json"), ("d", 3, None)]
    got = build.declared_labels(spark.createDataFrame(rows, "doc_id string, section_index int, arguments string"), sections).orderBy("place").collect()
    assert [(r["label"], r["env"], r["number_components"], r["anchor_found"], r["anchor_offsets"]) for r in got] == [("", "thm", ["1", "a"], True, [27, 61]), ("", None, [], False, [])]
    actions = [("d", 1, json.dumps([{"action": "delete", "env": "x", "reason": 0}, [], {"action": 7, "target_label": ""}]))]
    got = build.tool_actions(spark.createDataFrame(actions, "doc_id string, section_index int, actions string")).orderBy("place").collect()
    assert [(r["action"], r["env"], r["reason"], r["target_label"]) for r in got] == [("delete", None, "", None), ("update", None, "", "")]
    results = spark.createDataFrame([(1, '{"text":"abc","found":true,"matches":[1,2]}'), (2, "[]"), (3, '{"error":"e"}')], "i int, r string")
    s = {r["i"]: r["s"] for r in results.select("i", build.tool_summary(F.col("r")).alias("s")).collect()}
    assert (s[1]["keys"], s[1]["chars"], s[1]["found"], s[1]["matches_count"]) == (["found", "matches", "text"], 3, True, 2) and s[2] is None and s[3]["error"] == "e" and s[3]["chars"] is None


def test_annotation_fields_in_odd_forms(spark):
    items = [
        {"statement": None, "content": "c", "dependencies": ["a", {"name": "n", "resolved": True}, {"label": ""}, 3], "page": 4, "modified": True, "image": "x", "context": {"chapter": "C", "section_number": 1.5}},
        {"content": 5, "references": "none", "unresolved_references": ["u"], "pages": [1, "2", "x", None], "block_ids": ["a", None, True], "source": {"bbox_refs": [{"bbox": [1, 2, 3]}, {"page": "7", "bbox": [1, 2, 3, 4]}, 9]}, "modified": {"any": 0}, "caption": "cap"},
        [],
    ]
    df = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(items)] + [(3, None), (4, "{")], "i int, p string")
    got = {r["i"]: r["f"] for r in df.select("i", annotate.fields(F.col("p")).alias("f")).collect()}
    a, b = got[0], got[1]
    assert a["statement"] == "" and [tuple(d) for d in a["dependencies"]] == [("a", None, False), ("n", None, True), ("3", None, False)] and a["source_refs"]["pages"] == [4] and a["modified"] and a["assets"]["image_path"] == ""
    assert (a["context"]["chapter_title"], a["context"]["section_number"]) == ("C", "1.5")
    assert b["statement"] == "5" and b["dependencies"] == [] and b["source_refs"]["pages"] == [1, 2] and b["source_refs"]["block_ids"] == ["a", "True"] and not b["modified"] and b["assets"]["caption"] == "cap"
    assert [(x["page"], x["bbox"]) for x in b["source_refs"]["bbox_refs"]] == [(7, [1.0, 2.0, 3.0, 4.0])]
    for i in (2, 3, 4):
        assert got[i]["statement"] == "" and got[i]["dependencies"] == [] and got[i]["source_refs"]["pages"] == []


def test_annotations_are_checked_and_replaced_whole(spark):
    good = {"schema_version": R.SCHEMA_VERSION, "source": {}, "items": [{"id": "a"}, {"id": "b"}]}
    cases = [
        (good, None), ("x", "object"), ({**good, "schema_version": 1}, "schema_version"), ({**good, "source": []}, "source object"), ({**good, "source": {"source_type": "pdf"}}, "match"),
        ({**good, "items": {}}, "items array"), ({**good, "items": [{"id": "a"}, 3]}, "index 2 must be"), ({**good, "items": [{"id": 1}]}, "non-empty id"),
        ({**good, "items": [{"id": "b"}, {"id": "a"}, {"id": "b"}]}, "Duplicate annotation item id: b"), ({**good, "quality": []}, "quality"),
        ({**good, "quality": None, "source": {"source_type": None}}, None),
    ]
    df = spark.createDataFrame([(i, json.dumps(p)) for i, (p, _) in enumerate(cases)] + [(99, None)], "id int, payload string")
    got = {r["id"]: r["e"] for r in df.select("id", annotate.payload_error(F.col("payload"), F.lit("markdown")).alias("e")).collect()}
    for i, (_, want) in enumerate(cases):
        assert got[i] is None if want is None else want in got[i], (i, got[i])
    assert got[99]
    row = lambda i, n, at: (i, json.dumps({**good, "items": [{"id": str(k)} for k in range(n)]}), at)
    schema = "id int, payload string, updated_at int"
    out = annotate.saved(spark.createDataFrame([row(1, 1, 5), row(2, 1, 5)], schema), spark.createDataFrame([row(1, 3, 6), row(2, 3, 4), (1, "{}", 9), row(3, 0, 1)], schema))
    assert {r["id"]: (r["updated_at"], r["item_count"]) for r in out.collect()} == {1: (6, 3), 2: (5, 1), 3: (1, 0)}


def test_ocr_answers_and_archives(spark):
    cases = [
        ({"md": " ", "text": "t "}, "t "), ({"data": {"ocrResp": {"pages": [{"md": "a \n"}, {"md": 3}, {"md": "b"}]}}}, "a\n\nb"),
        ({"data": {"lines": ["x", {"md": "", "latex": "y"}, {"other": 1}, 4]}}, "x\ny"), ({"code": "success", "data": {"content": "c"}}, "c"), ({"code": "parse_error", "md": "m"}, None),
        ({"data": 5, "md": "own"}, "own"), ({}, ""),
    ]
    df = spark.createDataFrame([(i, json.dumps(p)) for i, (p, _) in enumerate(cases)], "i int, p string")
    got = {r["i"]: r["m"] for r in df.select("i", readers.image_markdown(F.col("p")).alias("m")).collect()}
    assert [got[i] for i in range(len(cases))] == [w for _, w in cases]

    def packed(files):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for n, t in files.items():
                z.writestr(n, t)
        return bytearray(out.getvalue())

    rows = [("a", packed({"x/deep.md": "deep", "b.MD": "b", "c.md": "c", "dir.md/": ""})), ("b", packed({"x.txt": "no"}))]
    assert {r["path"]: r["markdown"] for r in readers.archive_markdown(spark.createDataFrame(rows, "path string, content binary")).collect()} == {"a": "b", "b": None}


def test_names_of_exports_and_keys(spark):
    long = "数学" * 20
    cases = {"in/a?b:c.pdf": "a_b_c", f"in/{long}.pdf": "数学" * 8, "in/ . .pdf": "output", "in/v1.2 final.pdf": "v1.2 final", ".pdf": "pdf", "x/" + "a" * 49 + "é.pdf": "a" * 49, "x/" + "b" * 48 + "_é.pdf": "b" * 48}
    df = spark.createDataFrame([(k,) for k in cases], "f string")
    got = {r["f"]: r["n"] for r in df.select("f", readers.export_name(F.col("f")).alias("n")).collect()}
    assert got == cases and all(len(v.encode()) <= 50 for v in got.values())
    keys = spark.createDataFrame([("/in/a/b.c.pdf",), ("/in/.hidden",), ("/else/x.pdf",)], "f string").select(readers.relative_key(F.col("f"), "/in/").alias("k"))
    assert [r["k"] for r in keys.collect()] == ["a/b.c", ".hidden", "/else/x"]
    folders = spark.createDataFrame([("a/b/output.md",), ("a/b/x.md",), ("c/output.md.part",)], "path string")
    assert [r["folder"] for r in readers.source_folders(folders).collect()] == ["a/b"]


def test_usage_is_merged_turn_by_turn(spark):
    turns = [("k", 1, '{"a":1,"b":"x","c":2}'), ("k", 2, '{"a":2.5,"b":3,"c":"t"}'), ("k", 3, None), ("k", 4, '{"b":4,"d":null}')]
    got = {r["name"]: r["value"] for r in jobs.merged_usage(spark.createDataFrame(turns, "k string, turn int, usage string"), "k").collect()}
    assert got == {"a": "3.5", "b": "7.0", "c": "t", "d": None}
    conversion = spark.createDataFrame([("a", 2, 10, 5, 15, 1.25, 3.0)], "id string, requests int, input_tokens int, output_tokens int, total_tokens int, llm_elapsed_seconds double, wall_clock_elapsed_seconds double")
    out = {r["id"]: tuple(r)[1:] for r in jobs.combined_usage(conversion, spark.createDataFrame([("a", 10.0), ("b", 2.0)], "id string, total_seconds double")).collect()}
    assert out == {"a": (3, 10, 5, 15, 1.25, 10.0, 7.0), "b": (1, 0, 0, 0, 0.0, 2.0, 2.0)}


def test_gates_options_and_profiles(spark):
    assert options.checked({}) == {"prompt_profile": "auto", "structure_mode": "auto", "audit_mode": "auto"}
    with pytest.raises(ValueError, match="structure_mode"):
        options.checked({"structure_mode": "soft"})
    assert options.audits(None, "mock") and not options.audits("off", "openai") and not options.audits("llm", "local") and not options.audits("x", "mock")
    assert [options.planner(*x) for x in ((" LLM ", "azure"), ("auto", "mock"), ("hard", "mock"), ("llm", "local"), ("x", "mock"))] == ["always", "asked", "never", "never", "never"]
    one = spark.range(1)
    assert one.select(profile(" Paper ").alias("p"), profile("other").alias("q")).first() == ("paper", "textbook")


def test_folders_by_age(spark):
    at = lambda *rows: spark.createDataFrame(rows, "path string, modified_at string").withColumn("modified_at", F.to_timestamp("modified_at"))
    now = F.lit("2024-02-01").cast("timestamp")
    paths = at(("jobs/" + "0a" * 16, "2024-01-01"), ("jobs/full/x", "2024-01-01"), ("jobs/other", "2024-01-01"), ("jobs/doc2x/y", "2024-01-30"), ("jobs/" + "0A" * 16, "2024-01-01"))
    assert {r["path"] for r in jobs.job_folders(paths, now).collect()} == {"jobs/" + "0a" * 16, "jobs/full/x"}
    files = at(("a", "2024-01-31 23:59:20"), ("a", "2024-01-01"), ("b", "2024-01-31 23:59:50")).withColumnRenamed("path", "folder")
    assert [r["folder"] for r in jobs.settled_folders(files, now).collect()] == ["a"] and jobs.settled_folders(files, now, 0).count() == 2
    seen = spark.createDataFrame([("p", 100, 80), ("q", 100, 60), ("r", 100, None)], "path string, s long, m long").select("path", F.timestamp_seconds("s").alias("seen_at"), F.timestamp_seconds("m").alias("modified_at"))
    assert {r["path"] for r in stable(seen).collect()} == {"q", "r"} and stable(seen.drop("modified_at")).count() == 3


def test_audits_without_a_model(spark, sections):
    items = spark.createDataFrame([("d", 1)], "doc_id string, section_index int")
    out = build.unaudited(sections, items).orderBy("section_index").first()
    assert "section01_1" in out["audit_markdown"] and "1 item(s)" in out["audit_markdown"] and json.loads(out["patch_json"]) == {"section_id": "section01_1", "overall_assessment": "no change", "actions": [], "open_questions": []}


def test_unfinished_jobs_come_oldest_first(spark):
    rows = spark.createDataFrame([(1, "running", 5), (2, "queued", 3), (3, "failed", 1)], "id int, status string, updated_at int")
    assert [r["id"] for r in jobs.unfinished(rows).collect()] == [2, 1]


def test_spans_clip_at_the_next_item(spark):
    df = spark.createDataFrame([(True, 0, 9, 5), (True, 6, 9, 5), (False, 0, 9, 5), (True, 0, 9, None)], "found boolean, char_start int, char_end int, next_anchor int").withColumn("text", F.lit("0123456789"))
    got = [(r["found"], r["span_text"]) for r in spans.clipped_to_next(df, "content").collect()]
    assert got == [(True, "01234"), (False, "678"), (False, "012345678"), (True, "012345678")]


BOOK = "Foreword by nobody.\n# Chapter 1. C\n## 1.1 A\nDefinition 1.1. x\n## 1.2 Two\nTheorem 1.2. y\nProof. z\n## References\n[1] none\n"


def test_conversion_writes_all_artefacts(spark, tmp_path):
    from lemmaflow.plans.convert import artefacts, convert

    docs = spark.createDataFrame([("d", "d.md", BOOK, 1), ("e", "e.md", "no heading", 1)], "doc_id string, source_name string, text string, other int")
    audits = spark.createDataFrame([("d", 1, "Fine.", [], [], "{}")], "doc_id string, section_index int, audit_markdown string, actions array<string>, open_questions array<string>, patch_json string")
    repaired = spark.createDataFrame([("d", 2, 1, "lemma", "L", ["7"], "new", [], None)], "doc_id string, section_index int, position int, env string, label string, number_components array<string>, content string, dependencies array<string>, proof string")
    usage = spark.createDataFrame([("d", '{"requests": 2}')], "doc_id string, usage_json string")
    names = convert(docs, str(tmp_path), audits=audits, repaired=repaired, usage=usage)
    assert set(names) == {"items", "section_items", "initial_items", "sections", "structure", "index", "quality", "quality_json", "candidates", "summary", "audits", "patches", "section_audits", "front_matter", "back_matter"}
    read = lambda n: store.read(spark, str(tmp_path), n)
    assert {r["doc_id"]: r["markdown"] for r in read("front_matter").collect()} == {"d": "Foreword by nobody.\n# Chapter 1. C\n"}
    assert {r["doc_id"]: r["markdown"] for r in read("back_matter").collect()} == {"d": "## References\n[1] none\n"}
    assert [len(json.loads(r["quality_json"])["sections"]) for r in read("quality_json").orderBy("doc_id").collect()] == [2, 1]
    summary = {r["doc_id"]: json.loads(r["summary_json"]) for r in read("summary").collect()}
    d, e = summary["d"], summary["e"]
    assert (d["sections_written"], d["items_total"], d["front_matter_chars"], d["back_matter_chars"], d["audit_enabled"], d["usage_summary"]) == (2, 2, len("Foreword by nobody.\n# Chapter 1. C"), len("## References\n[1] none"), True, {"requests": 2})
    assert [f["section_number"] for f in d["files"]] == ["1.1", "1.2"] and len(e["files"]) == 1 and e["items_total"] == 0 and len(e["split_warnings"]) == 1
    labels = {(r["doc_id"], r["section_index"]): [i["label"] for i in json.loads(r["items_json"])] for r in read("section_items").collect()}
    assert labels == {("d", 1): ["Definition 1.1"], ("d", 2): ["Lemma 7"], ("e", 1): []}
    first = {(r["doc_id"], r["section_index"]): [i["label"] for i in json.loads(r["items_json"])] for r in read("initial_items").collect()}
    assert first["d", 2] == ["Theorem 1.2"]
    assert {r["doc_id"] for r in read("candidates").collect()} == {"d"} and "Fine." in read("audits").filter("doc_id = 'd'").first()["markdown"]
    plans = spark.createDataFrame([("e", 0, 1, 1, "1", "All", "C", "", "C", "")], "doc_id string, position int, start_line int, end_line int, section_number string, section_title string, chapter string, chapter_number string, fallback_chapter string, fallback_number string")
    planned = artefacts(docs, plans=plans)
    assert {r["doc_id"]: r["n"] for r in planned["sections"].groupBy("doc_id").count().withColumnRenamed("count", "n").collect()} == {"d": 2, "e": 1}


def test_traces_and_annotation_files(spark, tmp_path):
    for name, body in {"extract/a.json": {"usage": {"input_tokens": 5, "total_tokens": 7}, "timing": {"elapsed_seconds": 1.5}}, "extract/deep/b.json": {"usage": {"prompt_tokens": 3, "completion_tokens": 1}, "elapsed_seconds": 2}, "audit/c.json": {"usage": None}, "audit/d.json": {"usage": {"output_tokens": 4}, "elapsed_seconds": "3"}}.items():
        (tmp_path / "traces" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "traces" / name).write_text(json.dumps(body, indent=1))
    (tmp_path / "traces" / "audit" / "bad.json").write_text("{")
    got = {r["phase"]: tuple(r)[1:] for r in jobs.usage_by_phase(readers.traces(spark, str(tmp_path / "traces"))).collect()}
    assert got["extract"] == (2, 8, 1, 7, 3.5) and got["audit"] == (1, 0, 4, 0, 0.0) and got["structure"] == (0, 0, 0, 0, 0.0)
    good = {"schema_version": R.SCHEMA_VERSION, "source": {}, "items": []}
    for name, body in {"one": good, "two words": {}}.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(body))
    got = {r["id"]: r["error"] for r in readers.annotations(spark, str(tmp_path)).collect()}
    assert got["one"] is None and "schema_version" in got["two words"]
