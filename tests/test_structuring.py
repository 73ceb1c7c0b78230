"""Golden cases of the splitter, extractor, normalization, quality and annotation operators."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lemmaflow.functions import text as T
from lemmaflow.operators import annotate, extract, jobs, normalize, quality, spans, split, structure
from lemmaflow.sources import readers

BOOKS = [
    ("lettered", "m.md", "# Chapter 13. First order differentiation\n\n## A. Open sets\n\ntext\n\n### 13.1. Theorem. Let x\n\n## B. More\n\nz\n"),
    ("levels", "l.md", "# Chapter 1. C\n## 1.1 One\na\n## 1.2 Two\nb\n"),
    ("paper", "p.md", "# My paper\n\n## Abstract\nabs\n\n## 1. Intro\nx\n\n## 1.1 Sub\ny\n\n## 2 Next\nq\n\n## 2.1 S\n\n\n## References\n[1] a\n## Appendix A. Proofs\nProof. x\n"),
    ("chinese", "zh.md", "# 第十二章 集合\n\n定义 1.1.1 x\n\n定理 1.1.2 y\n\n## 1.2 节\nz"),
    ("bare", "no.md", "hello\nworld\n\n## Index\nz"),
    ("empty", "e.md", ""),
    ("null", "n.md", None),
    ("again", "a.md", "## 1 A\n## 1 B\n" + "x" * 45_001),
]


@pytest.fixture(scope="module")
def sections(spark):
    return split.sections(spark.createDataFrame(BOOKS, "doc_id string, source_name string, text string")).cache()


def test_sections(sections):
    got = {}
    for r in sections.orderBy("section_index").collect():
        got.setdefault(r["doc_id"], []).append(r)
    numbers = {k: [r["section_number"] for r in v] for k, v in got.items()}
    assert numbers == {"lettered": ["13.A", "13.B"], "levels": ["1.1", "1.2"], "paper": ["1", "1.1", "2", "2.1", "A"], "chinese": ["1.1", "1.2"], "bare": ["1"], "empty": ["1"], "null": ["1"], "again": ["1", "1"]}
    assert got["lettered"][0]["chapter"] == "Chapter 13. First order differentiation" and "13.1. Theorem" in got["lettered"][0]["text"]
    assert (got["lettered"][0]["start_line"], got["lettered"][0]["end_line"]) == (3, 7)
    assert got["chinese"][0]["synthetic"] and got["chinese"][0]["chapter"] == "Chapter 12. 集合"
    assert got["bare"][0]["text"] == "hello\nworld" and got["bare"][0]["section"] == "no" and got["empty"][0]["text"] == ""
    assert got["paper"][4]["text"].endswith("Proof. x") and got["paper"][0]["chapter"] == "My paper"


def test_back_matter_and_warnings(spark, sections):
    docs = spark.createDataFrame(BOOKS, "doc_id string, source_name string, text string")
    assert {r["doc_id"]: r["back_matter"] for r in split.back_matter(docs).collect()} == {"paper": "## References\n[1] a", "bare": "## Index\nz"}
    found = {}
    for r in split.split_warnings(sections).orderBy("position").collect():
        found.setdefault(r["doc_id"], []).append(r["warning"])
    assert found["again"] == ["duplicate section number detected: 1", "section 02 is very long (45008 chars); consider smaller chunks"]
    assert found["chinese"][0].startswith("created a synthetic") and "lettered" not in found and found["empty"][0].startswith("no explicit")


ITEMS = """# Chapter 2. X

## 2.1 Basics

Definition 2.1. A thing.

Theorem 2.2. It holds.
Proof. Because
so.

Lemma 2.3. More.

Proof of Theorem 2.2. again
and so.

Remark. Not numbered ...

定理 2.4 中文。
证明 显然。

Corollary 2.5. X
Proof of Theorem 2.5. own

## 2.2 Empty
"""


@pytest.fixture(scope="module")
def items(spark):
    own = split.sections(spark.createDataFrame([("b", "b.md", ITEMS), ("p", "p.md", "## A. Proof of Theorem 3\nWe show it."), ("q", "q.md", "## 5 Short\nProof. x")], "doc_id string, source_name string, text string")).cache()
    return own, normalize.normalized(extract.local_items(own), own).cache()


def test_local_items_and_proofs(items):
    own, _ = items
    for once in (True, False):
        got = {r["content"]: r["proof"] for r in extract.local_items(own, once).filter("doc_id = 'b'").collect()}
        assert got["Definition 2.1. A thing."] is None
        assert got["Theorem 2.2. It holds."] == "Proof. Because\nso.\n\nProof of Theorem 2.2. again\nand so."
        assert got["定理 2.4 中文。"] == "显然。"
        assert got["Corollary 2.5. X"] == ("own" if once else "own\n\nown")
    alone = {r["doc_id"]: r for r in extract.local_items(own).filter("doc_id <> 'b'").collect()}
    assert alone["p"]["env"] == "remark" and alone["p"]["dependencies"] == ["Theorem 3"] and alone["q"]["dependencies"] == []


def test_normalized_labels(items):
    _, n = items
    labels = [r["label"] for r in n.filter("doc_id = 'b'").orderBy("global_index").collect()]
    assert labels == ["Definition 2.1", "Theorem 2.2", "Lemma 2.3", "Remark 2.1-extra-1", "Theorem 2.4", "Corollary 2.5"]


def test_dependencies_follow_labels(spark):
    section = spark.createDataFrame([("d", 1, "6", "6. S", "", "")], "doc_id string, section_index int, section_number string, section string, chapter string, chapter_number string")
    raw = [
        ("d", 1, 1, "notation", "N", [], "Let.", [], None), ("d", 1, 2, "Definition", "D", [], " ", [], None), ("d", 1, 3, "def", "D2", [], "Def.", [], None),
        ("d", 1, 4, "Theorem", "Theorem -6-3", ["6", "1"], "T", [], None), ("d", 1, 5, "cor", "C", ["6", "1", "1"], "C", ["Theorem -6-3", "other", " "], " p "),
        ("d", 1, 6, "?", "A", [], "**Remark IV.2. x**", [], ""),
    ]
    got = normalize.normalized(spark.createDataFrame(raw, "doc_id string, section_index int, position int, env string, label string, number_components array<string>, content string, dependencies array<string>, proof string"), section).orderBy("item_index").collect()
    assert [r["label"] for r in got] == ["Notation 6-extra-1", "Definition 6-extra-3", "Theorem 6.1", "Corollary 6.1.1", "Remark IV.2"]
    assert got[3]["dependencies"] == ["Theorem 6.1", "other"] and got[3]["proof"] == "p" and got[4]["proof"] is None
    assert [r["item_index"] for r in got] == [1, 3, 4, 5, 6] and [r["global_index"] for r in got] == [1, 2, 3, 4, 5]


def test_quality_and_annotation(items):
    own, n = items
    reports = quality.section_reports(own, n)
    first = reports.filter("doc_id = 'b' and section_index = 1").first()
    assert (first["n_item_markers"], first["n_items"], first["n_proofs"]) == (6, 6, 3) and first["env_counts"]["thm"] == 2
    assert first["warnings"] == ["Remark 2.1-extra-1: content appears truncated"]
    documents = quality.document_reports(own, n, split.split_warnings(own))
    assert {r["doc_id"]: r["items_total"] for r in documents.collect()} == {"b": 6, "p": 1, "q": 1}
    twice = n.unionByName(n.filter("doc_id = 'b' and global_index = 1").withColumn("global_index", F.lit(9)).withColumn("content", F.lit("")))
    a = annotate.annotated(twice)
    found = [(r["item_id"], r["severity"], r["code"]) for r in annotate.issues(a).filter("doc_id = 'b'").orderBy("item_id", "place").collect()]
    assert found == [("item_000001", "warning", "duplicate_label"), ("item_000009", "error", "empty_statement"), ("item_000009", "warning", "duplicate_label")]
    summary = {r["doc_id"]: (r["error_count"], r["warning_count"]) for r in annotate.quality_summary(a, documents, reports).collect()}
    assert summary["b"] == (1, 3)
    assert [(r["number"], r["title"]) for r in annotate.chapters(a).filter("doc_id = 'b'").collect()] == [("2", "Chapter 2. X")]
    assert annotate.issues(annotate.annotated(n.filter("doc_id = 'p'").withColumn("dependencies", F.array(F.lit("Theorem 3"))))).first()["code"] == "unresolved_dependency"


def test_planned_sections_never_overlap(spark):
    rng, rows, want = random.Random(2), [], {}
    for d in range(60):
        total = rng.randrange(1, 40)
        plan = [(rng.randrange(-2, 45), rng.randrange(-2, 50)) for _ in range(rng.randrange(1, 7))]
        rows += [(d, i, s, e, total) for i, (s, e) in enumerate(plan)]
        previous, out = 0, []
        for s, e in sorted(plan, key=lambda p: p[0]) if len({p[0] for p in plan}) == len(plan) else []:
            s = min(max(s, 1), total)
            e = min(max(e, s), total)
            if s <= previous:
                s = min(previous + 1, total)
                e = max(e, s)
            out.append((s, e))
            previous = e
        want[d] = out
    got = structure.clipped(spark.createDataFrame(rows, "doc_id int, position int, start_line int, end_line int, n_lines int")).orderBy("doc_id", "section_index").collect()
    for d, out in want.items():
        if out:
            assert [(r["start_line"], r["end_line"]) for r in got if r["doc_id"] == d] == out


def test_candidates(spark):
    text = "# Chapter 1. A\n\n## 1.1 B\n1.2 A short title\nTry it now\n3. This is a sentence, which ends.\n## References\nplain\n" + "p\n" * 3
    got = structure.candidates(split.lines(spark.createDataFrame([("d", text)], "doc_id string, text string"))).orderBy("line_no").collect()
    assert [(r["line_no"], r["kind"]) for r in got] == [(1, "markdown_h1_chapter"), (3, "markdown_h2_section_candidate"), (4, "bare_section_candidate"), (5, "item_or_activity_candidate"), (7, "markdown_h2_back_matter")]
    assert (got[1]["prev"], got[1]["next"]) == ("# Chapter 1. A", "1.2 A short title")


def test_spans(spark):
    rows = [
        ("aXbXXc", "X", None, 2, 1, True, False), ("aXbXXc", "XX", "c", 1, 1, False, True), ("aaa", "aa", None, 2, 1, True, True), ("ab", "", None, 1, 1, True, True),
        ("ab", "b", "a", 1, 1, True, False), ("😀.*b\n.*c", ".*", "", 1, 1, True, True), ("😀.*b\n.*c", ".*", None, 2, 0, True, True), ("x\\Ey", "\\E", None, 1, 1, True, True),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, text string, start_anchor string, end_anchor string, start_occurrence int, end_occurrence int, include_start boolean, include_end boolean").withColumn("start_line", F.lit(10))
    got = {r["id"]: r for r in spans.resolved(df).collect()}
    assert [got[i]["span_text"] for i in range(8)] == ["XXc", "c", None, None, None, None, ".*c", "\\Ey"]
    assert got[2]["error"].startswith("start_anchor not found") and got[3]["error"] == "empty start_anchor" and got[4]["error"] == "end anchor resolved before start anchor" and got[5]["error"] == "empty end_anchor"
    assert got[6]["line_start"] == 11 and got[6]["char_start"] == 5


def test_titles_and_numbers(spark):
    cases = [("Part X", "X"), ("第二十一章 x", "21"), ("第12章", "12"), ("第十章", "10"), ("Introduction", None), ("Part of the story", "of")]
    df = spark.createDataFrame(cases, "title string, want string")
    assert all(r["got"] == r["want"] for r in df.withColumn("got", T.chapter_number(F.col("title"))).collect())
    kinds = [("A Brief History", "letter"), ("1.2 Theorem 3", None), ("Appendix B", "appendix"), ("3) Sets", "numeric"), ("Theorem 1", None), ("A Theorem 1.1", None), ("A Proof of x", "letter"), ("index", None)]
    df = spark.createDataFrame(kinds, "title string, want string")
    assert all(r["got"] == r["want"] for r in df.withColumn("got", T.section_kind(F.col("title"))).collect())
    assert [r[0] for r in spark.createDataFrame([("a\r\nb\x0bc d\n",), ("",), (None,)], "x string").select(T.split_lines(F.col("x"))).collect()] == [["a", "b", "c", "d"], [], []]


def test_jobs_and_ingest(spark):
    events = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 5, None)], "id int, t int, status string")
    assert {r["id"]: r["status"] for r in jobs.latest(events, "id", F.col("t")).collect()} == {1: "b", 2: None}
    traces = spark.createDataFrame(
        [("extract", 5, 1, None, 2, 8, 0.5, True), ("extract", 0, 3, 4, 9, None, None, True), ("audit", 1, 1, 1, 1, 1, 1.0, False)],
        "phase string, input_tokens long, prompt_tokens long, output_tokens long, completion_tokens long, total_tokens long, elapsed_seconds double, has_usage boolean",
    )
    got = {r["phase"]: tuple(r)[1:] for r in jobs.usage_by_phase(traces).collect()}
    assert got["extract"] == (2, 8, 6, 8, 0.5) and got["audit"] == (0, 0, 0, 0, 0.0) and len(got) == 6
    assert tuple(jobs.usage_total(jobs.usage_by_phase(traces)).first()) == (2, 8, 6, 8, 0.5)


def test_page_chunks(spark):
    pages = "doc_id int, chunk_index int, start_page int, pages array<struct<page_idx:int,md:string>>"
    df = spark.createDataFrame([(1, 1, 2, [(0, "c \n"), (1, None)]), (1, 0, 0, [(0, "a"), (1, "  ")])], pages)
    r = readers.merged_chunks(df).first()
    assert r["text"] == "a\n\nc" and [p["page_idx"] for p in r["pages"]] == [0, 1, 2, 3]


def test_markdown_files_and_uploads(spark, tmp_path):
    (tmp_path / "a b.md").write_text("# x\ny")
    (tmp_path / "c.exe").write_text("x")
    assert [(r["source_name"], r["text"]) for r in readers.markdown_files(spark, str(tmp_path)).collect()] == [("a b.md", "# x\ny")]
    assert {r["name"]: r["error"] for r in readers.uploads(spark, str(tmp_path)).collect()} == {"a b.md": None, "c.exe": "unsupported type"}


def test_ingest_stream_keeps_state_across_passes(spark, tmp_path):
    from lemmaflow.streaming.ingest import SEEN, run_available

    def sight(*rows):
        spark.createDataFrame(rows, "path string, digest string, seen_at string, outcome string").selectExpr("path", "digest", "cast(seen_at as timestamp) as seen_at", "outcome").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def go():
        source = spark.readStream.schema(SEEN).parquet(str(tmp_path / "in"))
        return sorted((r["path"], r["digest"], r["action"], r["failure_count"]) for r in run_available(spark, source, str(tmp_path / "out"), str(tmp_path / "check")).collect())

    sight(("a", "1", "2024-01-01 00:00:00", "ok"), ("b", "1", "2024-01-01 00:00:00", "error"))
    assert go() == [("a", "1", "converted", 0), ("b", "1", "failed", 1)]
    sight(("a", "1", "2024-01-01 01:00:00", "ok"), ("a", "2", "2024-01-01 02:00:00", "error"), ("b", "1", "2024-01-01 00:30:00", "ok"), ("b", "1", "2024-01-01 02:00:00", "error"), ("b", "1", "2024-01-01 04:00:00", "error"), ("b", "1", "2024-01-01 09:00:00", "ok"))
    assert go() == [("a", "1", "converted", 0), ("a", "1", "skip_done", 0), ("a", "2", "failed", 1), ("b", "1", "blocked", 3), ("b", "1", "failed", 1), ("b", "1", "failed", 2), ("b", "1", "skip_blocked", 3), ("b", "1", "skip_cooling", 1)]


def _corpus(spark, tmp_path, texts):
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_whole_structure_candidates_have_bare_sections(spark, tmp_path):
    from lemmaflow.plans.queries import queries

    lines = ["Start", "1.1 Open sets", "B Closed sets", "def", "2 A sentence that ends here.", "3 x = y", "thm", "proof", "C) Compact sets", "remark", "12 plain title", "plain text"]
    folder = _corpus(spark, tmp_path, [(0, "\n".join(lines))])
    whole = {(r["line_no"], r["kind"]) for r in queries()["structure_candidates"](spark, folder).collect()}
    assert {n for n, kind in whole if kind == "bare_section_candidate"} == {2, 3, 9, 11}


def test_whole_source_backed_tests_every_document(spark, tmp_path):
    from lemmaflow.plans.queries import queries

    texts = [(i, f"first   line of {i}\nsame line") for i in range(40)]
    texts[5], texts[20], texts[21] = (5, None), (20, "same  line\nx"), (21, " \nx")
    got = {(int(r["doc_id"]), r["document"]): r["backed"] for r in queries()["source_backed"](spark, _corpus(spark, tmp_path, texts)).collect()}
    assert set(got) == {(i // 16, i) for i in range(40)} | {(i // 16 - 1, i) for i in range(16, 40)}
    for (book, i), backed in got.items():
        assert backed == (book == i // 16 or i in (20, 21)), (book, i)
