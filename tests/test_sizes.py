"""What long texts cost, and that the cheap ways give what the plain ones gave."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from lemmaflow.functions import text as T
from lemmaflow.sources import readers


def test_names_of_long_lines_are_made_once(spark):
    names = spark.range(0, 1000, 1, 4).select(F.concat(F.lit("in/"), F.repeat(F.lit("é x."), 5000), F.col("id").cast("string"), F.lit(".pdf")).alias("f"))
    began = time.time()
    rows = names.select(readers.export_name(F.col("f")).alias("n")).distinct().collect()
    assert [r["n"] for r in rows] == ["é x." * 9 + "é x"]
    assert time.time() - began < 15  # every length that was tried cleaned the whole name again: minutes


def test_strip_and_clean_know_all_white_space(spark):
    chars = spark.range(1, 0xFFFF).filter("id < 55296 or id > 57343").select(F.concat(F.expr("decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE')")).alias("c"))
    x = chars.select(F.concat("c", F.lit(" a"), "c", "c", F.lit("b  c "), "c").alias("x"))
    old = F.regexp_replace("x", r"(?U)^\s+|\s+$", "")
    assert x.filter((T.strip(F.col("x")) != old) | (T.clean(F.col("x")) != F.regexp_replace(old, r"(?U)\s+", " "))).count() == 0


def test_lines_are_pythons(spark):
    texts = ["", "\n", "a", "a\n", "a\r\nb", "a\r\r\nb\n\r", "\r\n\r\n", "x\x0by\x0cz\x1c1\x1d2\x1e3\x85e f g\x1f", "\n\na\x85\n", "\x0b\n\r"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    got = df.select("i", T.split_lines(F.col("x")).alias("lines"), T.first_lines(F.col("x"), 2).alias("first")).collect()
    assert {r["i"]: r["lines"] for r in got} == {i: x.splitlines() for i, x in enumerate(texts)}
    assert all([y for y in r["first"] if y] == [y for y in r["lines"][:2] if y] for r in got)


def test_a_listing_of_many_partitions_is_one_batch(spark, tmp_path):
    from lemmaflow.streaming import watch

    w = watch.Watch(spark, str(tmp_path / "work"), lambda texts: texts.select("path", "digest", F.lit(None).cast("string").alias("error")), stable_seconds=0, most_files=1000)
    found = spark.range(0, 60, 1, 12).select(F.concat(F.lit("f"), F.col("id").cast("string")).alias("path"), F.timestamp_seconds(F.lit(1700000000)).alias("modified_at"), F.encode(F.col("id").cast("string"), "utf-8").alias("content"))
    w.run(found)
    rows = w.actions().groupBy("batch_id", "action").count().collect()
    assert [(r["action"], r["count"]) for r in rows] == [("convert", 60)]  # a batch a file before: twelve


def test_blocks_of_sections_are_cut_without_moving_lines(spark):
    from lemmaflow.operators import extract

    text = "before\nDefinition 1. A\nmore\n\nTheorem 2. B\nProof. x"
    rows = extract.blocks(spark.createDataFrame([("d", 1, text), ("d", 2, ""), ("d", 3, "Lemma 1. only"), ("d", 4, None)], "doc_id string, section_index int, text string"))
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()  # lines were shuffled and sorted
    got = {(r["section_index"], r["block"]): (r["lines"], r["number"], r["word"]) for r in rows.collect()}
    assert got == {(1, 0): (["before"], None, None), (1, 1): (["Definition 1. A", "more", ""], "1", "Definition"), (1, 2): (["Theorem 2. B", "Proof. x"], "2", "Theorem"), (3, 1): (["Lemma 1. only"], "1", "Lemma")}


def test_heuristic_plans_parse_each_line_once(spark, monkeypatch):
    from lemmaflow.operators import split, structure

    docs = spark.createDataFrame([("d", "d.md", "# Chapter 1 X\n## 1.1 Y\ntext\n## 1.2 Z\nthing\n\nend")], "doc_id string, source_name string, text string")
    sections = split.sections(docs)
    names = []
    monkeypatch.setattr(structure, "staged", lambda df, name: names.append(name) or df.localCheckpoint())
    plans = structure.heuristic_plans(split.lines(docs), sections)
    assert names == ["parsed"]  # four reads parsed all lines four times
    assert sorted((r["start_line"], r["end_line"], r["section_number"]) for r in plans.collect()) == [(2, 3, "1.1"), (4, 7, "1.2")]


def test_large_plans_are_dealt_out_by_their_rows(spark, monkeypatch):
    from lemmaflow.operators import structure

    monkeypatch.setattr(structure, "ROWS_A_TASK", 100)
    plan = spark.range(2000).select((F.col("id") % 300).alias("doc_id"), F.col("id").alias("position"), (F.col("id") % 7).cast("int").alias("start_line"), (F.col("id") % 11).cast("int").alias("end_line"), F.lit(9).alias("n_lines"))
    out = structure.clipped(plan, 2000)
    assert out.rdd.getNumPartitions() == 20  # four, the session's, whatever the rows
    assert sorted(out.collect()) == sorted(structure.clipped(plan).collect())


def test_turns_of_the_tool_loop_do_not_carry_texts(spark, monkeypatch):
    from lemmaflow.operators import audit

    kept, real = {}, audit.staged
    monkeypatch.setattr(audit, "staged", lambda df, name: kept.setdefault(name, df.columns) and real(df, name))
    sections = spark.createDataFrame([("d", 1, "some text", 1)], "doc_id string, section_index int, text string, start_line int")
    current = spark.createDataFrame([], "doc_id string, section_index int, item_index int, label string, env string, content string, proof string")
    out = audit.tool_loop(sections, current, lambda: lambda row: (None, [("b", "build_repaired_items", '{"audit_markdown": "' + row["text"] + '"}')], {}), free=0, attempts=1)
    assert not any("text" in columns for columns in kept.values())  # each turn wrote and moved the whole text
    assert [r["audit_markdown"] for r in out["audits"].collect()] == ["some text"]


def test_sections_are_cut_without_tables_of_headings(spark, monkeypatch):
    from pyspark.sql import DataFrameWriter

    from lemmaflow.operators import split

    text = "Definition 2.1. early\n# Chapter 1 X\r\n## References\nr\n## 1.1 Y\nbody\n\n## Index\nz\n## 1.2 Z"
    docs = spark.createDataFrame([("d", "d.md", text), ("lone", "lone.md", "## Index\nall\n# Funding\nmore"), (None, "x.md", "## 1 A"), ("empty", "e.md", None)], "doc_id string, source_name string, text string")
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda *a, **k: 1 / 0)  # headings and starts were written and read again, all lines with them
    got = [(r["doc_id"], r["section_index"], r["section_number"], r["start_line"], r["end_line"], r["text"]) for r in split.sections(docs).orderBy("doc_id", "section_index").collect()]
    assert got == [("d", 1, "2", 1, 2, "Definition 2.1. early\n# Chapter 1 X"), ("d", 2, "1.1", 5, 6, "## 1.1 Y\nbody"), ("d", 3, "1.2", 10, 10, "## 1.2 Z"), ("empty", 1, "1", 1, 0, ""), ("lone", 1, "1", 1, 2, "## Index\nall")]
    assert {r["doc_id"]: r["back_matter"] for r in split.back_matter(docs).collect()} == {"d": "## References\nr\n\n## Index\nz", "lone": "## Index\nall\n# Funding\nmore"}
    assert split.front_matter(docs).count() == 0


def test_warnings_of_sections_do_not_move_texts(spark):
    from lemmaflow.operators import split

    sections = spark.createDataFrame([("d", 1, "1", False, False, "x" * 45_001), ("d", 2, "1", False, False, "y")], "doc_id string, section_index int, section_number string, lone boolean, synthetic boolean, text string")
    out = split.split_warnings(sections)
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    below = next(i for i, x in enumerate(plan) if "Window" in x) + 1
    assert "length(text" in plan[below]  # the texts went through the shuffle and the sort
    assert [r["position"] for r in out.orderBy("position").collect()] == [12, 21]


def test_only_lines_that_may_head_are_parsed_for_the_planner(spark, monkeypatch):
    from lemmaflow.operators import split, structure

    seen, real = [], structure.parsed
    monkeypatch.setattr(structure, "parsed", lambda rows: seen.append(rows) or real(rows))
    lines = ["## 1 One", "A plain sentence.", "text", "  2. Two", "\u00a0## 3 Three", "B) Four", "\u0663 Five", "Bad", ""]
    docs = spark.createDataFrame([("d", "d.md", "\n".join(lines))], "doc_id string, source_name string, text string")
    sections = split.sections(docs)
    assert [r["needed"] for r in structure.planner_needed(split.lines(docs), sections, split.split_warnings(sections)).collect()] == [True]
    assert [r["line_no"] for r in seen[0].orderBy("line_no").collect()] == [1, 2, 4, 5, 6, 7]  # all nine before


def test_items_are_made_in_their_sections_row(spark, monkeypatch):
    from pyspark.sql import DataFrameWriter

    from lemmaflow.operators import extract, normalize, split

    monkeypatch.setattr(DataFrameWriter, "parquet", lambda *a, **k: 1 / 0)  # blocks were written and read again
    text = "## 1 A\nProof of Theorem 1.2. early\nTheorem 1.2. a\nLemma 3. b\nTheorem 1.2. c\n## mark\nProof of Lemma. no\nmore\nRemark. r\nProof of Theorem 1.2. late\nProof of 3. third"
    sections = split.sections(spark.createDataFrame([("d", "d.md", text)], "doc_id string, source_name string, text string"))
    raw = extract.local_items(sections)
    assert {r["position"]: (r["content"], r["proof"]) for r in raw.collect()} == {
        1: ("Theorem 1.2. a", None), 2: ("Lemma 3. b", "third"), 3: ("Theorem 1.2. c\nmark", "Proof of Lemma. no\nmore\n\nearly\n\nProof of Theorem 1.2. late\nProof of 3. third"), 4: ("Remark. r", "late"),
    }
    items = normalize.normalized(raw.withColumn("dependencies", F.array(F.lit("Remark 1-4"), F.lit("x"))), sections)
    assert {r["global_index"]: (r["label"], r["dependencies"]) for r in items.collect()} == {i + 1: (x, ["Remark 1-extra-1", "x"]) for i, x in enumerate(["Theorem 1.2", "Lemma 3", "Theorem 1.2", "Remark 1-extra-1"])}
    wide = raw.select(*raw.columns)
    wide = spark.createDataFrame(wide.rdd, wide.schema)
    assert normalize.normalized(wide, sections)._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0].count("Exchange") == 1  # items moved three times


def _kept_low(df, column, within):
    """Whether a column is read only by what ``within`` names, and goes no further."""
    lines = [x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if f"{column}#" in x]
    return lines and all("LogicalRDD" in x or within in x and f", {column}#" not in x for x in lines)


ITEMS = "doc_id string, section_index int, item_index int, global_index int, label string, env string, number_components array<string>, section_number string, section string, chapter string, chapter_number string, content string, dependencies array<string>, proof string"


def test_issues_of_items_do_not_move_statements(spark):
    from lemmaflow.operators import annotate

    rows = [("d", 1, i, i, label, "thm", ["1"], "1", "s", "c", "1", content, [], None) for i, (label, content) in enumerate([("A", "x"), ("A", " "), ("B", "y")], 1)]
    found = annotate.issues(annotate.annotated(spark.createDataFrame(rows, ITEMS)))
    assert _kept_low(found, "content", "trim(")  # statements went through a shuffle and a sort by label
    assert sorted((r["global_index"], r["code"]) for r in found.collect()) == [(1, "duplicate_label"), (2, "duplicate_label"), (2, "empty_statement")]


def test_reports_of_sections_do_not_move_contents(spark):
    from lemmaflow.operators import quality

    sections = spark.createDataFrame([("d", 1, "s", "1", "## 1 s", 1, 3, "Theorem 1. x...\nProof. y")], "doc_id string, section_index int, section string, section_number string, source_heading string, start_line int, end_line int, text string")
    rows = [("d", 1, 1, 1, "A", "thm", ["1"], "1", "s", "c", "1", "x [Mock excerpt truncated] y", [], None), ("d", 1, 2, 2, "B", "thm", ["2"], "1", "s", "c", "1", "x...\nProof. y", [], None), ("d", 1, 3, 3, "C", "thm", ["2"], "1", "s", "c", "1", "z... ", [], "p")]
    found = quality.section_reports(sections, spark.createDataFrame(rows, ITEMS))
    assert _kept_low(found, "content", "RLIKE")  # contents were joined with their sections
    assert [r["warnings"] for r in found.collect()] == [["A: content appears truncated", "B: proof marker remains in content while proof is null", "C: content appears truncated"]]


def test_whatever_starts_an_item_begins_as_one(spark):
    from lemmaflow.functions import patterns as R

    words = [*R.EN15.split("|"), *R.CN14.split("|")]
    lines = [x for w in words for x in (w, w.lower() + " 1.2. a", w.upper(), "## " + w, w.replace("s", "ſ") + " 3")] + [f"{n} {w} b" for n in ("1.2", "٣.٤.") for w in R.EN8.split("|")] + ["text", "", "Theory", "1.2 text"]
    df = spark.createDataFrame([(x,) for x in lines], "x string")
    got = {r["x"]: (r["starts"], r["begins"]) for r in df.select("x", T.matches(F.col("x"), R.ITEM_START).alias("starts"), T.matches(F.substring("x", 1, 3), R.ITEM_BEGINS).alias("begins")).collect()}
    assert all(begins for starts, begins in got.values() if starts) and sum(starts for starts, _ in got.values()) > 5 * 15 and not got["text"][1]


def test_kinds_of_items_lower_their_title_once(spark):
    kinds = spark.createDataFrame([("Satz Theorem",), ("EXERCISE",), ("注记",), ("",), (None,)], "x string").select(T.item_kind(F.col("x")).alias("k"))
    assert kinds._jdf.queryExecution().optimizedPlan().toString().lower().count("lower(") == 1  # once a rule before
    assert [r["k"] for r in kinds.collect()] == ["thm", "exercise", "remark", "remark", "remark"]


def _moves(df):
    """How many exchanges a plan that has run made, but for those that it used again."""
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    return sum("Exchange hashpartitioning" in x and "ReusedExchange" not in x for x in final.splitlines())


def _from_where_they_were_grouped(spark, monkeypatch, name, plain):
    """A query's rows, with nothing staged and texts moved once, against those of the staged way."""
    from pyspark.sql import DataFrameWriter

    from lemmaflow.operators import annotate
    from lemmaflow.plans import queries
    from lemmaflow.plans.corpus import books

    folder = "/root/testdata/sf0.001"
    want = plain(annotate.annotated(queries._items(books(spark, folder))[1])).collect()
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda *a, **k: 1 / 0)  # books, sections and items were written and read again
    found = getattr(queries, name)(spark, folder)
    rows = found.collect()
    assert _moves(found) == 1  # texts moved three times
    return rows, want


def test_chapters_are_made_where_documents_were_grouped(spark, monkeypatch):
    from lemmaflow.operators import annotate

    rows, want = _from_where_they_were_grouped(spark, monkeypatch, "annotation_chapters", annotate.chapters)
    assert rows and sorted(rows) == sorted(want)


def test_issues_are_made_where_documents_were_grouped(spark, monkeypatch):
    from lemmaflow.operators import annotate

    key = ["doc_id", "global_index", "item_id", "severity", "code", "message"]
    rows, want = _from_where_they_were_grouped(spark, monkeypatch, "annotation_issues", lambda a: annotate.issues(a).select(*key))
    assert rows and sorted(rows) == sorted(want)
