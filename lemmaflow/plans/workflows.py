"""Registered queries of what goes on over several runs or turns: the store, the folder stream, plugged models and their answers, plans' ranges; over rows derived from the tables."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lemmaflow.functions import patterns as R
from lemmaflow.operators import audit, joblog, models, planner, structure
from lemmaflow.plans import convert
from lemmaflow.plans.corpus import books
from lemmaflow.plans.progress import ProgressLog
from lemmaflow.scratch import scratch_dir, staged
from lemmaflow.sources import store
from lemmaflow.streaming import watch

RANGES = "array<struct<start_line:int,end_line:int>>"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), F.col("doc_id").alias("n"), F.coalesce("text", F.lit("")).alias("text"), "lang")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "labels").groupBy(F.col("doc_id").cast("string").alias("doc_id")).agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))


def store_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a store has after all documents were written, the labelled ones came again (without notes, and those of quality 0 without sizes), the toxic ones were removed, and the runs were compacted."""
    folder = scratch_dir(spark, "store")
    docs = staged(_texts(spark, sf_dir).select("doc_id", F.length("text").cast("long").alias("n_chars"), F.col("lang").alias("note")), "docs")
    again = staged(docs.join(_labels(spark, sf_dir), "doc_id"), "again")
    store.commit(folder, docs, {"sizes": docs.select("doc_id", "n_chars"), "notes": docs.select("doc_id", "note")})
    store.commit(folder, again, {"sizes": again.filter("quality = 1").select("doc_id", (-F.col("n_chars")).alias("n_chars"))})
    store.remove(folder, again.filter("toxic = 1"))
    store.compact(spark, folder)
    rows = store.manifest(spark, folder).select("doc_id").join(store.read(spark, folder, "sizes"), "doc_id", "left").join(store.read(spark, folder, "notes"), "doc_id", "left")
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("n_chars", F.lit(0)).alias("n_chars"), F.coalesce("note", F.lit("-")).alias("note"))


def folder_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a watched folder, of which the labelled ones change once; contents whose digest begins with 0 or 1 fail, twice at most.

    A row for each content of a file: how often it was converted, and how the last content ended.
    """
    docs = staged(_texts(spark, sf_dir).select(F.col("doc_id").alias("path"), "text"), "files")
    second = docs.join(_labels(spark, sf_dir).select(F.col("doc_id").alias("path")), "path", "left_semi").withColumn("text", F.concat("text", F.lit("!")))
    look = lambda df, day: df.select("path", F.to_timestamp(F.lit(day)).alias("modified_at"), F.encode("text", "utf-8").alias("content"))

    def convert(texts: DataFrame) -> DataFrame:
        return texts.select("path", "digest", F.when(F.substring("digest", 1, 1).isin("0", "1"), "odd").alias("error"))

    w = watch.Watch(spark, scratch_dir(spark, "watch"), convert, stable_seconds=0, cooldown_seconds=0, most_failures=2, most_files=1 << 20)
    w.run(look(docs, "2024-01-01"))
    w.run(look(second, "2024-02-01"))
    w.run()  # the second contents' outcomes
    w.run()  # those of the second attempts
    actions = w.actions()
    newest = docs.select("path", F.sha2(F.encode("text", "utf-8"), 256).alias("first")).join(second.select("path", F.sha2(F.encode("text", "utf-8"), 256).alias("second")), "path", "left").select("path", F.coalesce("second", "first").alias("digest"), F.lit(True).alias("newest"))
    ends = actions.filter("action in ('done', 'blocked')").select("path", "digest", "action").distinct().join(newest, ["path", "digest"])
    results = spark.read.parquet(f"{w.work}/results").groupBy("path", "digest").agg(F.count_if(F.col("error").isNull()).alias("n_converted"))
    rows = results.join(ends, ["path", "digest"], "left")
    return rows.select(F.col("path").cast("long").alias("doc_id"), "digest", "n_converted", F.coalesce("action", F.lit("-")).alias("status"))


def plan_matter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Front and back matter by ranges of lines, from the documents' ids: overlapping, reversed, missing and out of the text; some plans have none, so that what stands before the first section counts."""
    docs = _texts(spark, sf_dir)
    n = F.col("n").cast("int")
    span = lambda a, b: F.struct(a.cast("int").alias("start_line"), b.cast("int").alias("end_line"))
    null = F.lit(None)
    front = F.when(n % 3 > 0, F.array(span(n % 7 - 2, n % 11), span(F.lit(3), F.lit(1)), span(n % 5, n % 9)))
    back = F.when(n % 4 > 0, F.array(span(n % 40, n % 50 + 5), span(F.lit(1000000), F.lit(2)), span(null, n % 3)))
    heads = docs.select("doc_id", front.alias("front_matter_ranges"), back.alias("back_matter_ranges"))
    sections = docs.select("doc_id", (n % 6).alias("start_line")).filter("start_line > 0")
    out = structure.plan_matter(heads, sections, docs.select("doc_id", "text"))
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2("front_matter", 256).alias("front_sha256"), F.sha2("back_matter", 256).alias("back_sha256"))


#: Answers of a planner by doc_id modulo their number; {n} is the id.
PLAN_ANSWERS = [
    '{"sections": [{"start_line": 1, "end_line": {n}, "section_number": "1", "section_title": "T"}], "chapter": "C", "chapter_number": ""}', "{", "[{n}]", '{"chapter": "x"}',
    '{"sections": [{n}, {"start_line": "3", "end_line": null}]}', '{"sections": [{"start_line": {n}, "end_line": 2, "chapter_number": null, "section_title": 7}], "chapter_number": 2, "back_matter_ranges": [{"start_line": 1.5}, 3]}', '{"sections": {}}',
]


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _texts(spark, sf_dir)
    answer = F.element_at(F.lit(PLAN_ANSWERS), (F.pmod("n", F.lit(len(PLAN_ANSWERS))) + 1).cast("int"))
    return docs.select("doc_id", F.replace(answer, F.lit("{n}"), F.col("n").cast("string")).alias("answer"), F.lit(None).cast("string").alias("error"))


def planner_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planner.faults(_answers(spark, sf_dir)).select(F.col("doc_id").cast("long").alias("doc_id"), "path", "fault", "fatal")


def planner_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sections of usable plans, with the languages as the splitter's chapters."""
    hard = _texts(spark, sf_dir).select("doc_id", F.lit(1).alias("section_index"), F.col("lang").alias("chapter"), F.lit("9").alias("chapter_number"))
    _, plans = planner.plans(_answers(spark, sf_dir), hard)
    text = lambda c: F.coalesce(c, F.lit("(none)")).alias(c)
    return plans.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("position").cast("long").alias("position"), *(F.col(c).cast("long").alias(c) for c in ("start_line", "end_line")), *map(text, ("section_number", "section_title", "chapter", "chapter_number", "fallback_chapter")))


def _scripted() -> Callable[[dict], tuple]:
    """A client without a model: by its id a section is built at once, after a search, never, or by the forced build."""
    lists, search, _, build = R.TOOLS
    keep = {"audit_markdown": "kept", "items": [{"label": "First", "env": "thm", "number_components": ["1"], "preserve_current_label": "First"}, {"label": "Gone", "content_span": {"start_anchor": "\x01 nowhere"}}]}

    def client(row: dict) -> tuple:
        n = int(row["doc_id"]) % 4
        usage = {"input_tokens": len(json.loads(row["items"])) + 9}
        final = None, [("b", build, json.dumps(keep))], usage
        if n == 0:
            return final
        if row["tool_choice"] == lists:
            return None, [("l", lists, json.dumps({"items": [{"label": "First", "anchor_text": row["text"][4:7]}]}))], usage
        if n == 1:
            asked = any(m["call"] == "s" for m in json.loads(row["messages"]))
            return final if asked else (None, [("s", search, json.dumps({"query": row["text"][4:6], "max_matches": 2}))], usage)
        return final if n == 2 and row["tool_choice"] == build else ("thinking", [], usage)

    return client


def tool_loop_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A section a document, whose first line is its current item, through the repair's tool loop with a scripted client: turns, calls, matches, usage, the items kept, and the error."""
    docs = staged(_texts(spark, sf_dir), "docs")
    sections = docs.select("doc_id", F.lit(1).alias("section_index"), "text", F.lit(1).alias("start_line"))
    current = docs.select("doc_id", F.lit(1).alias("section_index"), F.lit(1).alias("item_index"), F.lit("First").alias("label"), F.lit("def").alias("env"), F.substring_index("text", "\n", 1).alias("content"), F.lit(None).cast("string").alias("proof"))
    out = audit.tool_loop(sections, current, _scripted, free=2, attempts=1)
    key = ["doc_id", "section_index"]
    turns = out["replies"].groupBy(*key).agg(F.count(F.lit(1)).alias("n_turns"))
    calls = out["traces"].groupBy(*key).agg(F.count(F.lit(1)).alias("n_calls"), F.max("summary.matches_count").alias("n_matches"))
    usage = out["usage"].filter("name = 'input_tokens'").select(*key, F.col("value").cast("double").cast("long").alias("input_tokens"))
    items = out["repaired"].groupBy(*key).agg(F.count(F.lit(1)).alias("n_items"), F.max(F.sha2("content", 256)).alias("content_sha256"))
    rows = turns
    for other in (calls, usage, items, out["errors"], out["audits"].select(*key, "audit_markdown")):
        rows = rows.join(other, key, "left")
    number = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), *map(number, ("n_turns", "n_calls", "n_matches", "input_tokens", "n_items")), *(F.coalesce(c, F.lit("-")).alias(c) for c in ("content_sha256", "error")), F.sha2(F.coalesce("audit_markdown", F.lit("-")), 256).alias("audit_sha256"))


def answers_reused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as sections that a model answers twice: between the runs the labelled ones change, and those of quality 0 become as their neighbours were. Whether the second answer is a kept one."""
    docs = staged(_texts(spark, sf_dir), "docs")
    text = lambda df: df.select("doc_id", F.lit(1).alias("section_index"), *(F.lit("s").alias(c) for c in ("section", "section_number", "chapter", "chapter_number")), "text")
    folder, settings = scratch_dir(spark, "answers"), {"model": "none", "effort": "low"}

    def make() -> Callable[[dict], tuple]:
        return lambda row: ([{"label": "L", "env": "thm", "content": row["text"][:20]}], {"input_tokens": len(row["text"])})

    def ask(rows: DataFrame) -> DataFrame:
        return models.AnswerStore(spark, folder, settings).answered(rows, make, attempts=1)

    ask(text(docs))
    before = docs.select((F.col("n") + 1).alias("n"), F.col("text").alias("other"))
    changed = docs.join(_labels(spark, sf_dir), "doc_id", "left").join(before, "n", "left")
    second = changed.withColumn("text", F.when(F.col("quality") == 0, F.coalesce("other", F.lit(""))).when(F.col("quality") == 1, F.concat("text", F.lit("!"))).otherwise(F.col("text")))
    return ask(text(second)).select(F.col("doc_id").cast("long").alias("doc_id"), "reused", "input_tokens", F.sha2("response", 256).alias("response_sha256"))


def plan_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warnings of plans made of an order's lines, with starts and ends from part and supplier keys, for texts of fifty lines; every seventh order's plan has no sections."""
    lines = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("doc_id"), F.col("l_orderkey").alias("n"), F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")).alias("position"), (F.col("l_partkey") % 60).cast("int").alias("start_line"), (F.col("l_partkey") % 60 + F.col("l_suppkey") % 25 - 9).cast("int").alias("end_line"))
    orders = staged(lines.select("doc_id", "n").distinct(), "orders")
    plans = staged(lines.filter("n % 7 > 0").drop("n"), "plans")
    heads = orders.select("doc_id", F.when(F.col("n") % 5 == 0, F.array(F.lit(" told "), F.lit(" "))).alias("warnings"))
    texts = orders.select("doc_id", F.repeat(F.lit("x\n"), 50).alias("text"))
    hard = orders.filter("n % 2 = 0").select("doc_id", F.lit(0).alias("position"), F.lit("hard").alias("warning"))
    out = structure.plan_warnings(heads, plans, texts, hard)
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("position").cast("long").alias("position"), "warning")




def job_log_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of users as moves of jobs, in two batches with a snapshot between them: what jobs there are in the end."""
    e = _table(spark, sf_dir, "events")
    kind = F.element_at(F.lit(["create", "status", "status", "status", "complete", "resume", "delete", "progress", "access"]), (F.col("event_id") % 9 + 1).cast("int"))
    status = F.when(F.col("event_id") % 5 < 3, "running").when(F.col("event_id") % 5 == 3, "failed").otherwise("queued")
    none = F.lit(None).cast("string")
    rows = staged(e.select(
        F.col("user_id").cast("string").alias("id"), F.col("event_id").cast("long").alias("seq"), F.col("ts").cast("timestamp").alias("at"), kind.alias("kind"), F.when(kind == "status", status).alias("status"), F.col("event_type").alias("phase"),
        (F.col("event_id") % 1000 * 2).cast("int").alias("sections_total"), (F.col("event_id") % 1000).cast("int").alias("sections_completed"), none.alias("error"), none.alias("result"),
    ), "events")
    half = rows.agg(F.max("seq")).first()[0] or 0
    log = joblog.JobLog(spark, scratch_dir(spark, "jobs"))
    log.append(rows.filter(F.col("seq") <= half // 2))
    log.compact()
    log.append(rows.filter(F.col("seq") > half // 2))
    out = log.states()
    return out.select(F.col("id").cast("long").alias("id"), "status", F.unix_seconds("created_at").alias("created_at"), F.coalesce("sections_total", F.lit(-1)).cast("long").alias("sections_total"), F.col("sections_completed").cast("long").alias("sections_completed"))


def page_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen documents in a row as the pages of a file, cut into ranges of at most six pages and 8,000 bytes."""
    docs = _table(spark, sf_dir, "documents")
    pages = docs.select(F.expr("doc_id div 16").alias("doc_id"), F.col("doc_id").alias("page"), F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("bytes"))
    out = joblog.page_ranges(pages, 6, 8000, overhead=100)
    number = lambda c: F.col(c).cast("long").alias(c)
    return out.select("doc_id", *map(number, ("chunk", "start_page", "end_page", "bytes")), F.col("error").isNotNull().alias("too_large"))


def collection_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as jobs of both kinds, labelled documents' ids as those with an annotation, every tenth order's folder as debug output."""
    orders = _table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "succeeded").when(F.col("o_orderkey") % 3 == 0, "failed").otherwise("running")
    name = F.col("o_orderkey").cast("string")
    at = F.col("o_orderdate").cast("timestamp")
    jobs = orders.select(F.when(F.col("o_orderkey") % 2 == 0, "markdown").otherwise("full").alias("kind"), name.alias("id"), status.alias("status"), at.alias("updated_at"), F.concat(F.lit("/jobs/"), name).alias("path"))
    debug = orders.filter("o_orderkey % 10 = 0").select(F.concat(F.lit("/debug/"), name).alias("path"), at.alias("modified_at"))
    saved = _table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"))
    return joblog.collection_plan(jobs, saved, debug, F.expr("timestamp'1997-01-01 00:00:00'"))


def conversion_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the log of a conversion of all books in two blocks tells: the counts of committed blocks, those at the end, and what the store has then."""
    log, folder = ProgressLog(spark, scratch_dir(spark, "progress")), scratch_dir(spark, "converted")
    convert.convert(books(spark, sf_dir), folder, blocks=2, progress=log, run="books")
    rows = log.rows("books")
    committed = rows.filter("block is not null").agg(F.lit("committed").alias("phase"), F.sum("documents_completed").alias("documents"), F.sum("sections_completed").alias("sections"))
    end = rows.filter("phase = 'completed'").select("phase", F.col("documents_completed").alias("documents"), F.col("sections_completed").alias("sections"))
    stored = convert.read(spark, folder, "sections").agg(F.lit("stored").alias("phase"), F.count_distinct("doc_id").alias("documents"), F.count(F.lit(1)).alias("sections"))
    return committed.unionByName(end).unionByName(stored)


QUERIES = [conversion_progress, job_log_states, page_ranges, collection_plan, store_snapshot, folder_stream, plan_matter, planner_faults, planner_plans, tool_loop_sections, answers_reused, plan_warnings]
