"""Structure plans by a plugged model: who is asked, what is asked, and strict reading of the answers.

An answer is checked field by field; each fault is a row with its path, and a document whose answer has a fault that makes it unusable keeps the hard splitter's sections. What a plan
says and what it leaves out are told apart: a chapter number that isn't there is the fallback's, an empty one is none.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lemmaflow.functions import values as V
from lemmaflow.operators import split, structure
from lemmaflow.operators.models import attempted
from lemmaflow.scratch import staged
from lemmaflow.sources import writers

#: A client gets a document (a dict: doc_id, source_name, n_lines, sections, warnings and candidates as JSON) and gives an answer (JSON) and usage.
Client = Callable[[dict], tuple[str, dict]]
ANSWER = "doc_id string, answer string, usage string, error string"
RANGES = ("front_matter_ranges", "back_matter_ranges", "excluded_ranges")


def requests(documents: DataFrame, mode: str = "auto") -> DataFrame:
    """(doc_id, source_name, n_lines, sections, warnings, candidates) of the documents that a planner is asked about: with mode "auto" those that
    need one, "always" all, "never" none."""
    lines = split.lines(documents)
    sections = staged(split.sections(documents), "sections")
    warnings = staged(split.split_warnings(sections), "warnings")
    wanted = documents.select("doc_id", "source_name").filter(F.lit(mode != "never"))
    if mode == "auto":
        wanted = wanted.join(structure.planner_needed(lines, sections, warnings).filter("needed"), "doc_id", "left_semi")
    one = F.struct("section_index", "section_number", "section", "start_line", "end_line")
    hard = sections.groupBy("doc_id").agg(F.to_json(F.array_sort(F.collect_list(one))).alias("sections"))
    told = warnings.groupBy("doc_id").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("position", "warning"))), lambda x: x["warning"])).alias("warnings"))
    size = lines.groupBy("doc_id").agg(F.max("line_no").alias("n_lines"))
    candidates = writers.candidates_json(structure.candidates(lines)).select("doc_id", F.col("candidates_json").alias("candidates"))
    rows = wanted.join(size, "doc_id", "left").join(hard, "doc_id", "left").join(told, "doc_id", "left").join(candidates, "doc_id", "left")
    return rows.select("doc_id", "source_name", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), *(F.coalesce(c, F.lit("[]")).alias(c) for c in ("sections", "warnings", "candidates")))


def asked(requests_: DataFrame, make_client: Callable[[], Client], attempts: int = 3, delay: float = 5.0) -> DataFrame:
    """The planner's answer about each document, or its error. Calls are paid for: write the result before using it."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                done, error, _ = attempted(client, row, attempts, delay)
                answer, usage = done or (None, {})
                out.append((row["doc_id"], answer, json.dumps(usage) if usage else None, error))
            yield pd.DataFrame(out, columns=["doc_id", "answer", "usage", "error"])

    return requests_.mapInPandas(run, ANSWER)


def _there(v: Column, name: str) -> Column:
    return V.field(v, name).isNotNull()


def _whole(v: Column) -> Column:
    """A value as a whole number; null for others, texts of digits among them."""
    return F.when(V.kind(v) == "BIGINT", F.try_variant_get(v, "$", "bigint"))


def _wrong(path: Column, v: Column, kinds: tuple[str, ...], optional: bool = True) -> Column:
    """A fault where a value is there and of another kind; null counts as not there."""
    kind = V.kind(v)
    missing = v.isNull() | (kind == "VOID")
    fault = lambda what: F.struct(path.alias("path"), what.alias("fault"))
    absent = F.lit(None).cast("struct<path:string,fault:string>") if optional else F.when(missing, fault(F.lit("missing")))
    return F.coalesce(absent, F.when(~missing & ~kind.isin(*kinds), fault(F.concat(F.lit("is "), F.lower(kind)))))


def _at(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def faults(answers: DataFrame) -> DataFrame:
    """(doc_id, path, fault, fatal) of all answers (doc_id, answer, error): what isn't JSON, is missing or of a wrong kind. Fatal ones make an answer unusable."""
    v = V.parsed(F.col("answer"))
    rows = answers.withColumn("v", v)
    v, listed = F.col("v"), lambda n: V.listed(V.field(F.col("v"), n))
    usable = V.is_object(v) & (V.kind(V.field(v, "sections")) == "ARRAY")
    one = lambda path, fault: F.struct(F.lit(path).alias("path"), fault.alias("fault"))
    fatal = (
        F.when(F.col("error").isNotNull(), one("$", F.col("error"))).when(F.col("answer").isNull(), one("$", F.lit("missing"))).when(v.isNull(), one("$", F.lit("not JSON")))
        .when(~V.is_object(v), one("$", F.concat(F.lit("is "), F.lower(V.kind(v))))).when(~F.coalesce(usable, F.lit(False)), one("$.sections", F.coalesce(F.concat(F.lit("is "), F.lower(V.kind(V.field(v, "sections")))), F.lit("missing"))))
    )
    none = F.array().cast("array<struct<path:string,fault:string>>")
    texts = [_wrong(F.lit(f"$.{n}"), V.field(v, n), ("STRING",)) for n in ("chapter", "chapter_number")]

    def section(x: Column, i: Column) -> Column:
        bad = F.array(_wrong(_at("$.sections[", i, "]"), x, ("OBJECT",), optional=False))
        numbers = [_wrong(_at("$.sections[", i, f"].{n}"), V.field(x, n), ("BIGINT",), optional=False) for n in ("start_line", "end_line")]
        names = [_wrong(_at("$.sections[", i, f"].{n}"), V.field(x, n), ("STRING",)) for n in ("section_number", "section_title", "chapter", "chapter_number")]
        return F.when(V.is_object(x), F.array(*numbers, *names)).otherwise(bad)

    def ranges(name: str) -> Column:
        def each(x: Column, i: Column) -> Column:
            numbers = [_wrong(_at(f"$.{name}[", i, f"].{n}"), V.field(x, n), ("BIGINT",)) for n in ("start_line", "end_line")]
            return F.when(V.is_object(x), F.array(*numbers)).otherwise(F.array(_wrong(_at(f"$.{name}[", i, "]"), x, ("OBJECT",), optional=False)))

        return F.concat(F.array(_wrong(F.lit(f"$.{name}"), V.field(v, name), ("ARRAY",))), F.coalesce(F.flatten(F.transform(listed(name), each)), none))

    own = F.concat(F.array(*texts, _wrong(F.lit("$.warnings"), V.field(v, "warnings"), ("ARRAY",))), F.coalesce(F.flatten(F.transform(listed("sections"), section)), none), *(ranges(n) for n in RANGES))
    found = rows.select("doc_id", F.when(fatal.isNotNull(), F.array(fatal)).otherwise(F.array_compact(own)).alias("faults"), fatal.isNotNull().alias("whole"))
    each = found.select("doc_id", F.explode("faults").alias("f"), "whole").select("doc_id", "f.path", "f.fault", "whole")
    # a section's place must be known
    return each.select("doc_id", "path", "fault", (F.col("whole") | F.rlike("path", F.lit(r"^\$\.sections\[[0-9]+\](\.(start|end)_line)?$"))).alias("fatal"))


def plans(answers: DataFrame, sections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(heads, plans) of usable answers, as ``plans.convert`` takes them; ``sections``: the hard splitter's, for what a plan leaves out."""
    bad = faults(answers).filter("fatal").select("doc_id").distinct()
    rows = answers.join(bad, "doc_id", "left_anti").select("doc_id", V.parsed(F.col("answer")).alias("v"))
    v = F.col("v")
    spans = lambda n: F.transform(F.filter(V.listed(V.field(v, n)), V.is_object), lambda x: F.struct(_whole(V.field(x, "start_line")).cast("int").alias("start_line"), _whole(V.field(x, "end_line")).cast("int").alias("end_line")))
    heads = rows.select("doc_id", spans("front_matter_ranges").alias("front_matter_ranges"), spans("back_matter_ranges").alias("back_matter_ranges"), V.text_list(V.field(v, "warnings")).alias("warnings"))
    said = lambda x, n: F.when(_there(x, n), F.coalesce(V.nullable_text(x, n), F.lit("")))
    each = rows.select("doc_id", said(v, "chapter").alias("whole_chapter"), said(v, "chapter_number").alias("whole_number"), F.posexplode(V.listed(V.field(v, "sections"))).alias("position", "s"))
    s = F.col("s")
    first = sections.groupBy("doc_id").agg(F.min_by(F.struct("chapter", "chapter_number"), "section_index").alias("f"))
    own = each.join(first, "doc_id", "left").select(
        "doc_id", "position", _whole(V.field(s, "start_line")).cast("int").alias("start_line"), _whole(V.field(s, "end_line")).cast("int").alias("end_line"), V.nullable_text(s, "section_number").alias("section_number"), V.nullable_text(s, "section_title").alias("section_title"),
        F.coalesce(F.nullif(F.btrim(V.first_text(s, "chapter")), F.lit("")), "whole_chapter").alias("chapter"), F.coalesce(said(s, "chapter_number"), "whole_number").alias("chapter_number"),
        F.col("f.chapter").alias("fallback_chapter"), F.col("f.chapter_number").alias("fallback_number"),
    )
    return heads, own
