"""The repair's tool loop: a model reads sections with source tools, turn by turn, until it builds the repaired items.

All sections go on together, a turn at a time: a plugged client is asked, in the tasks, for the next message of every open section; the calls it makes are rows, which
the span, search, label and repair operators answer as joins; answers become messages, and sections without a final result go into the next turn. The first turn
forces the labels to be listed, up to ``free`` turns follow, the last one forces the build. Each turn is written before the next one begins, so what was paid for isn't asked again.

A client takes a section (a dict: doc_id, section_index, text, items and messages as JSON, and tool_choice: a tool's name or "auto") and gives (content, calls, usage): a text or None, a
list of (id, name, arguments as JSON) and a dict. Its failures, after ``attempts``, end their section with an error. Arguments that don't parse, or are no object, are empty ones.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lemmaflow.functions import patterns as R
from lemmaflow.functions import text as T
from lemmaflow.functions import values as V
from lemmaflow.operators import build, jobs, repair, spans
from lemmaflow.operators.models import attempted
from lemmaflow.scratch import bucketed, staged

KEY = ["doc_id", "section_index"]
LIST, SEARCH, EXTRACT, BUILD = R.TOOLS
Client = Callable[[dict], tuple[str | None, list[tuple[str, str, str]], dict]]
REPLY = "doc_id string, section_index int, content string, calls array<struct<id:string,name:string,arguments:string>>, usage string, elapsed_seconds double, error string"
SPAN = "struct<start_anchor:string,end_anchor:string,start_occurrence:int,end_occurrence:int,include_start:boolean,include_end:boolean>"
TEXTS = "array<string>"


def asked(rows: DataFrame, make_client: Callable[[], Client], attempts: int = 3, delay: float = 5.0) -> DataFrame:
    """The client's reply to each open section."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                reply, error, seconds = attempted(client, row, attempts, delay)
                content, calls, usage = reply or (None, [], {})
                calls = [{"id": i, "name": n, "arguments": a} for i, n, a in calls]
                out.append((row["doc_id"], row["section_index"], content, calls, json.dumps(usage) if usage else None, seconds, error))
            yield pd.DataFrame(out, columns=["doc_id", "section_index", "content", "calls", "usage", "elapsed_seconds", "error"])

    return rows.mapInPandas(run, REPLY)


def _bool(v: Column, name: str) -> Column:
    return F.coalesce(F.try_variant_get(V.field(v, name), "$", "boolean"), F.lit(False))


def _span(v: Column) -> Column:
    """A span's arguments as the span operators take them; null where it is no object."""
    whole = lambda n: F.try_variant_get(V.field(v, n), "$", "int")
    own = F.struct(
        V.first_text(v, "start_anchor").alias("start_anchor"), V.nullable_text(v, "end_anchor").alias("end_anchor"), whole("start_occurrence").alias("start_occurrence"), whole("end_occurrence").alias("end_occurrence"),
        _bool(v, "include_start").alias("include_start"), _bool(v, "include_end").alias("include_end"),
    )
    return F.when(V.is_object(v), own)


def _json(*columns: Column) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def _listed(calls: DataFrame, current: DataFrame) -> DataFrame:
    """Results of calls that list labels."""
    own = calls.filter(F.col("name") == LIST)
    fields = ["label", "env", "number_components", "anchor_text", "anchor_found", "anchor_offsets", "reason"]
    each = own.select(*KEY, "at", "text", "arguments", F.posexplode_outer(F.filter(V.listed(V.field(V.parsed(F.col("arguments")), "items")), V.is_object)).alias("place", "i"))
    i, env = F.col("i"), V.nullable_text(F.col("i"), "env")
    anchor = V.first_text(i, "anchor_text")
    found = T.positions(F.col("text"), anchor, 5)
    each = each.select(
        *KEY, "at", "arguments", "place", V.first_text(i, "label").alias("label"), F.when(env.isin(*R.DISPLAY), env).alias("env"), V.text_list(V.field(i, "number_components")).alias("number_components"),
        anchor.alias("anchor_text"), (F.size(found) > 0).alias("anchor_found"), found.alias("anchor_offsets"), V.first_text(i, "reason").alias("reason"),
    )
    listed = F.array_sort(F.collect_list(F.when(F.col("place").isNotNull(), F.struct("place", F.struct(*fields).alias("x")))))
    grouped = each.groupBy(*KEY, "at", "arguments").agg(F.transform(listed, lambda x: x["x"]).alias("declared_labels"))
    labels = current.groupBy(*KEY).agg(F.transform(F.array_sort(F.collect_list(F.struct("item_index", F.coalesce("label", F.lit("")).alias("label")))), lambda x: x["label"]).alias("current_labels"))
    rows = grouped.join(labels, KEY, "left")
    notes = V.first_text(V.parsed(F.col("arguments")), "notes")
    result = _json(F.col("declared_labels"), F.coalesce("current_labels", F.array().cast(TEXTS)).alias("current_labels"), notes.alias("notes"), F.lit(R.TOOL_NOTE).alias("tool_note"))
    return rows.select(*KEY, "at", result.alias("result"), F.size("declared_labels").alias("n_labels"))


def _searched(calls: DataFrame) -> DataFrame:
    v = V.parsed(F.col("arguments"))
    own = calls.filter(F.col("name") == SEARCH).withColumns({"query": V.first_text(v, "query"), "most": F.greatest(F.lit(1), F.coalesce(F.nullif(F.try_variant_get(V.field(v, "max_matches"), "$", "int"), F.lit(0)), F.lit(5)))})
    lists = spans.searched(own, F.col("most")).groupBy(*KEY, "at").agg(F.array_sort(F.collect_list(F.struct("offset", "line", "snippet"))).alias("matches"))
    rows = own.select(*KEY, "at").join(lists, [*KEY, "at"], "left")
    return rows.select(*KEY, "at", _json(F.coalesce("matches", F.array().cast("array<struct<offset:int,line:int,snippet:string>>")).alias("matches")).alias("result"))


def _extracted(calls: DataFrame) -> DataFrame:
    v = V.parsed(F.col("arguments"))
    own = calls.filter(F.col("name") == EXTRACT).withColumn("span", F.coalesce(_span(v), F.lit(None).cast(SPAN)))
    done = spans.resolved(own.select(*KEY, "at", "text", "start_line", "span.*"))
    good = _json(F.lit(True).alias("found"), F.col("span_text").alias("text"), F.col("char_start"), F.col("char_end"), F.col("line_start"), F.col("line_end"))
    return done.select(*KEY, "at", F.when(F.col("found"), good).otherwise(_json(F.lit(False).alias("found"), F.lit("").alias("text"), F.col("error"))).alias("result"))


def _requests(calls: DataFrame) -> DataFrame:
    """Repair requests of calls that build, a row a request."""
    items = F.filter(V.listed(V.field(V.parsed(F.col("arguments")), "items")), V.is_object)
    rows = calls.select(*KEY, F.posexplode(items).alias("place", "i"))
    i = F.col("i")
    return rows.select(
        *KEY, (F.col("place") + 1).alias("place"), V.first_text(i, "label").alias("label"), V.nullable_text(i, "preserve_current_label").alias("preserve_current_label"), V.nullable_text(i, "env").alias("env"),
        V.text_list(V.field(i, "number_components")).alias("number_components"), V.text_list(V.field(i, "dependencies")).alias("dependencies"), V.first_text(i, "source_order_anchor").alias("source_order_anchor"),
        F.try_variant_get(V.field(i, "source_order_occurrence"), "$", "int").alias("source_order_occurrence"), _span(V.field(i, "content_span")).alias("content_span"), _span(V.field(i, "proof_span")).alias("proof_span"),
    )


def _built(calls: DataFrame, current: DataFrame, sections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Results of calls that build (one a section), and the repaired items."""
    own = calls.filter(F.col("name") == BUILD)
    items = staged(repair.repaired_items(_requests(own), current, sections.select(*KEY, "text", "start_line")), "repaired")
    item = F.struct("item_index", "label", "env", "number_components", "content", "dependencies", "proof")
    lists = items.groupBy(*KEY).agg(
        F.array_sort(F.collect_list(F.when(F.col("accepted"), item))).alias("repaired_items"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("place", "warnings"))), lambda x: x["warnings"])).alias("warnings"),
        F.array_sort(F.collect_list(F.struct("place", "label", F.col("content_source"), F.col("accepted").alias("ok"), "warnings"))).alias("item_validations"),
    )
    actions = build.tool_actions(own.select(*KEY, F.to_json(V.field(V.parsed(F.col("arguments")), "actions")).alias("actions")))
    fields = [c for c in actions.columns if c not in (*KEY, "place")]
    acts = actions.groupBy(*KEY).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", F.struct(*fields).alias("a")))), lambda x: x["a"]).alias("actions"))
    v = V.parsed(F.col("arguments"))
    rows = own.join(lists, KEY, "left").join(acts, KEY, "left")
    name = F.format_string("section%02d", "section_index")
    none = lambda c, kind: F.coalesce(c, F.array().cast(kind))
    kinds = dict(lists.dtypes) | dict(acts.dtypes)
    warnings = none("warnings", TEXTS)
    said = T.strip(V.first_text(v, "audit_markdown"))
    told = F.when(F.size(warnings) > 0, T.strip(F.concat(said, F.lit(R.TOOL_WARNINGS), F.array_join(F.transform(warnings, lambda w: F.concat(F.lit("- "), w)), "\n")))).otherwise(said)
    markdown = F.coalesce(F.nullif(told, F.lit("")), F.concat(name, F.lit(R.TOOL_NO_AUDIT)))
    patch = F.struct(name.alias("section_id"), F.coalesce(F.nullif(V.first_text(v, "overall_assessment"), F.lit("")), F.lit("no change")).alias("overall_assessment"), none("actions", kinds["actions"]).alias("actions"), V.text_list(V.field(v, "open_questions")).alias("open_questions"))
    check = F.struct(F.coalesce("n_labels", F.lit(0)).alias("declared_labels_count"), none("item_validations", kinds["item_validations"]).alias("item_validations"), warnings.alias("warnings"))
    result = _json(markdown.alias("audit_markdown"), patch.alias("patch_candidate"), none("repaired_items", kinds["repaired_items"]).alias("repaired_items"), check.alias("tool_validation"))
    kinds_of_actions = F.transform(none("actions", kinds["actions"]), lambda a: a["action"])
    results = rows.select(*KEY, "at", result.alias("result"), markdown.alias("audit_markdown"), kinds_of_actions.alias("actions"), V.text_list(V.field(v, "open_questions")).alias("open_questions"), F.to_json(patch).alias("patch_json"))
    return results, items.filter("accepted").select(*KEY, F.col("item_index").alias("position"), "env", "label", "number_components", "content", "dependencies", "proof")


def tool_loop(sections: DataFrame, current: DataFrame, make_client: Callable[[], Client], free: int = 6, **settings) -> dict[str, DataFrame]:
    """Tables by name: audits (as ``writers.audit_markdown`` takes them), repaired (as ``plans.convert`` does), traces (a row a call: turn, place, tool, arguments, result, summary),
    replies (a row a turn: content, usage, elapsed_seconds, error), usage (doc_id, section_index, name, value; merged over the turns) and errors (sections without a result).

    ``sections``: doc_id, section_index, text, start_line; ``current``: doc_id, section_index, item_index, label, env, content, proof.
    """
    # texts move once, into buckets; turns bring the rest, which is small, to them
    base = bucketed(sections.select(*KEY, "text", "start_line"), "sections", KEY)
    item = F.struct("item_index", "label", "env", "content", "proof")
    shown = current.groupBy(*KEY).agg(F.to_json(F.array_sort(F.collect_list(item)), {"ignoreNullFields": "false"}).alias("items"))
    none = F.array().cast("array<struct<role:string,content:string,calls:array<struct<id:string,name:string,arguments:string>>,call:string>>")
    shown = bucketed(shown, "shown", KEY)
    open_ = staged(base.select(*KEY, none.alias("messages"), F.lit(0).alias("n_labels")), "open")
    out: dict[str, list[DataFrame]] = {n: [] for n in ("audits", "repaired", "traces", "replies", "errors")}
    for turn, choice in enumerate([LIST, *["auto"] * free, BUILD]):
        rows = base.join(open_, KEY).join(shown, KEY, "left").select(*KEY, "text", F.coalesce("items", F.lit("[]")).alias("items"), F.to_json("messages", {"ignoreNullFields": "false"}).alias("messages"), F.lit(choice).alias("tool_choice"))
        replies = staged(asked(rows, make_client, **settings), "replies")
        out["replies"].append(replies.withColumn("turn", F.lit(turn)))
        failed = replies.filter("error is not null").select(*KEY, "error")
        going = open_.join(replies.filter("error is null").select(*KEY, "content", "calls"), KEY)
        each = staged(going.select(*KEY, F.col("n_labels").alias("known"), F.posexplode("calls").alias("at", "call")).select(*KEY, "known", "at", "call.id", "call.name", F.when(V.is_object(V.parsed(F.col("call.arguments"))), F.col("call.arguments")).otherwise("{}").alias("arguments")), "calls")
        of = lambda name: base.join(each.filter(F.col("name") == name), KEY)
        labels = staged(_listed(of(LIST), current), "labels")
        # a build counts the labels of the last list before it; of several builds in a turn the last one counts
        last = each.filter(F.col("name") == BUILD).groupBy(*KEY).agg(F.max("at").alias("at"))
        final = each.join(last, [*KEY, "at"])
        before = final.select(*KEY, F.col("at").alias("until")).join(labels, KEY).filter("at < until").groupBy(*KEY).agg(F.max_by("n_labels", "at").alias("n_labels"))
        results, items = _built(final.join(before, KEY, "left").withColumn("n_labels", F.coalesce("n_labels", "known")), current, base)
        results = staged(results, "results")
        out["repaired"].append(items)
        out["audits"].append(results.drop("at", "result"))
        unknown = each.filter(~F.col("name").isin(*R.TOOLS)).select(*KEY, "at", _json(F.concat(F.lit(R.TOOL_UNKNOWN), "name").alias("error")).alias("result"))
        early = each.filter(F.col("name") == BUILD).join(last, [*KEY, "at"], "left_anti").select(*KEY, "at", F.lit(None).cast("string").alias("result"))
        answers = [labels.drop("n_labels"), _searched(of(SEARCH)), _extracted(of(EXTRACT)), results.select(*KEY, "at", "result"), unknown, early]
        answered = answers[0]
        for a in answers[1:]:
            answered = answered.unionByName(a)
        traced = staged(each.drop("known").join(answered, [*KEY, "at"]), "traces")
        out["traces"].append(traced.select(*KEY, F.lit(turn).alias("turn"), F.col("at").alias("place"), F.col("name").alias("tool"), "arguments", "result", build.tool_summary(F.col("result")).alias("summary")))
        if choice == BUILD:
            left = going.join(results.select(*KEY), KEY, "left_anti")
            out["errors"] += [failed, left.select(*KEY, F.lit(R.TOOL_NO_RESULT).alias("error"))]
            break
        said = F.transform(F.array_sort(F.collect_list(F.struct("at", "id", "result"))), lambda x: F.struct(F.lit("tool").alias("role"), x["result"].alias("content"), F.lit(None).cast("array<struct<id:string,name:string,arguments:string>>").alias("calls"), x["id"].alias("call")))
        tools = traced.groupBy(*KEY).agg(said.alias("said"))
        newest = labels.groupBy(*KEY).agg(F.max_by("n_labels", "at").alias("newest"))
        one = lambda role, content, calls: F.array(F.struct(F.lit(role).alias("role"), content.alias("content"), calls.alias("calls"), F.lit(None).cast("string").alias("call")))
        no_calls = F.lit(None).cast("array<struct<id:string,name:string,arguments:string>>")
        more = going.join(results.select(*KEY), KEY, "left_anti").join(tools, KEY, "left").join(newest, KEY, "left")
        nudges = ([R.TOOL_CONTINUE] if turn else []) + ([R.TOOL_MUST_BUILD] if turn == free else [])
        messages = F.concat("messages", one("assistant", F.col("content"), F.col("calls")), F.coalesce("said", F.filter("messages", lambda m: F.lit(False))), *(one("user", F.lit(n), no_calls) for n in nudges))
        open_ = staged(more.select(*KEY, messages.alias("messages"), F.coalesce("newest", "n_labels").alias("n_labels")), "open")
        out["errors"].append(failed)
        if open_.isEmpty():
            break

    def whole(parts: list[DataFrame]) -> DataFrame:
        found = parts[0]
        for p in parts[1:]:
            found = found.unionByName(p)
        return found

    tables = {n: whole(parts) for n, parts in out.items()}
    return tables | {"usage": jobs.merged_usage(tables["replies"].filter("usage is not null").select(*KEY, "turn", "usage"), *KEY)}
