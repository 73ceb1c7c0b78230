"""Pluggable extraction by a model: a client for each task, retries in the task, one row of usage for each section, answers kept by what was asked."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lemmaflow.operators.extract import local_items
from lemmaflow.scratch import staged

#: A client gets a section (a dict) and gives raw items and usage.
Client = Callable[[dict], tuple[list[dict], dict]]
ANSWER = "doc_id string, section_index int, response string, input_tokens long, output_tokens long, elapsed_seconds double, error string"
ITEM = "array<struct<label:string,env:string,number_components:array<string>,dependencies:array<string>,content:string,proof:string>>"
KEPT = "key string, bucket int, response string, input_tokens long, output_tokens long, elapsed_seconds double, error string, run string, answered_at timestamp"
#: What a client sees of a section, and so what an answer depends on.
ASKED = ("section", "section_number", "chapter", "chapter_number", "text")


def attempted(client: Callable, row: dict, attempts: int, delay: float) -> tuple:
    """What the client gives for a row, or None, the error of the last attempt, or None, and the seconds that it took."""
    began, error = time.monotonic(), None
    for attempt in range(1, attempts + 1):
        try:
            return client(row), None, time.monotonic() - began
        except Exception as e:  # what a service does wrong is the row's result, after the last attempt
            error = f"{type(e).__name__}: {e}"
            if attempt < attempts:
                time.sleep(delay * attempt)
    return None, error, time.monotonic() - began


def answers(sections: DataFrame, make_client: Callable[[], Client], attempts: int = 3, delay: float = 5.0) -> DataFrame:
    """The model's answer for each section, or its error. Calls are paid for: run this without speculation, and write the result before using it."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                done, error, seconds = attempted(client, row, attempts, delay)
                items, usage = done or (None, {})
                out.append((row["doc_id"], row["section_index"], None if items is None else json.dumps(items, ensure_ascii=False), int(usage.get("input_tokens", 0)), int(usage.get("output_tokens", 0)), seconds, error))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in ANSWER.split(", ")])

    return sections.select("doc_id", "section_index", *ASKED).mapInPandas(run, ANSWER)


def raw_items(answers_: DataFrame) -> DataFrame:
    """The raw items of all answers, in order; answers that failed or don't parse have none."""
    parsed = answers_.select("doc_id", "section_index", F.posexplode(F.from_json("response", ITEM)).alias("at", "item"))
    return parsed.select("doc_id", "section_index", (F.col("at") + 1).alias("position"), "item.*")


def settings_text(settings: dict) -> str:
    """Settings in a form that doesn't depend on their order."""
    return json.dumps(settings, sort_keys=True, ensure_ascii=False, default=str)


def answer_key(settings: dict) -> Column:
    """The digest of all that an answer depends on: what the client sees of the section, and the settings (model, prompt, effort and the like)."""
    seen = F.to_json(F.struct(*(F.col(c).cast("string").alias(c) for c in ASKED)), {"ignoreNullFields": "false"})
    return F.sha2(F.concat(F.lit(settings_text(settings)), F.lit("\n"), seen), 256)


class AnswerStore:
    """Answers by what was asked: an append-only table in buckets of the key; of several answers to one question the latest counts.

    A section whose text or title has changed, or other settings, is another question; equal sections of several documents are one. Failures are kept as rows, but answer nothing.
    """

    def __init__(self, spark: SparkSession, folder: str, settings: dict, buckets: int = 64):
        self.spark, self.folder, self.settings, self.buckets = spark, folder.rstrip("/"), settings, buckets

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.conv(F.substring(key, 1, 8), 16, 10).cast("long"), F.lit(self.buckets)).cast("int")

    def kept(self) -> DataFrame:
        """The latest answer to each question."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], KEPT)
        rows = self.spark.read.schema(KEPT).parquet(self.folder).filter("response is not null")
        names = [c for c in rows.columns if c not in ("key", "bucket")]
        return rows.groupBy("bucket", "key").agg(F.max_by(F.struct(*names), F.struct("answered_at", "response")).alias("a")).select("key", "bucket", "a.*")

    def append(self, answers_: DataFrame) -> DataFrame:
        """Keep answers (key, response, input_tokens, output_tokens, elapsed_seconds, error); the same rows, from the table."""
        run = uuid.uuid4().hex
        rows = answers_.withColumns({"bucket": self._bucket(F.col("key")), "run": F.lit(run), "answered_at": F.current_timestamp()})
        rows.select(*(c.split()[0] for c in KEPT.split(", "))).write.mode("append").partitionBy("bucket").parquet(self.folder)
        return self.spark.read.schema(KEPT).parquet(self.folder).filter(F.col("run") == run)

    def answered(self, sections: DataFrame, make_client: Callable[[], Client], **settings) -> DataFrame:
        """Answers for all sections, with ``reused``: kept ones, and new ones, each question asked once, which are kept before they are used."""
        rows = staged(sections.select("doc_id", "section_index", *ASKED).withColumn("key", answer_key(self.settings)), "questions")
        known = staged(self.kept().drop("bucket", "answered_at", "run", "error"), "known")
        asked = rows.join(known, "key", "left_anti").groupBy("key").agg(F.min_by(F.struct("doc_id", "section_index", *ASKED), F.struct("doc_id", "section_index")).alias("s")).select("key", "s.*")
        asked = staged(asked, "asked")
        # answers go to the table first: what was paid for is there, whatever comes after
        made = self.append(answers(asked, make_client, **settings).join(asked.select("doc_id", "section_index", "key"), ["doc_id", "section_index"]))
        fields = ["response", "input_tokens", "output_tokens", "elapsed_seconds"]
        # what was asked now isn't among the kept answers that were read before
        old = rows.select("doc_id", "section_index", "key").join(known, "key").join(asked.select("key"), "key", "left_anti").select("doc_id", "section_index", "key", *fields, F.lit(None).cast("string").alias("error"), F.lit(True).alias("reused"))
        new = rows.select("doc_id", "section_index", "key").join(made.select("key", *fields, "error"), "key").select("doc_id", "section_index", "key", *fields, "error", F.lit(False).alias("reused"))
        return staged(old.unionByName(new), "answered")


def manifest_of(documents: DataFrame, settings: dict) -> DataFrame:
    """(doc_id, input_sha256, settings): what a conversion of each document depends on."""
    return documents.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("input_sha256"), F.lit(settings_text(settings)).alias("settings"))


def resumable(documents: DataFrame, settings: dict, earlier: DataFrame) -> DataFrame:
    """(doc_id, state) against the manifest rows of an earlier run: "new", "resume", or why it is refused: "input changed", "settings changed"."""
    now = manifest_of(documents, settings)
    rows = now.join(earlier.select("doc_id", F.col("input_sha256").alias("old_sha256"), F.col("settings").alias("old_settings")), "doc_id", "left")
    state = F.when(F.col("old_sha256").isNull(), "new").when(F.col("old_sha256") != F.col("input_sha256"), "input changed").when(F.col("old_settings") != F.col("settings"), "settings changed").otherwise("resume")
    return rows.select("doc_id", state.alias("state"))


def extracted(sections: DataFrame, store: AnswerStore | None = None, make_client: Callable[[], Client] | None = None, **settings) -> DataFrame:
    """Raw items by a model, or by the local rules without one. Questions that ``store`` has an answer to aren't asked again."""
    if make_client is None:
        return local_items(sections)
    if store is None:
        return raw_items(answers(sections, make_client, **settings))
    return raw_items(store.answered(sections, make_client, **settings))
