"""A folder as a stream: files that are new or have changed are converted once each, when they are stable, and again after failures.

Spark's file source gives a file once by name, so a changed file would never come again, and a file that isn't stable yet would be lost. Here each look at the
folder is a *listing*: the files that are new or changed since the listings before are appended, with their digest, to a log table, after their contents were written to a
table beside it. The log is the stream. A second stream are the *outcomes* of conversions, which come back to the state of their file. The state of a path is a stateful processor's value: its digest, its
status, failures and when it is due; processing-time timers end the wait of files that aren't stable or whose last conversion failed, without a new sighting; an optional time
to live forgets paths.

    new digest -> pending -(stable)-> due -(ok)-> done
                                      due -(error)-> failed -(cooldown)-> due; after ``most_failures``: blocked

Due files are handed to a converter in ``foreachBatch``. Actions, results and outcomes of a batch are written to partitions named by its id, which a batch that
runs again replaces, so each digest has its results once, whenever the stream is killed. The log's files have up to ``most_files`` sightings each, however many partitions a listing
has, and a batch takes one file: a path has at most one sighting a batch, its task reads a bounded number of rows, and there are no more batches than the sightings ask for.

Timers are checked in every batch; a listing without changes is logged too, as an empty file, so that each pass has one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from math import ceil

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

SIGHTED = "path string, digest string, modified_at timestamp, seen_at timestamp, listing string"
CONTENT = "path string, digest string, modified_at timestamp, seen_at timestamp, content binary, listing string"
OUTCOME = "path string, digest string, seen_at timestamp, error string"
ACTION = "path string, digest string, action string, failures int, listing string"
STATE = "digest string, status string, failures int, due long, seen long, listing string"
CONFS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",  # else a query with timers never ends by itself
}


def files(spark: SparkSession, folder: str, glob: str = "*.{md,MD}", recursive: bool = True) -> DataFrame:
    """(path, modified_at, content) of the files in a folder as they are now; Spark leaves out those without any byte."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).option("pathGlobFilter", glob).load(folder)
    return found.select("path", F.col("modificationTime").alias("modified_at"), "content")


class Pending(StatefulProcessor):
    """The state of one path. Times are in milliseconds."""

    def __init__(self, stable_seconds: float, cooldown_seconds: float, most_failures: int, keep_seconds: float | None):
        self.stable, self.cooldown, self.most, self.keep = int(stable_seconds * 1000), int(cooldown_seconds * 1000), most_failures, keep_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("file", STATE, *([int(self.keep * 1000)] if self.keep else []))

    def _wait(self, s: dict, now: int) -> list[tuple]:
        """Make a pending or failed file due, or set its timer."""
        if s["status"] not in ("pending", "failed"):
            return []
        if s["due"] > now:
            self.handle.registerTimer(s["due"])
            return []
        s["status"] = "due"
        return [("convert", s)]

    def _get(self) -> dict | None:
        return dict(zip(("digest", "status", "failures", "due", "seen", "listing"), self.state.get(), strict=True)) if self.state.exists() else None

    def _out(self, key: tuple, s: dict, actions: list[tuple]) -> Iterator[Row]:
        self.state.update((s["digest"], s["status"], s["failures"], s["due"], s["seen"], s["listing"]))
        for a, x in actions:
            yield Row(path=key[0], digest=x["digest"], action=a, failures=x["failures"], listing=x["listing"])

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:  # noqa: N802, N803
        now, s, actions = timerValues.getCurrentProcessingTimeInMs(), self._get(), []
        # outcomes belong to what was sighted before them
        for r in sorted(rows, key=lambda r: (r.listing is not None, r.seen)):
            at = r.seen
            if r.listing is None:
                if s is None or r.digest != s["digest"] or s["status"] != "due":
                    continue
                if r.error is None:
                    s |= {"status": "done", "failures": 0}
                else:
                    s["failures"] += 1
                    s |= {"status": "blocked" if s["failures"] >= self.most else "failed", "due": at + self.cooldown}
                actions.append((s["status"], dict(s)))
            elif s is None or at >= s["seen"]:
                stable = 0 if r.modified is None else r.modified + self.stable
                if s is None or r.digest != s["digest"]:
                    s = {"digest": r.digest, "status": "pending", "failures": 0, "due": stable, "seen": at, "listing": r.listing}
                else:
                    s["seen"] = at
                    if s["status"] == "pending":
                        s["due"] = max(s["due"], stable)
                    else:
                        actions.append((f"skip_{s['status']}", dict(s)))
        if s is not None:
            actions += self._wait(s, now)
            yield from self._out(key, s, actions)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        s = self._get()
        if s is not None:  # a timer of an earlier digest finds nothing due, or sets the right one
            yield from self._out(key, s, self._wait(s, timerValues.getCurrentProcessingTimeInMs()))

    def close(self) -> None:
        pass


@contextmanager
def _confs(spark: SparkSession) -> Iterator[None]:
    old = {k: spark.conf.get(k, None) for k in CONFS}
    try:
        for k, v in CONFS.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@dataclass
class Watch:
    """A watched folder and its tables below ``work``: contents, log, outcomes, actions, results, checkpoint.

    ``convert``: takes (path, digest, content) and returns (path, digest, error, ...), with a null error where the conversion succeeded. What it returns is the results table.
    """

    spark: SparkSession
    work: str
    convert: Callable[[DataFrame], DataFrame]
    stable_seconds: float = 30
    cooldown_seconds: float = 3600
    most_failures: int = 3
    most_files: int = 1000
    keep_seconds: float | None = None

    def _at(self, name: str) -> str:
        return f"{self.work.rstrip('/')}/{name}"

    def _read(self, name: str, schema: str) -> DataFrame:
        self._make(name)
        return self.spark.read.schema(schema).parquet(self._at(name))

    def _make(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._at(name))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(path)

    def sight(self, found: DataFrame) -> None:
        """Log a listing: those of the files (path, modified_at, content) that are new, changed, or there again since the listings before."""
        last = self._read("log", SIGHTED).groupBy("path").agg(F.max("modified_at").alias("last"))
        new = found.join(last, "path", "left").filter(F.col("last").isNull() | (F.col("modified_at") > F.col("last")))
        rows = new.select("path", F.sha2("content", 256).alias("digest"), "modified_at", F.current_timestamp().alias("seen_at"), "content")
        listing = f"listing={uuid.uuid4().hex}"
        rows.write.parquet(f"{self._at('contents')}/{listing}")
        names = self.spark.read.schema(rows.schema).parquet(f"{self._at('contents')}/{listing}").drop("content")
        n = names.count()
        # shares differ by a few rows, which must not make files of their own
        parts = 1 if n <= self.most_files else ceil(n / self.most_files * 1.1)
        names.repartition(parts).write.option("maxRecordsPerFile", self.most_files).parquet(f"{self._at('log')}/{listing}")

    def start(self, **trigger) -> StreamingQuery:
        """The stream over listings and outcomes. ``trigger``: as ``DataStreamWriter.trigger`` takes it."""
        self._make("log")
        self._make("outcomes")
        log = self.spark.readStream.schema(SIGHTED).option("maxFilesPerTrigger", 1).parquet(self._at("log"))
        outcomes = self.spark.readStream.schema(OUTCOME + ", batch_id long").parquet(self._at("outcomes"))
        none = lambda kind: F.lit(None).cast(kind)
        both = log.select("path", "digest", F.unix_millis("modified_at").alias("modified"), F.unix_millis("seen_at").alias("seen"), "listing", none("string").alias("error")).unionByName(
            outcomes.select("path", "digest", none("long").alias("modified"), F.unix_millis("seen_at").alias("seen"), none("string").alias("listing"), "error")
        )
        state = Pending(self.stable_seconds, self.cooldown_seconds, self.most_failures, self.keep_seconds)
        actions = both.groupBy("path").transformWithState(state, ACTION, "Append", "ProcessingTime")
        with _confs(self.spark):
            return actions.writeStream.foreachBatch(self._batch).option("checkpointLocation", self._at("checkpoint")).outputMode("append").trigger(**trigger).start()

    def _batch(self, actions: DataFrame, batch: int) -> None:
        def put(df: DataFrame, name: str) -> DataFrame:
            path = f"{self._at(name)}/batch_id={batch}"
            df.write.mode("overwrite").parquet(path)
            return df.sparkSession.read.schema(df.schema).parquet(path)

        due = put(actions, "actions").filter("action = 'convert'")
        listings = [r[0] for r in due.select("listing").distinct().collect()]  # a batch reads one listing; with timers those of the files that wait
        if listings:
            contents = actions.sparkSession.read.schema(CONTENT).parquet(self._at("contents")).filter(F.col("listing").isin(listings))
            texts = contents.join(due.select("path", "digest", "listing"), ["path", "digest", "listing"]).select("path", "digest", "content")
            results = put(self.convert(texts), "results")
            put(results.select("path", "digest", F.current_timestamp().alias("seen_at"), F.col("error").cast("string").alias("error")), "outcomes")

    def run(self, found: DataFrame | None = None) -> None:
        """One pass: log a listing, if given, and go on with all there is."""
        self.sight(found if found is not None else self.spark.createDataFrame([], "path string, modified_at timestamp, content binary"))
        self.start(availableNow=True).awaitTermination()

    def actions(self) -> DataFrame:
        return self._read("actions", ACTION + ", batch_id long")


def documents(texts: DataFrame) -> DataFrame:
    """(doc_id, source_name, text, digest, error) of (path, digest, content); ``error`` tells why a file can't be converted."""
    text = F.col("content").cast("string")
    error = F.when(F.octet_length("content") == 0, "empty file").when(~F.is_valid_utf8(text), "not UTF-8")
    return texts.select(F.col("path").alias("doc_id"), F.url_decode(F.element_at(F.split("path", "/"), -1)).alias("source_name"), F.when(error.isNull(), text).alias("text"), "digest", error.alias("error"))


def conversion(folder: str, **settings) -> Callable[[DataFrame], DataFrame]:
    """A converter that writes all artefacts of the files below ``folder`` (``plans.convert``)."""
    from lemmaflow.plans.convert import convert

    def run(texts: DataFrame) -> DataFrame:
        docs = documents(texts)
        convert(docs.filter("error is null").select("doc_id", "source_name", "text"), folder, **settings)
        return docs.select(F.col("doc_id").alias("path"), "digest", "error")

    return run
