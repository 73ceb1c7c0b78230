"""Incremental ingest of changing files as a stream with state: done by digest, failures counted, cooled down, blocked."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lemmaflow.scratch import scratch_dir

SEEN = "path string, digest string, seen_at timestamp, outcome string"
RESULT = "path string, digest string, action string, failure_count int"
STATE = "digest string, status string, failure_count int, updated_at double"


def stable(sightings: DataFrame, stable_seconds: int = 30) -> DataFrame:
    """Sightings of files that haven't changed for a while; those without ``modified_at`` count as such. The others go, so a source must give them again;
    ``streaming.watch`` keeps them pending instead."""
    if "modified_at" not in sightings.columns:
        return sightings
    changed = F.unix_micros("seen_at") - F.unix_micros("modified_at") < stable_seconds * 1_000_000
    return sightings.filter(~F.coalesce(changed, F.lit(False))).drop("modified_at")


def decide(cooldown_seconds: int = 3600, most_failures: int = 3) -> Callable:
    """State of one path: what happens at each sighting (path, digest, seen_at, outcome of a conversion at this time), in the order of time.

    A changed digest forgets failures. Done files are skipped, failed ones wait for the cooldown, and are blocked after ``most_failures``.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        digest, status, failures, at = state.get if state.exists else (None, "", 0, 0.0)
        out = []
        rows = pd.concat(list(frames)).sort_values(["seen_at", "digest", "outcome"], na_position="last")
        for r in rows.itertuples():
            now = r.seen_at.timestamp()
            if r.digest != digest:
                digest, status, failures, at = r.digest, "", 0, 0.0
            if status in ("done", "blocked"):
                action = f"skip_{status}"
            elif status == "failed" and now - at < cooldown_seconds:
                action = "skip_cooling"
            elif r.outcome == "ok":
                action, status, failures, at = "converted", "done", 0, now
            else:
                failures, at = failures + 1, now
                status = "blocked" if failures >= most_failures else "failed"
                action = status
            out.append((key[0], digest, action, failures))
        state.update((digest, status, failures, at))
        yield pd.DataFrame(out, columns=["path", "digest", "action", "failure_count"])

    return step


def ingest(sightings: DataFrame, stable_seconds: int = 30, **settings) -> DataFrame:
    """The actions for a stream of sightings (as SEEN, and modified_at if known) of stable files; state is kept by path, across batches."""
    return stable(sightings, stable_seconds).groupBy("path").applyInPandasWithState(decide(**settings), RESULT, STATE, "append", GroupStateTimeout.NoTimeout)


def run_available(spark: SparkSession, source: DataFrame, target: str, checkpoint: str, **settings) -> DataFrame:
    """One pass over what there is: the stream's actions are appended to ``target`` as Parquet, exactly once by the checkpoint."""
    query = ingest(source, **settings).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(RESULT).parquet(target)


def replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table ``events`` as sightings: users are files, and event values their outcomes."""
    folder = scratch_dir(spark, "ingest")
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    seen = events.select(F.col("user_id").cast("string").alias("path"), F.expr("cast(event_id div 40 as string)").alias("digest"), F.col("ts").alias("seen_at"), F.when(F.col("value") > 20, "ok").otherwise("error").alias("outcome"))
    return run_available(spark, seen, f"{folder}/actions", f"{folder}/checkpoint").groupBy("action").agg(F.count(F.lit(1)).alias("n"))
