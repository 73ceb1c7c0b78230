"""Jobs, usage, retention and ingest state as tables of events and rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lemmaflow.functions import patterns as R
from lemmaflow.functions import values as V

PHASES = ["structure", "extract", "audit", "mock_structure", "mock_extract", "mock_audit"]


def latest(events: DataFrame, key: str, *order: Column) -> DataFrame:
    """The last event of each key, as one aggregation; ``order``: what decides, most important first."""
    names = events.columns
    return events.groupBy(key).agg(F.max_by(F.struct(*names), F.struct(*order)).alias("e")).select("e.*")


def top_jobs(jobs: DataFrame, limit: int = 50, status: str | None = None) -> DataFrame:
    """The newest jobs; the status is filtered first and the limit is between 1 and 500."""
    rows = jobs.filter(F.col("status") == status) if status else jobs
    return rows.orderBy(F.desc("updated_at"), F.desc("id")).limit(min(max(limit, 1), 500))


def unfinished(jobs: DataFrame) -> DataFrame:
    """Jobs that wait or run, the oldest first."""
    return jobs.filter(F.col("status").isin("queued", "running")).orderBy("updated_at", "id")


def merged_usage(turns: DataFrame, *keys: str) -> DataFrame:
    """(keys, name, value) of usage reports (keys, turn, usage as JSON), merged turn by turn: numbers add up, other values replace what was there.

    After a value that is no number, numbers begin anew. Null reports are none.
    """
    own = turns.select(*keys, "turn", F.explode(F.try_variant_get(V.parsed(F.col("usage")), "$", "map<string,variant>")).alias("name", "v"))
    number = F.when(V.kind(F.col("v")).isin("BIGINT", "DOUBLE", "DECIMAL"), F.try_variant_get("v", "$", "double"))
    rows = own.select(*keys, "turn", "name", number.alias("number"), V.text(F.col("v")).alias("said"))
    broken = F.max(F.when(F.col("number").isNull(), F.col("turn"))).over(Window.partitionBy(*keys, "name"))
    rows = rows.withColumn("broken", broken)
    run = F.sum(F.when(F.col("broken").isNull() | (F.col("turn") > F.col("broken")), F.col("number")))
    return rows.groupBy(*keys, "name").agg(run.alias("sum"), F.max_by("said", "turn").alias("said")).select(*keys, "name", F.coalesce(F.col("sum").cast("string"), "said").alias("value"))


def combined_usage(conversion: DataFrame, seconds: DataFrame) -> DataFrame:
    """Usage of an OCR run with its conversion: one request more, and the OCR's seconds are what the conversion leaves of the whole time.

    ``conversion``: id, requests, input_tokens, output_tokens, total_tokens, llm_elapsed_seconds, wall_clock_elapsed_seconds; ``seconds``: id, total_seconds.
    """
    rows = seconds.join(conversion, "id", "left")
    zero = {c: F.coalesce(c, F.lit(0)).alias(c) for c in ("input_tokens", "output_tokens", "total_tokens")}
    total = F.round(F.greatest(F.lit(0.0), F.col("total_seconds")), 6)
    ocr = F.round(F.greatest(F.lit(0.0), total - F.coalesce("wall_clock_elapsed_seconds", F.lit(0.0))), 6)
    return rows.select("id", (F.coalesce("requests", F.lit(0)) + 1).alias("requests"), *zero.values(), F.round(F.coalesce("llm_elapsed_seconds", F.lit(0.0)), 6).alias("llm_elapsed_seconds"), total.alias("wall_clock_elapsed_seconds"), ocr.alias("ocr_elapsed_seconds"))


def job_folders(paths: DataFrame, now: Column, days: int = 30) -> DataFrame:
    """Folders of jobs (path, modified_at) to remove: all below the folders of kinds, and those named by 32 hexadecimal digits, when old enough."""
    name, above = F.element_at(F.split("path", "/"), -1), F.element_at(F.split("path", "/"), -2)
    return paths.filter((above.isin(*R.JOB_FOLDERS) | F.rlike(name, F.lit("^[0-9a-f]{32}$"))) & (F.col("modified_at") <= now - F.make_dt_interval(F.lit(days))))


def settled_folders(files: DataFrame, now: Column, stable_seconds: int = 30) -> DataFrame:
    """(folder) of files (folder, modified_at): those whose newest file is old enough."""
    newest = files.groupBy("folder").agg(F.max("modified_at").alias("newest"))
    return newest.filter(F.lit(stable_seconds <= 0) | (F.col("newest") <= now - F.make_dt_interval(secs=F.lit(stable_seconds)))).select("folder")


def usage_by_phase(traces: DataFrame) -> DataFrame:
    """(phase, requests, input_tokens, output_tokens, total_tokens, elapsed_seconds) of traces with usage; a row of zeros for phases without any.

    ``traces``: phase, input_tokens, prompt_tokens, output_tokens, completion_tokens, total_tokens, elapsed_seconds and has_usage.
    """
    either = lambda a, b: F.coalesce(F.nullif(F.col(a), F.lit(0)), F.col(b), F.lit(0))
    own = traces.filter("has_usage").groupBy("phase").agg(
        F.count(F.lit(1)).alias("requests"), F.sum(either("input_tokens", "prompt_tokens")).alias("input_tokens"), F.sum(either("output_tokens", "completion_tokens")).alias("output_tokens"),
        F.sum(F.coalesce("total_tokens", F.lit(0))).alias("total_tokens"), F.round(F.sum(F.coalesce("elapsed_seconds", F.lit(0.0))), 6).alias("elapsed_seconds"),
    )
    all_ = traces.sparkSession.createDataFrame([(p,) for p in PHASES], "phase string")
    zero = {c: 0 for c in ("requests", "input_tokens", "output_tokens", "total_tokens", "elapsed_seconds")}
    return F.broadcast(all_).join(own, "phase", "left").fillna(zero)


def usage_total(by_phase: DataFrame) -> DataFrame:
    return by_phase.agg(*(F.sum(c).alias(c) for c in ("requests", "input_tokens", "output_tokens", "total_tokens")), F.round(F.sum("elapsed_seconds"), 6).alias("llm_elapsed_seconds"))


def expired(jobs: DataFrame, annotations: DataFrame, now: Column, failed_days: int = 7, annotated_days: int = 90, succeeded_days: int = 30) -> DataFrame:
    """Jobs past their days of retention, which depend on status and on whether an annotation was saved. Filtered by age before all else."""
    marked = jobs.join(annotations.select("id").distinct().withColumn("saved", F.lit(True)), "id", "left")
    days = F.when(F.col("status") == "failed", failed_days).when(F.col("saved"), annotated_days).otherwise(succeeded_days)
    return marked.filter(F.col("status").isin("failed", "succeeded") & (F.col("updated_at") <= now - F.make_dt_interval(days))).drop("saved")


def preferred(generated: DataFrame, saved: DataFrame, key: str, value: str) -> DataFrame:
    """The saved value where there is one, else the generated one."""
    return generated.join(saved.select(key, F.col(value).alias("saved_value")), key, "left").withColumn("origin", F.when(F.col("saved_value").isNotNull(), "saved").otherwise("generated")).withColumn(value, F.coalesce("saved_value", value)).drop("saved_value")


def pending(files: DataFrame, state: DataFrame, now: Column, stable_seconds: int = 30, cooldown_seconds: int = 3600, most_failures: int = 3) -> DataFrame:
    """Files to convert: stable, and not done, blocked or cooling down with the same digest.

    ``files``: path, digest, modified_at. ``state``: path, digest, status (done or failed), failure_count, updated_at.
    """
    waits = (F.col("status") == "done") | (F.col("failure_count") >= most_failures) | (F.col("updated_at") > now - F.make_dt_interval(secs=F.lit(cooldown_seconds)))
    held = state.filter(waits).select("path", "digest")
    return files.filter(F.col("modified_at") <= now - F.make_dt_interval(secs=F.lit(stable_seconds))).join(held, ["path", "digest"], "left_anti")
