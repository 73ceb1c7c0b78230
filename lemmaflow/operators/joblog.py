"""Jobs as a log of events, with a compacted snapshot: legal moves only, progress merged, recovery of what a crash left.

An event (id, seq, at, kind, status, phase, sections_total, sections_completed, error, result) is appended and never changed; ``seq`` orders the events of a job. The state of a job is
a replay of its moves (create, status, complete, resume, delete), which are few, over the state that the snapshot has; progress and access events, of which there may be very many, are
merged by one aggregation and never gathered. Moves that aren't legal from the state that they meet change nothing and are told.

    none -create-> queued -status running-> running -complete-> succeeded        any -delete-> none
    queued, running -status failed-> failed -resume-> queued                     running -status queued (recovery)-> queued
"""

from __future__ import annotations

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lemmaflow.functions import patterns as R
from lemmaflow.scratch import staged

EVENT = "id string, seq long, at timestamp, kind string, status string, phase string, sections_total int, sections_completed int, error string, result string"
STATE = "struct<status:string,phase:string,error:string,result:string,created_at:timestamp,updated_at:timestamp,born:bigint>"
MOVES = ("create", "status", "complete", "resume", "delete")


def _after(s: Column, e: Column) -> Column:
    """The status after a move; null if it isn't legal."""
    is_ = lambda *names: F.coalesce(s["status"].isin(*names), F.lit(False))
    kind, status = e["kind"], e["status"]
    return (
        F.when((kind == "create") & (s["status"] == "none"), "queued").when((kind == "delete") & (s["status"] != "none"), "none").when((kind == "complete") & is_("running"), "succeeded")
        .when((kind == "resume") & is_("failed"), "queued").when((kind == "status") & (status == "running") & is_("queued"), "running").when((kind == "status") & (status == "failed") & is_("queued", "running"), "failed")
        .when((kind == "status") & (status == "queued") & is_("running", "queued"), "queued")
    )


def _moved(s: Column, e: Column, prefix: str) -> Column:
    new, kind = _after(s, e), e["kind"]
    phase = F.when(kind == "create", "queued").when(kind == "complete", "completed").when(kind == "resume", "resuming").when(kind == "delete", None).otherwise(F.concat(F.lit(prefix), F.coalesce(e["phase"], F.lit(""))))
    made = F.struct(
        new.alias("status"), phase.alias("phase"), F.when(kind == "status", e["error"]).alias("error"), F.when(kind == "complete", e["result"]).when(kind == "delete", None).otherwise(s["result"]).alias("result"),
        F.when(kind == "create", e["at"]).when(kind == "delete", None).otherwise(s["created_at"]).alias("created_at"), F.when(kind != "delete", e["at"]).alias("updated_at"), F.when(kind == "create", e["seq"]).otherwise(s["born"]).alias("born"),
    ).cast(STATE)
    return F.when(new.isNull(), s).otherwise(made)


def _none() -> Column:
    return F.struct(F.lit("none").alias("status"), *(F.lit(None).alias(n) for n in ("phase", "error", "result", "created_at", "updated_at")), F.lit(-1).alias("born")).cast(STATE)


def states(events: DataFrame, snapshot: DataFrame | None = None, prefix: str = "") -> DataFrame:
    """A row for each job that there is: id, status, phase, sections_total, sections_completed, error, result, created_at, updated_at, last_accessed_at, last_seq, n_refused.

    ``snapshot``: what an earlier call gave, of which only events with greater seq are looked at. ``prefix``: before the phases of moves and progress ("doc2x_" or "md2json_" for full jobs).
    """
    fields = ["seq", "at", "kind", "status", "phase", "error", "result"]
    if snapshot is not None:
        events = events.join(snapshot.select("id", F.col("last_seq").alias("_seen")), "id", "left").filter("_seen is null or seq > _seen").drop("_seen")
    moves = F.array_sort(F.collect_list(F.when(F.col("kind").isin(*MOVES), F.struct(*fields))))
    latest = lambda kind: F.max_by(F.struct("seq", "at", "phase", "sections_total", "sections_completed"), F.when(F.col("kind") == kind, F.col("seq")))
    rows = events.groupBy("id").agg(moves.alias("moves"), latest("progress").alias("p"), latest("access").alias("a"), F.max("seq").alias("tail_seq"))
    if snapshot is not None:
        old = F.struct("status", "phase", "error", "result", "created_at", "updated_at", F.lit(-1).cast("long").alias("born")).cast(STATE)
        before = snapshot.select("id", old.alias("old"), F.col("sections_total").alias("old_total"), F.col("sections_completed").alias("old_completed"), F.col("last_accessed_at").alias("old_access"), "last_seq", F.col("n_refused").alias("old_refused"))
        rows = rows.join(before, "id", "full")
    else:
        rows = rows.selectExpr("*", f"cast(null as {STATE}) as old", "cast(null as int) as old_total", "cast(null as int) as old_completed", "cast(null as timestamp) as old_access", "cast(null as bigint) as last_seq", "0L as old_refused")
    both = F.struct(F.coalesce("old", _none()).alias("s"), F.lit(0).alias("refused"))
    step = lambda x, e: F.struct(_moved(x["s"], e, prefix).alias("s"), (x["refused"] + F.when(_after(x["s"], e).isNull(), 1).otherwise(0)).alias("refused"))
    done = F.aggregate(F.coalesce("moves", F.array().cast("array<struct<seq:bigint,at:timestamp,kind:string,status:string,phase:string,error:string,result:string>>")), both, step)
    rows = rows.withColumn("r", done).withColumns({"s": F.col("r.s"), "fresh": F.coalesce(F.col("p.seq") > F.col("r.s.born"), F.lit(False))})
    # progress belongs to the job that was created last, and to a job that runs; a newer move's phase wins
    phase = F.when(F.col("fresh") & (F.col("s.status") == "running") & (F.col("p.seq") > F.coalesce(F.when(F.size("moves") > 0, F.try_element_at("moves", F.lit(-1))["seq"]), F.lit(-1))), F.concat(F.lit(prefix), "p.phase")).otherwise(F.col("s.phase"))
    again = F.col("s.born") >= 0
    number = lambda new, old: F.when(F.col("fresh"), F.col(new)).when(~again, F.col(old))
    return rows.filter("s.status <> 'none'").select(
        "id", "s.status", phase.alias("phase"), number("p.sections_total", "old_total").alias("sections_total"), F.coalesce(number("p.sections_completed", "old_completed"), F.lit(0)).alias("sections_completed"), "s.error", "s.result", "s.created_at",
        F.greatest("s.updated_at", F.when(F.col("fresh"), F.col("p.at")), F.when(F.col("a.seq") > F.col("s.born"), F.col("a.at"))).alias("updated_at"), F.coalesce(F.when(F.col("a.seq") > F.col("s.born"), F.col("a.at")), F.when(~again, F.col("old_access"))).alias("last_accessed_at"),
        F.greatest("tail_seq", "last_seq").alias("last_seq"), (F.col("old_refused") + F.col("r.refused") if snapshot is None else F.coalesce("old_refused", F.lit(0)) + F.col("r.refused")).cast("long").alias("n_refused"),
    )


class JobLog:
    """A log below ``folder``: batches of events, and snapshots of all states up to a batch."""

    def __init__(self, spark: SparkSession, folder: str, prefix: str = ""):
        self.spark, self.folder, self.prefix = spark, folder.rstrip("/"), prefix

    def _numbers(self, name: str) -> list[int]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        found = (s.getPath() for s in fs.listStatus(path) if s.isDirectory())
        # what didn't commit doesn't count
        return sorted(int(p.getName().split("=")[1]) for p in found if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{p}/_SUCCESS")))

    def append(self, events: DataFrame) -> None:
        """Append events (as EVENT) as a batch."""
        n = max(self._numbers("events"), default=0) + 1
        events.select(*(c.split()[0] for c in EVENT.split(", "))).write.mode("overwrite").parquet(f"{self.folder}/events/batch={n}")

    def _events(self, after: int) -> DataFrame:
        batches = [b for b in self._numbers("events") if b > after]
        return self.spark.read.schema(EVENT).parquet(*(f"{self.folder}/events/batch={b}" for b in batches)) if batches else self.spark.createDataFrame([], EVENT)

    def states(self) -> DataFrame:
        """The states of all jobs: the newest snapshot, and the batches after it."""
        done = self._numbers("snapshots")
        if not done:
            return states(self._events(0), None, self.prefix)
        return states(self._events(done[-1]), self.spark.read.parquet(f"{self.folder}/snapshots/batch={done[-1]}"), self.prefix)

    def compact(self) -> None:
        """Write a snapshot up to the last batch."""
        n = max(self._numbers("events"), default=0)
        if n and n not in self._numbers("snapshots"):
            self.states().write.mode("overwrite").parquet(f"{self.folder}/snapshots/batch={n}")

    def recover(self, now: Column) -> DataFrame:
        """After a crash: jobs that run go back into the queue; the jobs that are to be started, oldest first."""
        left = staged(self.states().filter(F.col("status").isin("queued", "running")), "unfinished")
        none = F.lit(None).cast("string")
        self.append(left.filter("status = 'running'").select(
            "id", (F.col("last_seq") + 1).alias("seq"), now.cast("timestamp").alias("at"), F.lit("status").alias("kind"), F.lit("queued").alias("status"), F.lit("recovering").alias("phase"), F.lit(None).cast("int").alias("sections_total"), F.lit(None).cast("int").alias("sections_completed"), none.alias("error"), none.alias("result"),
        ))
        return left.orderBy("created_at", "id").select("id", "created_at")


def page_ranges(pages: DataFrame, most_pages: int, most_bytes: int, overhead: int = 0) -> DataFrame:
    """(doc_id, chunk, start_page, end_page, bytes, error): pages (doc_id, page, from 0, and bytes) cut into ranges of at most ``most_pages``, and those that are too large halved until
    they fit or are one page, which is an error if it doesn't. ``overhead``: bytes of a range besides its pages. A document that fits whole is one range. end_page is exclusive."""
    whole = pages.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page", "bytes"))).alias("p"))  # a document's pages are few
    size = F.transform("p", lambda x: x["bytes"])
    rows = whole.select("doc_id", size.alias("sizes"), F.explode(F.transform(F.sequence(F.lit(0), F.size("p") - 1, F.lit(most_pages)), lambda a: F.struct(a.alias("a"), F.least(a + most_pages, F.size("p")).alias("b")))).alias("r")).select("doc_id", "sizes", "r.a", "r.b")
    own = lambda: F.aggregate(F.slice("sizes", F.col("a") + 1, F.col("b") - F.col("a")), F.lit(overhead).cast("long"), lambda s, x: s + x)
    for _ in range(max(most_pages - 1, 0).bit_length()):
        half = F.col("a") + F.greatest(F.lit(1), F.floor((F.col("b") - F.col("a")) / 2).cast("int"))
        cut = F.when((own() > most_bytes) & (F.col("b") - F.col("a") > 1), F.array(F.struct(F.col("a").alias("a"), half.alias("b")), F.struct(half.alias("a"), F.col("b").alias("b")))).otherwise(F.array(F.struct("a", "b")))
        rows = rows.select("doc_id", "sizes", F.explode(cut).alias("r")).select("doc_id", "sizes", "r.a", "r.b")
    out = rows.select("doc_id", "a", "b", own().alias("bytes"))
    listed = out.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("a", "b", "bytes"))).alias("c")).select("doc_id", F.posexplode("c").alias("i", "c"))
    error = F.when(F.col("c.bytes") > most_bytes, F.format_string(R.ERROR_PAGE_SIZE, F.col("c.a") + 1, F.col("c.bytes")))
    return listed.select("doc_id", (F.col("i") + 1).alias("chunk"), F.col("c.a").alias("start_page"), F.col("c.b").alias("end_page"), "c.bytes", error.alias("error"))


def collection_plan(jobs: DataFrame, saved: DataFrame, debug: DataFrame, now: Column, *, failed_days: int = 7, succeeded_days: int = 14, annotated_days: int = 180, debug_days: int = 1) -> DataFrame:
    """(kind, id, path, reason) of what is to go: jobs (kind, id, status, updated_at, path) past their days, those with a saved annotation (``saved``: id) when they are past its days too,
    of whatever kind; and debug folders (path, modified_at). Jobs that wait or run stay. Nothing is deleted: ``collected`` does that."""
    old = lambda at, days: F.col(at) <= now - F.make_dt_interval(days)
    own = jobs.join(saved.select("id").distinct().withColumn("saved", F.lit(True)), "id", "left").withColumn("saved", F.coalesce("saved", F.lit(False)))
    days = F.when(F.col("status") == "failed", failed_days).otherwise(succeeded_days)
    gone = own.filter(F.col("status").isin("failed", "succeeded") & old("updated_at", days) & (~F.col("saved") | old("updated_at", F.lit(annotated_days))))
    reason = F.concat("status", F.when(F.col("saved"), " with annotation").otherwise(""), F.lit(", older than "), F.when(F.col("saved"), F.greatest(F.lit(annotated_days), days)).otherwise(days).cast("string"), F.lit(" days"))
    parts = debug.filter(old("modified_at", F.lit(debug_days))).select(F.lit("debug").alias("kind"), F.col("path").alias("id"), "path", F.lit(f"older than {debug_days} days").alias("reason"))
    return gone.select("kind", "id", "path", reason.alias("reason")).unionByName(parts)


def collection_report(plan: DataFrame) -> DataFrame:
    """(kind, n): how many of each kind a plan takes; zeros for kinds without any."""
    kinds = plan.sparkSession.createDataFrame([(k,) for k in R.COLLECTED], "kind string")
    return F.broadcast(kinds).join(plan.groupBy("kind").agg(F.count(F.lit(1)).alias("n")), "kind", "left").fillna(0, "n")


def collected(plan: DataFrame, dry_run: bool = False) -> DataFrame:
    """Delete the paths of a plan, in tasks, through the file system that they name; (kind, id, path, reason, deleted). A dry run deletes nothing and says false; what is gone already counts as deleted."""
    @F.pandas_udf("boolean")
    def delete(paths: pd.Series) -> pd.Series:
        def one(path: str) -> bool:
            if dry_run:
                return False
            fs, p = pafs.FileSystem.from_uri(path)
            kind = fs.get_file_info(p).type
            if kind == pafs.FileType.Directory:
                fs.delete_dir(p)
            elif kind == pafs.FileType.File:
                fs.delete_file(p)
            return True

        return paths.map(one)

    return staged(plan.withColumn("deleted", delete("path")), "collected")
