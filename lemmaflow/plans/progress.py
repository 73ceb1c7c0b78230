"""Progress of conversions and streams: rows that are appended while they run, and what a conversion that was cut off has done already."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from lemmaflow.scratch import staged

#: ``seq`` orders a run's rows; ``block`` is set where one has been committed.
ROW = "run string, seq long, phase string, block int, documents_total long, documents_completed long, sections_total long, sections_completed long"
COUNTS = ["documents_total", "documents_completed", "sections_total", "sections_completed"]

Report = Callable[[dict], None]


def staged_count(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``df`` staged, and its number of rows, which is observed while it is written."""
    seen = Observation()
    out = staged(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
    return out, seen.get["n"]


class ProgressLog:
    """A table of progress below ``folder``: a small file a report, of which a run makes a few a block."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def append(self, rows: list[dict]) -> None:
        names = [f.split()[0] for f in ROW.split(", ")]
        values = [tuple(r.get(n) for n in names) for r in rows]
        self.spark.createDataFrame(values, ROW).coalesce(1).write.mode("append").parquet(self.folder)

    def reporter(self, run: str) -> Report:
        """What ``convert`` takes as ``progress``: appends a row of ``run`` a call."""
        return lambda event: self.append([{"run": run, "seq": time.time_ns(), **event}])

    def rows(self, run: str | None = None) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], ROW)
        rows = self.spark.read.schema(ROW).parquet(self.folder)
        return rows if run is None else rows.filter(F.col("run") == run)

    def latest(self) -> DataFrame:
        """A row a run: its last phase and counts."""
        last = self.rows().groupBy("run").agg(F.max_by(F.struct("phase", *COUNTS), "seq").alias("last"))
        return last.select("run", "last.*")

    def committed(self, run: str) -> list[dict]:
        """The blocks that a run has committed, with their counts; a few numbers a block."""
        rows = self.rows(run).filter("block is not null").groupBy("block").agg(F.max_by(F.struct("documents_completed", "sections_completed"), "seq").alias("c"))
        return [r.asDict() for r in rows.select("block", "c.*").collect()]


class StreamProgress(StreamingQueryListener):
    """Keeps a row for each batch of the session's streams, until ``flush`` appends them to a log: the batch as phase, rows read as documents.

    Add it by ``spark.streams.addListener``. Events come after their batch, so the last ones may be there a moment after a query's end.
    """

    def __init__(self, log: ProgressLog) -> None:
        self.log, self.events = log, []

    def onQueryStarted(self, event) -> None:  # noqa: N802, ANN001
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802, ANN001
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802, ANN001
        failed = "failed" if event.exception else "completed"
        self.events.append({"run": str(event.runId), "seq": time.time_ns(), "phase": failed})

    def onQueryProgress(self, event) -> None:  # noqa: N802, ANN001
        p = event.progress
        self.events.append({"run": str(p.runId), "seq": time.time_ns(), "phase": f"batch {p.batchId}", "documents_total": p.numInputRows, "documents_completed": p.numInputRows})

    def flush(self) -> int:
        """The number of rows that were appended."""
        rows, self.events = self.events, []
        if rows:
            self.log.append(rows)
        return len(rows)
