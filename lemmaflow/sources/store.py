"""A store of documents' artefacts: tables in buckets, and a manifest that says which run each document's rows are of.

A run writes its tables below ``data/<table>/run=<run>/bucket=<bucket>``, then a row a document to ``manifest/run=<run>``: its run, its bucket and the tables that the run wrote. Only
that last write makes the run count, so a run that dies between two tables changes nothing. A reader takes of each table the rows whose document's newest row in the manifest
is of their run: a document that comes again without items, or without audits, has none from then on. ``compact`` rewrites what counts as one run and deletes the others.

Buckets are by hash of doc_id, which stays a column as it is: the number of folders doesn't grow with the documents, and ids may be of any length and form.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lemmaflow.scratch import staged

BUCKETS = 64


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _folders(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def bucket(doc_id: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(doc_id.cast("string")), F.lit(buckets)).cast("int")


def runs(spark: SparkSession, folder: str) -> list[str]:
    """The runs that count, the oldest first."""
    fs, _ = _fs(spark, folder)
    done = (r for r in _folders(spark, f"{folder}/manifest") if fs.exists(_fs(spark, f"{folder}/manifest/{r}/_SUCCESS")[1]))
    return [r.removeprefix("run=") for r in done]


def _next_run(spark: SparkSession, folder: str) -> str:
    seen = [r for r in _folders(spark, f"{folder}/manifest")]
    last = max((int(r.removeprefix("run=").split("-")[0]) for r in seen), default=0)
    return f"{last + 1:012d}-{uuid.uuid4().hex}"


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, run, bucket, tables): the newest row of each document."""
    found = runs(spark, folder)
    schema = "doc_id string, bucket int, tables array<string>, run string"
    if not found:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", f"{folder}/manifest").parquet(*(f"{folder}/manifest/run={r}" for r in found))
    return rows.groupBy("doc_id").agg(F.max_by(F.struct("run", "bucket", "tables"), "run").alias("m")).select("doc_id", "m.run", "m.bucket", "m.tables")


def commit(folder: str, documents: DataFrame, tables: dict[str, DataFrame], buckets: int = BUCKETS) -> str:
    """Write what a run made of ``documents`` (doc_id): tables with a column doc_id. The run's name.

    All earlier rows of these documents are superseded, in tables that the run doesn't have too; those of other documents stay.
    """
    spark = documents.sparkSession
    folder = folder.rstrip("/")
    run = _next_run(spark, folder)
    for name, df in tables.items():
        rows = df.withColumn("bucket", bucket(F.col("doc_id"), buckets))
        rows.repartition("bucket").sortWithinPartitions("bucket", "doc_id").write.partitionBy("bucket").parquet(f"{folder}/data/{name}/run={run}")
    rows = documents.select(F.col("doc_id").cast("string").alias("doc_id")).filter("doc_id is not null").distinct()
    own = F.array(*(F.lit(n) for n in sorted(tables))) if tables else F.array().cast("array<string>")
    rows.select("doc_id", bucket(F.col("doc_id"), buckets).alias("bucket"), own.alias("tables")).write.parquet(f"{folder}/manifest/run={run}")
    return run


def remove(folder: str, documents: DataFrame) -> str:
    """From now on these documents (doc_id) have no artefacts."""
    return commit(folder, documents, {})


def read(spark: SparkSession, folder: str, name: str, documents: Iterable[str] | None = None) -> DataFrame:
    """A table's rows that count, without their bucket and run. ``documents``: of these alone; only their buckets are read."""
    folder = folder.rstrip("/")
    now = manifest(spark, folder)
    written = [r for r in runs(spark, folder) if f"run={r}" in set(_folders(spark, f"{folder}/data/{name}"))]
    if not written:
        raise ValueError(f"no run wrote {name}")
    rows = spark.read.option("basePath", f"{folder}/data/{name}").option("mergeSchema", True).option("recursiveFileLookup", False)
    # partition values are names, never numbers
    rows = rows.parquet(*(f"{folder}/data/{name}/run={r}" for r in written)).withColumn("run", F.col("run").cast("string"))
    if documents is not None:
        ids = spark.createDataFrame([(d,) for d in documents], "doc_id string").select("doc_id", bucket(F.col("doc_id")).alias("bucket"))
        wanted = [r[0] for r in ids.select("bucket").distinct().collect()]
        rows, now = rows.filter(F.col("bucket").isin(wanted)), now.join(F.broadcast(ids.select("doc_id")), "doc_id", "left_semi")
    kept = rows.join(now.select(F.col("doc_id").alias("_id"), F.col("run").alias("_run")), (F.col("doc_id").cast("string") == F.col("_id")) & (F.col("run") == F.col("_run")), "left_semi")
    return kept.drop("run", "bucket")


def superseded(spark: SparkSession, folder: str) -> DataFrame:
    """(run, n_documents, n_current): how many of each run's documents still count; of runs that never committed both are null."""
    folder = folder.rstrip("/")
    found = runs(spark, folder)
    every = sorted({r.removeprefix("run=") for t in _folders(spark, f"{folder}/data") for r in _folders(spark, f"{folder}/data/{t}")} | set(found))
    names = spark.createDataFrame([(r,) for r in every], "run string")
    if not found:
        return names.select("run", F.lit(None).cast("long").alias("n_documents"), F.lit(None).cast("long").alias("n_current"))
    rows = spark.read.schema("doc_id string, run string").option("basePath", f"{folder}/manifest").parquet(*(f"{folder}/manifest/run={r}" for r in found))
    newest = F.max("run").over(Window.partitionBy("doc_id"))
    counts = rows.withColumn("newest", newest).groupBy("run").agg(F.count(F.lit(1)).alias("n_documents"), F.count_if(F.col("run") == F.col("newest")).alias("n_current"))
    return names.join(counts, "run", "left")


def vacuum(spark: SparkSession, folder: str, dry_run: bool = False, uncommitted: bool = False) -> list[str]:
    """Delete the runs of which nothing counts any more, and, if asked (none may be writing), those that never committed. Their names."""
    folder = folder.rstrip("/")
    gone = "n_current = 0 and n_documents > 0" + (" or n_documents is null" if uncommitted else "")
    names = sorted(r["run"] for r in superseded(spark, folder).filter(gone).collect())  # a row a run
    for run in [] if dry_run else names:
        # the manifest goes first: data without it doesn't count, the other way round it would be missed
        _delete(spark, f"{folder}/manifest/run={run}")
        for t in _folders(spark, f"{folder}/data"):
            _delete(spark, f"{folder}/data/{t}/run={run}")
    return names


def compact(spark: SparkSession, folder: str) -> str | None:
    """Rewrite all that counts as one run and delete the others. The run's name."""
    folder = folder.rstrip("/")
    old = runs(spark, folder)
    if not old:
        return None
    now = staged(manifest(spark, folder), "manifest")
    written = {t for t in _folders(spark, f"{folder}/data") if set(_folders(spark, f"{folder}/data/{t}")) & {f"run={r}" for r in old}}
    run = commit(folder, now.select("doc_id"), {t: read(spark, folder, t) for t in sorted(written)})
    vacuum(spark, folder)
    return run
