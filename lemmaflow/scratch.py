"""Scratch tables in the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []
_tables: dict[str, str] = {}


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new path in the session's ``spark.checkpoint.dir``.

    Only where that is unset and the master is local is a folder of our own chosen; on a cluster a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "/tmp/checkpoints"
    path = f"{base.rstrip('/')}/lemmaflow-{os.getpid()}/{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to scratch and read again: later steps don't compute it again, nor when executors are lost."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """``df`` written to scratch as a table in buckets by ``keys``, sorted by them: joins on these don't move it again."""
    spark = df.sparkSession
    path, n = scratch_dir(spark, name), int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    _tables[path] = table
    return spark.table(table)


def _delete(made: list[tuple[SparkSession, str]]) -> None:
    while made:
        spark, path = made.pop()
        try:
            if path in _tables:
                spark.sql(f"drop table if exists {_tables.pop(path)}")
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the JVM may be gone by then; the folder is its owner's to clean
            return


@contextmanager
def scratch_scope() -> Iterator[None]:
    """Deletes at its end the scratch tables that were made within. What reads them, a query's result included, must be used or written by then."""
    before = len(_made)
    try:
        yield
    finally:
        own = _made[before:]
        del _made[before:]
        _delete(own)


def drop_scratch() -> None:
    """Delete the scratch tables that this process has written; runs at the end of the process."""
    _delete(_made)


atexit.register(drop_scratch)
