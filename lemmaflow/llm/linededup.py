"""Line dedup over levelled sorted runs of line hashes, with DataFrame functions only.

A run is a bucketed, sorted table of (h1, h2, owner): 128-bit hashes of line keys and the smallest doc_id that holds each.
Documents come in batches of ascending doc_id. A batch merges with every run; the keys that no run has (an anti-join) make
the batch's own run on level 0. When a level has ``fanout`` runs, they are compacted into one on the next level. A key so lies in one run
only, and its owner never changes. Lines of keys whose owner is another document are dropped.

Only hashes are dealt by key; keys with over 1/500 of a batch's lines go by a broadcast of at most 500 rows, so no task gets all
lines of a frequent key. Texts move once, by doc_id.

Defined results: null text is one empty line; lines whose key has fewer than ``least`` code points always stay; a null doc_id
comes after all others, and all rows with null doc_id count as one document; rows with equal doc_id count as one document, so they don't
drop each other's lines; an empty table gives no rows; other columns are kept by ``dedup`` and not read.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lemmaflow.llm.common import P, heavy_keys, scratch_dir, staged

SPACES = " \t\n\x0b\f\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACES)), _UPPER, _LOWER)


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(docs: DataFrame, least: int) -> DataFrame:
    """(doc_id, row, line, h1, h2) of every line with a key of ``least`` code points. ``row`` tells rows of equal doc_id apart."""
    found = F.transform(lines(F.col("text")), lambda x, i: F.struct(i.alias("line"), line_key(x).alias("key")))
    long = F.filter(found, lambda x: F.length(x["key"]) >= least)
    each = docs.select("doc_id", F.xxhash64("text").alias("row"), F.inline(F.transform(long, lambda x: F.struct(x["line"].alias("line"), F.xxhash64(x["key"]).alias("h1"), F.xxhash64(F.lit("line"), x["key"]).alias("h2")))))
    return each


@dataclass
class Runs:
    """The runs of all levels, as bucketed tables below ``folder``. ``fanout``: runs of a level that are compacted into one."""

    spark: SparkSession
    folder: str
    fanout: int = 3
    levels: list[list[str]] = field(default_factory=list)
    #: Tables that may exist, whatever became of their writing.
    made: set[str] = field(default_factory=set)

    def names(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def write(self, rows: DataFrame) -> str:
        name, n = f"lemmaflow_run_{uuid.uuid4().hex}", int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.made.add(name)
        rows.select(*KEY, "owner").repartition(n, *KEY).write.bucketBy(n, *KEY).sortBy(*KEY).option("path", f"{self.folder}/{name}").saveAsTable(name)
        return name

    def add(self, rows: DataFrame) -> None:
        """A new run on level 0; full levels are compacted."""
        name, level = self.write(rows), 0
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(name)
            if len(self.levels[level]) < self.fanout:
                return
            old = self.levels[level]
            name = self.write(reduce(DataFrame.unionByName, map(self.spark.table, old)))
            # the new run counts from here on; if its writing failed, the old ones still do
            self.levels[level], level = [], level + 1
            for x in old:
                self.spark.sql(f"drop table {x}")
                self.made.discard(x)

    def owners(self, keys: DataFrame) -> DataFrame:
        """Adds ``owner`` to distinct keys: null where no run has the key. One merge join a run; the runs' side isn't shuffled."""
        out = keys
        for i, name in enumerate(self.names()):
            out = out.join(self.spark.table(name).withColumnRenamed("owner", f"{P}owner{i}").hint("merge"), KEY, "left")
        found = [F.col(f"{P}owner{i}") for i in range(len(self.names()))]
        return out.select(*keys.columns, (F.coalesce(*found, F.lit(None).cast("long")) if found else F.lit(None).cast("long")).alias("owner"))

    def close(self) -> None:
        for name in self.made:
            self.spark.sql(f"drop table if exists {name}")
        self.levels, self.made = [], set()


def add_batch(runs: Runs, batch: DataFrame) -> DataFrame:
    """Take a batch of line hashes into the runs; the (doc_id, row, line) that are dropped. ``batch`` is read several times: a table."""
    n = int(runs.spark.conf.get("spark.sql.shuffle.partitions"))
    # rows of null doc_id are one document, after all others
    first = batch.groupBy(*KEY).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.bool_or(F.col("doc_id").isNull()).alias("no_id"), F.count(F.lit(1)).alias("n"))
    known = staged(runs.owners(first.repartition(n, *KEY) if runs.names() else first), "keys")
    # a key that only documents without an id hold has no owner yet
    runs.add(known.filter("owner is null and first is not null").select(*KEY, F.col("first").alias("owner")))
    several = known.filter("owner is not null or first <> last or (no_id and first is not null)").select(*KEY, F.coalesce("owner", "first").alias("owner"), "n")
    hot = heavy_keys(several, KEY)
    hot = F.broadcast(hot.drop("n"))
    others = batch.join(hot, KEY, "left_anti").join(several.drop("n"), KEY)
    return batch.join(hot, KEY).unionByName(others).filter(~F.col("doc_id").eqNullSafe(F.col("owner"))).select("doc_id", "row", "line")


def dropped_lines(docs: DataFrame, least: int = 10, batches: int = 4, fanout: int = 3, runs: Runs | None = None) -> DataFrame:
    """(doc_id, row, drops): the places of each document's dropped lines, in order; only documents that lose some.

    ``runs``: those of earlier deliveries, which own their keys; this one's are added, and the caller closes them.
    """
    spark = docs.sparkSession
    hashes = line_hashes(docs.select(F.col("doc_id").cast("long"), "text"), least)
    cuts = docs.select(F.col("doc_id").cast("double").alias("d")).approxQuantile("d", [i / batches for i in range(1, batches)], 0.01) if batches > 1 else []
    batch = F.lit(0)
    for c in cuts:
        batch = batch + F.when(F.coalesce(F.col("doc_id") > int(c), F.lit(True)), 1).otherwise(0)
    path = scratch_dir(spark, "lines")
    hashes.withColumn(f"{P}batch", batch).write.partitionBy(f"{P}batch").parquet(path)
    all_ = spark.read.schema(hashes.schema.add(f"{P}batch", "integer")).parquet(path)
    own, parts = runs or Runs(spark, scratch_dir(spark, "runs"), fanout), []
    try:
        for b in range(len(cuts) + 1):
            parts.append(staged(add_batch(own, all_.filter(F.col(f"{P}batch") == b).drop(f"{P}batch")), "drops"))
    finally:
        if runs is None:
            own.close()
    return reduce(DataFrame.unionByName, parts).groupBy("doc_id", "row").agg(F.sort_array(F.collect_set("line")).alias("drops"))


def dedup(docs: DataFrame, least: int = 10, batches: int = 4, fanout: int = 3, runs: Runs | None = None) -> DataFrame:
    """``docs`` with ``text`` without the dropped lines, ``__lf_lines`` (before) and ``__lf_dropped``."""
    drops = dropped_lines(docs, least, batches, fanout, runs).select(F.col("doc_id").alias(f"{P}id"), F.col("row").alias(f"{P}row"), F.col("drops").alias(f"{P}drops"))
    joined = docs.join(drops, F.col("doc_id").cast("long").eqNullSafe(F.col(f"{P}id")) & (F.xxhash64("text") == F.col(f"{P}row")), "left")
    cut = joined.withColumns({f"{P}all": lines(F.col("text")), f"{P}from": F.concat(F.array(F.lit(0)), F.transform(f"{P}drops", lambda i: i + 1))})
    n = F.size(f"{P}all")
    # between two dropped lines lies a run of kept ones
    runs = F.zip_with(F.col(f"{P}from"), F.concat(F.col(f"{P}drops"), F.array(n)), lambda a, b: F.slice(F.col(f"{P}all"), a + 1, b - a))
    text = F.when(F.col(f"{P}drops").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(F.flatten(runs), "\n"))
    return cut.select(*(text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns), n.cast("long").alias(f"{P}lines"), F.coalesce(F.size(f"{P}drops"), F.lit(0)).cast("long").alias(f"{P}dropped"))
