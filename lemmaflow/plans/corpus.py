"""A corpus of Markdown books derived from the table ``documents``: sixteen documents in a row make a book.

Its lines are those of the documents; by their place some become headings, items (every fifth definition repeats a number), proofs or back matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id (the book), source_name, text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    each = docs.groupBy(F.expr("cast(doc_id div 16 as string)").alias("doc_id")).agg(F.array_sort(F.collect_list(F.struct("doc_id", "text"))).alias("documents"))
    each = each.select("doc_id", F.flatten(F.transform("documents", lambda d: F.split(F.coalesce(d["text"], F.lit("")), "\n", -1))).alias("lines"))

    def line(x: Column, i: Column) -> Column:
        r, number = i % 12, F.floor(i / 12) + 1
        k = number.cast("string")
        return (
            F.when(i % 60 == 0, F.concat(F.lit("# Chapter "), (F.floor((i + 1) / 60) + 1).cast("string"), F.lit(" "), x))
            .when(r == 0, F.concat(F.lit("## "), k, F.lit(" "), F.substring(x, 1, 40)))
            .when(r == 3, F.concat(F.lit("Definition "), F.when(number % 5 == 0, (number - 1).cast("string")).otherwise(k), F.lit(".1. "), x))
            .when(r == 6, F.concat(F.lit("Theorem "), k, F.lit(".2. "), x))
            .when(r == 7, F.concat(F.lit("Proof. "), x))
            .when(r == 9, F.concat(F.lit("Remark. "), x))
            .when((r == 10) & (number % 3 == 0), F.concat(F.lit("Proof of Theorem "), k, F.lit(".2. "), x))
            .when((r == 11) & (number % 7 == 0), F.lit("## References"))
            .otherwise(x)
        )

    return each.select("doc_id", F.concat(F.lit("book"), "doc_id", F.lit(".md")).alias("source_name"), F.array_join(F.transform("lines", line), "\n").alias("text"))
