"""Cleaning pipeline over ``documents``: each stage gets what the one before it kept, as Parquet.

All stages but the last return the columns of documents. Rejected documents, dropped lines, further copies and contaminated
documents are gone for the stages that follow; the last stage gives the packed pieces of what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lemmaflow.llm import decontam, jaccard, linededup, packing, rules
from lemmaflow.llm.common import staged, table
from lemmaflow.llm.oracles import PIPELINE_KEPT
from lemmaflow.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps."""
    return rules.keep_good(docs, rules.POLICIES["2024-2"])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a document of smaller id has; n_chars follows the text."""
    out = linededup.dedup(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: that of least id."""
    return jaccard.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences, with their ids."""
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"), prompt=packing.first_line())


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("ngram_jaccard", ngram_jaccard), ("benchmark_decontamination", benchmark_decontamination), ("packing", pack)]
#: SQL has no tiling and no tokenizer; tests/llm/test_pipeline.py holds the stages against a brute-force version.
ORACLE_SQL = None


#: SQL for the first three stages.
KEPT_SQL = PIPELINE_KEPT


def through(spark: SparkSession, sf_dir: str, stages: int) -> DataFrame:
    """What so many stages keep of the documents, as a table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:stages]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs


def kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the first three stages keep, with the digests of their texts."""
    return through(spark, sf_dir, 3).select("doc_id", F.sha2("text", 256).alias("text_sha256"))


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return STAGES[-1][1](spark, through(spark, sf_dir, len(STAGES) - 1), sf_dir)
