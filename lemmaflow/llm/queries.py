"""The queries of this package: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lemmaflow.llm.common import P, scratch_dir, table
from lemmaflow.llm.urls import Rule


URL_RULES = [Rule("block", "net/"), Rule("allow", "example.net/en/"), Rule("block", "example.com/de/"), Rule("allow", "org/fr/")]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lemmaflow.llm.secrets import PATTERNS, find_secrets, named

    found = find_secrets(table(spark, sf_dir, "documents"))

    def number(rank: int) -> Column:
        return F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")

    numbers = [number(i).alias(f"n_{k}") for i, (k, *_) in enumerate(PATTERNS)]
    return found.select("doc_id", *numbers, F.sha2(named(F.col("base")), 256).alias("base_sha256"), named(F.col("spans")).alias("spans"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lemmaflow.llm.linededup import dedup

    out = dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col(f"{P}lines").alias("n_lines"), F.col(f"{P}dropped").alias("n_dropped"), F.sha2("text", 256).alias("kept_sha256"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first line of a document counts as its prompt, so that all three limits act."""
    from lemmaflow.llm.packing import first_line, pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), prompt=first_line(), with_ids=False)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lemmaflow.llm.warc import convert_pages

    return convert_pages(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lemmaflow.llm.urls import filter_urls

    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lemmaflow.llm.quality import score, train

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lemmaflow.llm.tokenfile import read_token_files, write_token_files

    path = scratch_dir(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_path("word_bpe_49k.json"))
    return read_token_files(spark, path, with_ids=False)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contaminated documents, with the items that they hold."""
    from lemmaflow.llm.decontam import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lemmaflow.llm.jaccard import jaccard_classes

    return jaccard_classes(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lemmaflow.llm.rules import POLICIES, apply_policy, ledger

    rows = apply_policy(ledger(table(spark, sf_dir, "documents")), POLICIES["2024-2"])
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "fail_bits")


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lemmaflow.llm.repeats import dedup

    out = dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col(f"{P}bytes").alias("n_bytes"), F.col(f"{P}removed").alias("n_removed"), F.col(f"{P}spans").alias("n_spans"), F.sha2(f"{P}kept", 256).alias("kept_sha256"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lemmaflow.llm.spelling import grouped

    return grouped(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lemmaflow.llm.codes import compressed

    return compressed(table(spark, sf_dir, "embeddings")).drop("label")


def secrets_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of ``op1_secrets`` that the fixed patterns alone decide."""
    return op1_secrets(spark, sf_dir).drop("spans")


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts, paths and rules of all URLs, without the models."""
    from lemmaflow.llm.urls import with_rules

    return with_rules(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).select("page_id", "host", "path", "rule")


def quality_rules_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the current policy would keep without each of its rules."""
    from lemmaflow.llm.rules import POLICIES, ablations, ledger

    return ablations(ledger(table(spark, sf_dir, "documents")), POLICIES["2024-2"])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op")} | {f.__name__: f for f in (secrets_base, url_rules, quality_rules_ablations)}


def oracle_sql() -> dict[str, str]:
    from lemmaflow.llm.oracles import ORACLES

    return ORACLES
