"""The pipeline's stages against plain Python, each on its own input, and the whole run."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lemmaflow.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(9)
    text = lambda n: " ".join(f"term{rng.randrange(3000)}" for _ in range(n))
    items = [(i, text(30)) for i in range(4)]
    docs = {i: text(rng.randrange(40, 120)) for i in range(30)}
    docs[30] = "spam " * 50  # repeats
    docs[31] = "few words"
    docs[32] = docs[3]  # a copy
    w = docs[4].split()
    w[10] = "changed"
    docs[33] = " ".join(w)  # a near copy
    docs[34] = text(20) + "\n" + items[0][1] + "\n" + text(20)  # contaminated
    for i in (35, 36):
        docs[i] = f"a license line that repeats in documents\n{text(40)}"
    folder = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, t, "en", "s", len(t)) for i, t in docs.items()] + [(None, text(50), None, None, None), (99, None, "en", None, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, dict((r[0], r[1]) for r in rows)


def test_stages_in_order(spark, tables):
    folder, docs = tables
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "ngram_jaccard", "benchmark_decontamination", "packing"]
    kept, at = {}, spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, at, folder)
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        rows = out.collect()
        kept[name] = {r["doc_id"]: r["text"] for r in rows}
        at = spark.createDataFrame(rows, out.schema) if rows else out
        if name == "line_dedup":
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
    assert set(docs) - set(kept["quality_rules"]) == {30, 31, 99}
    lines = kept["line_dedup"]
    assert set(lines) == set(kept["quality_rules"])
    assert lines[32] == "" and lines[35].startswith("a license") and not lines[36].startswith("a license")
    assert set(lines) - set(kept["ngram_jaccard"]) == {33}
    assert set(kept["ngram_jaccard"]) - set(kept["benchmark_decontamination"]) == {34}
    last = kept["benchmark_decontamination"]
    tokenizer = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    want = Counter({i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in last.items()})
    got = Counter()
    for r in corpus_pipeline.run(spark, folder).collect():
        got[r["doc_id"]] += r["length"]
    assert got == want


def test_stages_of_empty_tables(spark, tables):
    folder, _ = tables
    none = spark.createDataFrame([], SCHEMA)
    assert all(stage(spark, none, folder).count() == 0 for _, stage in corpus_pipeline.STAGES)


def test_windows_of_words_are_hashed_side_by_side(spark):
    from lemmaflow.llm import rules

    texts = ["a b c d", "a b c d e", "x a b c d e y a b c d e", "one two three four five six " * 3, "", None]
    out = rules.measure(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert "sequence(" not in out._jdf.queryExecution().optimizedPlan().toString()  # five look-ups a word, by its place
    assert {r["doc_id"]: (r["n_words"], r["n_repeat_words"]) for r in out.collect()} == {0: (4, 0), 1: (5, 0), 2: (12, 10), 3: (18, 18), 4: (0, 0), 5: (0, 0)}
