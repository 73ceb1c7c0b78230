"""The folder stream: stable, changed, failing, blocked and re-added files, and a stream that is killed."""

from __future__ import annotations

import os
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lemmaflow.streaming import watch


def put(folder, name, text, age=1000):
    (folder / f"{name}.md").write_bytes(text if isinstance(text, bytes) else text.encode())
    os.utime(folder / f"{name}.md", (time.time() - age,) * 2)


def convert(texts):
    return watch.documents(texts).select(F.col("doc_id").alias("path"), "digest", F.coalesce("error", F.when(F.contains("text", F.lit("bad")), "bad file")).alias("error"))


def seen(w):
    return Counter((r["path"].rsplit("/", 1)[1][:-3], r["action"], r["failures"]) for r in w.actions().collect())


def test_files_are_converted_once_when_stable_and_again_after_failures(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    w = watch.Watch(spark, str(tmp_path / "work"), convert, stable_seconds=8, cooldown_seconds=5, most_failures=2, most_files=2)
    put(folder, "a", "one")
    put(folder, "bad", "bad")
    put(folder, "odd", b"\xff\xfe")
    began = time.time()
    put(folder, "young", "text", 0)
    w.run(watch.files(spark, str(folder)))
    first = seen(w)
    assert first >= Counter([("a", "convert", 0), ("bad", "convert", 0), ("odd", "convert", 0)])
    # a changes, a copy of it is another path; young has no new sighting, so only its timer can bring it
    put(folder, "a", "two", 500)
    put(folder, "c", "two")
    w.run(watch.files(spark, str(folder)))
    second = seen(w) - first
    assert second[("a", "convert", 0)] == 1 and second[("a", "done", 0)] == 1 and second[("c", "convert", 0)] == 1 and second[("bad", "failed", 1)] == 1
    assert not any(k[0] == "bad" and k[1] == "convert" for k in second)  # it cools
    time.sleep(max(0, 9 - (time.time() - began)))
    (folder / "a.md").unlink()
    put(folder, "a", "two", 100)  # there again with what is done
    time.sleep(5)
    w.run(watch.files(spark, str(folder)))
    w.run()
    w.run()
    last = seen(w)
    assert {k: last[k] for k in last if k[0] == "young"} == {("young", "convert", 0): 1, ("young", "done", 0): 1}
    assert last[("a", "convert", 0)] == 2 and last[("a", "skip_done", 0)] == 1 and last[("a", "done", 0)] == 2
    time.sleep(5)
    w.run()
    w.run()
    last = seen(w)
    assert {k: last[k] for k in last if k[0] in ("bad", "odd")} == {(n, *k): 1 for n in ("bad", "odd") for k in (("convert", 0), ("failed", 1), ("convert", 1), ("blocked", 2))}
    results = spark.read.parquet(str(tmp_path / "work" / "results")).filter("error is null")
    assert max(r["count"] for r in results.groupBy("path", "digest").count().collect()) == 1
    put(folder, "bad", "good now", 10)
    w.run(watch.files(spark, str(folder)))
    assert seen(w)[("bad", "convert", 0)] == 2  # other content, so the failures are forgotten


def test_a_killed_stream_goes_on(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(6):
        put(folder, f"f{i}", f"text {i}")
    fails = []

    def breaks(texts):
        out = convert(texts)
        if len(fails) < 2:
            fails.append(out.collect())
            raise RuntimeError("killed")
        return out

    w = watch.Watch(spark, str(tmp_path / "work"), breaks, stable_seconds=0, most_files=2)
    for listing in (watch.files(spark, str(folder)), None):
        with pytest.raises(Exception, match="killed"):
            w.run(listing)
    w.run()
    w.run(watch.files(spark, str(folder)))
    assert Counter(k[1] for k in seen(w).elements()) == {"convert": 6, "done": 6}
    assert Counter(r["path"] for r in spark.read.parquet(str(tmp_path / "work" / "results")).collect()) == Counter(f"file:{folder}/f{i}.md" for i in range(6))


def test_a_watched_folder_becomes_artefacts(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    put(folder, "book", "# Chapter 1 X\n## 1.1 Y\nDefinition 1.1. A thing is a thing.\n")
    put(folder, "none", b"\xff")
    w = watch.Watch(spark, str(tmp_path / "work"), watch.conversion(str(tmp_path / "out")), stable_seconds=0)
    w.run(watch.files(spark, str(folder)))
    w.run()
    assert seen(w) == Counter([("book", "convert", 0), ("book", "done", 0), ("none", "convert", 0), ("none", "failed", 1)])
    from lemmaflow.plans.convert import read

    assert [r["doc_id"] for r in read(spark, str(tmp_path / "out"), "items").collect()] == [f"file:{folder}/book.md"]
