"""Progress of conversions in blocks and of streams."""

from __future__ import annotations

import time

import pytest

from lemmaflow.plans.convert import convert, read
from lemmaflow.plans.progress import ProgressLog, StreamProgress
from lemmaflow.sources import store

TEXT = "# Chapter 1 C\n## 1.1 A\nDefinition 1.1. x\n## 1.2 Two\nTheorem 1.2. y\n"


def test_blocks_tell_their_progress_and_go_on(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(f"d{i}", "d.md", TEXT) for i in range(5, 10)] + [("empty", "e.md", "")], "doc_id string, source_name string, text string")
    out, log = str(tmp_path / "out"), ProgressLog(spark, str(tmp_path / "log"))
    assert log.rows().count() == 0 and log.committed("r") == []
    commit, calls = store.commit, []

    def dies(*args, **kw):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return commit(*args, **kw)

    monkeypatch.setattr(store, "commit", dies)
    with pytest.raises(RuntimeError, match="lost"):
        convert(docs, out, blocks=2, progress=log, run="r")
    first = log.committed("r")
    assert [c["block"] for c in first] == [0] and len(log.latest().filter("phase = 'extracting'").collect()) == 1
    some = {r["doc_id"] for r in read(spark, out, "sections").collect()}
    assert 0 < len(some) == first[0]["documents_completed"] < 6
    names = convert(docs, out, blocks=2, progress=log, run="r")
    assert len(calls) == 3 and "items" in names  # the first block isn't done again
    last = log.latest().first()
    n = read(spark, out, "sections").count()
    assert (last["phase"], last["documents_total"], last["documents_completed"], last["sections_total"], last["sections_completed"]) == ("completed", 6, 6, n, n)
    assert {r["doc_id"] for r in read(spark, out, "sections").collect()} >= {f"d{i}" for i in range(5, 10)}
    rows = log.rows("r").orderBy("seq").collect()
    assert all(r["sections_completed"] <= r["sections_total"] and r["documents_completed"] <= r["documents_total"] for r in rows)
    started = [r for r in rows if r["phase"] == "extracting"]
    assert any(r["sections_completed"] < r["sections_total"] for r in started) and any(r["sections_completed"] == r["sections_total"] for r in started)


def test_streams_tell_their_batches(spark, tmp_path):
    log = ProgressLog(spark, str(tmp_path / "log"))
    listener = StreamProgress(log)
    spark.streams.addListener(listener)
    try:
        spark.range(7).write.parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in")).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        run = str(stream.runId)
        stream.awaitTermination()
        for _ in range(100):
            if any(e["run"] == run and e["phase"] == "completed" for e in listener.events):
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert listener.flush() >= 2 and listener.flush() == 0
    rows = log.rows(run).collect()
    assert sum(r["documents_completed"] or 0 for r in rows) == 7 and log.latest().filter(f"run = '{run}'").first()["phase"] == "completed"
