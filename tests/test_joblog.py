"""The job log against a replay, page ranges against recursion, collection both ways, and broken archives."""

from __future__ import annotations

import io
import random
import zipfile
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from lemmaflow.operators import joblog
from lemmaflow.sources import readers

START = datetime(2024, 1, 1)


def replay(events):
    jobs, refused = {}, {}
    for e in sorted(events, key=lambda e: (e[0], e[1])):
        i, seq, at, kind, status, phase, total, completed, error, result = e
        j = jobs.get(i)
        s = j["status"] if j else "none"
        new = {"create": {"none": "queued"}, "complete": {"running": "succeeded"}, "resume": {"failed": "queued"}, "delete": {x: "none" for x in ("queued", "running", "failed", "succeeded")}}.get(kind, {}).get(s)
        if kind == "status":
            new = {"running": {"queued": "running"}, "failed": {"queued": "failed", "running": "failed"}, "queued": {"running": "queued", "queued": "queued"}}.get(status, {}).get(s)
        if kind in ("progress", "access"):
            if j and kind == "progress":
                j |= {"total": total, "completed": completed, "updated": max(j["updated"], at)}
                if s == "running":
                    j["shown"] = phase
            elif j:
                j |= {"accessed": at, "updated": max(j["updated"], at)}
        elif new is None:
            refused[i] = refused.get(i, 0) + 1
        elif kind == "delete":
            jobs[i] = None
        else:
            if kind == "create":
                j = jobs[i] = {"total": None, "completed": 0, "result": None, "created": at, "accessed": None, "updated": at}
            j |= {"status": new, "shown": {"create": "queued", "complete": "completed", "resume": "resuming"}.get(kind, phase), "updated": max(j["updated"], at), "error": error if kind == "status" else None}
            if kind == "complete":
                j["result"] = result
    return {i: (j["status"], j["total"], j["completed"], j["error"], j["result"], j["created"], j["accessed"], refused.get(i, 0)) for i, j in jobs.items() if j}


def rows_of(df):
    return {r["id"]: (r["status"], r["sections_total"], r["sections_completed"], r["error"], r["result"], r["created_at"], r["last_accessed_at"], r["n_refused"]) for r in df.collect()}


def some_events(seed, jobs=40):
    r, out = random.Random(seed), []
    for i in range(jobs):
        for seq in range(r.randrange(1, 14)):
            kind = "create" if seq == 0 and r.random() < 0.9 else r.choice(["status"] * 5 + ["progress"] * 3 + ["access", "complete", "resume", "delete", "create"])
            out.append((f"j{i}", seq, START + timedelta(minutes=seq), kind, r.choice(["running", "running", "failed", "queued", "odd"]), f"p{seq}", seq * 2, seq, r.choice([None, "e"]), f"r{seq}"))
    return out


def test_states_are_those_of_a_replay(spark):
    for seed in range(3):
        events = some_events(seed)
        assert rows_of(joblog.states(spark.createDataFrame(events, joblog.EVENT).repartition(3))) == replay(events)


def test_a_snapshot_and_its_tail_give_the_same(spark, tmp_path):
    events = some_events(7)
    log = joblog.JobLog(spark, str(tmp_path / "log"))
    for k in range(3):
        log.append(spark.createDataFrame([e for e in events if e[1] // 4 == k], joblog.EVENT))
        if k < 2:
            log.compact()
    log.append(spark.createDataFrame([e for e in events if e[1] >= 12], joblog.EVENT))
    want = replay(events)
    got = rows_of(log.states())
    # a job that is gone at a snapshot forgets what was refused
    assert {i: v[:-1] for i, v in got.items()} == {i: v[:-1] for i, v in want.items()}
    running = {i for i, v in want.items() if v[0] == "running"}
    waits = [r["id"] for r in log.recover(F.lit("2024-02-01 00:00:00")).collect()]
    assert set(waits) == running | {i for i, v in want.items() if v[0] == "queued"}
    after = rows_of(log.states())
    assert {i for i, v in after.items() if v[0] == "running"} == set() and all(after[i][0] == "queued" for i in running)


def test_phases_have_their_prefix(spark):
    at = START
    events = [("a", 0, at, "create", None, None, None, None, None, None), ("a", 1, at, "status", "running", "extract", None, None, None, None), ("b", 0, at, "create", None, None, None, None, None, None), ("b", 1, at, "status", "running", "x", None, None, None, None), ("b", 2, at, "progress", None, "audit", 3, 1, None, None)]
    got = {r["id"]: r["phase"] for r in joblog.states(spark.createDataFrame(events, joblog.EVENT), prefix="md2json_").collect()}
    assert got == {"a": "md2json_extract", "b": "md2json_audit"}


def test_page_ranges_halve_what_is_too_large(spark):
    r = random.Random(3)
    docs = {d: [r.choice([5, 10, 40, 200]) for _ in range(n)] for d, n in enumerate((1, 2, 7, 8, 9, 40, 33, 16))}

    def cut(sizes, a, b, most):
        if b - a > most:
            return cut(sizes, a, a + most, most) + cut(sizes, a + most, b, most)
        if sum(sizes[a:b]) + 3 <= 100 or b - a == 1:
            return [(a, b, sum(sizes[a:b]) + 3)]
        m = a + max(1, (b - a) // 2)
        return cut(sizes, a, m, most) + cut(sizes, m, b, most)

    pages = spark.createDataFrame([(d, i, s) for d, p in docs.items() for i, s in enumerate(p)], "doc_id int, page int, bytes long")
    for most in (1, 2, 7, 8, 100):
        got = {}
        for x in sorted(joblog.page_ranges(pages, most, 100, overhead=3).collect(), key=lambda x: (x["doc_id"], x["chunk"])):
            got.setdefault(x["doc_id"], []).append((x["start_page"], x["end_page"], x["bytes"]))
            assert (x["error"] is not None) == (x["bytes"] > 100) and (x["error"] is None or x["error"].endswith(f"page={x['start_page'] + 1} bytes={x['bytes']}"))
        assert got == {d: cut(p, 0, len(p), most) for d, p in docs.items()}, most


def test_collection_plans_reports_and_deletes(spark, tmp_path):
    now = F.lit("2024-07-01 00:00:00").cast("timestamp")
    for n in ("a", "b", "c", "d", "e", "dbg"):
        (tmp_path / n).mkdir()
        (tmp_path / n / "x.json").write_text("{}")
    path = lambda n: f"file://{tmp_path / n}"
    jobs = [("markdown", "a", "succeeded", "2024-06-01", path("a")), ("full", "b", "succeeded", "2024-06-01", path("b")), ("full", "c", "failed", "2024-06-25", path("c")), ("markdown", "d", "running", "2020-01-01", path("d")), ("full", "e", "succeeded", "2023-01-01", path("e")), ("markdown", "gone", "failed", "2024-01-01", path("gone"))]
    jobs = spark.createDataFrame(jobs, "kind string, id string, status string, updated_at string, path string").withColumn("updated_at", F.to_timestamp("updated_at"))
    saved = spark.createDataFrame([("b",), ("e",), ("b",)], "id string")
    debug = spark.createDataFrame([(path("dbg"), "2024-06-29"), (path("a"), "2024-06-30 12:00:00")], "path string, modified_at string").withColumn("modified_at", F.to_timestamp("modified_at"))
    plan = joblog.collection_plan(jobs, saved, debug, now)
    assert {(r["kind"], r["id"], r["reason"]) for r in plan.collect()} == {("markdown", "a", "succeeded, older than 14 days"), ("full", "e", "succeeded with annotation, older than 180 days"), ("markdown", "gone", "failed, older than 7 days"), ("debug", path("dbg"), "older than 1 days")}
    assert {r["kind"]: r["n"] for r in joblog.collection_report(plan).collect()} == {"markdown": 2, "full": 1, "annotation": 0, "debug": 1}
    assert not any(r["deleted"] for r in joblog.collected(plan, dry_run=True).collect()) and len(list(tmp_path.iterdir())) == 6  # a dry run deletes nothing
    assert all(r["deleted"] for r in joblog.collected(plan).collect()) and sorted(p.name for p in tmp_path.iterdir()) == ["b", "c", "d"]


def test_broken_archives_are_rows(spark):
    def packed(*members, mode=zipfile.ZIP_DEFLATED):
        f = io.BytesIO()
        with zipfile.ZipFile(f, "w", mode) as z:
            for n, d in members:
                z.writestr(n, d)
        return f.getvalue()

    good = packed(("x/deep.md", "deep"), ("top.MD", "é"))
    broken = bytearray(packed(("a.md", "some text " * 50), mode=zipfile.ZIP_STORED))
    broken[45] ^= 0xFF
    cases = {"good": good, "null": None, "empty": b"", "noise": b"PK\x03\x04 no archive", "cut": good[: len(good) // 2], "crc": bytes(broken), "none": packed(("a.txt", "x")), "bytes": packed(("a.md", b"\xff\xfe")), "large": packed(("a.md", "x" * 200))}
    rows = spark.createDataFrame(list(cases.items()), "path string, content binary").repartition(3)
    got = {r["path"]: (r["markdown"], r["error"] and r["error"].split(":")[0]) for r in readers.archive_markdown(rows, most=600).collect()}
    assert got == {"good": ("é", None), "null": (None, "no content"), "none": (None, None), "bytes": (None, "not UTF-8"), "large": ("x" * 200, None)} | {k: (None, "broken archive") for k in ("empty", "noise", "cut", "crc")}
    assert {r["path"]: r["error"] for r in readers.archive_markdown(rows, most=100).collect()}["large"] == "too large"
