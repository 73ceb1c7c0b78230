"""The driver contract: queries with oracles have results, and the training-data subpackage can go."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

REPO = Path(__file__).resolve().parent.parent
DATA = Path("/root/testdata/sf0.001")
CHEAP = ["lines_explode", "heading_scan", "chapter_carry_forward", "plan_clip_overlaps", "span_resolve", "source_search", "audit_report", "patch_candidates", "span_nth_occurrence", "usage_by_phase", "jobs_latest_state", "retention_expired", "ingest_pending", "pages_to_markdown", "source_backed", "structure_candidates", "planner_faults", "planner_plans", "plan_matter", "plan_warnings", "page_ranges", "collection_plan", "job_log_states",
         "annotation_documents", "span_items", "repaired_items", "declared_labels", "annotation_fields", "annotations_saved", "usage_merged", "planned_sections"]


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
@pytest.mark.parametrize("name", CHEAP)
def test_query_agrees_with_its_oracle(spark, name):
    from lemmaflow.plans.queries import oracle_sql, queries

    con = duckdb.connect()
    for f in DATA.iterdir():
        con.execute(f"create view {f.name.split('.')[0]} as select * from '{f}'")
    got = queries()[name](spark, str(DATA))
    names = sorted(got.columns)
    want = con.execute(f"select {', '.join(names)} from ({oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, (tuple(r) for r in got.select(*names).collect()))) == sorted(map(repr, want)) and want


def test_every_oracle_has_a_query():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_works_without_the_training_data_package(tmp_path):
    import shutil

    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    shutil.copytree(REPO / "lemmaflow", tmp_path / "lemmaflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'section_item_counts' in q and not any(k.startswith('op') for k in q) and set(e.oracle_sql()) <= set(q)"
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path).returncode == 0
