"""One conversion from documents to all artefacts: sections, items, reports, audits, index and summary, each a table with a row a document or section."""

from __future__ import annotations

from collections.abc import Iterable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lemmaflow.operators import annotate, models, normalize, quality, split, structure
from lemmaflow.plans.progress import ProgressLog, Report, staged_count
from lemmaflow.scratch import scratch_dir, staged
from lemmaflow.sources import store, writers

RANGES = "array<struct<start_line:int,end_line:int>>"


def plan_heads(plans: DataFrame, heads: DataFrame | None) -> DataFrame:
    """(doc_id, front_matter_ranges, back_matter_ranges, warnings) of every document with a plan: as given, else without any."""
    names = {"front_matter_ranges": RANGES, "back_matter_ranges": RANGES, "warnings": "array<string>"}
    if heads is None:
        return plans.select("doc_id").distinct().select("doc_id", *(F.lit(None).cast(k).alias(n) for n, k in names.items()))
    return heads.select("doc_id", *(F.col(n).cast(k).alias(n) if n in heads.columns else F.lit(None).cast(k).alias(n) for n, k in names.items()))


def artefacts(
    documents: DataFrame, *, plans: DataFrame | None = None, heads: DataFrame | None = None, audits: DataFrame | None = None, repaired: DataFrame | None = None, usage: DataFrame | None = None, progress: Report | None = None,
    **extraction,
) -> dict[str, DataFrame]:
    """The artefacts of documents (doc_id, source_name, text), by name.

    ``plans``: planned sections for some documents, as ``structure.planned_sections`` takes them, and ``heads``: the rest of their plans (front_matter_ranges, back_matter_ranges,
    warnings; what isn't there is none); a document in ``heads`` alone has a plan without sections. The others keep the splitter's. ``audits``: as
    ``writers.audit_markdown`` takes them; ``repaired``: items that replace the extracted ones of their sections; ``usage``: (doc_id, usage_json);
    ``progress`` is told the number of sections before and after their extraction; ``extraction``: what ``models.extracted`` takes (a model's client, its store of answers); without it the local rules extract.
    """
    tell = progress or (lambda event: None)
    # lines move to their headings once for all three
    found, front, back = split.parts(staged(split.outlined(documents), "outlined"))
    hard, n = staged_count(found, "sections")
    sections, warnings = hard, staged(split.split_warnings(hard), "warnings")
    front, back = staged(front, "front"), staged(back, "back")
    out = {}
    if plans is not None:
        heads = staged(plan_heads(plans, heads), "heads")
        planned = structure.planned_sections(plans, documents).withColumns({"synthetic": F.lit(False), "lone": F.lit(False)})
        sections, n = staged_count(hard.join(plans.select("doc_id").distinct(), "doc_id", "left_anti").unionByName(planned), "sections")
        said = structure.plan_warnings(heads, plans, documents, warnings)
        warnings = staged(warnings.join(heads.select("doc_id"), "doc_id", "left_anti").unionByName(said), "warnings")
        whole = heads.join(plans.select("doc_id").distinct(), "doc_id", "left_semi")
        matter = staged(structure.plan_matter(whole, sections, documents), "matter")
        own = lambda df, name: df.join(matter.select("doc_id"), "doc_id", "left_anti").unionByName(matter.filter(F.col(name) != "").select("doc_id", name))
        front, back = own(front, "front_matter"), own(back, "back_matter")
        out["plan"] = writers.plans_json(whole, plans)
    tell({"phase": "extracting", "sections_total": n, "sections_completed": 0})
    initial = staged(normalize.normalized(models.extracted(sections, **extraction), sections), "items")
    tell({"phase": "extracting", "sections_total": n, "sections_completed": n})
    items = initial
    if repaired is not None:
        key = ["doc_id", "section_index"]
        raw = initial.join(repaired.select(*key).distinct(), key, "left_anti").withColumn("position", F.col("item_index")).select(*key, "position", "env", "label", "number_components", "content", "dependencies", "proof")
        items = staged(normalize.normalized(raw.unionByName(repaired.select(raw.columns)), sections), "items")
    reports = staged(quality.section_reports(sections, items), "reports")
    whole = staged(quality.document_reports(sections, items, warnings), "documents")
    out |= {
        "items": writers.items_json(items), "section_items": writers.section_items_json(items, sections), "sections": sections.select("doc_id", "section_index", F.concat(F.regexp_replace("text", r"(?U)\s+\z", ""), F.lit("\n")).alias("markdown")),
        "structure": writers.structure_index(sections, reports), "index": writers.index_markdown(reports, documents), "quality": writers.quality_markdown(whole, reports), "quality_json": writers.quality_json(whole, reports),
        "candidates": writers.candidates_json(structure.candidates(split.lines(documents)), plans), "summary": writers.summary_json(documents, sections, whole, warnings, front, back, usage, audits is not None),
        "front_matter": front.select("doc_id", F.concat("front_matter", F.lit("\n")).alias("markdown")), "back_matter": back.select("doc_id", F.concat("back_matter", F.lit("\n")).alias("markdown")),
    }
    out["annotation"] = writers.annotation_json(annotate.assembled(annotate.annotated(items), whole, reports, documents))
    if repaired is not None:
        out["initial_items"] = writers.section_items_json(initial, sections)
    if audits is not None:
        out |= {"audits": writers.audit_markdown(sections, audits), "patches": writers.patch_candidates(sections, audits), "section_audits": writers.section_audits(audits)}
    return out


def convert(documents: DataFrame, folder: str, *, blocks: int = 1, progress: ProgressLog | None = None, run: str | None = None, **settings) -> list[str]:
    """Write the artefacts of documents to the store ``folder``: all that earlier conversions of these documents left is superseded, that of other documents stays. The names of the tables.

    ``blocks``: that many parts of the documents, by hash of doc_id, are converted and committed one after the other. Each is a whole job over its documents, so that there should be few
    and large ones. ``progress`` gets the counts while they go on: all documents, those of committed blocks, and the sections that have been found and extracted so far; sections_total
    grows with the blocks. With ``run``, a conversion that was cut off goes on where it was: blocks that its log has as committed are not done again, so the documents, the settings and ``blocks`` must be the same.
    A block that was committed but not logged is converted again, with the same result.
    """
    spark = documents.sparkSession
    path = scratch_dir(spark, "source")
    part = F.coalesce(store.bucket(F.col("doc_id"), blocks), F.lit(0)).alias("part")
    documents.select("doc_id", "source_name", "text", part).write.partitionBy("part").parquet(path)
    source = spark.read.schema(documents.select("doc_id", "source_name", "text", part).schema).parquet(path)
    run = run or uuid4().hex
    report = progress.reporter(run) if progress else lambda event: None
    finished = {c["block"]: c for c in progress.committed(run)} if progress else {}
    done, names = {"documents_total": source.count(), "documents_completed": sum(c["documents_completed"] for c in finished.values()), "sections_total": sum(c["sections_completed"] for c in finished.values())}, set()
    done["sections_completed"] = done["sections_total"]
    for block in (b for b in range(blocks) if b not in finished):
        mine = source.filter(F.col("part") == block).drop("part")
        last = {"sections_total": 0}

        def tell(event: dict, last: dict = last) -> None:
            last.update(event)
            report({**done, **event, **{k: done[k] + event[k] for k in ("sections_total", "sections_completed")}})

        own = {k: v.filter(F.coalesce(store.bucket(F.col("doc_id"), blocks), F.lit(0)) == block) if isinstance(v, DataFrame) and "doc_id" in v.columns else v for k, v in settings.items()}
        found = artefacts(mine, progress=tell, **own)
        store.commit(folder, mine.select("doc_id"), found)
        names |= set(found)
        n_documents = mine.count()
        report({"phase": "committed", "block": block, "documents_total": done["documents_total"], "documents_completed": n_documents, "sections_total": last["sections_total"], "sections_completed": last["sections_total"]})
        done["documents_completed"] += n_documents
        done["sections_total"] = done["sections_completed"] = done["sections_total"] + last["sections_total"]
    report({"phase": "completed", **done})
    return sorted(names)


def read(spark: SparkSession, folder: str, name: str, documents: Iterable[str] | None = None) -> DataFrame:
    """An artefact of all documents, or of some, as their last conversion left it."""
    return store.read(spark, folder, name, documents)
