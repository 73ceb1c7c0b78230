"""Items to the annotation document: typed items with issues, a quality summary and a document summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lemmaflow.functions import patterns as R
from lemmaflow.functions import text as T
from lemmaflow.functions import values as V
from lemmaflow.operators import jobs

ISSUES = "array<struct<severity:string,code:string,message:string>>"


def _issue(severity: str, code: str, message) -> Column:
    return F.struct(F.lit(severity).alias("severity"), F.lit(code).alias("code"), (F.lit(message) if isinstance(message, str) else message).alias("message"))


def annotated(items: DataFrame, together: bool = False) -> DataFrame:
    """Items as the annotation has them: item_id, order_index, label, type, statement, proof, context, dependencies (never resolved) and issues.

    Ids and order count through the whole document, as its list of items does, so that no two items of a document share an id.
    ``together``: a document's items are in one task already.
    """
    statement, label = F.coalesce("content", F.lit("")), F.coalesce("label", F.lit(""))
    item_id = F.format_string("item_%06d", F.col("global_index"))
    many = F.count(F.lit(1)).over(Window.partitionBy("doc_id", "raw"))
    # by document, as what comes after, so that items move once; where statements aren't asked for, they stay
    own = items.withColumns({"raw": label, "shown": F.when(label != "", label).otherwise(item_id), "blank": T.strip(statement) == ""})
    own = (own if together else own.repartition("doc_id")).withColumn("many", many)
    depends = F.filter(F.coalesce("dependencies", F.array().cast("array<string>")), lambda d: d != "")
    first = F.array_compact(F.array(
        F.when(F.col("blank"), _issue("error", "empty_statement", R.ISSUE_EMPTY)),
        F.when(T.strip(F.col("shown")) == "", _issue("warning", "missing_label", R.ISSUE_NO_LABEL)).when((F.col("raw") == F.col("shown")) & (F.col("many") > 1), _issue("warning", "duplicate_label", F.concat(F.lit(R.ISSUE_DUPLICATE), "shown"))),
    ))
    before, after = R.ISSUE_DEPENDENCY
    unresolved = F.transform(depends, lambda d: _issue("warning", "unresolved_dependency", F.concat(F.lit(before), d, F.lit(after))))
    targets = F.transform(depends, lambda d: F.struct(d.alias("label"), F.lit(None).cast("string").alias("target_id"), F.lit(False).alias("resolved")))
    context = F.struct(
        F.coalesce("chapter", F.lit("")).alias("chapter_title"), F.coalesce("chapter_number", F.lit("")).alias("chapter_number"), F.coalesce("section", F.lit("")).alias("section_title"),
        F.coalesce("section_number", F.lit("")).alias("section_number"), F.lit("").alias("subsection_title"), F.lit("").alias("subsection_number"),
    )
    return own.select(
        "doc_id", "global_index", item_id.alias("item_id"), F.col("global_index").alias("order_index"), F.col("shown").alias("label"), F.col("raw").alias("label_raw"),
        T.item_type(F.col("env")).alias("type"), "number_components", statement.alias("statement"), F.coalesce("proof", F.lit("")).alias("proof"), context.alias("context"),
        targets.alias("dependencies"), F.array_distinct(F.concat(first.cast(ISSUES), unresolved.cast(ISSUES))).alias("issues"), F.coalesce("env", F.lit("")).alias("raw_env"),
    )


def issues(annotated_: DataFrame) -> DataFrame:
    """(doc_id, item_id, global_index, place, severity, code, message): a row an issue."""
    return annotated_.select("doc_id", "item_id", "global_index", F.posexplode("issues").alias("place", "i")).select("doc_id", "item_id", "global_index", "place", "i.*")


def quality_issues(annotated_: DataFrame, documents: DataFrame, sections: DataFrame) -> DataFrame:
    """(doc_id, place, severity, code, message, item_id): the different issues of items and warnings of documents and sections (item_id is null), in this order.

    ``documents`` and ``sections``: reports with global_warnings and warnings. Equal ones count where they come first.
    """
    none, at = F.lit(None).cast("string"), lambda part, a, b: F.struct(F.lit(part).alias("part"), a.cast("long").alias("a"), b.cast("long").alias("b")).alias("at")
    own = issues(annotated_).select("doc_id", "severity", "code", "message", "item_id", at(0, F.col("global_index"), F.col("place")))
    said = lambda df, code, warnings, part, a: df.select("doc_id", F.lit("warning").alias("severity"), F.lit(code).alias("code"), a.alias("a"), F.posexplode(warnings).alias("b", "message"))
    whole = said(documents, "global_warning", "global_warnings", 1, F.lit(0)).select("doc_id", "severity", "code", "message", none.alias("item_id"), at(1, F.col("a"), F.col("b")))
    parts = said(sections, "section_warning", "warnings", 2, F.col("section_index")).select("doc_id", "severity", "code", "message", none.alias("item_id"), at(2, F.col("a"), F.col("b")))
    return own.unionByName(whole).unionByName(parts).groupBy("doc_id", "severity", "code", "message", "item_id").agg(F.min("at").alias("place")).select("doc_id", "place", "severity", "code", "message", "item_id")


def quality_summary(annotated_: DataFrame, documents: DataFrame, sections: DataFrame) -> DataFrame:
    """(doc_id, error_count, warning_count) over ``quality_issues``; a document without any has zeros."""
    once = quality_issues(annotated_, documents, sections)
    counts = once.groupBy("doc_id").agg(F.count_if(F.col("severity") == "error").alias("error_count"), F.count_if(F.col("severity") == "warning").alias("warning_count"))
    zero = F.lit(0).cast("long")
    return documents.select("doc_id").join(counts, "doc_id", "left").select("doc_id", F.coalesce("error_count", zero).alias("error_count"), F.coalesce("warning_count", zero).alias("warning_count"))


def chapters(annotated_: DataFrame) -> DataFrame:
    """(doc_id, place, number, title): different chapters in the order in which items show them."""
    rows = annotated_.select("doc_id", "global_index", F.col("context.chapter_number").alias("number"), F.col("context.chapter_title").alias("title")).filter("number <> '' or title <> ''")
    first = rows.groupBy("doc_id", "number", "title").agg(F.min("global_index").alias("first"))
    return first.withColumn("place", F.row_number().over(Window.partitionBy("doc_id").orderBy("first"))).select("doc_id", "place", "number", "title")


def document_titles(annotated_: DataFrame) -> DataFrame:
    """(doc_id, title): the first chapter title that an item has."""
    title = F.col("context.chapter_title")
    return annotated_.groupBy("doc_id").agg(F.coalesce(F.min_by(title, F.when(title != "", F.col("global_index"))), F.lit("")).alias("title"))


def _listed(rows: DataFrame, order: str, value: Column, name: str) -> DataFrame:
    """(doc_id, ``name``): each document's values as an array, by ``order``."""
    return rows.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct(order, value.alias("value")))), lambda x: x["value"]).alias(name))


def assembled(annotated_: DataFrame, documents: DataFrame, sections: DataFrame, sources: DataFrame) -> DataFrame:
    """The annotation document of each source, a row a document: doc_id, schema_version, source, document, items, quality; nested as its JSON.

    ``documents`` and ``sections``: reports, as ``quality_issues`` takes them. ``sources``: doc_id, source_name and, if it has them, source_type (else markdown) and original_mime_type (else by
    the name). A source without items has empty lists; one without an id (null), or named twice in ``sources``, isn't a document of its own: null ids go, of equal ids one row stays.
    Everything is grouped by document, whose items are parts of one text; nothing else is brought together.
    """
    texts, boxes = F.array().cast("array<string>"), F.array().cast("array<struct<page:bigint,block_id:string,bbox:array<double>>>")
    refs = F.struct(F.array().cast("array<bigint>").alias("pages"), texts.alias("block_ids"), texts.alias("span_ids"), boxes.alias("bbox_refs"))
    assets = F.struct(*(F.lit("").alias(n) for n in ("image_path", "caption", "table_markdown")))
    item = F.struct(
        F.col("item_id").alias("id"), "order_index", "label", "label_raw", "type", "number_components", "statement", "proof", "context", "dependencies", refs.alias("source_refs"), assets.alias("assets"),
        F.struct(F.lit(False).alias("modified"), "issues").alias("audit"), F.struct(F.col("raw_env").alias("env")).alias("raw"),
    )
    items = _listed(annotated_, "global_index", item, "items")
    once = quality_issues(annotated_, documents, sections)
    found = _listed(once, "place", F.struct("severity", "code", "message", "item_id"), "issues")
    own_chapters = _listed(chapters(annotated_), "place", F.struct("number", "title"), "chapters")
    optional = lambda n: F.col(n).cast("string") if n in sources.columns else F.lit(None).cast("string")
    name, kind = F.coalesce("source_name", F.lit("input")), F.coalesce(optional("source_type"), F.lit("markdown"))
    source = F.struct(name.alias("filename"), kind.alias("source_type"), F.coalesce(F.nullif(optional("original_mime_type"), F.lit("")), T.mime_type(name, kind)).alias("original_mime_type"), F.lit(None).cast("string").alias("content_hash"))
    rows = sources.filter("doc_id is not null").select("doc_id", source.alias("source")).groupBy("doc_id").agg(F.min("source").alias("source"))
    for part in (items, found, own_chapters, document_titles(annotated_)):
        rows = rows.join(part, "doc_id", "left")
    listed = lambda n, part: F.coalesce(n, F.array().cast(part.schema[n].dataType)).alias(n)
    rows = rows.select("doc_id", "source", "title", listed("items", items), listed("issues", found), listed("chapters", own_chapters))
    counted = lambda severity: F.size(F.filter("issues", lambda x: x["severity"] == severity)).alias(f"{severity}_count")
    return rows.select(
        "doc_id", F.lit(R.SCHEMA_VERSION).alias("schema_version"), "source", F.struct(F.coalesce("title", F.lit("")).alias("title"), F.lit("").alias("language"), "chapters").alias("document"), "items",
        F.struct(counted("error"), counted("warning"), "issues").alias("quality"),
    )


def fields(payload: Column) -> Column:
    """The annotation's fields of an item's JSON, in whatever form it has them: statement, number_components, context, dependencies, source_refs, assets and modified."""
    v = V.parsed(payload)
    statement = F.when(V.field(v, "statement").isNotNull(), V.nullable_text(v, "statement")).otherwise(V.nullable_text(v, "content"))
    c = V.field(v, "context")
    context = F.struct(
        V.first_text(c, "chapter_title", "chapter").alias("chapter_title"), V.first_text(c, "chapter_number").alias("chapter_number"), V.first_text(c, "section_title", "section").alias("section_title"),
        V.first_text(c, "section_number").alias("section_number"), V.first_text(c, "subsection_title").alias("subsection_title"), V.first_text(c, "subsection_number").alias("subsection_number"),
    )
    given = V.field(v, "dependencies")
    depends = F.when(given.isNull() | F.is_variant_null(given), V.field(v, "references")).otherwise(given)

    def dependency(d: Column) -> Column:
        target, resolved = V.nullable_text(d, "target_id"), F.try_variant_get(d, "$.resolved", "boolean")
        own = F.struct(V.first_text(d, "label", "target_label", "name").alias("label"), target.alias("target_id"), F.coalesce(resolved, target.isNotNull()).alias("resolved"))
        return F.when(V.is_object(d), own).otherwise(F.struct(V.text(d).alias("label"), F.lit(None).cast("string").alias("target_id"), F.lit(False).alias("resolved")))

    targets = F.filter(F.transform(V.listed(depends), dependency), lambda d: d["label"] != "")
    open_ = F.transform(V.text_list(V.field(v, "unresolved_references")), lambda x: F.struct(x.alias("label"), F.lit(None).cast("string").alias("target_id"), F.lit(False).alias("resolved")))
    listed = F.when(V.listed(depends).isNotNull(), F.concat(targets, open_)).otherwise(F.array().cast("array<struct<label:string,target_id:string,resolved:boolean>>"))
    source = V.field(v, "source")
    either = lambda n: F.when(V.counts(V.field(source, n)), V.field(source, n)).otherwise(V.field(v, n))
    pages = F.when(V.field(v, "pages").isNotNull(), V.field(v, "pages")).otherwise(V.field(source, "pages"))
    page = F.array_compact(F.array(F.try_variant_get(v, "$.page", "bigint")))

    def box(b: Column) -> Column:
        return F.struct(F.coalesce(F.try_variant_get(b, "$.page", "bigint"), F.lit(0)).alias("page"), V.first_text(b, "block_id").alias("block_id"), F.try_variant_get(b, "$.bbox", "array<double>").alias("bbox"))

    boxes = F.filter(F.transform(F.filter(V.listed(either("bbox_refs")), V.is_object), box), lambda b: F.size(b["bbox"]) == 4)
    refs = F.struct(
        F.when(pages.isNull() | F.is_variant_null(pages), page).otherwise(V.number_list(pages)).alias("pages"), V.text_list(either("block_ids")).alias("block_ids"), V.text_list(either("span_ids")).alias("span_ids"),
        F.coalesce(boxes, F.array().cast("array<struct<page:bigint,block_id:string,bbox:array<double>>>")).alias("bbox_refs"),
    )
    image = V.first_text(v, "image_path")
    assets = F.struct(F.when(image != "", image).otherwise(V.first_text(V.field(v, "image"), "path")).alias("image_path"), V.first_text(v, "caption").alias("caption"), V.first_text(v, "table_markdown").alias("table_markdown"))
    modified = V.field(v, "modified")
    return F.struct(
        F.coalesce(statement, F.lit("")).alias("statement"), V.text_list(V.field(v, "number_components")).alias("number_components"), context.alias("context"), listed.alias("dependencies"), refs.alias("source_refs"), assets.alias("assets"),
        F.when(V.is_object(modified), V.counts(V.field(modified, "any"))).otherwise(V.counts(modified)).alias("modified"),
    )


def payload_error(payload: Column, source_type: Column | None = None) -> Column:
    """The first thing that is wrong with a submitted annotation (JSON), else null. ``source_type``: what the payload's own, if it has one, must be."""
    v = V.parsed(payload)
    source, items, quality = V.field(v, "source"), V.listed(V.field(v, "items")), V.field(v, "quality")
    ids = F.transform(items, lambda i: F.when(V.is_text(V.field(i, "id")), F.nullif(V.text(V.field(i, "id")), F.lit(""))))
    # places of repeated ids are looked for only where there are some
    repeats = F.size(F.array_distinct(ids)) < F.size(ids)
    at = lambda i, what: F.concat(F.lit(R.BAD_ITEM), (i + 1).cast("string"), F.lit(what))
    first = lambda x, i: F.when(~V.is_object(x), at(i, R.BAD_ITEM_OBJECT)).when(F.get(ids, i).isNull(), at(i, R.BAD_ITEM_ID)).when(repeats & (F.array_position(ids, F.get(ids, i)) <= i), F.concat(F.lit(R.BAD_DUPLICATE), F.get(ids, i)))
    own_type = V.field(source, "source_type")
    other = F.lit(False) if source_type is None else own_type.isNotNull() & ~F.is_variant_null(own_type) & ~V.text(own_type).eqNullSafe(source_type)
    version = V.field(v, "schema_version")
    return (
        F.when(~V.is_object(v), R.BAD_OBJECT).when(~F.coalesce(V.is_text(version) & (V.text(version) == R.SCHEMA_VERSION), F.lit(False)), R.BAD_VERSION).when(~V.is_object(source), R.BAD_SOURCE).when(other, R.BAD_SOURCE_TYPE)
        .when(items.isNull(), R.BAD_ITEMS).otherwise(F.coalesce(F.get(F.array_compact(F.transform(items, first)), F.lit(0)), F.when(quality.isNotNull() & ~F.is_variant_null(quality) & ~V.is_object(quality), R.BAD_QUALITY)))
    )


def saved(stored: DataFrame, submitted: DataFrame) -> DataFrame:
    """Annotation documents (id, payload, updated_at) after submissions of the same form: of the valid ones and what was stored, each id's latest, whole.

    Adds item_count. Of equal times the greater payload wins.
    """
    good = submitted.select("id", "payload", "updated_at").filter(payload_error(F.col("payload")).isNull())
    last = jobs.latest(stored.select("id", "payload", "updated_at").unionByName(good), "id", F.col("updated_at"), F.col("payload"))
    return last.withColumn("item_count", F.coalesce(F.size(V.listed(V.field(V.parsed(F.col("payload")), "items"))), F.lit(0)))
