"""Raw items to items: kinds, numbers, labels, rewritten dependencies and running numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lemmaflow.functions import patterns as R
from lemmaflow.functions import text as T
from lemmaflow.operators.extract import CONTEXT

KEY = ["doc_id", "section_index"]


def normalized(raw: DataFrame, sections: DataFrame, together: bool = False) -> DataFrame:
    """Items with canonical env and label; blank ones go, after they have been counted.

    ``raw``: doc_id, section_index, position, env, label, number_components, content, dependencies, proof.
    A numbered item's label is its kind and number; others count up within their section. Dependencies on raw labels of kept
    items follow the new labels (of equal raw labels, the last). ``item_index`` keeps gaps, ``global_index`` has none.
    Where raw items have their section's columns already, as local ones do, sections aren't joined; items move once, by document.
    ``together``: a document's items are in one task already, as those of documents that have just been grouped are, so that they needn't move.
    """
    trimmed = lambda c: F.filter(F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x: T.strip(x)), lambda x: x != "")
    own = raw if set(CONTEXT) <= set(raw.columns) else raw.join(sections.select(*KEY, *CONTEXT), KEY)
    own = own.withColumns({"env": T.normal_kind(F.col("env")), "raw_label": T.strip(F.coalesce("label", F.lit(""))), "content": T.strip(F.coalesce("content", F.lit("")))})
    given = trimmed(F.col("number_components"))
    own = own.withColumns({"first": T.first_line(F.col("content")), "given": given, "blank": F.col("content") == ""})
    own = own.withColumn("number_components", F.when(F.size("given") > 0, F.col("given")).otherwise(T.inferred_number(F.col("first"), F.col("env")))).drop("first", "given")
    # all that is read of contents is known by now; who doesn't ask for them doesn't move them
    own = own if together else own.repartition("doc_id")
    section = Window.partitionBy(*KEY).orderBy("position")
    whole = section.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bare = (F.size("number_components") == 0).cast("int")
    prefix = F.coalesce(F.nullif(T.strip(F.coalesce("section_number", F.lit(""))), F.lit("")), F.nullif(T.strip(F.coalesce("chapter_number", F.lit(""))), F.lit("")), F.lit("section"))
    name = T.lookup(F.col("env"), R.DISPLAY)
    own = own.withColumns({"item_index": F.row_number().over(section), "extra": F.sum(bare).over(section.rowsBetween(Window.unboundedPreceding, Window.currentRow)), "dependencies": trimmed(F.col("dependencies"))})
    label = F.when(F.size("number_components") > 0, F.concat(name, F.lit(" "), F.array_join("number_components", "."))).otherwise(F.concat(name, F.lit(" "), prefix, F.lit("-extra-"), F.col("extra").cast("string")))
    kept = own.withColumn("label", label).filter("not blank")
    # names are brought together only in sections where an item depends on something
    kept = kept.withColumn("asked", F.bool_or(F.size("dependencies") > 0).over(whole))
    renamed = F.col("asked") & (F.col("raw_label") != "") & (F.col("raw_label") != F.col("label"))
    kept = kept.withColumn("names", F.collect_list(F.when(renamed, F.struct("raw_label", "label"))).over(whole))
    named = lambda d: F.try_element_at(F.filter("names", lambda n: n["raw_label"] == d), F.lit(-1))["label"]
    follows = F.when(F.size("names") > 0, F.transform("dependencies", lambda d: F.coalesce(named(d), d))).otherwise(F.col("dependencies"))
    everywhere = Window.partitionBy("doc_id").orderBy("section_index", "position", "item_index")
    return kept.select(*KEY, "item_index", F.row_number().over(everywhere).alias("global_index"), "label", "env", "number_components", "section_number", "section", "chapter", "chapter_number", "content", follows.alias("dependencies"), F.nullif(T.strip(F.col("proof")), F.lit("")).alias("proof"))
