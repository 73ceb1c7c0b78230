"""Sections to items by local rules: blocks, inline and delayed proofs, standalone proofs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lemmaflow.functions import patterns as R
from lemmaflow.functions import text as T

KEY = ["doc_id", "section_index"]


#: What items take along of their section.
CONTEXT = ["section_number", "chapter_number", "section", "chapter"]


def _parts(sections: DataFrame, *along: str) -> DataFrame:
    """A row a section, with what ``along`` names: its blocks that have lines, as structs of block, lines, named, number and word.

    Block n has the lines from the n-th item's to the next one's; block 0 stands before all. ``named``: the proof number of each line. Each line is looked at once.
    """
    look = lambda x: T.let(T.strip(x), lambda bare: F.struct(x.alias("line"), (T.matches(F.substring(bare, 1, 3), R.ITEM_BEGINS) & T.matches(bare, R.ITEM_START)).alias("starts"), proof_number(bare).alias("named")))
    rows = sections.select(*KEY, *along, F.transform(T.split_lines(F.col("text")), look).alias("looked"))
    starts = F.array_compact(F.transform("looked", lambda x, i: F.when(x["starts"], i)))
    rows = rows.withColumn("bounds", F.concat(F.array(F.lit(0)), starts, F.array(F.size("looked"))))
    at = lambda b: F.get("bounds", b)

    def block(b: Column) -> Column:
        own = F.slice("looked", at(b) + 1, at(b + 1) - at(b))
        some = lambda head, *groups: F.when(b > 0, F.coalesce(*(F.nullif(T.part(head, R.ITEM_START, g), F.lit("")) for g in groups), F.lit("")))
        return T.let(T.strip(F.get("looked", at(b))["line"]), lambda head: F.struct(b.cast("long").alias("block"), own["line"].alias("lines"), own["named"].alias("named"), some(head, 2, 4, 5).alias("number"), some(head, 1, 3, 6).alias("word")))

    some_lines = F.filter(F.sequence(F.lit(0), F.size("bounds") - 2), lambda b: at(b + 1) > at(b))
    return rows.select(*KEY, *along, F.transform(some_lines, block).alias("parts"))


def blocks(sections: DataFrame) -> DataFrame:
    """(doc_id, section_index, block, lines, number, word): a row a block, with its item's number and kind word."""
    # of a plain column Spark would infer a filter, for which it computes the blocks once more, below all steps
    return _parts(sections).select(*KEY, F.inline(F.filter("parts", lambda p: p["block"].isNotNull()))).drop("named")


def proof_number(line: Column) -> Column:
    """The number that a proof line names (empty if none); null for other lines."""
    x = T.strip(line)
    return F.when(T.matches(F.substring(x, 1, 5), R.PROOF_BEGINS), T.part(x, R.PROOF, 1))


def without_mark(proof: Column) -> Column:
    """A proof without its opening word, which only goes when one line of text at most follows it."""
    body = T.strip(F.regexp_replace(T.strip(proof), R.PROOF, "$2"))
    return T.strip(F.regexp_replace(body, R.CONSTRUCTION, "$1"))


def inline_proofs(items: DataFrame) -> DataFrame:
    """Adds content and proof to item blocks: the lines from the first proof or construction on, unless it names another item; up to a proof of another."""
    lines, number, first = F.col("lines"), F.col("number"), F.col("first")
    opens = F.transform(lines, lambda x, i: F.get("named", i).isNotNull() | T.matches(F.substring(F.ltrim(x, F.lit(T.SPACES)), 1, 13), R.CONSTRUCTION_BEGINS))
    out = items.withColumn("first", F.array_position(opens, True).cast("int"))
    foreign = F.coalesce((F.get("named", first - 1) != "") & (number != "") & (F.get("named", first - 1) != number), F.lit(False))
    tail = F.slice("lines", F.greatest(first, F.lit(1)), F.size("lines"))
    later = F.transform(F.slice("named", F.greatest(first, F.lit(1)), F.size("lines")), lambda x, i: (i > 0) & F.coalesce((x != "") & (x != number), F.lit(False)))
    out = out.withColumn("cut", F.array_position(later, True).cast("int"))
    proof = without_mark(F.array_join(F.when(F.col("cut") > 0, F.slice(tail, 1, F.col("cut") - 1)).otherwise(tail), "\n"))
    content = T.strip(F.array_join(F.when(first > 0, F.slice("lines", 1, first - 1)).otherwise(lines), "\n"))
    unmarked = T.let(content, lambda x: F.when(F.contains(x, F.lit("#")), T.strip(F.regexp_replace(x, r"(?dmU)^#{1,6}\s+", ""))).otherwise(x))
    return out.withColumns({"content": unmarked, "proof": F.when((first > 0) & ~foreign, F.nullif(proof, F.lit("")))}).drop("named", "first", "cut")


def _delayed_proofs(parts: DataFrame, once: bool) -> DataFrame:
    """Adds ``delayed`` to sections' blocks: a map from blocks to proofs that name an item of the section, for the last item of that number, joined by blank lines.

    ``once``: a proof within its own item's block is inline already and isn't attached again. Sorting brings together what belongs together, so that a section's work doesn't grow with its blocks times its proofs.
    """
    numbered = F.array_sort(F.filter(F.transform("parts", lambda p: F.struct(p["number"].alias("number"), p["block"].alias("block"))), lambda p: p["number"] != ""))
    last = T.let(numbered, lambda s: F.filter(s, lambda p, i: ~p["number"].eqNullSafe(F.get(s, i + 1)["number"])))

    def marked(p: Column) -> Column:
        rest = lambda i: T.strip(F.regexp_replace(T.strip(F.array_join(F.slice(p["lines"], i + 1, F.size(p["lines"])), "\n")), R.PROOF, "$2"))
        # an item's line is no proof
        of = F.filter(F.transform(p["named"], lambda n, i: F.when((n != "") & ((i > 0) | (p["block"] == 0)), F.struct(n.alias("number"), i.alias("i")))), lambda m: m.isNotNull())
        return F.transform(of, lambda m: F.struct(m["number"].alias("number"), p["block"].alias("from_block"), m["i"].alias("i"), rest(m["i"]).alias("text")))

    marks = F.flatten(F.transform("parts", marked))
    owned = lambda owners: F.transform(marks, lambda m: F.struct(F.element_at(owners, m["number"]).alias("owner"), m["from_block"].alias("from_block"), m["i"].alias("i"), m["text"].alias("text")))
    mine = lambda m: m["owner"].isNotNull() & (m["text"] != "") & ((m["owner"] != m["from_block"]) if once else F.lit(True))
    rows = parts.withColumn("placed", F.array_sort(F.filter(T.let(F.map_from_entries(last), owned), mine)))
    firsts = F.array_compact(F.transform("placed", lambda m, i: F.when(~m["owner"].eqNullSafe(F.get("placed", i - 1)["owner"]), i)))

    def joined(at: Column) -> Column:
        end = lambda j: F.coalesce(F.get(at, j + 1), F.size("placed"))
        return F.map_from_entries(F.transform(at, lambda s, j: F.struct(F.get("placed", s)["owner"], F.array_join(F.slice("placed", s + 1, end(j) - s)["text"], "\n\n"))))

    return rows.withColumn("delayed", T.let(firsts, joined)).drop("placed")


def proof_dependency(text: Column) -> Column:
    return F.when(T.matches(text, R.PROOF_OF), F.concat(F.initcap(T.part(text, R.PROOF_OF, 1)), F.lit(" "), T.part(text, R.PROOF_OF, 2)))


def standalone_heading() -> Column:
    heading = F.lower(F.concat_ws(" ", "source_heading", "section"))
    return F.contains(heading, F.lit("proof of")) | F.contains(heading, F.lit("证明"))


def standalone_proof() -> Column:
    """The content and dependencies of a section that is a proof as a whole, if it has no items; else null."""
    opening = F.exists(T.first_lines(F.col("text"), 5), lambda x: T.matches(T.strip(x), R.PROOF))
    depends = F.coalesce(proof_dependency(F.col("source_heading")), proof_dependency(F.col("section")))
    return F.when(standalone_heading() | opening, F.struct(T.strip(F.col("text")).alias("content"), F.array_compact(F.array(depends)).alias("dependencies")))


def local_items(sections: DataFrame, once: bool = True) -> DataFrame:
    """Items of all sections: doc_id, section_index, position, env, number_components, content, dependencies, proof, a label by position, and what CONTEXT names.

    All that an item needs is in its section's row, so nothing is moved, and sections are made once. A section without items that is a proof as a whole is one remark.
    """
    sections = sections.filter("doc_id is not null and section_index is not null").withColumn("whole", standalone_proof())
    parts = _delayed_proofs(_parts(sections, *CONTEXT, "whole"), once)
    names, texts = ("block", "lines", "named", "number", "word"), F.array().cast("array<string>")
    kind = "struct<content:string,dependencies:array<string>>"
    # each block takes its own proof along, not the section's
    own = T.let(F.col("delayed"), lambda d: F.transform(F.filter("parts", lambda p: p["block"] > 0), lambda p: F.struct(*(p[c].alias(c) for c in names), F.element_at(d, p["block"]).alias("delayed"), F.lit(None).cast(kind).alias("alone"))))
    alone = dict(zip(names, (F.lit(1).cast("long"), texts, texts, F.lit(""), F.lit("")), strict=True)) | {"delayed": F.lit(None).cast("string"), "alone": F.col("whole")}
    own = T.let(own, lambda found: F.when(F.size(found) > 0, found).when(F.col("whole.content") != "", F.array(F.struct(*(v.alias(n) for n, v in alone.items())))))
    proofs = inline_proofs(parts.select(*KEY, *CONTEXT, F.inline(own)))
    both = F.when(F.col("proof").isNotNull() & F.col("delayed").isNotNull(), T.strip(F.concat("proof", F.lit("\n\n"), "delayed"))).otherwise(F.coalesce("proof", "delayed"))
    # an item's content has its first line at least; a filter on it would compute it twice
    return proofs.withColumn("env", T.item_kind(F.col("word"))).select(
        *KEY, F.col("block").cast("int").alias("position"), "env", F.filter(F.split("number", r"\."), lambda x: x != "").alias("number_components"), F.coalesce("alone.content", "content").alias("content"), F.coalesce("alone.dependencies", texts).alias("dependencies"),
        both.alias("proof"), F.concat(T.lookup(F.col("env"), R.DISPLAY), F.lit(" "), "section_number", F.lit("-"), F.col("block").cast("string")).alias("label"), *CONTEXT,
    )
