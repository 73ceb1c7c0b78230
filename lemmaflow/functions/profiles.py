"""Which prompt profile a section asks for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lemmaflow.functions import patterns as R

# ---- fixed values
CHINESE_MARKS = ["定义", "定理", "命题", "引理", "推论", "证明", "注记"]
PAPER_MARKS = ["abstract", "introduction", "prior work", "our contributions", "computational results", "conclusion", "proof of theorem", "algorithm ", "proposition ", "arxiv"]
PAPER_TITLES = ["problem statement", "prior work", "our contributions", "conclusion"]
PROFILES = ["textbook", "paper", "chinese_math"]


def _any(x: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(x, F.lit(w))
    return out


def profile(requested: str = "auto") -> Column:
    """Of a row with chapter, section, section_number, chapter_number, source_heading and text; the first 4000 characters decide, as the profile asks for.

    ``requested``: a profile's name in any case, or auto.
    """
    requested = requested.strip().lower()
    if requested != "auto":
        return F.lit(requested if requested in PROFILES else "textbook")
    text = F.concat_ws("\n", "chapter", "section", "source_heading", F.substring("text", 1, 4000))
    chinese = (F.regexp_count(text, F.lit(R.CJK)) >= 20) | _any(text, CHINESE_MARKS)
    numbered = (F.coalesce("chapter_number", F.lit("")) == "") & F.rlike("section_number", F.lit(r"^(?:\d+(?:\.\d+)*|[A-Z])$"))
    paper = numbered | _any(F.lower(text), PAPER_MARKS) | _any(F.lower(F.col("section")), PAPER_TITLES)
    return F.when(chinese, "chinese_math").when(paper, "paper").otherwise("textbook")
