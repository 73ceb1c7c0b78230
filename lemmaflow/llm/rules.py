"""Quality rules as a bitmask ledger, with DataFrame functions only.

Every rule is evaluated once for a document. The ledger, a table, keeps what was measured and one bit for each rule that failed. Policies are versioned
sets of rules, as masks: a document is kept if none of a policy's bits is set in it. Ablations (what a policy would
keep without one of its rules) come from the ledger alone, by bitwise aggregation over the few different bit patterns.

Defined results: null text is the empty text, which has no words and fails ``few_words``; a null doc_id stays null; repeated rows get
equal ledger rows; an empty table makes an empty ledger; columns of the input aren't read, but for doc_id and text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lemmaflow.llm.common import P, staged

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
#: Words of the windows whose repeats count.
WINDOW = 5

#: Rules by bit: name and when a document fails, over the measurements. New rules go to the end; bits are never used again.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 10"),
    ("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "100 * n_symbols > 25 * n_words"),
    ("repeated_lines", "n_lines >= 4 and 100 * n_dup_lines > 40 * n_lines"),
    ("upper_case", "n_words >= 10 and 100 * n_upper > 60 * word_chars"),
    ("word_length", "n_words >= 10 and (word_chars < 2 * n_words or word_chars > 20 * n_words)"),
]
BITS = {name: 1 << i for i, (name, _) in enumerate(RULES)}
BASE = BITS["few_words"] | BITS["repeated_words"]


@dataclass(frozen=True)
class Policy:
    """Which rules reject a document. A version's rules never change; a change is a new version."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BITS[r] for r in set(self.rules))


POLICIES = {
    "2024-1": Policy("2024-1", ("few_words", "repeated_words")),
    "2024-2": Policy("2024-2", ("few_words", "repeated_words", "symbols", "repeated_lines", "upper_case", "word_length")),
}


def word_hashes(text: Column) -> Column:
    """A hash for each word, in order."""
    inside = F.btrim(text, F.lit(SPACES))
    return F.when(inside == "", F.array().cast("array<bigint>")).otherwise(F.transform(F.split(inside, r"[\x20\x09-\x0D]+"), lambda w: F.xxhash64(w)))


def with_repeat_words(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words: how many words lie in windows that occur twice or more. Reads ``__lf_windows``, a hash for each window in order.

    Sorted by hash, equal windows are neighbours; their places, sorted again, cover WINDOW words each, less where the next one begins.
    Most texts repeat no window, which a set shows without sorting; the steps are columns of their own, so that each is computed once.
    """
    windows = F.col(f"{P}windows")
    placed = F.when(F.size(F.array_distinct(windows)) < F.size(windows), F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    step = df.withColumn(f"{P}placed", placed)
    placed = F.col(f"{P}placed")
    last = F.size(placed) - 1
    # each pair of equal neighbours gives both places, so a place may come twice
    equal = F.flatten(F.zip_with(F.slice(placed, 1, last), F.slice(placed, 2, last), lambda x, y: F.when(x["h"] == y["h"], F.array(x["i"], y["i"])).otherwise(F.array().cast("array<int>"))))
    step = step.withColumn(f"{P}at", F.when(placed.isNotNull(), F.sort_array(equal)))
    at = F.col(f"{P}at")
    steps = F.zip_with(F.slice(at, 1, F.size(at) - 1), F.slice(at, 2, F.size(at) - 1), lambda i, j: F.least(j - i, F.lit(WINDOW)))
    covered = F.aggregate(steps, F.lit(WINDOW), lambda a, x: a + x)
    return step.withColumn("n_repeat_words", F.when(at.isNull(), 0).otherwise(covered).cast("long")).drop(f"{P}placed", f"{P}at")


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words and n_upper."""
    body = F.coalesce(F.col(text), F.lit(""))
    step = df.withColumns({f"{P}text": body, f"{P}hashes": word_hashes(body), f"{P}lines": F.filter(F.split(body, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")})
    hashes, lines, body = F.col(f"{P}hashes"), F.col(f"{P}lines"), F.col(f"{P}text")
    n = F.size(hashes)
    # hashes of a window's words side by side, not five look-ups a word
    beside = F.arrays_zip(*(F.slice(hashes, k + 1, F.greatest(n - (WINDOW - 1), F.lit(0))).alias(str(k)) for k in range(WINDOW)))
    windows = F.when(n >= WINDOW, F.transform(beside, lambda w: F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))
    measured = step.withColumns({
        f"{P}windows": windows,
        "n_words": n.cast("long"),
        "word_chars": F.length(F.translate(body, SPACES, "")).cast("long"),
        "n_symbols": (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_upper": (F.length(body) - F.length(F.translate(body, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long"),
    })
    return with_repeat_words(measured).drop(*(P + x for x in ("text", "hashes", "lines", "windows")))


def _with_bits(measured: DataFrame) -> DataFrame:
    bits = F.lit(0).cast("long")
    for name, fails in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(BITS[name])).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn("fail_bits", bits)


def ledger(df: DataFrame) -> DataFrame:
    """The table of doc_id, the measurements and fail_bits: one bit for each rule of RULES that the document fails."""
    return staged(_with_bits(measure(df.select("doc_id", "text")).drop("text")), "ledger")


def apply_policy(rows: DataFrame, policy: Policy) -> DataFrame:
    """Adds base_failed, kept and policy_version to ledger rows."""
    failed = F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long")) != 0
    base = F.col("fail_bits").bitwiseAND(F.lit(BASE).cast("long")) != 0
    return rows.withColumns({"base_failed": base, "kept": ~(base | failed), "policy_version": F.lit(policy.version)})


def ablations(rows: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of a policy: documents that fail it, that only it rejects, and that the policy keeps without it."""
    patterns = rows.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    names = [r for r, _ in RULES if r in policy.rules]
    rules = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(BITS[r]).cast("long").alias("bit")) for r in names)))
    each = patterns.withColumn("r", rules).select("n", "r.rule", "r.bit", F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long")).alias("bits"))
    fails = F.col("bits").bitwiseAND(F.col("bit")) != 0
    others = F.col("bits").bitwiseAND(F.bitwise_not(F.col("bit"))) == 0
    count = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    return each.groupBy("rule").agg(count(fails).alias("n_failed"), count(fails & others).alias("n_only_this"), count(others).alias("n_kept_without"), F.sum("n").alias("n_documents"))


def keep_good(docs: DataFrame, policy: Policy) -> DataFrame:
    """The rows of ``docs`` that the policy keeps, with their own columns, which the ledger carries along."""
    names = docs.columns
    rows = docs.select(*(F.col(f"`{c}`").alias(f"{P}c{i}") for i, c in enumerate(names)), F.col("text"))
    judged = apply_policy(staged(_with_bits(measure(rows)).drop("text"), "ledger"), policy)
    return judged.filter("kept").select(*(F.col(f"{P}c{i}").alias(c) for i, c in enumerate(names)))
