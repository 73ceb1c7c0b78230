"""Secret scans, with DataFrame functions only: fixed patterns, and character Markov models for what the patterns don't name.

Two first-order Markov models over the characters of long tokens are trained from labelled samples: strings that look random and
ordinary identifiers. A token whose log-likelihood ratio exceeds a threshold is a span of kind ``random``, if it overlaps no pattern's span.
The labels come from the patterns: what they match is random, long tokens that touch no match are ordinary. Counts cover all documents; there are no more
than two for each pair of characters. Tokens that hide among the ordinary ones but look random to a first model lose their label, as secrets that no
pattern names are among them. One labelled token in ``HELD_OUT``, by hash, is left out of the counts; on these the threshold is set: at the least sum of the share of random ones missed and COST times the share of ordinary ones taken, in the middle of the best range.
Work is linear in a text's length: matches are masked in one pass, and places are summed up in chunks.

Defined results: null text is the empty text, without spans; a null doc_id stays null; repeated rows are scanned alike;
without samples of one kind its model is uniform; an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lemmaflow.llm.common import P, staged


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


#: Kind, pattern, group that is measured, its least length, and what a text with a match must contain.
PATTERNS = [
    ("assign", "(" + "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key"))) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, (":", "=")),
    ("access", r"AKIA[A-Z0-9]+", 0, 18, ("AKIA",)),
    # 16 and more at once: a shorter run can hide no longer one
    ("hex", r"[0-9a-f]{16,}+", 0, 16, ()),
]
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
MASK = "\u00e9"
TOKEN = r"(?<![\p{L}\p{N}+/_=-])[A-Za-z0-9+/_=-]{16,}+(?!\p{L})"
#: Gain in log-likelihood from which a token counts as random where no held-out tokens tell.
LEAST_GAIN = 10.0
WEIGHT = 500.0
#: One token in so many sets the threshold; an ordinary token taken counts as so many random ones missed.
HELD_OUT, COST = 5, 10.0
#: Gains from -LIMIT to LIMIT in so many bins.
LIMIT, BINS = 256.0, 1024
SPAN = "array<struct<start:int,rank:int,end:int>>"
KINDS = [k for k, *_ in PATTERNS] + ["random"]


def _none() -> Column:
    return F.array().cast(SPAN)


#: Arrays are summed up in chunks of so many, as an array that grows by one each time is copied each time.
CHUNK = 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once; in a lambda, an expression of the row would be worked out again for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def sums_so_far(numbers: Column, levels: int = 3) -> Column:
    """The sum of each number and those before it. Chunks are summed up on their own and then moved by the sums of the chunks before, found alike."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("found"))

    def plain(x: Column) -> Column:
        return F.aggregate(x, start, lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["found"], F.array(acc["at"] + n)).alias("found")))["found"]

    def moved(own: Column) -> Column:
        ends = sums_so_far(F.transform(own, lambda c: F.element_at(c, -1)), levels - 1)
        return F.flatten(F.zip_with(own, F.slice(F.concat(F.array(F.lit(0)), ends), 1, F.size(own)), lambda c, before: F.transform(c, lambda x: x + before)))

    def whole(a: Column) -> Column:
        cut = F.transform(F.sequence(F.lit(1), F.greatest(F.size(a), F.lit(1)), F.lit(CHUNK)), lambda i: plain(F.slice(a, i, CHUNK)))
        return F.when(F.size(a) <= CHUNK, plain(a)).otherwise(let(cut, moved))

    return let(numbers, whole if levels else plain)


def _located(text: Column, pattern: str, sizes: Column, matches: Column, least: int, rank: int) -> Column:
    """Spans of matches, from what stands between them. ``sizes``: lengths that must be ``least`` or more."""

    def spans(m: Column) -> Column:
        gaps = F.transform(F.slice(F.split(text, pattern, -1), 1, F.size(m)), lambda x: F.length(x))
        ends = sums_so_far(F.zip_with(gaps, m, lambda g, x: g + F.length(x)))
        each = F.zip_with(F.zip_with(ends, m, lambda e, x: F.struct((e - F.length(x)).alias("start"), F.lit(rank).alias("rank"), e.alias("end"))), sizes, lambda x, n: F.struct(x.alias("span"), (n >= least).alias("good")))
        return F.transform(F.filter(each, lambda x: x["good"]), lambda x: x["span"])

    return let(matches, spans)


def _masked(text: Column, rank: int) -> Column:
    """The text with a letter that no token has in place of each character of the pattern's matches that count: tokens that touch these are no tokens any more, and all others stay where they are."""
    _, pattern, group, least, needs = PATTERNS[rank]
    pieces, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    long = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda x: F.length(x) >= least)
    hidden = F.zip_with(matches, long, lambda m, good: F.when(good, F.repeat(F.lit(MASK), F.length(m))).otherwise(m))
    whole = F.array_join(F.zip_with(pieces, hidden, lambda p, m: F.concat(p, F.coalesce(m, F.lit("")))), "")
    return F.when((_any(text, needs) if needs else F.lit(True)) & F.rlike(text, F.lit(pattern)), whole).otherwise(text)


def masked(docs: DataFrame) -> DataFrame:
    """Adds the text without its nulls, and the text with all patterns' matches masked; a column each, so that none is made twice."""
    out = docs.withColumn(f"{P}text", F.coalesce("text", F.lit(""))).withColumn(f"{P}mask", _masked(F.col(f"{P}text"), 0))
    for rank in range(1, len(PATTERNS)):
        out = out.withColumn(f"{P}mask", _masked(F.col(f"{P}mask"), rank))
    return out


def base_spans(text: Column, rank: int) -> Column:
    kind, pattern, group, least, needs = PATTERNS[rank]
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sizes = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda x: F.length(x))
    return F.when((_any(text, needs) if needs else F.lit(True)) & F.rlike(text, F.lit(pattern)), _located(text, pattern, sizes, matches, least, rank)).otherwise(_none())


def codes(token: Column) -> Column:
    """Pairs of neighbouring characters as numbers from 0."""
    at = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    n = F.greatest(F.length(token) - 1, F.lit(0))
    return F.zip_with(F.slice(at, 1, n), F.slice(at, 2, n), lambda a, b: a * len(ALPHABET) + b)


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def labelled_tokens(docs: DataFrame) -> DataFrame:
    """(token, random) of all documents: values that the patterns match, and the other long tokens."""
    text = F.col(f"{P}text")
    known = F.concat(*(
        F.when(_any(text, needs) if needs else F.lit(True), F.filter(F.regexp_extract_all(text, F.lit(p), F.lit(g)), lambda x: F.length(x) >= least)).otherwise(F.array().cast("array<string>"))
        for _, p, g, least, needs in PATTERNS
    ))
    step = masked(docs.select("text")).select(known.alias(f"{P}known"), tokens(F.col(f"{P}mask")).alias(f"{P}tokens"))
    both = F.concat(F.transform(f"{P}known", lambda t: F.struct(t.alias("token"), F.lit(True).alias("random"))), F.transform(f"{P}tokens", lambda t: F.struct(t.alias("token"), F.lit(False).alias("random"))))
    return step.select(F.inline(both))


def _any(text: Column, needs: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for n in needs:
        out = out | F.contains(text, F.lit(n))
    return out


def _held_out(token: Column) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(HELD_OUT)) == 0


def _inside(token: Column) -> Column:
    """A token's characters of ALPHABET."""
    return F.array_join(F.filter(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c) > 0), "")


def train(labelled: DataFrame) -> list[float]:
    """The gain in log-likelihood (random over ordinary) of each pair of characters.

    Rows of pairs are smoothed by the frequencies of single characters with a weight of WEIGHT, so that a few strings in a corpus don't make
    their own rare pairs likely; single characters by one more each.
    """
    n = len(ALPHABET)
    pairs = labelled.select(_inside(F.col("token")).alias("token"), "random").select(F.explode(codes(F.col("token"))).alias("pair"), "random").groupBy("pair", "random").count()
    found = {True: [0] * (n * n), False: [0] * (n * n)}
    for r in pairs.collect():  # two rows a pair of characters at most
        if r["pair"] >= 0:
            found[r["random"]][r["pair"]] += r["count"]

    def logs(counts: list[int]) -> list[float]:
        single = [(sum(counts[b::n]) + 1) / (sum(counts) + n) for b in range(n)]
        totals = [sum(counts[a * n : (a + 1) * n]) for a in range(n)]
        return [math.log((counts[a * n + b] + WEIGHT * single[b]) / (totals[a] + WEIGHT)) for a in range(n) for b in range(n)]

    return [x - y for x, y in zip(logs(found[True]), logs(found[False]), strict=True)]


def gain_of(token: Column, gain: list[float]) -> Column:
    table = F.lit(gain)
    return F.aggregate(codes(token), F.lit(0.0), lambda a, c: a + F.get(table, c))


def threshold(labelled: DataFrame, gain: list[float]) -> float:
    """Where the labelled tokens part best; LEAST_GAIN without tokens of both kinds. There are two rows a bin at most."""
    width = 2 * LIMIT / BINS
    bin_ = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor((gain_of(_inside(F.col("token")), gain) + LIMIT) / width)))
    found = {True: [0] * BINS, False: [0] * BINS}
    for r in labelled.groupBy(bin_.cast("int").alias("bin"), "random").count().collect():
        found[r["random"]][r["bin"]] = r["count"]
    n = {k: sum(v) for k, v in found.items()}
    if not n[True] or not n[False]:
        return LEAST_GAIN
    missed, taken, costs = 0, n[False], []
    for b in range(BINS + 1):  # tokens from bin b on are taken
        costs.append(missed / n[True] + COST * taken / n[False])
        if b < BINS:
            missed, taken = missed + found[True][b], taken - found[False][b]
    first = costs.index(min(costs))
    last = next((b for b in range(first, BINS + 1) if costs[b] > costs[first]), BINS + 1) - 1
    return width * (first + last) / 2 - LIMIT


def learn(docs: DataFrame) -> tuple[list[float], float]:
    """The gains and the threshold."""
    labelled = staged(labelled_tokens(docs), "tokens")
    first = train(labelled.filter(~_held_out(F.col("token"))))
    labelled = staged(labelled.filter(F.col("random") | (gain_of(_inside(F.col("token")), first) <= LEAST_GAIN)), "tokens")
    gain = train(labelled.filter(~_held_out(F.col("token"))))
    return gain, threshold(labelled.filter(_held_out(F.col("token"))), gain)


def find_secrets(docs: DataFrame, model: tuple[list[float], float] | None = None) -> DataFrame:
    """doc_id, base (spans of the patterns) and spans (all), each span as (start, rank of its kind in KINDS, end) in code points. ``model``: what ``learn`` gives."""
    gain, least = model or learn(docs)
    text, rest = F.col(f"{P}text"), F.col(f"{P}mask")
    step = masked(docs.select("doc_id", "text")).withColumns({f"{P}{k}": base_spans(text, i) for i, (k, *_) in enumerate(PATTERNS)} | {f"{P}tokens": tokens(rest)})
    step = step.withColumn(f"{P}scores", F.transform(f"{P}tokens", lambda t: gain_of(t, gain)))
    scores, found = F.col(f"{P}scores"), F.col(f"{P}tokens")
    base = F.sort_array(F.concat(*(F.col(f"{P}{k}") for k, *_ in PATTERNS)))
    # a score stands for the length that is measured: 1 where it is high enough
    high = F.transform(scores, lambda s: F.when(s > least, 1).otherwise(0))
    random = F.when(F.exists(scores, lambda s: s > least), _located(rest, TOKEN, high, found, 1, len(PATTERNS))).otherwise(_none())
    return step.select("doc_id", base.alias("base"), random.alias(f"{P}random")).select("doc_id", "base", F.sort_array(F.concat("base", f"{P}random")).alias("spans"))


def named(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    kinds = F.lit(KINDS)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["end"])), ",")
