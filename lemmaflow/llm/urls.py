"""URL filters: rules first, then the ratio of two character language models.

The models are variable-order Markov models over the URL's bytes, one of accepted and one of rejected URLs. Counts are exact, a Spark
table of the different windows of six bytes, from which those of all orders follow; orders are smoothed into each other, from the
lowest up. The score is the difference of the log-likelihoods over the length; the threshold is calibrated on labelled URLs left out of training.

Labels come from the rules: what they allow or block. Counts cover all labelled URLs but the left-out fifth, which sets the threshold.

Defined results: a null or empty url has empty host and path and the score 0; without labelled URLs of both kinds every score is 0
and the threshold 0, so that the rest is allowed; repeated rows are judged alike; an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lemmaflow.llm.common import heavy_keys, staged
from lemmaflow.llm.textnum import buffer, chunks

ORDERS = 6
#: A byte plus one takes nine bits.
BITS = 9
SMOOTH = 2.0
#: Gains are whole numbers of 1/UNIT, so that their sum doesn't depend on the order of the rows.
UNIT = 1 << 32
#: Scores from -LIMIT to LIMIT in so many bins, for the calibration.
LIMIT, BINS = 8.0, 2048

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with its subdomains, below a path."""

    verdict: str
    rule: str

    def fits(self, host: Column, path: Column) -> Column:
        own, slash, below = self.rule.partition("/")
        return ((host == own) | F.endswith(host, F.lit(f".{own}"))) & F.startswith(path, F.lit(slash + below))


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path."""
    there = F.coalesce(F.instr(url, "://"), F.lit(0)) > 0
    rest = F.when(there, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def with_rules(df: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """Adds host, path, rule and rule_verdict; the longest rule that fits wins."""
    host, path = parts(F.col(url))
    out = df.withColumns({"host": host, "path": path})
    name = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.rule), r.rule)):
        name = F.when(r.fits(F.col("host"), F.col("path")), r.rule).otherwise(name)
        verdict = F.when(r.fits(F.col("host"), F.col("path")), r.verdict).otherwise(verdict)
    return out.withColumns({"rule": name, "rule_verdict": verdict})


# ---- models


def windows(urls: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """At every byte the ORDERS bytes that end there as one number of nine bits each, the latest lowest, zero before the URL; and where each URL begins."""
    data, offsets = buffer(urls)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    code = data.astype(np.int64) + 1
    out = code.copy()
    for k in range(1, ORDERS):
        at = np.flatnonzero(place >= k)
        out[at] |= code[at - k] << (BITS * k)
    return out, offsets


def counts(urls: DataFrame) -> DataFrame:
    """(window, n, n0, n1) over (url, trains) rows: how often each window occurs in all URLs, and in the rejected and accepted ones of training."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in chunks(batch.column(0)):
                kinds = pc.fill_null(batch.column(1).slice(at, len(part)), -1).to_numpy(zero_copy_only=False)
                found, offsets = windows(part)
                keys, place = np.unique(found, return_inverse=True)
                kinds = np.repeat(kinds, np.diff(offsets))
                own = [np.bincount(place[of], minlength=len(keys)) for of in (kinds > -2, kinds == 0, kinds == 1)]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (keys, *own)], names=["window", "n", "n0", "n1"])

    rows = urls.select("url", F.col("trains").cast("int")).mapInArrow(run, "window long, n long, n0 long, n1 long")
    return rows.groupBy("window").agg(*(F.sum(c).alias(c) for c in ("n", "n0", "n1")))


def gains(found: DataFrame) -> DataFrame:
    """(window, n, gain): log-likelihood of the last byte by the accepted model less that by the rejected one, in units of 1/UNIT.

    ``found``: a staged table of counts. A key of any join or window has 257 rows at most, one for each byte or none.
    """
    before = None
    for k in range(ORDERS):
        joint = F.col("window").bitwiseAND(F.lit((1 << BITS * (k + 1)) - 1))
        rows = found.groupBy(joint.alias("window")).agg(F.sum("n").alias("n"), F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        context = Window.partitionBy(F.shiftright("window", BITS))
        rows = rows.withColumns({f"all{c}": F.sum(f"n{c}").over(context) for c in (0, 1)})
        if before is None:
            rows = rows.withColumns({"q0": F.lit(1 / 256), "q1": F.lit(1 / 256)})
        else:
            rows = rows.withColumn("lower", F.col("window").bitwiseAND(F.lit((1 << BITS * k) - 1))).join(before, "lower")
        p = [((F.col(f"n{c}") + SMOOTH * F.col(f"q{c}")) / (F.col(f"all{c}") + SMOOTH)).alias(f"q{c}") for c in (0, 1)]
        before = rows.select(F.col("window").alias("lower"), "n", *p)
        last, before = before, before.drop("n")
    return last.select(F.col("lower").alias("window"), "n", F.round((F.log("q1") - F.log("q0")) * UNIT).cast("long").alias("gain"))


def scored(rows: DataFrame) -> DataFrame:
    """Adds ``score`` to a staged table with a unique ``id``, ``url`` and ``trains`` (1 accepted, 0 rejected, null: not in training).

    URLs meet the gains by a join on their windows; frequent windows (500 at most) are summed up where the URLs are.
    """
    found = staged(counts(rows), "windows")
    kinds = found.agg(F.sum("n0"), F.sum("n1")).first()
    if not kinds[0] or not kinds[1]:
        return rows.withColumn("score", F.lit(0.0))
    table = staged(gains(found), "gains")
    often = heavy_keys(table, ["window"]).select("window", "gain").orderBy("window").toArrow()
    keys, own = (often.column(c).to_numpy() for c in ("window", "gain"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in chunks(batch.column(1)):
                ids = batch.column(0).slice(at, len(part)).to_numpy()
                here, offsets = windows(part)
                ids = np.repeat(ids, np.diff(offsets))
                place = np.minimum(np.searchsorted(keys, here), max(len(keys) - 1, 0))
                known = keys[place] == here if len(keys) else np.zeros(len(here), bool)
                total = np.concatenate([[0], np.cumsum(np.where(known, own[place] if len(keys) else 0, 0))])
                there = np.diff(offsets) > 0
                first = batch.column(0).slice(at, len(part)).to_numpy()[there]
                sums = (total[offsets[1:]] - total[offsets[:-1]])[there]
                yield pa.RecordBatch.from_arrays([pa.array(first), pa.nulls(len(first), pa.int64()), pa.array(sums, pa.int64())], names=["id", "window", "sum"])
                rare = np.flatnonzero(~known)
                yield pa.RecordBatch.from_arrays([pa.array(ids[rare]), pa.array(here[rare]), pa.array(np.zeros(len(rare), np.int64))], names=["id", "window", "sum"])

    each = rows.select("id", "url").mapInArrow(run, "id long, window long, sum long")
    frequent = each.filter("window is null").select("id", "sum")
    rare = each.filter("window is not null").join(table.select("window", "gain"), "window").select("id", F.col("gain").alias("sum"))
    sums = frequent.unionByName(rare).groupBy("id").agg(F.sum("sum").alias("sum"))
    score = F.coalesce(F.col("sum") / F.lit(float(UNIT)) / F.greatest(F.octet_length("url"), F.lit(1)), F.lit(0.0))
    return rows.join(sums, "id", "left").withColumn("score", score).drop("sum")


def threshold(labelled: DataFrame) -> float:
    """The score from which URLs are accepted: the least sum of both error rates over (score, accepted) rows, nearest to 0 among equals."""
    width = 2 * LIMIT / BINS
    bin_ = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor((F.col("score") + LIMIT) / width)))
    rows = labelled.groupBy(bin_.cast("int").alias("bin"), "accepted").count().toArrow()
    table = np.zeros((2, BINS))
    np.add.at(table, (rows.column("accepted").to_numpy(zero_copy_only=False).astype(int), rows.column("bin").to_numpy()), rows.column("count").to_numpy())
    if not table.sum(1).all():
        return 0.0
    share = table / table.sum(1, keepdims=True)
    wrong = np.concatenate([[0.0], np.cumsum(share[1])]) + np.concatenate([np.cumsum(share[0][::-1])[::-1], [0.0]])
    edges = -LIMIT + width * np.arange(BINS + 1)
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    return float(edges[best[np.argmin(np.abs(edges[best]))]])


def filter_urls(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """page_id, host, path, rule, verdict and score of every row: the rule's verdict, else the models'."""
    accepted = F.when(F.col("rule_verdict").isNotNull(), (F.col("rule_verdict") == "allow").cast("int"))
    held_out = F.crc32(F.col("url").cast("binary")) % 5 == 0
    ruled = with_rules(df.select("page_id", "url"), rules).withColumns({"id": F.monotonically_increasing_id(), "accepted": accepted, "trains": F.when(~held_out, accepted)})
    out = staged(scored(staged(ruled, "urls")), "scored")
    least = threshold(out.filter(held_out & F.col("accepted").isNotNull()).select("score", (F.col("accepted") == 1).alias("accepted")))
    judged = F.coalesce("rule_verdict", F.when(F.col("score") >= least, "allow").otherwise("block"))
    return out.select("page_id", "host", "path", "rule", judged.alias("verdict"), "score")
