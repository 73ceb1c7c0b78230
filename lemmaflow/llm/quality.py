"""Quality classifier: supervised subword embeddings.

Features of a text are its words, the pairs of words in a row, the character n-grams inside its words (with the white space at their ends) and one for the text itself, hashed into BUCKETS.
Each bucket has a learned vector; a text's vector is the sum of three averages and the vector of the text itself: over the words, over the pairs, over the character n-grams. In the
first two each different one counts once, over the number of all, so that a text that repeats itself has a shorter vector than one that doesn't. A softmax over the classes gives the score.
Training is stochastic gradient descent in numpy on a bounded sample of labelled rows: those whose ids have the least hashes, ``most`` rows and
``most_features`` different features of rows at most. Scoring reads whole texts.

As the output is linear in a text's vector, a bucket's vector times the difference of the class weights is a number, and
a text's score comes from the weighted sum of these; that table of BUCKETS numbers is all that goes to the tasks.

Defined results: null text is the empty text, whose only feature is the mark for the text itself; null doc_ids are never learned from, and score
as others do; rows with null labels are no labels; repeated rows score alike; without labels of both kinds all scores are the share of
label 1 (0.5 without labels); an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lemmaflow.llm.common import staged
from lemmaflow.llm.textnum import chunks, mix, shingles

BUCKETS = 1 << 17
DIMENSIONS = 8
GRAMS = (3, 4, 5)
TEXT = 0  # bucket of the text itself
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _bucket(hashes: np.ndarray, kind: int) -> np.ndarray:
    return (mix(hashes + np.uint64(kind << 48)) % np.uint64(BUCKETS - 1)).astype(np.int32) + 1


def features(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Features, the texts that they belong to and their weights in the average, a part at a time. Words and pairs come once a text, however often it has them."""
    sizes = np.array([len(t) for t in texts], np.int64)
    codes = np.frombuffer((" " + " ".join(texts) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes + 1)  # of places from 1 on; a text has the space after it
    gap = ((codes >= 9) & (codes <= 13)) | (codes == 32)
    n = len(codes)
    yield np.full(len(texts), TEXT, np.int32), np.arange(len(texts), dtype=np.int32), np.ones(len(texts))
    # words
    starts = np.flatnonzero(~gap[1:] & gap[:-1]) + 1
    ends = np.flatnonzero(gap[1:] & ~gap[:-1]) + 1
    values = codes.astype(np.uint64) + np.uint64(1)
    if len(starts):
        power = np.full(n, _MULTIPLIER, np.uint64)
        power[0] = 1
        power = np.multiply.accumulate(power)
        total = np.concatenate([[np.uint64(0)], np.cumsum(values * power)])
        inverse = np.uint64(pow(int(_MULTIPLIER), -1, 1 << 64))
        down = np.full(n, inverse, np.uint64)
        down[0] = 1
        words = mix((total[ends] - total[starts]) * np.multiply.accumulate(down)[starts])
        mine = owner[starts - 1]
        inside = np.flatnonzero(mine[1:] == mine[:-1])
        pairs = mix(words[inside] * _MULTIPLIER + words[inside + 1])
        for hashes, of, kind in ((words, mine, 1), (pairs, mine[inside], 2)):
            if len(of):
                every = np.bincount(of, minlength=len(texts))
                own = np.unique(of.astype(np.int64) * BUCKETS + _bucket(hashes, kind))
                of = (own // BUCKETS).astype(np.int32)
                yield (own % BUCKETS).astype(np.int32), of, 1 / every[of]
    # character n-grams: white space at their ends only
    gaps = np.concatenate([[0], np.cumsum(gap)])
    gram, found = values.copy(), []
    for k in range(2, max(GRAMS) + 1):
        gram = gram[: n - k + 1] * _MULTIPLIER + values[k - 1 :] if n >= k else gram[:0]
        if k in GRAMS and len(gram):
            at = np.flatnonzero(gaps[k - 1 : n] - gaps[1 : n - k + 2] == 0)
            found.append((_bucket(gram[at], k), owner[at + gap[at] - 1]))  # the space before a word isn't the text before
    every = sum(np.bincount(of, minlength=len(texts)) for _, of in found) if found else np.zeros(len(texts))
    for ids, of in found:
        yield ids, of, 1 / every[of]


@dataclass
class Model:
    """A number for each bucket; a text's score is the logistic function of their weighted sum over its features."""

    gain: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        total = np.zeros(len(texts))
        for ids, of, weight in features(texts):
            total += np.bincount(of, self.gain[ids] * weight, len(texts))
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def bag(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its different features, and the weight of each."""
    out = []
    for t in texts:
        parts = list(features([t]))
        ids, at = np.unique(np.concatenate([i for i, _, _ in parts]), return_inverse=True)
        out.append((ids, np.bincount(at, np.concatenate([w for _, _, w in parts])).astype(np.float32)))
    return out


def fit(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, *, epochs: int = 8, rate: float = 0.5, seed: int = 7) -> Model:
    """Stochastic gradient descent on vectors and class weights, one text at a time, at a falling rate."""
    if len(labels) == 0 or labels.min() == labels.max():
        share = np.clip(labels.mean() if len(labels) else 0.5, 0.01, 0.99)
        return Model(np.full(BUCKETS, np.log(share / (1 - share)), np.float32))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weights = np.zeros((2, DIMENSIONS), np.float32)
    steps, done = epochs * len(bags), 0
    for _ in range(epochs):
        for i in rng.permutation(len(bags)):
            ids, share = bags[i]
            hidden = share @ vectors[ids]
            out = weights @ hidden
            p = np.exp(out - out.max())
            p /= p.sum()
            p[labels[i]] -= 1  # the gradient at the output
            step = rate * (1 - done / steps)
            back = p @ weights
            weights -= step * np.outer(p, hidden)
            # shares are small, so vectors learn at the rate of the whole text: a step moves its average by the gradient
            part = np.minimum(share * len(ids), 4.0)
            vectors[ids] -= (step / (share @ part) * part)[:, None] * back[None, :]
            done += 1
    return Model((vectors @ (weights[1] - weights[0])).astype(np.float32))


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, most: int = 3000, most_features: int = 1 << 24) -> Model:
    """Fit on labelled rows in the order of their ids' hashes: ``most`` at most, with ``most_features`` different features (summed over rows) at most."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    chosen = usable.select("doc_id", F.col("quality").cast("int").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in chunks(batch.column(1)):
                bags = bag(part.to_pylist())
                columns = [batch.column(0).slice(at, len(part)), batch.column(2).slice(at, len(part)), pa.array([len(b[0]) for b in bags], pa.int64()), pa.array([b[0] for b in bags], pa.list_(pa.int32())), pa.array([b[1] for b in bags], pa.list_(pa.float32()))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "quality", "size", "ids", "share"])

    # at most ``most`` rows are broadcast; of several texts with one id the least is taken
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    bags = staged(texts.select("doc_id", "text", "quality").mapInArrow(run, "doc_id long, quality int, size long, ids array<int>, share array<float>").withColumn("place", F.xxhash64("doc_id")), "bags")
    order = [("place", "ascending"), ("doc_id", "ascending"), ("quality", "ascending")]
    sizes = bags.select("place", "doc_id", "quality", "size").toArrow().sort_by(order)
    n = int(np.searchsorted(np.cumsum(sizes.column("size").to_numpy()), most_features, "right"))
    if n == 0:
        return fit([], np.zeros(0, int))
    rows = bags.filter(F.col("place") <= sizes.column("place")[n - 1].as_py()).toArrow().sort_by(order).slice(0, n)
    found = [(np.array(i.as_py(), np.int32), np.array(s.as_py(), np.float32)) for i, s in zip(rows.column("ids"), rows.column("share"), strict=True)]
    return fit(found, rows.column("quality").to_numpy())


def score(docs: DataFrame, model: Model, least: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model.gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(shared.value)
        for batch in batches:
            for at, part in chunks(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), pa.array(own.scores(part.to_pylist()), pa.float64())], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= least, 1).otherwise(0).alias("predicted"))
