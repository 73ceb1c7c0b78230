"""Vector code compression: product quantisation in integers, with a vantage-point tree over the entries of each part position.

Components become integers floor(scale * x). A vector is cut into ``parts`` equal parts; each part position has a codebook of at most
``entries`` entries, which begins as that part of the vectors with the smallest ids. In each round every part goes to its nearest entry (squared
Euclidean distance, ties to the lower index), then each entry becomes the componentwise floor of its parts' mean; unused entries stay.

The nearest entry is found by branch and bound in the metric: a tree node has a vantage entry and two balls of entries around it, an inner and an
outer one. Radii and distances are square roots rounded outwards, a ball is visited when its bound doesn't exceed the best distance (not only when it
is less), and every entry met is compared by its exact integer distance, so that the result is that of a full search. Batches of parts go
down a tree together.

Only the codebooks (parts x entries x width integers) and the sums of their parts pass through the driver, whatever the number of rows.

Defined results: rows are dropped whose vector is null, empty, holds a null or a non-finite component, or whose length isn't that of the kept vector with
the smallest id or no multiple of ``parts``; null ids come last when codebooks begin; of equal ids the one with the least vector comes first; repeated rows are coded
alike and each counts; with fewer than ``entries`` rows codebooks are shorter; integers of any size are exact, but errors over
2**63 - 1 read 2**63 - 1; an empty table gives no rows; null labels are one label; other columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lemmaflow.llm.common import P, heavy_keys, staged

MOST = (1 << 63) - 1
#: Sums are carried in two parts, as components of extreme vectors need over 64 bits.
_LOW = 40


def _down(x: np.ndarray) -> np.ndarray:
    """Square roots of exact integers, not above the true ones."""
    r = np.sqrt(x.astype(np.float64))
    for _ in range(3):
        r = np.nextafter(r, 0)
    return r


def _up(x: np.ndarray) -> np.ndarray:
    r = np.sqrt(x.astype(np.float64))
    for _ in range(3):
        r = np.nextafter(r, np.inf)
    return r


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``a`` to ``b``."""
    d = a - b
    return (d * d).sum(axis=1)


@dataclass
class Ball:
    """A vantage entry and the balls of the entries nearer to and farther from it, each with bounds of their distances to it."""

    vantage: int
    children: list[tuple[Ball, float, float]]


def tree(points: np.ndarray, members: list[int]) -> Ball | None:
    if not members:
        return None
    first, rest = members[0], members[1:]
    if not rest:
        return Ball(first, [])
    far = _squares(points[rest], points[first])
    order = sorted(range(len(rest)), key=lambda i: (far[i], rest[i]))
    half, children = (len(order) + 1) // 2, []
    for own in (order[:half], order[half:]):
        if own:
            child = tree(points, sorted(rest[i] for i in own))
            children.append((child, float(_down(far[own]).min()), float(_up(far[own]).max())))
    return Ball(first, children)


def nearest(queries: np.ndarray, points: np.ndarray, root: Ball) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``queries`` the index of its nearest row of ``points`` and the squared distance; both of integers."""
    best = _squares(queries, points[root.vantage])
    index = np.full(len(queries), root.vantage, np.int64)

    def visit(ball: Ball, rows: np.ndarray) -> None:
        d = _squares(queries[rows], points[ball.vantage])
        better = (d < best[rows]) | ((d == best[rows]) & (ball.vantage < index[rows]))
        best[rows[better]], index[rows[better]] = d[better], ball.vantage
        low, high = _down(d), _up(d)
        if not ball.children:
            return
        inner = low <= ball.children[0][2]
        for side, order in ((inner, ball.children), (~inner, ball.children[::-1])):
            for child, least, most in order:
                at = np.flatnonzero(side)
                reach = _up(best[rows[at]])
                at = at[(low[at] - most <= reach) & (least - high[at] <= reach)]
                if len(at):
                    visit(child, rows[at])

    visit(root, np.arange(len(queries)))
    return index, best


def _integers(batch: pa.Array, width: int, scale: int) -> np.ndarray:
    """Vectors as rows of integers: int64 where these are small, else Python's."""
    x = batch.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    x = np.floor(x * scale)
    return x.astype(np.int64) if not x.size or np.abs(x).max() < 1 << 62 else np.array([[int(v) for v in row] for row in x], object)


class Codebooks:
    """A list of entries (lists of integers) for each part position, with their trees."""

    def __init__(self, entries: list[list[list[int]]]):
        self.entries = entries
        self.width = len(entries[0][0])
        most = max(abs(v) for book in entries for e in book for v in e)
        self.most = most

    def assigned(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (a row a vector, a column a part) and squared distances."""
        top = max(self.most, int(np.abs(vectors).max()) if vectors.size else 0)
        exact = np.int64 if (2 * top) ** 2 * self.width < 1 << 62 else object
        codes, errors = np.zeros((len(vectors), len(self.entries)), np.int64), np.zeros((len(vectors), len(self.entries)), exact)
        for p, book in enumerate(self.entries):
            points = np.array(book, exact)
            part = vectors[:, p * self.width : (p + 1) * self.width].astype(exact)
            codes[:, p], errors[:, p] = nearest(part, points, tree(points, list(range(len(book)))))
        return codes, errors

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(v) for book in self.entries for e in book for v in e).encode()).hexdigest()


def usable(vector: Column) -> Column:
    """Vectors without null or non-finite components."""
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))


def _rounds(rows: DataFrame, width: int, books: Codebooks, scale: int) -> Codebooks:
    """Codebooks after one more round."""
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = shared.value, {}
        for batch in batches:
            vectors = _integers(batch.column(0), width, scale)
            codes, _ = own.assigned(vectors)
            for p in range(codes.shape[1]):
                part = vectors[:, p * own.width : (p + 1) * own.width]
                for e in np.unique(codes[:, p]).tolist():
                    chosen = part[codes[:, p] == e]
                    # halves first: a batch of large integers may have a sum over 64 bits
                    high, low = (chosen >> _LOW).sum(axis=0), (chosen & ((1 << _LOW) - 1)).sum(axis=0)
                    n, old = total.get((p, e), (0, [0] * own.width))
                    total[p, e] = n + len(chosen), [o + (int(h) << _LOW) + int(w) for o, h, w in zip(old, high, low, strict=True)]
        out = [(p, e, d, n, v >> _LOW, v & ((1 << _LOW) - 1)) for (p, e), (n, values) in total.items() for d, v in enumerate(values)]
        columns = list(zip(*out, strict=True)) or [()] * 6
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["part", "entry", "place", "n", "high", "low"])

    each = rows.select("vector").mapInArrow(sums, "part int, entry int, place int, n long, high decimal(38,0), low long")
    found = each.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")).collect()  # a row for each number of the codebooks
    shared.unpersist()
    entries = [[list(e) for e in book] for book in books.entries]
    for r in found:
        entries[r["part"]][r["entry"]][r["place"]] = ((int(r["high"]) << _LOW) + int(r["low"])) // r["n"]
    return Codebooks(entries)


def kept_vectors(vectors: DataFrame, column: str, parts: int) -> tuple[DataFrame, int]:
    """(vec_id, label, vector) of the usable rows, as a table, and the length of the vectors."""
    rows = staged(vectors.select("vec_id", "label", F.col(column).alias("vector")).filter(usable(F.col("vector")) & (F.size("vector") % parts == 0)), "vectors")
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "vector").select(F.size("vector").alias("n")).first()
    width = first["n"] if first else parts
    return rows.filter(F.size("vector") == width), width


def learned(rows: DataFrame, width: int, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> Codebooks | None:
    """Codebooks of the rows that ``kept_vectors`` gives; None without rows."""
    begin = rows.orderBy(F.asc_nulls_last("vec_id"), "vector").select("vector").limit(entries).toArrow().column(0).combine_chunks()
    if not len(begin):
        return None
    size = width // parts
    chosen = [[int(v) for v in row] for row in _integers(begin, width, scale)]
    books = Codebooks([[row[p * size : (p + 1) * size] for row in chosen] for p in range(parts)])
    for _ in range(rounds):
        books = _rounds(rows, width, books, scale)
    return books


def compressed(vectors: DataFrame, column: str = "embedding", parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> DataFrame:
    """vec_id, label, code (two hex digits a part), error, label_error and codebooks_sha256 of every usable row."""
    rows, width = kept_vectors(vectors, column, parts)
    books = learned(rows, width, parts, entries, rounds, scale)
    if books is None:
        return rows.selectExpr("vec_id", "label", "'' as code", "0L as error", "0L as label_error", "'' as codebooks_sha256")
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            codes, errors = own.assigned(_integers(batch.column(2), width, scale))
            text = ["".join(f"{c:02x}" for c in row) for row in codes.tolist()]
            total = [min(sum(map(int, row)), MOST) for row in errors.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(total, pa.int64())], names=["vec_id", "label", "code", "error"])

    kind = dict(rows.dtypes)
    coded = staged(rows.mapInArrow(run, f"vec_id {kind['vec_id']}, label {kind['label']}, code string, error long"), "codes")
    own, n = f"{P}label", f"{P}n"
    sums = staged(coded.groupBy(F.col("label").alias(own)).agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST).cast("decimal(38,0)")).cast("long").alias("label_error"), F.count(F.lit(1)).alias(n)), "label_errors")
    hot = F.broadcast(heavy_keys(sums, [own], n).drop(n))
    same = F.col("label").eqNullSafe(F.col(own))
    found = coded.join(hot, same).unionByName(coded.join(hot, same, "left_anti").join(sums.drop(n), same))
    return found.select("vec_id", "label", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
