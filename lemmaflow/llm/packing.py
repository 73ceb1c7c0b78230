"""Packing: vector bin packing of token sequences under simultaneous limits, by the dot-product heuristic.

Every example asks for tokens, segments and loss-bearing tokens; every sequence (bin) has a capacity of each.
The open sequence takes, from a bounded pool of waiting examples, the fitting example whose demand has the largest
dot product with what the sequence has left, both as shares of the capacities. When none fits whole, the example of
the largest product is cut, among those of which a token fits. When no token fits any more, the sequence is closed; one that isn't full is
cut at powers of two, which need no padding. Each Spark partition packs its own examples: no shuffle, no state between tasks,
and a task that runs again makes its own sequences again.

Instruction data has a prompt, whose tokens bear no loss, before the answer, whose tokens do.

Defined results: null text is the empty text (only the end id); a null doc_id stays null; rows with equal doc_id are
separate examples; a null prompt or loss start is none, so that all tokens bear loss; an empty table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lemmaflow.llm.tokens import encode_column

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, segment long, loss_tokens long, ids binary"


@dataclass(frozen=True)
class Limits:
    """Capacities of a sequence. ``pool``: examples that wait at once in a task."""

    tokens: int = 2048
    segments: int = 64
    loss_tokens: int = 1984
    pool: int = 512


@dataclass(slots=True)
class Example:
    doc_id: int | None
    ids: np.ndarray
    total: int
    start: int
    #: Tokens from here on bear loss; those before it (an instruction) don't.
    loss_from: int

    def loss(self, n: int) -> int:
        """Loss-bearing ones among the next n tokens."""
        return max(0, self.start + n - max(self.start, self.loss_from))

    def take(self, n: int) -> tuple[int | None, int, np.ndarray, int, int]:
        piece = (self.doc_id, self.start, self.ids[self.start : self.start + n], self.total, self.loss(n))
        self.start += n
        return piece


def choose(need: np.ndarray, room: np.ndarray, caps: np.ndarray) -> tuple[int, int] | None:
    """The example to place next and how many of its tokens; None if no token of any fits. ``need``: tokens, segments and loss-bearing tokens of each, 0 if placed."""
    if room[1] < 1:
        return None
    # tokens before the loss-bearing ones, and as many of those as fit
    fits = np.minimum(need[:, 0], np.minimum(room[0], need[:, 0] - need[:, 2] + room[2]))
    able = (need[:, 0] > 0) & (fits >= need[:, 0])
    if not able.any():
        able = fits > 0
        if not able.any():
            return None
    at = int(np.argmax(np.where(able, (need / caps) @ (room / caps), -1.0)))
    return at, int(fits[at])


class Packer:
    """Packs one stream of examples; ``add`` and ``finish`` give the closed sequences, each a list of pieces."""

    def __init__(self, limits: Limits):
        self.limits = limits
        self.caps = np.array([limits.tokens, limits.segments, limits.loss_tokens], np.float64)
        self.pool: list[Example] = []
        self.begin()

    def begin(self) -> None:
        self.room, self.pieces = self.caps.copy(), []

    def demand(self, x: Example) -> tuple[int, int, int]:
        left = x.total - x.start
        return (left, 1, x.loss(left)) if left else (0, 0, 0)

    def add(self, x: Example) -> Iterator[list[tuple]]:
        self.pool.append(x)
        if len(self.pool) >= self.limits.pool:
            yield from self.pack(self.limits.pool // 2)

    def finish(self) -> Iterator[list[tuple]]:
        yield from self.pack(0)
        yield from self.close()

    def close(self) -> Iterator[list[tuple]]:
        pieces, full = self.pieces, self.room[0] == 0
        self.begin()
        if pieces:
            yield from [pieces] if full else at_powers_of_two(pieces)

    def pack(self, leave: int) -> Iterator[list[tuple]]:
        """Close sequences until no more than ``leave`` examples wait. A sequence that wants examples stays open."""
        need = np.array([self.demand(x) for x in self.pool], np.float64).reshape(-1, 3)
        n = len(self.pool)
        while n > leave:
            while n and (chosen := choose(need, self.room, self.caps)):
                at, take = chosen
                x = self.pool[at]
                piece = x.take(take)
                self.pieces.append(piece)
                self.room -= (take, 1, piece[4])
                need[at] = self.demand(x)
                n -= x.start == x.total
            if n or self.room[0] == 0:
                yield from self.close()
        self.pool = [x for x in self.pool if x.start < x.total]


def at_powers_of_two(pieces: list[tuple]) -> Iterator[list[tuple]]:
    """A last, short sequence as sequences whose lengths are powers of two, which need no padding."""
    left = sum(len(p[2]) for p in pieces)
    waiting = list(reversed(pieces))
    while left:
        room, out = 1 << (left.bit_length() - 1), []
        left -= room
        while room:
            doc_id, start, ids, total, loss = waiting.pop()
            head, tail = ids[:room], ids[room:]
            lost = max(0, loss - len(tail))  # loss-bearing tokens stand at the end of a piece
            out.append((doc_id, start, head, total, lost))
            room -= len(head)
            if len(tail):
                waiting.append((doc_id, start + len(head), tail, total, loss - lost))
        yield out


def pack_documents(
    df: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text", loss_from: str | None = None, prompt: Column | None = None, limits: Limits = Limits(), end_id: int = 1, with_ids: bool = True
) -> DataFrame:
    """One row for each piece of a document: where it lies in its document and in its sequence, its ids (uint32, little-endian) and its loss-bearing tokens.

    ``loss_from``: a column with the token from which a document's tokens bear loss. ``prompt``: instead, a column with the text's first part; as
    many tokens as it has by itself bear no loss. Without both all do.
    """
    from pyspark import TaskContext

    prompted = prompt is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, base, made = Packer(limits), TaskContext.get().partitionId() << 32, 0
        columns: list[list] = [[] for _ in range(10)]

        def put(pieces: list[tuple]) -> None:
            nonlocal made
            offset = 0
            for k, (doc, start, ids, total, loss) in enumerate(pieces):
                raw = ids.astype("<u4").tobytes()
                for c, v in zip(columns, (doc, start, len(ids), zlib.crc32(raw), total, base + made, offset, k, loss, raw if with_ids else None), strict=True):
                    c.append(v)
                offset += len(ids)
            made += bool(pieces)

        def out() -> Iterator[pa.RecordBatch]:
            if columns[0]:
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:9]), pa.array(columns[9], pa.binary())], names=[x.split()[0] for x in PIECES.split(", ")])
                for c in columns:
                    c.clear()

        for batch in batches:
            docs, begins = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            if prompted:
                begins = [n - 1 for _, _, offsets in encode_column(batch.column(3), tokenizer, end_id) for n in np.diff(offsets).tolist()]
            for at, ids, offsets in encode_column(batch.column(1), tokenizer, end_id):
                for i in range(len(offsets) - 1):
                    own = ids[offsets[i] : offsets[i + 1]]
                    for pieces in packer.add(Example(docs[at + i], own.copy(), len(own), 0, begins[at + i] or 0)):
                        put(pieces)
                    if len(columns[0]) >= 2000:
                        yield from out()
        for pieces in packer.finish():
            put(pieces)
        yield from out()

    begins = F.col(loss_from).cast("long") if loss_from else F.lit(0).cast("long")
    before = [] if prompt is None else [prompt.alias("prompt")]
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), begins.alias("loss_from"), *before).mapInArrow(run, PIECES)
    return rows if with_ids else rows.drop("ids")


def first_line(text: str = "text") -> Column:
    """The first line of a text of several, as its prompt; null for a text of one line."""
    return F.when(F.contains(F.col(text), F.lit("\n")), F.substring_index(text, "\n", 1))
