"""Benchmark decontamination by greedy string tiling.

Items and documents are words. Karp-Rabin fingerprints of all windows of ``least`` words are seeds; a document and an item that share one
are tiled: the longest match of unmarked words is marked in both, again and again, until no match of ``least`` words is left. The share of the
item's words that lie in tiles is its coverage, whatever their order, so reordered passages count. From ``coverage`` on, the document is contaminated.
Items of fewer words than a seed, but ``shortest`` at least, have seeds of their own length: all their words in a row.

Items come in blocks of at most ``block_words`` words, which are broadcast; every block meets all documents in one pass without a shuffle. Where there
are several, each pass is staged and its broadcast is destroyed before the next, so no more than one is held anywhere. A document is tiled within
its own row, so a passage in a third of all documents is spread as the documents are.

Seeds are handled at most ``SEEDS`` at once, whatever texts and items repeat. A text with more of them (a word or phrase over and over) meets its items
one by one, its windows a slice at a time. Windows with the same surroundings as ``enough`` earlier ones, as far as any match can reach, are left out first:
the tiles of an item of n words touch n words of the text, so of so many equal matches one is always free, and the first free one is taken.

Defined results: null texts are empty and match nothing; an item of fewer than ``shortest`` words matches only a document that is just these words;
null ids stay null; repeated rows are judged alike; without items nothing is contaminated; an empty table gives no rows; clashing column names don't matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lemmaflow.llm.common import staged
from lemmaflow.llm.textnum import chunks, mix, powers, shingles, word_hashes

FOUND = "doc_id long, item_id long, item_words long, covered long, n_tiles long, coverage double"
#: Seeds that are handled at once.
SEEDS = 1 << 20


@dataclass
class Windows:
    """Windows of ``size`` words of some items, sorted by fingerprint."""

    size: int
    fingerprints: np.ndarray
    item: np.ndarray
    place: np.ndarray
    marked: np.ndarray  # a bit for each low end of a fingerprint, to pass over most windows quickly

    @classmethod
    def of(cls, words: np.ndarray, tokens: np.ndarray, items: np.ndarray, size: int) -> Windows:
        marks, first, at = shingles(words, tokens, size)
        item = np.repeat(np.arange(len(tokens) - 1), np.diff(first))
        mine = np.flatnonzero(items[item])
        marks, item, at = marks[mine], item[mine], at[mine]
        order = np.argsort(marks, kind="stable")
        bits = np.zeros(1 << min(24, (64 * len(marks)).bit_length()), bool)
        bits[(marks & np.uint64(len(bits) - 1)).astype(np.int64)] = True
        return cls(size, marks[order], item[order], (at - tokens[:-1][item])[order], bits)

    def range_of(self, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Those of ``marks`` that are here (their places), and from where to where."""
        near = np.flatnonzero(self.marked[(marks & np.uint64(len(self.marked) - 1)).astype(np.int64)])
        low, high = (np.searchsorted(self.fingerprints, marks[near], side) for side in ("left", "right"))
        there = high > low
        return near[there], low[there], high[there]


@dataclass
class Block:
    """Items of a benchmark: their words' hashes and their windows."""

    ids: list[int | None]
    least: int
    words: np.ndarray
    tokens: np.ndarray
    windows: list[Windows]

    @classmethod
    def of(cls, rows: list[tuple[int | None, str | None]], least: int, shortest: int = 3) -> Block:
        words, tokens = word_hashes(pa.array([t or "" for _, t in rows], pa.large_string()))
        n = np.diff(tokens)
        size = np.where((n >= shortest) & (n < least), n, least)
        return cls([i for i, _ in rows], least, words, tokens, [Windows.of(words, tokens, size == k, int(k)) for k in np.unique(size)])

    def length(self, item: int) -> int:
        return int(self.tokens[item + 1] - self.tokens[item])

    def matches(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
        """(text, item, maximal matches) for every text and item that share a window; a match is (words, place in the item, place in the text)."""
        words, tokens = word_hashes(texts)
        for windows in self.windows:
            marks, first, at = shingles(words, tokens, windows.size)
            near, low, high = windows.range_of(marks)
            if not len(near):
                continue
            text = np.searchsorted(first, near, "right") - 1
            here = at[near] - tokens[text]
            total = np.concatenate([[0], np.cumsum(high - low)])
            starts = np.flatnonzero(np.diff(text, prepend=-1))
            ends = np.append(starts[1:], len(text))
            held = 0
            for k in range(len(starts)):  # as many texts at once as SEEDS allows
                if total[ends[k]] - total[starts[k]] > SEEDS:
                    yield from self.of_texts(windows, text, here, low, high, starts[held], starts[k])
                    yield from self.of_text(windows, int(text[starts[k]]), words[tokens[text[starts[k]]] : tokens[text[starts[k]] + 1]], marks[near], here, low, high, starts[k], ends[k])
                    held = k + 1
                elif total[ends[k]] - total[starts[held]] > SEEDS:
                    yield from self.of_texts(windows, text, here, low, high, starts[held], starts[k])
                    held = k
            if held < len(starts):
                yield from self.of_texts(windows, text, here, low, high, starts[held], len(text))

    def least_of(self, windows: Windows, item: int) -> int:
        return min(windows.size, self.length(item))

    def of_texts(self, windows: Windows, text: np.ndarray, here: np.ndarray, low: np.ndarray, high: np.ndarray, a: int, b: int) -> Iterator[tuple[int, int, np.ndarray]]:
        """Texts with few seeds, all at once."""
        if a == b:
            return
        text, here, low, count = text[a:b], here[a:b], low[a:b], (high - low)[a:b]
        slot = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        text, here, item, there = np.repeat(text, count), np.repeat(here, count), windows.item[slot], windows.place[slot]
        order = np.lexsort((here, here - there, item, text))
        text, here, item, there = text[order], here[order], item[order], there[order]
        pair = np.flatnonzero((np.diff(text, prepend=-1) != 0) | (np.diff(item, prepend=-1) != 0))
        for x, y in zip(pair, np.append(pair[1:], len(text)), strict=True):
            yield int(text[x]), int(item[x]), runs(here[x:y], there[x:y], self.least_of(windows, int(item[x])))

    def of_text(self, windows: Windows, text: int, words: np.ndarray, marks: np.ndarray, here: np.ndarray, low: np.ndarray, high: np.ndarray, a: int, b: int) -> Iterator[tuple[int, int, np.ndarray]]:
        """A text with many seeds: item by item, its windows by slices."""
        marks, here = marks[a:b], here[a:b]
        different, at = np.unique(marks, return_index=True)
        items = np.unique(np.concatenate([np.unique(windows.item[x:y]) for x, y in zip(low[a:b][at], high[a:b][at], strict=True)]))
        sizes = np.diff(self.tokens)[items]
        for reach in np.unique(1 << np.ceil(np.log2(sizes)).astype(int)):  # items of like size
            kept = needed(words, here, int(reach), enough(int(reach), windows.size))
            own, place = marks[kept], here[kept]
            order = np.argsort(own, kind="stable")
            own = own[order]
            for item in items[(sizes <= reach) & (2 * sizes > reach)].tolist():
                w = self.words[self.tokens[item] : self.tokens[item + 1]]
                mine, _, _ = shingles(w, np.array([0, len(w)]), windows.size)
                x, y = (np.searchsorted(own, np.unique(mine), side) for side in ("left", "right"))
                if not (y > x).any():
                    continue
                # the windows of the text that this item has, in order, and how many of the item's each meets
                spots = np.sort(np.concatenate([order[i:j] for i, j in zip(x, y, strict=True)]))
                by_mark = np.argsort(mine, kind="stable")
                least = self.least_of(windows, item)
                found = Matches(least, enough(len(w), least))
                begin, end = (np.searchsorted(mine[by_mark], marks[kept][spots], side) for side in ("left", "right"))
                upto = np.cumsum(end - begin)
                cuts = np.flatnonzero(np.diff(upto // SEEDS)) + 1
                for p, q in zip([0, *cuts], [*cuts, len(spots)], strict=True):
                    times = (end - begin)[p:q]
                    slot = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(begin[p:q], times)
                    found.add(np.repeat(place[spots[p:q]], times), by_mark[slot])
                yield text, item, found.all()


def enough(words: int, least: int) -> int:
    """So many equal matches that one is free whatever else is marked: tiles of an item of so many words touch fewer."""
    return words * (words // max(least, 1) + 1) + words + 1


def needed(words: np.ndarray, places: np.ndarray, reach: int, most: int) -> np.ndarray:
    """Which places of a text are needed: the first ``most`` of those with equal words ``reach`` before them and after them."""
    n = len(words)
    inside = np.flatnonzero((places >= reach) & (places + 2 * reach <= n))
    if len(inside) <= most:
        return np.arange(len(places))
    up, down = powers(n + 1)
    total = np.concatenate([[np.uint64(0)], np.cumsum(mix(words + np.uint64(7)) * up[:n])])
    x = places[inside]
    around = mix((total[x + 2 * reach] - total[x - reach]) * down[x - reach])
    order = np.argsort(around, kind="stable")
    begins = np.flatnonzero(np.diff(around[order], prepend=~around[order[:1]]))
    rank = np.arange(len(order)) - np.repeat(begins, np.diff(np.append(begins, len(order))))
    keep = np.ones(len(places), bool)
    keep[inside[order[rank >= most]]] = False
    return np.flatnonzero(keep)


def runs(here: np.ndarray, there: np.ndarray, least: int) -> np.ndarray:
    """Maximal matches (words, place in the item, place in the text) that shared windows make up: runs on a diagonal. Sorted by diagonal and place."""
    begin = np.flatnonzero((np.diff(here, prepend=-2) != 1) | (np.diff(there, prepend=-2) != 1))
    end = np.append(begin[1:], len(here))
    return np.stack([end - begin + least - 1, there[begin], here[begin]], 1)


class Matches:
    """Matches of a text and an item from slices of seeds in order of the text; of equal ones (length, place in the item) the first ``most``."""

    def __init__(self, least: int, most: int):
        self.least, self.most = least, most
        self.open = self.closed = np.zeros((0, 3), np.int64)

    def add(self, here: np.ndarray, there: np.ndarray) -> None:
        order = np.lexsort((here, here - there))
        new = runs(here[order], there[order], self.least)
        # what ended with the last slice may go on in this one, on the same diagonal
        old = self.open
        by_diagonal = np.argsort(new[:, 2] - new[:, 1], kind="stable")
        diagonal = (new[:, 2] - new[:, 1])[by_diagonal]
        at = np.searchsorted(diagonal, old[:, 2] - old[:, 1])
        there_is = at < len(new)
        first = by_diagonal[np.minimum(at, len(new) - 1)]
        goes_on = there_is & (diagonal[np.minimum(at, len(new) - 1)] == old[:, 2] - old[:, 1]) & (new[first, 2] == old[:, 2] + old[:, 0] - self.least + 1)
        on, of = first[goes_on], old[goes_on]
        new[on, 0] += of[:, 0] - self.least + 1
        new[on, 1:] = of[:, 1:]
        last = here.max()
        ends = new[:, 2] + new[:, 0] - self.least >= last
        self.closed = self.first(np.concatenate([self.closed, old[~goes_on], new[~ends]]))
        self.open = new[ends]

    def first(self, found: np.ndarray) -> np.ndarray:
        found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
        begins = np.flatnonzero((np.diff(found[:, :2], axis=0, prepend=-1) != 0).any(1))
        rank = np.arange(len(found)) - np.repeat(begins, np.diff(np.append(begins, len(found))))
        return found[rank < self.most]

    def all(self) -> np.ndarray:
        return self.first(np.concatenate([self.closed, self.open]))


def free_runs(length: int, i: int, t: int, item: np.ndarray, text: set[int]) -> list[tuple[int, int, int]]:
    """The parts of a match whose words are unmarked on both sides."""
    out, begin = [], None
    for k in range(length + 1):
        if k < length and not item[i + k] and t + k not in text:
            begin = k if begin is None else begin
        elif begin is not None:
            out.append((k - begin, i + begin, t + begin))
            begin = None
    return out


def tile(found: np.ndarray, n: int, least: int) -> tuple[int, int]:
    """Greedy tiling of an item of n words: covered words and tiles. The longest match first; of equals, the first in the item, then in the text."""
    item, text, tiles = np.zeros(n, bool), set(), 0
    heap = [(-min(length, n), i, t) for length, i, t in found.tolist()]
    heapify(heap)
    while heap and not item.all():
        length, i, t = heappop(heap)
        parts = free_runs(-length, i, t, item, text)
        if parts and parts[0][0] == -length:
            item[i : i - length] = True
            text.update(range(t, t - length))
            tiles += 1
        else:
            for p in parts:
                if p[0] >= least:
                    heappush(heap, (-p[0], p[1], p[2]))
    return int(item.sum()), tiles


def overlaps(texts: pa.Array, block: Block) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, item, the item's words, covered, tiles) for texts and items that share a window."""
    for at, part in chunks(texts):
        for text, item, found in block.matches(part):
            n = block.length(item)
            yield at + text, item, n, *tile(found, n, min(block.least, n))


def blocks(items: DataFrame, least: int, block_words: int, shortest: int) -> Iterator[Block]:
    """The benchmark in blocks of bounded size; no more than one is in the driver at a time."""
    rows, size = [], 0
    for r in items.select(F.col("item_id").cast("long"), "text").toLocalIterator():
        n = len((r["text"] or "").split()) + 1
        if rows and size + n > block_words:
            yield Block.of(rows, least, shortest)
            rows, size = [], 0
        rows.append((r["item_id"], r["text"]))
        size += n
    if rows:
        yield Block.of(rows, least, shortest)


def broadcasts(items: DataFrame, least: int, block_words: int, shortest: int) -> Iterator[tuple[Broadcast, bool]]:
    """Each block as a broadcast, and whether it is the last. A broadcast is destroyed when the next one is asked for; what needs it must be staged by then."""
    found = blocks(items, least, block_words, shortest)
    block = next(found, None)
    while block is not None:
        shared = items.sparkSession.sparkContext.broadcast(block)
        block = next(found, None)
        yield shared, block is None
        shared.destroy()


def contaminated(docs: DataFrame, items: DataFrame, *, least: int = 5, coverage: float = 0.5, block_words: int = 1 << 20, shortest: int = 3) -> DataFrame:
    """A row for each document and item whose coverage is ``coverage`` or more."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")

    def judged(shared: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for batch in batches:
                ids = batch.column(0).to_pylist()
                rows = [(ids[t], own.ids[i], n, c, k, c / n) for t, i, n, c, k in overlaps(batch.column(1), own) if c >= coverage * n]
                if rows:
                    kinds = [pa.int64()] * 5 + [pa.float64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in FOUND.split(", ")])

        return docs.mapInArrow(run, FOUND)

    parts = []
    for shared, last in broadcasts(items, least, block_words, shortest):
        parts.append(judged(shared) if last else staged(judged(shared), "found"))
        if last:
            break
    return reduce(DataFrame.unionByName, parts) if parts else docs.sparkSession.createDataFrame([], FOUND)


def drop_contaminated(docs: DataFrame, items: DataFrame, *, least: int = 5, coverage: float = 0.5, block_words: int = 1 << 20, shortest: int = 3) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with all their columns; no join, no shuffle."""
    at_text = docs.columns.index("text")

    def kept(rows: DataFrame, shared: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for t, _, n, c, _ in overlaps(batch.column(at_text), own):
                    keep[t] &= c < coverage * n
                yield batch.filter(pa.array(keep))

        return rows.mapInArrow(run, rows.schema)

    for shared, last in broadcasts(items, least, block_words, shortest):
        docs = kept(docs, shared)
        if last:
            break
        docs = staged(docs, "kept")
    return docs
