"""External induced sorting of suffixes with their common prefixes, a shard at a time.

A shard is a set of segments, each a piece of text around an anchor. The suffixes at one offset from the anchors are sorted by induction from those one
place to the right: a suffix is a tuple (byte, rank of the suffix behind it), so pushing the tuples in the order of ranks into a priority queue
and popping them gives their order. The recursion starts ``depth`` bytes right of the anchors, where nothing is known, sorts the suffixes at the anchors, and goes
on to the left, until every start of a window of ``depth`` bytes has had its turn.

Common prefixes go along. When a tuple is pushed, it takes the least common prefix since the last tuple of its byte; when it is popped, one more
than that is its common prefix with the tuple before it, or 0 if its byte differs. They are counted up to ``depth``.

The queue is on disk beyond a bound. As ranks come in order, a block of pushed tuples sorted by byte is a sorted run, and the queue pops, byte by byte, each
run's share. Text is kept by offset, a column a byte, on disk as well beyond the bound. In memory stay a few bytes for each segment and the buffers.
Files are written under new names to a folder that the caller names, through pyarrow's file systems, and deleted when the shard is done.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyarrow.fs import FileSystem

from lemmaflow.llm.files import new_name, put

#: Stands where a segment has no byte; UTF-8 has none of this value.
NO_BYTE = 255
_LOGS = np.zeros(1, np.uint8)


def _logs(n: int) -> np.ndarray:
    """The whole binary logarithm of each number up to n; 0 for 0."""
    global _LOGS
    if len(_LOGS) <= n:
        size = 1 << int(n).bit_length()
        made = np.zeros(size, np.uint8)
        for k in range(1, size.bit_length()):
            made[1 << k :] = k
        _LOGS = made
    return _LOGS


def range_minima(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The least of values[first..last], both included, for each pair."""
    out = values[last].copy()
    size = last - first + 1
    log = _logs(int(size.max()) if len(size) else 0)[size]
    level, k = values, 0
    while True:
        at = np.flatnonzero(log == k)
        if len(at):
            out[at] = np.minimum(level[first[at]], level[last[at] - (1 << k) + 1])
        if not (log > k).any():
            return out
        level = np.minimum(level[: -(1 << k)], level[1 << k :])
        k += 1


class Store:
    """Arrays on disk: in files of a folder, a file an array."""

    def __init__(self, folder: str | None):
        self.folder = folder
        self.names: list[str] = []

    def save(self, data: np.ndarray) -> str:
        name = put(self.folder, new_name(".run"), data.tobytes())
        self.names.append(name)
        return name

    def load(self, name: str, kind: type, first: int, last: int) -> np.ndarray:
        """Entries from ``first`` to before ``last``."""
        fs, path = FileSystem.from_uri(self.folder)
        size = np.dtype(kind).itemsize
        with fs.open_input_file(f"{path}/{name}") as f:
            f.seek(first * size)
            return np.frombuffer(f.read((last - first) * size), kind)

    def drop(self, names: list[str]) -> None:
        if names:
            fs, path = FileSystem.from_uri(self.folder)
            for name in names:
                fs.delete_file(f"{path}/{name}")
            self.names = [x for x in self.names if x not in set(names)]


class Columns:
    """The bytes of segments by offset from their anchors; blocks of segments, on disk beyond ``memory`` bytes."""

    def __init__(self, store: Store, left: int, right: int, memory: int):
        self.store, self.left, self.width, self.memory, self.held = store, left, left + right, memory, 0
        self.blocks: list[tuple[int, np.ndarray | str]] = []

    def add(self, segments: list[bytes], anchors: np.ndarray) -> None:
        n = len(segments)
        sizes = np.array([len(s) for s in segments], np.int64)
        text = np.frombuffer(b"".join(segments), np.uint8)
        row = np.repeat(np.arange(n), sizes)
        place = np.arange(len(text)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + self.left - anchors[row]
        block = np.full((self.width, n), NO_BYTE, np.uint8)
        block[place, row] = text
        if self.held + block.size > self.memory and self.store.folder:
            self.blocks.append((n, self.store.save(block)))
        else:
            self.held += block.size
            self.blocks.append((n, block))

    def at(self, offset: int) -> np.ndarray:
        """The byte at this offset from the anchor of every segment."""
        k = offset + self.left
        return np.concatenate([b[k] if isinstance(b, np.ndarray) else self.store.load(b, np.uint8, k * n, (k + 1) * n) for n, b in self.blocks])


class SuffixQueue:
    """A priority queue of tuples (byte, rank, segment, least common prefix) whose ranks are pushed in order."""

    def __init__(self, store: Store, memory: int):
        self.store, self.memory, self.held = store, memory, 0
        self.runs: list[tuple[np.ndarray, np.ndarray | str, np.ndarray | str]] = []
        #: The least common prefix since the last tuple of each byte.
        self.since = np.full(256, 255, np.uint8)

    def push(self, symbols: np.ndarray, segments: np.ndarray, common: np.ndarray) -> None:
        """A block of tuples in the order of ranks; ``common``: with the tuple of the rank before."""
        n = len(symbols)
        order = np.argsort(symbols, kind="stable")
        own = symbols[order]
        ends = np.searchsorted(own, np.arange(257))
        again = np.flatnonzero(own[1:] == own[:-1]) + 1
        least = np.empty(n, np.uint8)
        least[again] = range_minima(common, order[again - 1] + 1, order[again])
        present = np.flatnonzero(ends[1:] > ends[:-1])
        first, last = order[ends[present]], order[ends[present + 1] - 1]
        so_far = np.minimum.accumulate(common)
        least[ends[present]] = np.minimum(self.since[present], so_far[first])
        self.since = np.minimum(self.since, so_far[-1])
        to_end = np.append(np.minimum.accumulate(common[::-1])[::-1], np.uint8(255))
        self.since[present] = to_end[last + 1]
        run = [segments[order], least]
        if self.held + 5 * n > self.memory and self.store.folder:
            run = [self.store.save(x) for x in run]
        else:
            self.held += 5 * n
        self.runs.append((ends, *run))

    def pop(self, block: int, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(segments, common prefixes) in order, in blocks. The queue is empty afterwards."""

        def part(x: np.ndarray | str, kind: type, first: int, last: int) -> np.ndarray:
            return x[first:last] if isinstance(x, np.ndarray) else self.store.load(x, kind, first, last)

        found, size = [], 0
        for byte in range(256):
            new = True
            for ends, segments, least in self.runs:
                first, stop = int(ends[byte]), int(ends[byte + 1])
                for a in range(first, stop, block):
                    b = min(a + block, stop)
                    common = np.minimum(part(least, np.uint8, a, b), depth - 1) + np.uint8(1)
                    if new:
                        common[0], new = 0, False
                    found.append((part(segments, np.int32, a, b), common))
                    size += b - a
                    if size >= block:
                        yield np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])
                        found, size = [], 0
        if found:
            yield np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])
        self.store.drop([x for run in self.runs for x in run[1:] if isinstance(x, str)])


class Shard:
    """Segments (bytes, where the anchor is, the first and last start of a window in it), and whether another place has the same segment.

    ``memory``: bytes of text, and of each queue, that are kept in memory where ``folder`` is given; the rest is on disk. ``block``: tuples at once.
    """

    def __init__(self, depth: int, left: int, folder: str | None = None, memory: int = 256 << 20, block: int = 1 << 18):
        assert depth < 255
        self.depth, self.left, self.memory, self.block = depth, left, memory, block
        self.store = Store(folder)
        self.text = Columns(self.store, left, depth, memory)
        self.added: list[np.ndarray] = []
        self.ends: dict[str, np.ndarray] = {}

    def add(self, segments: list[bytes], anchors: np.ndarray, windows: np.ndarray) -> None:
        """``windows``: how many windows each segment has; the first starts where the segment does."""
        self.text.add(segments, anchors)
        self.added.append(np.stack([anchors, anchors - windows + 1]).astype(np.int16))

    def repeated(self, keep: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(segment, first, last): runs of window starts, counted from the segment's first one, whose window is in the shard at another place too.

        Afterwards the shard's files are deleted; with ``keep`` only by ``close``.
        """
        try:
            if self.added:
                yield from self._repeated(*np.concatenate(self.added, axis=1))
        finally:
            if not keep:
                self.close()

    def close(self) -> None:
        self.store.drop(list(self.store.names))

    def spill(self, segments: list[bytes]) -> str:
        """Segments put on disk; ``spilled`` gives some of them back."""
        ends = np.cumsum([0, *map(len, segments)], dtype=np.int64)
        name = self.store.save(np.frombuffer(b"".join(segments), np.uint8))
        self.ends[name] = ends
        return name

    def spilled(self, name: str, first: int, last: int) -> list[bytes]:
        ends = self.ends[name][first : last + 1]
        data = self.store.load(name, np.uint8, int(ends[0]), int(ends[-1])).tobytes()
        return [data[a:b] for a, b in zip((ends[:-1] - ends[0]).tolist(), (ends[1:] - ends[0]).tolist(), strict=True)]

    def _repeated(self, most: np.ndarray, least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``most``, ``least``: distances from the anchor to the first and the last start of a window."""
        n, depth = len(most), self.depth
        begun, ended = np.full(n, -1, np.int16), np.full(n, -2, np.int16)  # runs of distances
        tape: Iterator[tuple[np.ndarray, np.ndarray]] = ((np.arange(a, min(a + self.block, n), dtype=np.int32), np.zeros(min(self.block, n - a), np.uint8)) for a in range(0, n, self.block))
        end = -int(most.max())
        for offset in range(depth - 1, end - 2, -1):  # the tape has the order one place to the right
            queue, hit, before, carried = SuffixQueue(self.store, self.memory), np.zeros(n, bool), None, np.uint8(255)
            column = self.text.at(offset) if offset >= end else None
            for segments, common in tape:
                if offset < 0:
                    equal = np.flatnonzero(common >= depth)
                    hit[segments[equal]] = True
                    hit[segments[equal[equal > 0] - 1]] = True
                    if len(equal) and equal[0] == 0 and before is not None:
                        hit[before] = True
                    before = segments[-1]
                    segments, common, carried = _without(segments, common, most[segments] >= -offset, carried)
                if column is not None and len(segments):
                    queue.push(column[segments], segments, common)
            if offset < 0:
                distance = -offset - 1
                hits = np.flatnonzero(hit & (least <= distance) & (most >= distance))
                fresh = hits[ended[hits] != distance - 1]
                old = fresh[begun[fresh] >= 0]
                if len(old):
                    yield old, most[old] - ended[old], most[old] - begun[old]
                begun[fresh], ended[hits] = distance, distance
            tape = queue.pop(self.block, depth)
        old = np.flatnonzero(begun >= 0)
        if len(old):
            yield old, most[old] - ended[old], most[old] - begun[old]


def _without(segments: np.ndarray, common: np.ndarray, stays: np.ndarray, carried: np.uint8) -> tuple[np.ndarray, np.ndarray, np.uint8]:
    """A block without the tuples that leave; the next one that stays takes their common prefixes, in the next block if need be (``carried``)."""
    stay = np.flatnonzero(stays)
    if not len(stay):
        return segments[:0], common[:0], np.uint8(min(carried, common.min(initial=np.uint8(255))))
    begin = np.concatenate([[0], stay[:-1] + 1])
    own = np.minimum.reduceat(common[: stay[-1] + 1], begin)
    own[0] = min(own[0], carried)
    return segments[stay], own, np.uint8(common[stay[-1] + 1 :].min(initial=np.uint8(255)))
