"""Word tokens and word shingles of many texts at once, as 64-bit hashes, by numpy over Arrow buffers.

A word is a maximal run of letters, digits and marks, in lower case. All arithmetic is modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

NOT_WORD = r"[^\p{L}\p{N}\p{M}]+"
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}
#: Weights of the words in a shingle, by place; odd, so that a change of one word always shows.
_PLACE = np.array([pow(0xD1342543DE82EF95, i + 1, 1 << 64) for i in range(64)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; kept for the usual chunk size, made anew for longer texts."""
    if len(_powers.get("up", ())) < n:
        m = max(n, 1 << 21)
        up, down = np.full(m, _BASE, np.uint64), np.full(m, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        made = {"up": np.multiply.accumulate(up), "down": np.multiply.accumulate(down)}
        if m > 1 << 21:
            return made["up"], made["down"]
        _powers.update(made)
    return _powers["up"], _powers["down"]


def chunks(texts: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, pa.Array]]:
    """Slices of about ``most`` bytes (or one longer text), with the place where each begins; nulls become empty texts."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if len(texts) == 0:
        return
    size = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    group = (np.cumsum(size) - size) // most
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield a, texts.slice(a, b - a)


def buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, one after the other, and where each text begins (one more entry than texts)."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def normal(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(pc.utf8_lower(texts), NOT_WORD, " ")


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of data[start:end] for each pair."""
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def token_bounds(data: np.ndarray, offsets: np.ndarray, is_gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs without gap bytes, none across two texts, and each text's first token (one more entry)."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    word = ~is_gap
    first, last = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
    first[offsets] = last[offsets] = True  # a text begins, the one before it ends
    before = np.empty(n, bool)
    before[0], before[1:] = False, word[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, word[1:]
    starts = np.flatnonzero(word & (~before | first[:n]))
    ends = np.flatnonzero(word & (~after | last[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and each text's first (one more entry than texts)."""
    data, offsets = buffer(normal(texts))
    starts, ends, tokens = token_bounds(data, offsets, data == 32)
    return run_hashes(data, starts, ends), tokens


def shingles(words: np.ndarray, tokens: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all windows of k words within a text, each text's first window, and the word that each window begins with.

    A text of fewer than k words, but one at least, has one window: all its words.
    """
    n = np.diff(tokens)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
    at = np.arange(first[-1]) - np.repeat(first[:-1] - tokens[:-1], count)
    left = np.repeat(tokens[1:], count) - at  # words from here to the text's end
    padded = np.concatenate([words, np.zeros(k, np.uint64)])
    total = np.zeros(len(at), np.uint64)
    for j in range(k):
        total += np.where(left > j, padded[at + j], np.uint64(0)) * _PLACE[j]
    return mix(total), first, at
