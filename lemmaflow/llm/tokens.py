"""Ids of many texts by a public tokenizer file, with each distinct piece of text tokenized once.

Tokenizers cut a text into pieces before they merge; pieces don't influence each other. Where the tokenizer
surely cuts (before a space that leads a word, or between a letter of LETTERS and a full stop or comma), this cuts first,
and gives the tokenizers library only pieces that it has not met. The letters of LETTERS are those that normalisation leaves
as they are; others may come apart, so no cut is made behind them. Texts with combining marks aren't put into lower case first, as
a capital and a mark may compose otherwise than the small letter and the mark. Before that, texts are cut at the strings of added
tokens, as the library does; each is a piece of its own and gets its own id. Other kinds of tokenizer get whole texts.
"""

from __future__ import annotations

import ctypes
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lemmaflow.llm.textnum import chunks

#: Pieces that a worker keeps; about 250 bytes each. When it is full, it is emptied. Idle workers hold it while other stages run.
KEPT = 600_000
_MARK = "\x01"
#: Letters that NFC leaves alone and lower case keeps single letters: those of ASCII and Latin-1.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_STOP = rf"([{LETTERS}])([.,])"


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        before = spec.get("pre_tokenizer") or {}
        steps = before.get("pretokenizers", [before])
        self.kind = "whole"
        if spec.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space"):
            self.kind = "led"  # words carry the space before them
        elif len(steps) == 2 and steps[0].get("invert") and steps[0]["pattern"].get("Regex", "").endswith(r"|[^\s\p{L}\p{N}]+") and "Lowercase" in str(spec.get("normalizer")):
            self.kind = "dropped"  # lower case, white space dropped
        added = spec.get("added_tokens") or []
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or (t["normalized"] and spec.get("normalizer")) or re.search(r"\s|\w[.,]|" + _MARK, t["content"]) for t in added):
            self.kind = "whole"  # where such tokens match depends on more than their strings, or the cuts of pieces could split them
        # the first match wins, the longest of those that begin at one place
        strings = sorted((t["content"] for t in added if t["content"]), key=len, reverse=True)
        self.added = re.compile("(" + "|".join(map(re.escape, strings)) + ")") if strings and self.kind != "whole" else None
        self.strings = strings
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.begin, self.length = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32)
        self.used = 0

    def add(self, pieces: list[str]) -> None:
        found = [x.ids for x in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        n, lengths = len(self.known), np.fromiter(map(len, found), np.int64, len(found))
        if n + len(pieces) > len(self.begin):
            self.begin, self.length = (np.concatenate([x, np.zeros(n + len(pieces), x.dtype)]) for x in (self.begin, self.length))
        total = int(lengths.sum())
        if self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(self.used + total, np.int32)])
        self.flat[self.used : self.used + total] = np.fromiter((i for x in found for i in x), np.int32, total)
        self.begin[n : n + len(pieces)] = self.used + np.cumsum(lengths) - lengths
        self.length[n : n + len(pieces)] = lengths
        self.used += total
        self.known.update(zip(pieces, range(n, n + len(pieces)), strict=True))

    def pieces(self, texts: pa.Array) -> pa.Array:
        """A list of pieces for each text."""
        if self.kind == "dropped":
            low = pc.ascii_lower(texts)
            as_is = self.holding(low, True) | pc.match_substring_regex(texts, r"\pM").to_numpy(zero_copy_only=False)
            if as_is.any():  # lower case would make or lose a token's string, or change what composes
                low = pc.if_else(pa.array(as_is), texts, low)
            return pc.split_pattern(pc.replace_substring_regex(low, _STOP, r"\1 \2"), " ")
        if self.kind == "led" and not pc.any(pc.match_substring(texts, _MARK)).as_py():
            cut = pc.replace_substring(texts, " ", _MARK + " ")
            odd = pc.match_substring_regex(texts, r" ([^\pL\pN\pP\pS]|$)")  # a space that leads no word
            if pc.any(odd).as_py():
                cut = pc.replace_with_mask(cut, odd, pc.replace_substring_regex(texts.filter(odd), r" ([\pL\pN\pP\pS])", _MARK + r" \1"))
            return pc.split_pattern(pc.replace_substring_regex(cut, _STOP, r"\1" + _MARK + r"\2"), _MARK)
        return pa.LargeListArray.from_arrays(np.arange(len(texts) + 1), texts)

    def holding(self, texts: pa.Array, low: bool = False) -> np.ndarray:
        """Which texts have an added token's string (or, with ``low``, one in lower case)."""
        hit = np.zeros(len(texts), bool)
        for x in self.strings:
            hit |= pc.match_substring(texts, pc.ascii_lower(x).as_py() if low else x).to_numpy(zero_copy_only=False)
        return hit

    def parts(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The texts cut before and after each added token's string, and where each text's parts begin (one more entry than texts)."""
        one = np.arange(len(texts) + 1)
        if self.added is None:
            return texts, one
        hit = self.holding(texts)
        if not hit.any():
            return texts, one
        out, count, last = [], np.ones(len(texts), np.int64), 0
        for i in np.flatnonzero(hit):
            own = pa.array([x for x in self.added.split(texts[i].as_py()) if x], texts.type)
            out += [texts.slice(last, i - last), own]
            count[i], last = len(own), i + 1
        return pa.concat_arrays([*out, texts.slice(last)]), np.concatenate([[0], np.cumsum(count)])

    def encode(self, texts: pa.Array, kept: int = KEPT) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text's begin (one more entry than texts). Texts: not null."""
        texts, first = self.parts(texts)
        lists = self.pieces(texts)
        offsets = (lists.offsets.to_numpy() - lists.offsets[0].as_py())[first]
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False)
        if len(self.known) > kept:
            self.clear()
        place = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        if len(new := np.flatnonzero(place < 0)):
            place[new] = len(self.known) + np.arange(len(new))
            self.add(words[new].tolist())
        at = place[coded.indices.to_numpy(zero_copy_only=False)]
        count = self.length[at]
        ends = np.cumsum(count, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.begin[at] - (ends - count), count) + np.arange(total)]
        return ids, np.concatenate([[0], ends])[offsets]


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One for each worker process; Spark keeps workers from task to task."""
    return Encoder(path)


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The end id after each text's ids."""
    n = len(offsets) - 1
    out = np.full(len(ids) + n, end_id, ids.dtype)
    keep = np.ones(len(out), bool)
    keep[offsets[1:] + np.arange(n)] = False
    out[keep] = ids
    return out, offsets + np.arange(n + 1)


def give_back() -> None:
    """Return freed memory to the system: workers wait for further tasks, and what they hold meanwhile is missing beside them."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def encode_column(texts: pa.Array, path: str, end_id: int, kept: int = KEPT) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place of the first text, ids, offsets) for chunks of a column; null is the empty text. ``kept``: pieces that a worker keeps at most."""
    own = encoder(path)
    for at, part in chunks(texts, 8 << 20):
        yield at, *with_end(*own.encode(part, kept), end_id)
    give_back()
