"""Spelling variant grouping: near words (one code point inserted, deleted or replaced) by two-dimensional range reporting.

Words are sorted by (length, word) and by (length, reversed word). For an edit at a place of a word, what stands before it is an interval in the one
order and what stands after it is one in the other; the words in both are the results. A wavelet tree over the ranks in the second order reports them.

The dictionary is dealt out in blocks of at most ``block`` words in a row, once in each order; a block has a tree of its own. An edit in the second half of a word is
looked up where its beginning is an interval of the first order's blocks, one in the first half where its end is an interval of the second's, as these are narrow; if one spans
more than two blocks and the other spans fewer, the other is taken. So a block gets the words that it shares a long beginning or end with. Only the blocks'
first words are on the driver (one word in ``block``, and one for each partition).

A word's form is its near word with the largest count (ties: the smallest in code-point order), if that is ``ratio`` times its own at least; a root is where the forms lead to. As
counts grow by this factor at every step, chains are short and a few doublings end them.

Defined results: null texts have no words; a null doc_id is the empty text where it is hashed; repeated rows and equal ids count each; an empty table gives no
rows; very long texts are counted piece by piece; other columns aren't read.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lemmaflow.llm.common import staged
from lemmaflow.llm.wavelet import WaveletTree

RUN = re.compile("[A-Za-zÀ-ÿ]+")
GAP = re.compile("[^A-Za-zÀ-ÿ]")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: One run in so many loses a code point.
CUT = 199
TOP = "\U0010ffff"


def runs_of(text: str, piece: int = 1 << 20) -> Counter[str]:
    """How often each run of letters occurs; no run is cut."""
    found, at = Counter(), 0
    while at < len(text):
        end = GAP.search(text, at + piece) if at + piece < len(text) else None
        end = end.start() if end else len(text)
        found.update(RUN.findall(text, at, end))
        at = end
    return found


def words_of(doc_id: int | None, text: str, least: int) -> Iterator[tuple[str, int]]:
    """The words of a document that have ``least`` code points, and their counts; a word may come twice."""
    begun = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in runs_of(text).items():
        word = run.translate(LOWER)
        h = zlib.crc32(word.encode(), begun)
        if h % CUT == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        if len(word) >= least:
            yield word, n


def word_counts(docs: DataFrame, least: int = 6, times: int = 5, most: int = 1 << 17) -> DataFrame:
    """(word, n) of words that occur ``times`` times. ``most``: different words that a task keeps before it passes them on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for word, n in words_of(doc_id, text.as_py() or "", least):
                    total[word] += n
                if len(total) >= most:
                    yield out()
                    total.clear()
        yield out()

    return docs.select("doc_id", "text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= times)


def _first_words(words: DataFrame, block: int) -> list[tuple[int, str]]:
    """The first (length, word) of each block, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            at = np.arange(-seen % block, batch.num_rows, block)
            yield batch.take(pa.array(at))
            seen += batch.num_rows

    rows = words.select(F.length("word").alias("size"), "word").repartitionByRange("size", "word").sortWithinPartitions("size", "word").mapInArrow(run, "size int, word string")
    return sorted((r["size"], r["word"]) for r in rows.collect())


class Blocks:
    """The blocks of one order."""

    def __init__(self, first: list[tuple[int, str]]):
        self.first = first

    def of(self, word: str) -> int:
        return max(bisect_right(self.first, (len(word), word)) - 1, 0)

    def range(self, size: int, prefix: str) -> tuple[int, int]:
        """The first and the last block that may have words of this size and prefix."""
        return max(bisect_right(self.first, (size, prefix)) - 1, 0), max(bisect_right(self.first, (size, prefix + TOP)) - 1, 0)


def _places(word: str) -> Iterator[tuple[int, int, str, str]]:
    """(code, size, what stands before, what stands after, reversed) of each edit: code 2 * i to replace the i-th code point, 2 * i + 1 to insert one before it."""
    n, back = len(word), word[::-1]
    for i in range(n + 1):
        if i < n:
            yield 2 * i, n, word[:i], back[: n - i - 1]
        yield 2 * i + 1, n + 1, word[:i], back[: n - i]


def _dealt(word: str, sides: tuple[Blocks, Blocks]) -> dict[tuple[int, int], list[int]]:
    """The edits to look up, by order (0 or 1) and block."""
    out: dict[tuple[int, int], list[int]] = defaultdict(list)
    for code, size, before, after in _places(word):
        side = int(len(before) < len(after))
        a, b = sides[side].range(size, after if side else before)
        if b - a > 1:
            c, d = sides[1 - side].range(size, before if side else after)
            if d - c < b - a:
                side, a, b = 1 - side, c, d
        for block in range(a, b + 1):
            out[side, block].append(code)
    return out


class Block:
    """Some words in both orders, with a tree over their ranks in the second one."""

    def __init__(self, words: list[str]):
        self.words = sorted(words, key=lambda w: (len(w), w))
        back = [w[::-1] for w in self.words]
        order = sorted(range(len(back)), key=lambda i: (len(back[i]), back[i]))
        self.order = np.array(order, np.int64)
        rank = np.empty(len(order), np.int64)
        rank[self.order] = np.arange(len(order))
        self.tree = WaveletTree(rank)
        self.sizes: dict[int, tuple[int, list[str], list[str]]] = {}
        first = 0
        for size, n in sorted(Counter(map(len, self.words)).items()):
            self.sizes[size] = first, self.words[first : first + n], [back[i] for i in order[first : first + n]]
            first += n

    def near(self, queries: list[tuple[str, list[int]]]) -> Iterator[tuple[int, int, int]]:
        """(number of the query, code of the edit, index of the word) for each edit of a query that leads to a word."""
        of, codes, ranges = [], [], []
        for q, (word, wanted) in enumerate(queries):
            back = word[::-1]
            for code in wanted:
                i, inserts = divmod(code, 2)
                own = self.sizes.get(len(word) + inserts)
                if own is None:
                    continue
                first, forward, backward = own
                before, after = word[:i], back[: len(word) - i - 1 + inserts]
                a, b = bisect_left(forward, before), bisect_right(forward, before + TOP)
                if a >= b:
                    continue
                c, d = bisect_left(backward, after), bisect_right(backward, after + TOP)
                if c < d:
                    of.append(q)
                    codes.append(code)
                    ranges.append((first + a, first + b, first + c, first + d))
        if ranges:
            found, rank = self.tree.report(*np.array(ranges, np.int64).T)
            for k, w in zip(found.tolist(), self.order[rank].tolist(), strict=True):
                yield of[k], codes[k], w


def near_words(words: DataFrame, block: int = 1 << 12) -> DataFrame:
    """(word, n, near, near_n), a row for each ordered pair of near words. ``words``: (word, n), a table."""
    first = _first_words(words, block), _first_words(words.select(F.reverse("word").alias("word")), block)
    shared = words.sparkSession.sparkContext.broadcast((Blocks(first[0]), Blocks(first[1])))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = shared.value
        for batch in batches:
            rows = []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows += [(0, sides[0].of(word), word, n, None), (1, sides[1].of(word[::-1]), word, n, None)]
                rows += [(side, at, word, n, codes) for (side, at), codes in _dealt(word, sides).items()]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["side", "block", "word", "n", "codes"])

    def look(group: pa.Table) -> pa.Table:
        words, counts, codes = (group.column(c).to_pylist() for c in ("word", "n", "codes"))
        own = {w: n for w, n, c in zip(words, counts, codes, strict=True) if c is None}
        asked = [(w, n, c) for w, n, c in zip(words, counts, codes, strict=True) if c is not None]
        rows = []
        if own:
            here = Block(list(own))
            for q, code, w in here.near([(x, c) for x, _, c in asked]):
                (word, n, _), found = asked[q], here.words[w]
                i, inserts = divmod(code, 2)
                if inserts:  # of equal code points in a row the last is the inserted one, so each pair is found once
                    if i == len(word) or found[i] != word[i]:
                        rows += [(word, n, found, own[found]), (found, own[found], word, n)]
                elif found != word:
                    rows.append((word, n, found, own[found]))
        columns = list(zip(*rows, strict=True)) or [()] * 4
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["word", "n", "near", "near_n"])

    dealt = words.select("word", "n").mapInArrow(deal, "side int, block int, word string, n long, codes array<int>")
    return dealt.groupBy("side", "block").applyInArrow(look, "word string, n long, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: (word, form), a table."""
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = staged(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if now.filter("moved").isEmpty():
            return now.select("word", "root")
        now = now.drop("moved")


def grouped(docs: DataFrame, least: int = 6, times: int = 5, ratio: int = 5, block: int = 1 << 12) -> DataFrame:
    """word, n, form, root, n_near and form_n of every word."""
    words = staged(word_counts(docs, least, times), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")
    near = near_words(words, block).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    enough = F.coalesce(-F.col("best.less") >= ratio * F.col("n"), F.lit(False))
    rows = words.join(near, "word", "left").select("word", "n", F.when(enough, F.col("best.near")).alias("form"), F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(enough, -F.col("best.less")).alias("form_n"))
    rows = staged(rows, "forms")
    found = rows.join(roots(rows.filter("form is not null").select("word", "form")), "word", "left")
    return found.select("word", "n", "form", F.coalesce("root", "word").alias("root"), "n_near", "form_n")
