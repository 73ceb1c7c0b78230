"""Suffix-array dedup: every byte that a repeated string of ``depth`` bytes covers is removed, by external induced sorting.

A window is a string of ``depth`` bytes of a text. Its anchor is the place of the least hash of the ``GRAM`` bytes that begin there (the first of equal ones), so
equal windows have their anchors at equal places and equal keys (the hash there). The windows of a text with one anchor are a run; its bytes are a
segment. Keys that only one run has need no further look. Of the others, equal segments count as one with a number of copies: the windows of a segment with
copies are repeated. Keys of several segments are sorted: each partition is a shard of segments, whose suffixes ``induced.Shard`` sorts, common
prefixes and all, and neighbours with a common prefix of ``depth`` bytes are equal windows.

A key with over ``most`` segments (a passage in very many surroundings) is dealt out in chunks by the segments' hashes. Each chunk is sorted on its own, and
gives the 128-bit hashes of its different windows; those in several chunks are repeated too.

Texts move once, into buckets; runs are about one in a hundred bytes. Nothing passes through the driver but the number of shared keys; these are broadcast up to
``most_keys``, else joined by shuffle.

Defined results: null text is empty; texts shorter than ``depth`` bytes stay whole; each row is a document of its own, whatever its doc_id (null
and equal ones too); matches never go from one row into another; an empty table gives no rows; other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lemmaflow.llm.common import P, bucketed, heavy_keys, scratch_dir, staged
from lemmaflow.llm.induced import Shard
from lemmaflow.llm.textnum import buffer, chunks, mix, run_hashes

GRAM = 16
#: Bytes of a text that are looked at in one go, and the bits of a place in it.
PIECE, PLACE = 1 << 23, 24
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
SEGMENT = ["key", "segment", "anchor", "windows"]


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` (a power of two) bytes from each place on."""
    h, by, size = data.astype(np.uint64) + np.uint64(1), _MULTIPLIER, 1
    while size < gram:
        h = h[:-size] * by + h[size:] if len(h) > size else h[:0]
        with np.errstate(over="ignore"):
            by, size = by * by, 2 * size
    return mix(h)


def runs(data: np.ndarray, offsets: np.ndarray, depth: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Key, first start, last start and anchor of each run of windows, as places in ``data``; none across two texts."""
    found = []
    for begin in range(0, max(len(data) - depth + 1, 0), PIECE):
        h = _gram_hashes(data[begin : begin + PIECE + depth - 1], gram)
        least = h >> np.uint64(PLACE) << np.uint64(PLACE) | np.arange(len(h), dtype=np.uint64)
        width, size = depth - gram + 1, 1
        while 2 * size <= width:
            least, size = np.minimum(least[:-size], least[size:]), 2 * size
        least = np.minimum(least[: len(least) - (width - size)], least[width - size :])
        at = (least & np.uint64((1 << PLACE) - 1)).astype(np.int64)
        inside = np.zeros(len(at) + 1, np.int8)  # windows that lie within one text
        first = np.clip(offsets[:-1] - begin, 0, len(at))
        last = np.clip(offsets[1:] - depth + 1 - begin, 0, len(at))
        some = last > first
        inside[first[some]], inside[last[some]] = 1, -1
        valid = np.cumsum(inside[:-1], dtype=np.int8) > 0
        cut = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (valid[1:] != valid[:-1])]))
        ends = np.append(cut[1:], len(at)) - 1
        own = valid[cut]
        cut, ends = cut[own], ends[own]
        found.append((h[at[cut]].view(np.int64), cut + begin, ends + begin, at[cut] + begin))
    if not found:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _keys(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part in chunks(batch.column(0), 1 << 22):
                key, n = np.unique(runs(*buffer(part), depth)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["key", "n"])

    return run


def _segments(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in chunks(batch.column(1), 1 << 22):
                data, offsets = buffer(part)
                key, first, last, anchor = runs(data, offsets, depth)
                text = np.searchsorted(offsets, first, "right") - 1
                rows = batch.column(0).slice(at, len(part)).take(pa.array(text))
                columns = [key, run_hashes(data, first, last + depth).view(np.int64), (anchor - first).astype(np.int16), (last - first + 1).astype(np.int16)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), rows, pa.array(first - offsets[text])], names=[*SEGMENT, "row", "start"])

    return run


def _cut(depth: int):
    """The bytes of segments, out of (row, text, list of segments)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat, of = lists.flatten(), np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            own = {n: flat.field(n) for n in (*SEGMENT, "copies", "chunk", "start")}
            start = own.pop("start").to_numpy()
            size = own["windows"].to_numpy().astype(np.int64) + depth - 1
            texts = batch.column(0).cast(pa.large_binary())
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :]
            data = memoryview(texts.buffers()[2]) if texts.buffers()[2] is not None else b""
            begin = offsets[of] + start
            pieces = [bytes(data[a : a + s]) for a, s in zip(begin.tolist(), size.tolist(), strict=True)]
            for a in range(0, len(pieces), 1 << 14):
                yield pa.RecordBatch.from_arrays([x.slice(a, 1 << 14) for x in own.values()] + [pa.array(pieces[a : a + (1 << 14)], pa.binary())], names=[*own, "bytes"])

    return run


FOUND = "key long, segment long, anchor short, windows short, first short, last short, one long, two long"


def _sort(depth: int, folder: str, memory: int):
    """Runs of repeated windows of each segment (first, last); for chunked ones also each different window: its place if it isn't repeated in the chunk, and its hashes."""

    def rows(ids: list[np.ndarray], of: np.ndarray, first, last, one=None, two=None) -> pa.RecordBatch:
        plain = [pa.array(x[of]) for x in ids[:4]] + [pa.array(np.asarray(x, np.int16)) for x in (first, last)]
        hashes = [pa.nulls(len(of), pa.int64()) if x is None else pa.array(x.view(np.int64)) for x in (one, two)]
        return pa.RecordBatch.from_arrays(plain + hashes, names=[*SEGMENT, "first", "last", "one", "two"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts = Shard(depth, depth - GRAM, folder, memory), []
        dealt: list[tuple[np.ndarray, list[bytes] | None, str | None]] = []
        held, n = 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            parts.append([batch.column(i).to_numpy() for i in range(6)])
            segments = batch.column(6).to_pylist()
            shard.add(segments, parts[-1][2].astype(np.int64), parts[-1][3].astype(np.int64))
            at = np.flatnonzero(parts[-1][5] >= 0)
            if len(at):
                own = [segments[i] for i in at.tolist()]
                held += sum(map(len, own))
                kept = held <= memory
                dealt.append((at + n, own if kept else None, None if kept else shard.spill(own)))
            n += len(segments)
        if not parts:
            return
        ids = [np.concatenate(x) for x in zip(*parts, strict=True)]
        copied = ids[4] > 1
        place = np.full(n, -1, np.int64)  # of the windows of chunked segments in ``seen``
        sizes = np.where(ids[5] >= 0, ids[3].astype(np.int64) + 1, 0)
        place[sizes > 0] = (np.cumsum(sizes) - sizes)[sizes > 0]
        seen = np.zeros(int(sizes.sum()) + 1, np.int32)
        for of, first, last in shard.repeated(keep=True):
            whole = ~copied[of]
            yield rows(ids, of[whole], first[whole], last[whole])
            own = place[of] >= 0
            np.add.at(seen, place[of[own]] + first[own], 1)
            np.add.at(seen, place[of[own]] + last[own] + 1, -1)
        again = np.cumsum(seen) > 0
        for at, segments, name in dealt:
            for a in range(0, len(at), 1 << 12):
                own = at[a : a + (1 << 12)]
                text = segments[a : a + (1 << 12)] if segments is not None else shard.spilled(name, a, a + (1 << 12))
                data = np.frombuffer(b"".join(text), np.uint8)
                count = ids[3][own].astype(np.int64)
                begin = np.cumsum(count + depth - 1) - (count + depth - 1)
                of = np.repeat(np.arange(len(own)), count)
                first = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
                starts = begin[of] + first
                one, two = run_hashes(data, starts, starts + depth), run_hashes(data ^ np.uint8(0x5A), starts, starts + depth)
                known = again[place[own[of]] + first] | copied[own[of]]
                yield rows(ids, own[of], np.where(known, -1, first), np.where(known, -1, first), one, two)
        shard.close()

    return run


def _remove(depth: int, at: int):
    """Texts (column ``at``) without their spans (the last column), which goes; bytes, bytes removed and spans removed are added."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(batch.num_columns - 1)
            kept, size, removed, n_spans = [], [], [], []
            for text, own in zip(batch.column(at).cast(pa.large_binary()), spans, strict=True):
                text, merged = text.as_py() or b"", []
                size.append(len(text))
                if own.is_valid:
                    x = own.values
                    starts, ends = x.field("start").to_numpy(), x.field("end").to_numpy()
                    order = np.argsort(starts)
                    starts, ends = starts[order], np.maximum.accumulate(ends[order])
                    new = np.flatnonzero(np.concatenate([[True], starts[1:] > ends[:-1]]))
                    merged = list(zip(starts[new].tolist(), ends[np.append(new[1:], len(ends)) - 1].tolist(), strict=True))
                last, pieces = 0, []
                for a, b in merged:
                    pieces.append(text[last:a])
                    last = b
                kept.append(b"".join([*pieces, text[last:]]))
                removed.append(sum(b - a for a, b in merged))
                n_spans.append(len(merged))
            columns = [pa.array(kept, pa.large_binary()).cast(pa.binary()) if sum(map(len, kept)) < 1 << 31 else pa.array(kept, pa.large_binary()), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64())]
            names = [f.name for f in batch.schema][:-1]
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + columns, names=[*names, f"{P}kept", f"{P}bytes", f"{P}removed", f"{P}spans"])

    return run


def repeated_spans(texts: DataFrame, depth: int = 200, most: int = 1 << 14, most_keys: int = 1 << 22, memory: int = 256 << 20) -> DataFrame:
    """(row, start, end) of repeated strings in ``texts`` (row, text; a table bucketed by ``row``), in bytes. Spans of one row may overlap."""
    text = F.coalesce("text", F.lit(""))
    keys = texts.select(text.alias("text")).mapInArrow(_keys(depth), "key long, n long")
    shared = staged(keys.groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1").select("key"), "keys")
    all_ = texts.select("row", text.alias("text")).mapInArrow(_segments(depth), "key long, segment long, anchor short, windows short, row long, start long")
    own = staged(all_.join(F.broadcast(shared) if shared.count() <= most_keys else shared, "key", "left_semi"), "runs")
    segments = staged(own.groupBy(*SEGMENT).agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("row", "start")).alias("at")), "segments")
    several = segments.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    chunk = F.when(F.col("n") > most, F.pmod(F.xxhash64("segment"), F.ceil(F.col("n") / most))).otherwise(-1).cast("int")
    mixed = segments.join(several, "key").select(F.col("at.row").alias("row"), F.struct(*SEGMENT, "copies", chunk.alias("chunk"), F.col("at.start").alias("start")).alias("s"))
    lists = mixed.groupBy("row").agg(F.collect_list("s").alias("segments"))  # the runs of one text
    cut = texts.select("row", text.alias("text")).join(lists, "row").select("text", "segments").mapInArrow(_cut(depth), "key long, segment long, anchor short, windows short, copies long, chunk int, bytes binary")
    found = staged(cut.repartition("key", "chunk").mapInArrow(_sort(depth, scratch_dir(texts.sparkSession, "suffixes"), memory), FOUND), "found")
    chunked = found.filter("one is not null").select(*SEGMENT, "first", "last", "one", "two", (F.col("anchor") - F.col("first")).alias("distance"))
    # a window that its chunk has several times comes from there several times, but only as known
    meets = chunked.groupBy("key", "one", "two").agg(F.count_if(F.col("first") >= 0).alias("fresh"), F.count_if(F.col("first") < 0).alias("known")).filter("fresh > 1 or (fresh > 0 and known > 0)")
    repeated = found.filter("one is null").select(*SEGMENT, "first", "last").unionByName(chunked.filter("first >= 0").join(meets, ["key", "one", "two"], "left_semi").select(*SEGMENT, "first", "last"))
    repeated = repeated.unionByName(segments.filter("copies > 1").select(*SEGMENT, F.lit(0).cast("short").alias("first"), (F.col("windows") - 1).cast("short").alias("last")))
    hot = F.broadcast(heavy_keys(segments.select(*SEGMENT, F.col("copies").alias("n")), SEGMENT).drop("n"))
    few = F.broadcast(repeated.join(hot, SEGMENT, "left_semi"))  # depth rows for each of 500 segments at most
    spans = own.join(few, SEGMENT).unionByName(own.join(hot, SEGMENT, "left_anti").join(repeated, SEGMENT))
    return spans.select("row", (F.col("start") + F.col("first")).alias("start"), (F.col("start") + F.col("last") + depth).alias("end"))


def dedup(docs: DataFrame, depth: int = 200, **settings) -> DataFrame:
    """``docs`` with ``__lf_kept`` (the remaining bytes, which may cut characters), ``__lf_bytes``, ``__lf_removed`` and ``__lf_spans`` (maximal removed runs)."""
    row = f"{P}row"
    texts = bucketed(docs.withColumn(row, F.monotonically_increasing_id()), "texts", [row])
    spans = repeated_spans(texts.select(F.col(row).alias("row"), "text"), depth, **settings)
    lists = spans.groupBy(F.col("row").alias(row)).agg(F.collect_list(F.struct("start", "end")).alias(f"{P}cut"))  # the runs of one text
    joined = texts.join(lists, row, "left").drop(row)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return joined.mapInArrow(_remove(depth, docs.columns.index("text")), f"{kinds}, {P}kept binary, {P}bytes long, {P}removed long, {P}spans long")
