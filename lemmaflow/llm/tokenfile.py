"""Token-ID output: frequency-ranked ids in a byte-aligned variable-length code with separate control bytes.

The format is a folder with two Parquet tables. ``ranks``: the token id of each rank; rank 0 is the most frequent id.
``blocks``: whole documents in ascending doc_id order, about a million ids a row. A block has the documents' ids and numbers
of tokens, two control bits for each token (its rank's bytes less 1, four to a byte, the first in the low bits) and, apart
from them, the ranks' bytes, little-endian. A table of 256 rows gives the four lengths of a control byte, so numpy decodes a block
without a loop over tokens. ``shard``, ``block`` and ``start`` place a block; Spark's own commit makes the writing safe
when executors are lost.

Defined results: null text is the empty text (the end id alone); null doc_ids come first; documents of equal doc_id
are ordered by their numbers of tokens and checksums; an empty table makes an empty file set; other columns aren't read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lemmaflow.llm.common import P, scratch_dir
from lemmaflow.llm.tokens import encode_column

#: Pieces of text that a worker keeps at most; nothing else here needs its memory.
KEPT = 1_000_000

BLOCK = 1 << 20
#: Lengths in bytes of the four codes that a control byte stands for.
LENGTHS = np.stack([(np.arange(256) >> shift & 3) + 1 for shift in (0, 2, 4, 6)], axis=1).astype(np.int64)
_BLOCKS = "shard int, block int, start long, n_ids long, doc_ids array<long>, doc_tokens array<int>, control binary, data binary"


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes."""
    ranks = ranks.astype(np.uint32)
    more = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    control = np.concatenate([more, np.zeros(-len(more) % 4, np.uint8)]).reshape(-1, 4)
    control = control[:, 0] | control[:, 1] << 2 | control[:, 2] << 4 | control[:, 3] << 6
    ends = np.cumsum(more.astype(np.int64) + 1)
    data = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    begin = ends - more - 1
    data[begin] = ranks & 0xFF
    for k in (1, 2, 3):
        at = np.flatnonzero(more >= k)
        data[begin[at] + k] = ranks[at] >> (8 * k) & 0xFF
    return control.astype(np.uint8).tobytes(), data.tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    length = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    data = np.frombuffer(data, np.uint8)
    begin = np.cumsum(length) - length
    out = data[begin].astype(np.uint32)
    for k in (1, 2, 3):
        at = np.flatnonzero(length > k)
        if not len(at):
            break
        out[at] |= data[begin[at] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def _tokenized(df: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, ids, offsets in encode_column(batch.column(1), tokenizer, end_id, KEPT):
                kind = np.uint16 if len(ids) == 0 or ids.max() < 1 << 16 else np.uint32
                raw, n = ids.astype(kind).tobytes(), np.diff(offsets)
                size = kind().itemsize
                parts = [raw[a * size : b * size] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(n)), pa.array(n, pa.int64()), pa.array([zlib.crc32(p) for p in parts], pa.int64()), pa.array(np.full(len(n), size), pa.int32()), pa.array(parts, pa.binary())], names=["doc_id", "n", "crc", "width", "ids"])

    return df.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n long, crc long, width int, ids binary")


def _ids(width: int, raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint16 if width == 2 else np.uint32)


def _counts(tokens: DataFrame) -> DataFrame:
    """How often each id occurs; each task sends a row an id at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for width, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = raw.as_buffer()
                if len(ids := _ids(width, raw)):
                    own = np.bincount(ids, minlength=len(total))
                    own[: len(total)] += total
                    total = own
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["id", "n"])

    return tokens.select("width", "ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def _rank_table(counts: DataFrame, most: int) -> np.ndarray:
    """The id of each rank. The vocabulary bounds the rows: the tokenizer's size is checked against ``most``."""
    rows = counts.orderBy(F.desc("n"), "id").limit(most + 1).toArrow()
    if rows.num_rows > most:
        raise ValueError(f"more than {most} different ids")
    return rows.column("id").to_numpy().astype(np.uint32)


def write_token_files(df: DataFrame, path: str, tokenizer: str, *, end_id: int = 1, vocabulary: int = 1 << 20) -> None:
    """Tokenize ``df`` (doc_id, text) and write it under ``path``. ``vocabulary``: most ids that a tokenizer may have."""
    spark = df.sparkSession
    raw = scratch_dir(spark, "ids")
    _tokenized(df, tokenizer, end_id).write.option("compression", "zstd").parquet(raw)
    tokens = spark.read.parquet(raw)
    ids = _rank_table(_counts(tokens), vocabulary)
    spark.createDataFrame(pa.table({"rank": pa.array(np.arange(len(ids)), pa.int64()), "id": pa.array(ids, pa.int64())})).coalesce(1).write.parquet(f"{path}/ranks")
    rank = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.uint32)
    rank[ids] = np.arange(len(ids), dtype=np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, block, start = TaskContext.get().partitionId(), 0, 0
        docs: list = []
        held: list[np.ndarray] = []
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal block, start, size
            if docs:
                control, data = encode_ranks(rank[np.concatenate(held)])
                values = [[shard], [block], [start], [size], [list(docs)], [[len(x) for x in held]], [control], [data]]
                kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=[x.split()[0] for x in _BLOCKS.split(", ")])
                block, start, size = block + 1, start + size, 0
                docs.clear()
                held.clear()

        for batch in batches:
            for doc, width, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                docs.append(doc)
                held.append(_ids(width, raw))
                size += len(held[-1])
                if size >= BLOCK:
                    yield from out()
        yield from out()

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = tokens.repartitionByRange(n, F.col("doc_id").asc_nulls_first(), "n", "crc").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "n", "crc")
    ordered.select("doc_id", "width", "ids").mapInArrow(run, _BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")


def read_token_files(spark: SparkSession, path: str, *, with_ids: bool = True) -> DataFrame:
    """One row a document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, unless dropped, ids (uint32, little-endian)."""
    ids = spark.read.parquet(f"{path}/ranks").orderBy("rank").toArrow().column("id").to_numpy().astype("<u4")
    schema = f"doc_id long, {P}shard int, {P}start long, n_tokens long, ids_crc32 long, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                raw = ids[decode_ranks(row["control"], row["data"], row["n_ids"])].tobytes()
                n = np.array(row["doc_tokens"], np.int64)
                ends = np.cumsum(n)
                parts = [raw[4 * a : 4 * b] for a, b in zip(ends - n, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(np.full(len(n), row["shard"]), pa.int32()), pa.array(ends - n + row["start"], pa.int64()), pa.array(n, pa.int64()), pa.array([zlib.crc32(p) for p in parts], pa.int64()), pa.array(parts if with_ids else [None] * len(n), pa.binary())],
                    names=[x.split()[0] for x in schema.split(", ")],
                )

    blocks = spark.read.parquet(f"{path}/blocks")
    # one row a shard, as many as the writer had partitions
    base = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).select(F.col("shard").alias(f"{P}shard"), (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias(f"{P}base"))
    rows = blocks.mapInArrow(run, schema).join(F.broadcast(base), f"{P}shard").select("doc_id", (F.col(f"{P}base") + F.col(f"{P}start")).alias("start"), "n_tokens", "ids_crc32", "ids")
    return rows if with_ids else rows.drop("ids")
