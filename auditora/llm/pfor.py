"""Token ids as patched frame-of-reference segments, written in ascending document order.

A segment holds whole documents.  Its ids are cut into blocks of 128; a block
stores its minimum and, at the width that a percentile of its differences
needs, every difference; larger ones are exceptions kept in a list of their
own (place in the block, difference).  Layout, little-endian:

  "PFR1", u32 documents, u64 ids, u32 blocks, u32 exceptions
  i64 document ids, u32 ids of each document
  block index: u32 minimum, u64 start of the packed bytes, u8 width, u8 exceptions
  packed words (u64), u8 places and u32 differences of the exceptions

Segments are rows of a Parquet table, so Spark's commit protocol and any
Hadoop file system serve them, and a lost task writes its rows anew.

Edge cases: a null or empty text is the end id alone; equal document ids stay
next to each other, in the order of their texts' hashes; a null document id
comes first; an empty table writes an empty one.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import scratch_path
from .tokens import Encoder, tokenizer_path, worker_encoder

BLOCK = 128
PERCENTILE = 95
SEGMENT_TOKENS = 1 << 20
HEAD = struct.Struct("<4sIQII")
NO_ID = -(1 << 63)


def _widths(values: np.ndarray) -> np.ndarray:
    return np.searchsorted(np.array([1 << k for k in range(33)], np.uint64), values.astype(np.uint64), side="right").astype(np.uint8)


def encode(ids: np.ndarray, doc_ids: np.ndarray, counts: np.ndarray, percentile: int = PERCENTILE) -> bytes:
    """One segment; counts are the ids of each document in order."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    grid = np.empty(blocks * BLOCK, np.uint32)
    grid[:n] = ids
    grid[n:] = ids[-1] if n else 0
    grid = grid.reshape(blocks, BLOCK)
    low = grid.min(axis=1) if blocks else np.zeros(0, np.uint32)
    diff = (grid - low[:, None]).astype(np.uint64)
    rank = -(-BLOCK * percentile // 100) - 1
    width = _widths(np.partition(diff, rank, axis=1)[:, rank]) if blocks else np.zeros(0, np.uint8)
    over = diff >> width[:, None].astype(np.uint64) > 0
    begin = np.append(0, np.cumsum(2 * width.astype(np.int64)))
    words = np.zeros(begin[-1], np.uint64)
    for w in np.unique(width[width > 0]).tolist():
        rows = np.flatnonzero(width == w)
        values = (diff[rows] & np.uint64((1 << w) - 1)).reshape(len(rows), 2, 64)
        packed = np.zeros((len(rows), 2, w), np.uint64)
        for i in range(64):
            at, shift = divmod(i * w, 64)
            packed[:, :, at] |= values[:, :, i] << np.uint64(shift)
            if shift + w > 64:
                packed[:, :, at + 1] |= values[:, :, i] >> np.uint64(64 - shift)
        words[begin[rows][:, None] + np.arange(2 * w)] = packed.reshape(len(rows), 2 * w)
    index = np.zeros(blocks, np.dtype([("low", "<u4"), ("at", "<u8"), ("width", "u1"), ("over", "u1")]))
    index["low"], index["at"], index["width"], index["over"] = low, 8 * begin[:-1], width, over.sum(axis=1)
    places = np.nonzero(over)[1].astype(np.uint8)
    return b"".join((HEAD.pack(b"PFR1", len(doc_ids), n, blocks, len(places)), doc_ids.astype("<i8").tobytes(), counts.astype("<u4").tobytes(), index.tobytes(), words.astype("<u8").tobytes(), places.tobytes(), diff[over].astype("<u4").tobytes()))


def decode(segment: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, document ids and ids of each document."""
    magic, docs, n, blocks, exceptions = HEAD.unpack_from(segment)
    if magic != b"PFR1":
        raise ValueError("not a segment of token ids")
    at = HEAD.size

    def take(kind: object, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(segment, kind, count, at)
        at += out.nbytes
        return out

    doc_ids, counts = take("<i8", docs), take("<u4", docs)
    index = take(np.dtype([("low", "<u4"), ("at", "<u8"), ("width", "u1"), ("over", "u1")]), blocks)
    width = index["width"]
    words = take("<u8", int(2 * width.astype(np.int64).sum()))
    places, extra = take("u1", exceptions), take("<u4", exceptions)
    begin = (index["at"] // 8).astype(np.int64)
    diff = np.zeros((blocks, BLOCK), np.uint64)
    for w in np.unique(width[width > 0]).tolist():
        rows = np.flatnonzero(width == w)
        packed = words[begin[rows][:, None] + np.arange(2 * w)].reshape(len(rows), 2, w)
        values = np.empty((len(rows), 2, 64), np.uint64)
        for i in range(64):
            k, shift = divmod(i * w, 64)
            values[:, :, i] = packed[:, :, k] >> np.uint64(shift)
            if shift + w > 64:
                values[:, :, i] |= packed[:, :, k + 1] << np.uint64(64 - shift)
        diff[rows] = (values & np.uint64((1 << w) - 1)).reshape(len(rows), BLOCK)
    diff[np.repeat(np.arange(blocks), index["over"]), places] = extra
    ids = (diff + index["low"].astype(np.uint64)[:, None]).astype(np.uint32).ravel()[:n]
    return ids, doc_ids, counts


SEGMENTS = "part int, segment int, part_start long, n_tokens long, n_docs long, payload binary"


def _segments(batches: Iterator[pa.RecordBatch], encoder: Encoder, end_id: int, limit: int) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    held: list[np.ndarray] = []
    names: list[int] = []
    tokens = start = segment = 0

    def close() -> pa.RecordBatch:
        nonlocal tokens, start, segment
        payload = encode(np.concatenate(held), np.array(names, np.int64), np.array([len(x) for x in held]))
        row = pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([start], pa.int64()), pa.array([tokens], pa.int64()), pa.array([len(names)], pa.int64()), pa.array([payload], pa.binary())], names=["part", "segment", "part_start", "n_tokens", "n_docs", "payload"])
        start, segment, tokens = start + tokens, segment + 1, 0
        held.clear()
        names.clear()
        return row

    for batch in batches:
        for doc, ids in zip(batch.column(0).to_pylist(), encoder.rows(batch.column(1), end_id), strict=True):
            if held and tokens + len(ids) > limit:
                yield close()
            held.append(ids)
            names.append(NO_ID if doc is None else doc)
            tokens += len(ids)
    if held:
        yield close()


def _encode_task(batches: Iterator[pa.RecordBatch], path: str, end_id: int, limit: int) -> Iterator[pa.RecordBatch]:
    with worker_encoder(path) as encoder:
        yield from _segments(batches, encoder, end_id, limit)


def write_token_ids(docs: DataFrame, path: str, end_id: int = 0, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", segment_tokens: int = SEGMENT_TOKENS) -> None:
    """Encodes whole texts and writes their ids as segments in ascending id order."""
    vocabulary = tokenizer_path(tokenizer)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"))
    rows.mapInArrow(lambda batches: _encode_task(batches, vocabulary, end_id, segment_tokens), SEGMENTS).write.option("compression", "uncompressed").parquet(path)


def _decode_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, begin, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            ids, doc_ids, counts = decode(payload.as_buffer())
            edges = np.append(0, np.cumsum(counts, dtype=np.int64))
            for i in range(0, len(doc_ids), 2048):
                span = range(i, min(i + 2048, len(doc_ids)))
                names = doc_ids[span.start : span.stop]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(span), part, np.int32)), pa.array(names, mask=names == NO_ID), pa.array(begin + edges[span.start : span.stop]), pa.array(counts[span.start : span.stop].astype(np.int64)), pa.array([ids[edges[k] : edges[k + 1]].astype("<u4").tobytes() for k in span], pa.binary())],
                    names=["part", "doc_id", "part_start", "n_tokens", "ids"],
                )


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (little-endian unsigned 32-bit) from the files.

    The offsets of the write's partitions are one row each, at most as many as the write had tasks."""
    segments = spark.read.schema(SEGMENTS).parquet(path)
    totals = segments.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("part_offset"))
    docs = segments.select("part", "part_start", "payload").mapInArrow(_decode_task, "part int, doc_id long, part_start long, n_tokens long, ids binary")
    return docs.join(F.broadcast(offsets), "part").select("doc_id", (F.col("part_offset") + F.col("part_start")).alias("start"), "n_tokens", "ids")


def round_trip(docs: DataFrame, **options: object) -> DataFrame:
    """Writes the ids to a new table in the shared folder and reads them back."""
    path = scratch_path(docs.sparkSession, "token-ids")
    write_token_ids(docs, path, **options)
    return read_token_ids(docs.sparkSession, path)


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
