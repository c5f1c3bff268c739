"""Best-fit decreasing packing of token sequences into fixed windows.

Overlong documents are cut into full windows first; what remains of each is
placed, longest first, into the open window with the least room that holds it.
A segment tree over remaining capacities finds that window.  Each task packs
what it reads, in groups of a bounded number of tokens, so there is no shuffle
and no task grows with the input; a group leaves a window or so part full.

Edge cases: a null or empty text is the end id alone; a document of exactly
one window fills it; repeated rows are packed as rows of their own; an empty
table gives no pieces.  Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .tokens import Encoder, tokenizer_path, worker_encoder

WINDOW = 1024
GROUP_TOKENS = 4 << 20
FLUSH_ROWS = 4096


class OpenWindows:
    """Open windows by remaining capacity, under a segment tree of how many there are."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.stacks: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, by: int) -> None:
        node = room + self.size
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, room: int, window: int) -> None:
        if room:
            self.stacks[room].append(window)
            self._add(room, 1)

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Takes out the window with the least room of at least need: (room, window)."""
        node, count = need + self.size, self.count
        if not count[node]:
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if count[2 * node] else 2 * node + 1
        room = node - self.size
        self._add(room, -1)
        return room, self.stacks[room].pop()


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Window and offset of each item, and the number of windows; equal lengths keep their order."""
    windows, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_windows, opened = OpenWindows(capacity), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        found = open_windows.tightest(need)
        if found is None:
            found = capacity, opened
            opened += 1
        room, windows[i] = found
        offsets[i] = capacity - room
        open_windows.put(room - need, int(windows[i]))
    return windows, offsets, opened


def _pack(batches: Iterator[pa.RecordBatch], encoder: Encoder, window: int, end_id: int, group_tokens: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    sequence = TaskContext.get().partitionId() << 33
    rows: list[tuple] = []
    rest: list[tuple] = []
    held = 0

    def out() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
        rows.clear()
        return batch

    def close() -> Iterator[pa.RecordBatch]:
        nonlocal sequence, held
        windows, offsets, opened = best_fit_decreasing(np.array([len(r[2]) for r in rest], np.int64), window)
        for (doc, start, ids, total), w, at in zip(rest, windows.tolist(), offsets.tolist(), strict=True):
            rows.append((doc, start, len(ids), total, sequence + w, at, ids.astype("<u4").tobytes()))
            if len(rows) >= FLUSH_ROWS:
                yield out()
        sequence, held = sequence + opened, 0
        rest.clear()

    for batch in batches:
        for doc, ids in zip(batch.column(0).to_pylist(), encoder.rows(batch.column(1), end_id), strict=True):
            n = len(ids)
            for start in range(0, n - window + 1, window):
                rows.append((doc, start, window, n, sequence, 0, ids[start : start + window].astype("<u4").tobytes()))
                sequence += 1
            if left := n % window:
                rest.append((doc, n - left, ids[n - left :].copy(), n))
                held += left
            if len(rows) >= FLUSH_ROWS:
                yield out()
            if held >= group_tokens:
                yield from close()
    if rest:
        yield from close()
    if rows:
        yield out()


def _pack_task(batches: Iterator[pa.RecordBatch], path: str, window: int, end_id: int, group_tokens: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    with worker_encoder(path) as encoder:
        yield from _pack(batches, encoder, window, end_id, group_tokens, schema)


def pack(docs: DataFrame, window: int = WINDOW, end_id: int = 0, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """One row per piece: document, start and length in it, its ids (little-endian unsigned 32-bit),
    the document's number of ids, the sequence and the offset there.  A sequence's pieces are gapless from 0."""
    kind = docs.schema[id_col].dataType
    fields = [(id_col, kind), ("start", T.LongType()), ("length", T.LongType()), ("doc_tokens", T.LongType()), ("sequence_id", T.LongType()), ("offset", T.LongType()), ("ids", T.BinaryType())]
    schema = T.StructType([T.StructField(n, t) for n, t in fields])
    arrow = pa.schema([pa.field(n, to_arrow_type(t)) for n, t in fields])
    path = tokenizer_path(tokenizer)
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(lambda batches: _pack_task(batches, path, window, end_id, group_tokens, arrow), schema)
