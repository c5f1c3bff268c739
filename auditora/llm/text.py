"""Vectorised word spans and 64-bit hashes over Arrow string columns.

Everything here works on the UTF-8 bytes of a column, a slice of a few
documents at a time, so memory stays bounded whatever a batch holds.  A word
is a run of bytes other than 0x20 and 0x09-0x0D.  Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the word."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


STEP = 0x9E3779B97F4A7C15
STEP_INV = pow(STEP, -1, 1 << 64)
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, U(base % (1 << 64)))
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


# Masks of the first 0 to 8 bytes of a little-endian word.
_COVER = np.array([(1 << 8 * k) - 1 for k in range(9)], U)
_SALT = 0xA0761D6478BD642F
CHUNK_BLOCKS = 1 << 18


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (rows + 1) and bytes of a string column, nulls as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if len(column) and column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return offsets, data


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most limit bytes, one row at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = j


def word_spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SEPARATOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words, and each row's first word (rows + 1); offsets begin at 0."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = ~separator[data]
    begins = np.empty(len(data), bool)
    begins[0], begins[1:] = True, ~solid[:-1]
    stops = np.empty(len(data), bool)
    stops[-1], stops[:-1] = True, ~solid[1:]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] = True
    inner = offsets[1:][offsets[1:] > 0]
    stops[inner - 1] = True
    starts = np.flatnonzero(begins & solid)
    ends = np.flatnonzero(stops & solid) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _eights(data: np.ndarray) -> np.ndarray:
    """The little-endian 64-bit word at every byte, zeros behind the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def _later_blocks(lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(span, block, edges) of the 8-byte blocks after each span's first, some at a time; edges begin a span's run."""
    long = np.flatnonzero(lengths > 8)
    stop = np.cumsum((lengths[long] - 1) >> 3)
    for a in range(0, int(stop[-1]) if len(long) else 0, CHUNK_BLOCKS):
        at = np.arange(a, min(a + CHUNK_BLOCKS, int(stop[-1])))
        k = np.searchsorted(stop, at, side="right")
        block = at - np.append(0, stop)[k] + 1
        yield long[k], block, np.flatnonzero(np.append(True, k[1:] != k[:-1]))


def span_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each span: its 8-byte blocks are mixed, with their place, before they are summed.

    Hashes of different seeds are independent."""
    eights, salt = _eights(data), mix(np.array([seed + 1], U) * U(_SALT))[0]
    sums = mix((eights[starts] & _COVER[np.minimum(lengths, 8)]) ^ salt)
    for span, block, edges in _later_blocks(lengths):
        value = eights[starts[span] + 8 * block] & _COVER[np.minimum(lengths[span] - 8 * block, 8)]
        sums[span[edges]] += np.add.reduceat(mix(mix(value ^ salt) + block.astype(U) * U(STEP)), edges)
    return mix(sums + lengths.astype(U) * U(0xD6E8FEB86659FD93))


def same_spans(data: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the spans of equal lengths that begin at a and at b hold the same bytes."""
    eights = _eights(data)
    out = ((eights[a] ^ eights[b]) & _COVER[np.minimum(lengths, 8)]) == 0
    for span, block, _ in _later_blocks(lengths):
        differ = ((eights[a[span] + 8 * block] ^ eights[b[span] + 8 * block]) & _COVER[np.minimum(lengths[span] - 8 * block, 8)]) != 0
        out[span[differ]] = False
    return out


def distinct_spans(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One span of each distinct content, and for every span which of them it equals; bytes are compared."""
    _, first, inverse = np.unique(span_hashes(data, starts, lengths), return_index=True, return_inverse=True)
    own = first[inverse]
    if (lengths == lengths[own]).all() and same_spans(data, starts, starts[own], lengths).all():
        return first, inverse
    seen: dict[bytes, int] = {}
    raw, at = data.tobytes(), []
    inverse = np.empty(len(starts), np.int64)
    for k, (s, n) in enumerate(zip(starts.tolist(), lengths.tolist(), strict=True)):
        inverse[k] = seen.setdefault(raw[s : s + n], len(seen))
        if len(at) < len(seen):
            at.append(k)
    return np.array(at, np.int64), inverse


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hashes(data, starts, ends - starts)


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words (position = first of them)."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, U)
    if n <= 16:
        out = words[:count].copy()
        for k in range(1, n):
            out *= U(STEP)
            out += words[k : k + count]
        return mix(out)
    total = np.zeros(len(words) + 1, U)
    np.cumsum(words * powers(STEP, len(words)), out=total[1:])
    return mix((total[n:] - total[:-n]) * powers(STEP_INV, count))


def within(first_word: np.ndarray, n: int, total: int) -> np.ndarray:
    """Positions whose n words lie in one row, given each row's first word (rows + 1)."""
    ok = np.zeros(max(0, total - n + 1), np.int8)
    if not len(ok):
        return np.zeros(0, np.int64)
    lo, hi = first_word[:-1], first_word[1:] - n + 1
    keep = hi > lo
    delta = np.zeros(len(ok) + 1, np.int32)
    np.add.at(delta, lo[keep], 1)
    np.add.at(delta, hi[keep], -1)
    return np.flatnonzero(np.cumsum(delta[:-1]))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def join_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: np.ndarray, rows: int) -> pa.Array:
    """One string for each of rows rows: its words (row ascends), joined by single spaces."""
    lengths = ends - starts
    last = np.append(row[1:] != row[:-1], True)[: len(row)]
    room = lengths + ~last
    stop = np.cumsum(room)
    out = np.full(int(stop[-1]) if len(stop) else 0, 0x20, np.uint8)
    inside = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(stop - room, lengths) + inside] = data[np.repeat(starts, lengths) + inside]
    offsets = np.append(0, np.cumsum(np.bincount(row, weights=room, minlength=rows))).astype(np.int64)
    return pa.LargeStringArray.from_buffers(rows, pa.py_buffer(offsets), pa.py_buffer(out)).cast(pa.string())
