"""Distinct word shingles of whole texts as sorted 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from . import text as tx

WORDS = 5


def shingle_rows(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles, by row then hash; a row of fewer words has its whole sequence as one."""
    data = tx.LOWER[data]
    starts, ends, first = tx.word_spans(data, offsets)
    hashes = tx.word_hashes(data, starts, ends)
    counts = np.diff(first)
    rows = [np.zeros(0, np.int64)]
    keys = [np.zeros(0, np.uint64)]
    for n in range(1, words + 1):
        if n == words:
            at = tx.within(first, n, len(hashes))
            row = np.searchsorted(first, at, side="right") - 1
        else:
            row = np.flatnonzero(counts == n)
            at = first[:-1][row]
        if len(at):
            rows.append(row)
            keys.append(tx.run_hashes(hashes, n)[at] + np.uint64(n))
    row, key = np.concatenate(rows), np.concatenate(keys)
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    keep = np.append(True, (row[1:] != row[:-1]) | (key[1:] != key[:-1]))[: len(row)]
    return row[keep], key[keep]


def column_shingles(column: pa.Array, words: int = WORDS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For slices of the column: first row, row behind, and shingle_rows with rows counted from the first."""
    offsets, data = tx.column_bytes(column)
    for i, j in tx.slices(offsets):
        yield (i, j, *shingle_rows(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], words))


def signatures(row: np.ndarray, key: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of shingles and a hash of the set of each row."""
    counts = np.bincount(row, minlength=rows)
    total = np.append(np.uint64(0), np.cumsum(tx.mix(key ^ np.uint64(0xA5A5F00DCAFE1234))))
    edge = np.append(0, np.cumsum(counts))
    return counts, tx.mix(total[edge[1:]] - total[edge[:-1]] + counts.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
