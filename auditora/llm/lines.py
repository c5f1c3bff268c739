"""Line deduplication by overlapping windows of three lines.

Every three consecutive lines of a document are a window.  Of all occurrences
of a window in the corpus the first (smallest document, then place) stays; the
lines that any later occurrence covers go, merged over overlapping windows.
Windows are judged on the input.  A window whose lines are all blank counts
for nothing, and documents of fewer lines than a window stay as they are.

Edge cases: a null text stays null, with no lines; an empty one has one empty
line; rows that repeat both id and text count as one document, and each gets its
result; an empty table gives no rows; a line of any length is hashed whole.  Other
columns pass through; where one is called n_lines or n_removed, the operator's
own comes with an underscore behind its name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .shared import free_name, written

WINDOW = 3
SEEDS = (1, 2)


def line_windows(data: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """row, place (from 1) and two 64-bit hashes of the windows that are not blank; offsets begin at 0."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    # Every line with a line feed behind it, so that empty ones have a byte too.
    rows = len(offsets) - 1
    full = np.insert(data, offsets[1:], 0x0A)
    stop = offsets[1:] + np.arange(1, rows + 1)
    ends = np.flatnonzero(full == 0x0A) + 1
    starts = np.append(0, ends[:-1])
    first = np.append(0, np.searchsorted(ends, stop, side="right"))
    at = tx.within(first, window, len(starts))
    if not len(at):
        return at, at, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    solid = np.append(0, np.cumsum(~tx.SEPARATOR[full]))
    at = at[solid[ends[at + window - 1]] > solid[starts[at]]]
    hashes = [tx.run_hashes(tx.span_hashes(full, starts, ends - starts, seed), window)[at] for seed in SEEDS]
    row = np.searchsorted(first, at, side="right") - 1
    return row, at - first[row] + 1, hashes[0], hashes[1]


def _window_task(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, data = tx.column_bytes(batch.column(2))
        for i, j in tx.slices(offsets):
            row, place, h1, h2 = line_windows(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], window)
            if len(row):
                take = pa.array(row + i)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(place.astype(np.int32)), pa.array(tx.signed(h1)), pa.array(tx.signed(h2))], names=["id", "hash", "place", "h1", "h2"])


def dedup_lines(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the text of the kept lines, and n_lines and n_removed (or their free names).

    Occurrences travel as hashes and places; the texts are shuffled once, to meet the places to remove.
    Hot windows are pre-aggregated to their first occurrence, a table of its own, so that Spark may split the join back."""
    keyed = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    found = keyed.select("id", "hash", "text").mapInArrow(lambda b: _window_task(b, window), f"id {kind}, hash long, place int, h1 long, h2 long")
    # A null id sorts first, as in Spark's own order of structs.
    here = F.struct("id", "hash", "place")
    first = written(found.groupBy("h1", "h2").agg(F.min(here).alias("first"), F.count("*").alias("n")).filter(F.col("n") > 1).select("h1", "h2", "first"), "repeated-windows")
    later = found.join(first, ["h1", "h2"]).filter(here > F.col("first")).select("id", "hash", "place")
    # Places of one document at most, as long as its own lines.
    gone = later.groupBy("id", "hash").agg(F.collect_set("place").alias("places"))
    joined = keyed.alias("d").join(gone.alias("g"), F.col("d.id").eqNullSafe(F.col("g.id")) & F.col("d.hash").eqNullSafe(F.col("g.hash")), "left").select("d.row", "d.text", "g.places")
    lines = F.split("text", "\n", -1)
    covered = F.array_distinct(F.flatten(F.transform(F.col("places"), lambda p: F.sequence(p, p + (window - 1)))))
    n_lines = F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1
    kept = F.transform(F.array_except(F.sequence(F.lit(1), F.size(lines)), covered), lambda i: F.element_at(lines, i))
    text = F.when(F.col("places").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(n_lines).cast("long").alias(free_name("n_lines", docs.columns))
    n_removed = F.coalesce(F.size(covered), F.lit(0)).cast("long").alias(free_name("n_removed", docs.columns))
    own = [text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns]
    return joined.select(*own, n_lines, n_removed)
