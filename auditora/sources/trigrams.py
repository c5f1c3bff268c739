"""Which files of a stored table can hold a text: a bitmap of byte trigrams for each file, consulted before any is read.

A bitmap is kept in parts of 4,096 bytes, so that Spark's own bitmap aggregate
joins what several tasks saw of one file.  A LIKE pattern's literal parts give
the trigrams that a matching row must hold; a file without one of them is not
read.  Files that the index does not know are always read, so counts stay right
whatever has been written since.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PART_BITS = 8 * 4096
PARTS = 32
SLICE_BYTES = 1 << 20


def positions(data: np.ndarray) -> np.ndarray:
    """Distinct bit positions of the trigrams of some bytes."""
    if len(data) < 3:
        return np.zeros(0, np.int64)
    wide = data.astype(np.uint64)
    # An odd factor spreads neighbours; the high bits choose the place.
    return np.unique(((wide[:-2] << np.uint64(16) | wide[1:-1] << np.uint64(8) | wide[2:]) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - (PARTS * PART_BITS - 1).bit_length())).astype(np.int64)


def _task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bitmaps of the files of a task, in parts that are not empty; a task's rows come file by file."""
    name, bits = None, np.zeros(PARTS * PART_BITS, bool)

    def parts() -> Iterator[pa.RecordBatch]:
        for k in np.unique(np.flatnonzero(bits) // PART_BITS).tolist():
            packed = np.packbits(bits[k * PART_BITS : (k + 1) * PART_BITS], bitorder="little")
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([k], pa.int32()), pa.array([packed.tobytes()])], names=["arquivo", "parte", "bits"])

    for batch in batches:
        for file, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if file != name:
                if name is not None:
                    yield from parts()
                name, bits = file, np.zeros(PARTS * PART_BITS, bool)
            raw = np.frombuffer(text.as_buffer(), np.uint8) if text.is_valid else np.zeros(0, np.uint8)
            for a in range(0, len(raw), SLICE_BYTES):
                bits[positions(raw[a : a + SLICE_BYTES + 2])] = True
    if name is not None:
        yield from parts()


def _file() -> Column:
    return F.input_file_name()


def write_index(spark: SparkSession, table: str, index: str, content: str = "conteudo") -> None:
    """Adds the files of a table that the index at a path does not hold yet."""
    rows = spark.read.parquet(table)
    fresh = sorted(set(rows.inputFiles()) - _indexed(spark, index))
    if not fresh:
        return
    rows = spark.read.schema(rows.schema).parquet(*fresh)
    seen = rows.select(_file().alias("arquivo"), F.col(content).cast("string").alias("texto")).mapInArrow(_task, "arquivo string, parte int, bits binary")
    # One row a file and part, and one that says a file is known, for those without a row too.
    merged = seen.groupBy("arquivo", "parte").agg(F.bitmap_or_agg("bits").alias("bits"))
    every = spark.createDataFrame([(name, -1, None) for name in fresh], "arquivo string, parte int, bits binary")
    merged.unionByName(every).write.mode("append").parquet(index)


def _indexed(spark: SparkSession, index: str) -> set[str]:
    try:
        return {r.arquivo for r in spark.read.parquet(index).filter("parte = -1").select("arquivo").collect()}
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return set()


def literals(pattern: str) -> list[bytes]:
    """What a LIKE pattern asks for literally; a backslash stands before a character that counts as itself."""
    out, now, at = [], "", 0
    while at < len(pattern):
        if pattern[at] in "%_":
            out.append(now)
            now = ""
        else:
            at += pattern[at] == "\\"
            now += pattern[at : at + 1]
        at += 1
    return [part.encode("utf-8") for part in [*out, now] if part]


def files_that_can_match(spark: SparkSession, table: str, index: str, pattern: str) -> list[str]:
    """Files of a table that may hold a row like pattern."""
    every, known = set(spark.read.parquet(table).inputFiles()), _indexed(spark, index)
    wanted = sorted({int(p) for part in literals(pattern) for p in positions(np.frombuffer(part, np.uint8))})
    if not wanted or not known:
        return sorted(every)
    by_part: dict[int, list[int]] = {}
    for place in wanted:
        by_part.setdefault(place // PART_BITS, []).append(place % PART_BITS)
    held = lambda place: F.conv(F.hex(F.substring("bits", place // 8 + 1, 1)), 16, 10).cast("int").bitwiseAND(1 << place % 8) != 0
    tests = [(F.col("parte") == k) & reduce(Column.__and__, map(held, places)) for k, places in by_part.items()]
    passed = spark.read.parquet(index).filter(F.col("parte").isin(*by_part)).filter(reduce(Column.__or__, tests)).groupBy("arquivo").agg(F.count("*").alias("n")).filter(F.col("n") == len(by_part))
    can = {r.arquivo for r in passed.select("arquivo").collect()}
    return sorted((every - known) | (every & can))


def like_rows(spark: SparkSession, table: str, index: str, pattern: str, content: str = "conteudo") -> DataFrame:
    """Rows of a table like pattern; only files that can hold one are read."""
    schema = spark.read.parquet(table).schema
    files = files_that_can_match(spark, table, index, pattern)
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    return rows.filter(F.col(content).like(pattern))
