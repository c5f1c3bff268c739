"""Importance resampling towards a target: hashed n-gram features, noisy scores, an exact draw of the best.

Features of a text are its runs of one to LONGEST consecutive words (ASCII letters
and digits in lower case and everything beyond ASCII), hashed to buckets by the
crc32 of their bytes.  A bucket's gain is the logarithm of its smoothed share in
the target over its share in the documents, in thousandths; a document's weight
is the mean gain of its features, and its score adds Gumbel noise drawn from its
id, so the highest scores are a sample without replacement by weight.

Counts of buckets are summed in each task and then over tasks, so what comes to
the driver is a row a bucket.  The drawn share is found by radix selection: the
composite key of score, id and row is cut to digits, and each pass counts the
rows of every value of one digit among those that still tie, until the k-th key
is known to its last digit.  Only the rows before it are sorted, by ranges.

Edge cases: a null or empty text, or one without a word, has no features and
weight 0; ids are cast to long, a null id counts as an empty text in the draw and
stands behind all others among ties; rows that repeat an id are drawn each by
itself, with one noise; ties that remain go by the order of rows in the table that
scores are kept in.  Without documents or target texts the counts are 0 and gains
follow from smoothing alone.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .shared import numbered, written

LONGEST, BUCKETS, SEED, LEAST_WORDS = 2, 10_000, 7, 20
SHARE = (25, 100)
DIGIT_BITS = 12
LONG_WORD = 64

# The reversed polynomial of crc32.
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1)
_OUTSIDE = np.ones(256, bool)
_OUTSIDE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def crc_over(crc: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """crc32 of what each crc stands for followed by a span of data; spans over LONG_WORD bytes go to zlib."""
    state = ~crc.astype(np.uint32)
    open_ = np.flatnonzero((lengths > 0) & (lengths <= LONG_WORD))
    at = 0
    while len(open_):
        now = state[open_]
        state[open_] = _CRC[(now ^ data[starts[open_] + at]) & 0xFF] ^ (now >> 8)
        at += 1
        open_ = open_[lengths[open_] > at]
    out = ~state
    for k in np.flatnonzero(lengths > LONG_WORD).tolist():
        out[k] = zlib.crc32(data[starts[k] : starts[k] + lengths[k]].tobytes(), int(crc[k]))
    return out


def features(data: np.ndarray, offsets: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of runs: crc32 of the runs and the first word of each row's, in order; offsets begin at 0."""
    data = tx.LOWER[data]
    starts, ends, first = tx.word_spans(data, offsets, _OUTSIDE)
    sizes = ends - starts
    crc = crc_over(np.zeros(len(starts), np.uint32), data, starts, sizes)
    yield crc, first
    space = np.array([0x20], np.uint8)
    row_end = np.repeat(first[1:], np.diff(first))
    for n in range(2, longest + 1):
        # Runs of n words, by their first word; those that would leave their row go.
        crc = crc_over(crc, space, np.zeros(len(crc), np.int64), np.ones(len(crc), np.int64))[: max(0, len(starts) - n + 1)]
        crc = crc_over(crc, data, starts[n - 1 :], sizes[n - 1 :])
        inside = np.arange(len(crc)) + n <= row_end[: len(crc)]
        yield crc[inside], np.append(0, np.cumsum(inside))[np.minimum(first, len(crc))]


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    offsets, data = tx.column_bytes(batch.column(column))
    for i, j in tx.slices(offsets):
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]


def bucket_counts(texts: DataFrame, text: str, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts each bucket has."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, offsets in _slices(batch, 0):
                for crc, _ in features(data, offsets, longest):
                    counts += np.bincount(crc % buckets, minlength=buckets)
        have = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(have), pa.array(counts[have])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for row in texts.select(text).mapInArrow(task, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's smoothed share in the target over its share in the documents, floored."""
    buckets = len(own)
    ratio = (target + 1.0) * (own.sum() + float(buckets)) / ((own + 1.0) * (target.sum() + float(buckets)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of Gumbel noise from an id, floored."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    share = (F.conv(F.left(digest, F.lit(8)), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(share)))


def weighed(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every document."""
    gain = gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, target_text, longest, buckets))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts, sums = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for i, j, data, offsets in _slices(batch, 1):
                for n, (crc, first) in enumerate(features(data, offsets, longest)):
                    total = np.append(0, np.cumsum(gain[crc % buckets]))
                    counts[i:j] += np.diff(first)
                    sums[i:j] += np.diff(total[first])
                    if n == 0:
                        words[i:j] = np.diff(first)
            weight = np.floor_divide(sums, np.maximum(counts, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (words, counts, weight))], names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(task, "doc_id long, n_words long, n_features long, weight long")
    return rows.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def _unsigned(value: int) -> int:
    """Place of a signed 64-bit value among all of them."""
    return value + (1 << 63)


def kth_key(rows: DataFrame, keys: list[str], k: int) -> tuple[int, ...]:
    """Exact values of the k-th row (from 1) in ascending order of long columns without nulls, by radix selection.

    Bits that all rows share are passed over; each pass brings one row for each value of a digit to the driver."""
    ends = rows.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in keys for f in (F.min, F.max)]).first()
    found = []
    for name in keys:
        low, high = _unsigned(ends[f"min_{name}"]), _unsigned(ends[f"max_{name}"])
        bits = (low ^ high).bit_length()
        prefix = low >> bits
        biased = F.col(name).bitwiseXOR(F.lit(-(1 << 63)))
        while bits:
            width = min(DIGIT_BITS, bits)
            bits -= width
            digit = F.shiftrightunsigned(biased, bits).bitwiseAND((1 << width) - 1)
            for value, n in sorted((r.digit, r.n) for r in rows.groupBy(digit.alias("digit")).agg(F.count("*").alias("n")).collect()):
                if k <= n:
                    break
                k -= n
            prefix = prefix << width | value
            rows = rows.filter(digit == value)
        found.append(prefix - (1 << 63))
    return tuple(found)


def resample(docs: DataFrame, target: DataFrame, share: tuple[int, int] = SHARE, least: int = LEAST_WORDS, **options: object) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every document: share of those with at least least words are drawn, the others have no rank."""
    scores = weighed(docs, target, **options)
    # Ascending keys: the highest score first, then the smallest id (null last), then the row.
    row = F.monotonically_increasing_id().alias("__row")
    scores = written(scores.select("*", (-F.col("score")).alias("__score"), F.col("doc_id").isNull().cast("long").alias("__null"), F.coalesce("doc_id", F.lit(0)).cast("long").alias("__id"), row), "scores", keep=True)
    keys = ["__score", "__null", "__id", "__row"]
    fit = scores.filter(F.col("n_words") >= least)
    k = fit.count() * share[0] // share[1]
    if k == 0:
        return scores.withColumn("rank", F.lit(None).cast("long")).drop(*keys)
    last = kth_key(fit, keys, k)
    drawn = F.lit(True)
    for name, value in reversed(list(zip(keys, last, strict=True))):
        drawn = (F.col(name) < value) | ((F.col(name) == value) & drawn)
    drawn = drawn & (F.col("n_words") >= least)
    ranked = numbered(scores.filter(drawn), "rank", "drawn", keys)
    return ranked.unionByName(scores.filter(~drawn).withColumn("rank", F.lit(None).cast("long"))).drop(*keys)


def drawn_documents(docs: DataFrame, result: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The rows of docs whose id resample() has drawn; rows that repeat an id come together, those without one stay behind."""
    ids = result.filter("rank IS NOT NULL").select(F.col("doc_id").alias("__drawn")).distinct()
    return docs.join(ids, F.col(doc_id).cast("long") == F.col("__drawn"), "left_semi")
