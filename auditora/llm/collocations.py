"""Phrase collocations: exact counts of frequent phrases, their weakest cut, and the strongest of each language.

Texts are split into pieces and these into words.  A phrase can only be frequent
if each of its words is, so words below the threshold break pieces as well, and
the others have numbers (of word and language together).  Every place where two
numbered words stand side by side yields one binary key of fixed width: the
numbers of the up to LONGEST words from there on, zeros behind a break, in as few
bytes a number as the numbering needs.  Keys are summed in a slice of texts,
partitioned by ranges and sorted; phrases of every length are then runs of equal
prefixes, counted by one pass over the sorted keys.  A run that reaches the edge
of its range may go on in the next, so runs at edges are emitted whatever their
count and summed.  Ranges follow from the words' frequencies, so no pass over the
texts is spent on samples; a range that holds more than its share is sorted by
Spark like any other, on disk where it must.

The numbering is broadcast while it holds at most SMALL_WORDS words (SMALL_BYTES
of text); beyond that, slices are written with numbers of their own, their
distinct words are joined to the numbering, and each slice gets its own part of
it.  Both ways give the same rows.  Scores are exact: decimals of 38 digits hold
products of counts below 10^17, and larger ones raise an error.

Edge cases: a null text is empty; a null language is `und`; a text without a
word counts for nothing; rows that repeat count each; empty tables give no rows.
A piece of any length is taken whole.  Ties of score and count go by the bytes
of the phrase.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import text as tx
from .shared import numbered, written

LEAST, LONGEST, TOP, COVER = 100, 5, 2000, 100
SLICE_BYTES = 4 << 20
SMALL_WORDS, SMALL_BYTES = 1 << 20, 16 << 20
TASK_KEYS = 1 << 21
BREAK = -1

# What ends a piece, and what stands between words.
_ENDS = np.zeros(256, bool)
_ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BETWEEN = _ENDS.copy()
_BETWEEN[[0x20, 0x09]] = True


def local_words(langs: list[str], offsets: np.ndarray, data: np.ndarray) -> Iterator[tuple[str, list[bytes], np.ndarray, np.ndarray]]:
    """For each language of a slice of rows: its distinct words, their counts, and the places of all words among them with BREAK between pieces."""
    data = tx.LOWER[data]
    starts, ends, first = tx.word_spans(data, offsets, _BETWEEN)
    if not len(starts):
        return
    ended = np.append(0, np.cumsum(_ENDS[data]))
    cut = np.append(True, ended[starts[1:]] != ended[ends[:-1]])
    cut[first[:-1][first[:-1] < len(cut)]] = True
    distinct, inverse = tx.distinct_spans(data, starts, ends - starts)
    raw = data.tobytes()
    names = {g: k for k, g in enumerate(dict.fromkeys(langs))}
    of_word = np.repeat([names[g] for g in langs], np.diff(first))
    for name, k in names.items():
        own = np.flatnonzero(of_word == k)
        if len(own):
            kinds, at, counts = np.unique(inverse[own], return_inverse=True, return_counts=True)
            spans = distinct[kinds]
            words = [raw[a:b] for a, b in zip(starts[spans].tolist(), ends[spans].tolist(), strict=True)]
            yield name, words, counts, np.insert(at, np.flatnonzero(cut[own]), BREAK)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], np.ndarray, np.ndarray]]:
    for batch in batches:
        langs = batch.column(0).to_pylist()
        offsets, data = tx.column_bytes(batch.column(1))
        for i, j in tx.slices(offsets, SLICE_BYTES):
            yield from local_words(langs[i:j], offsets[i : j + 1] - offsets[i], data[offsets[i] : offsets[j]])


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lang, words, counts, _ in _slices(batches):
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words)), pa.array(words, pa.binary()).cast(pa.string()), pa.array(counts)], names=["lang", "word", "n"])


def keys_of(ids: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys (rows of longest numbers, in order) of the places of a slice, and their counts; 0 in ids breaks."""
    # A place needs a word behind it; what lies beyond the end breaks too.
    at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
    padded = np.append(ids, np.zeros(longest, ids.dtype)).astype(np.uint32)
    key = np.zeros((longest, len(at)), np.uint32)
    open_ = np.ones(len(at), bool)
    for n in range(longest):
        here = padded[at + n]
        open_ &= here > 0
        key[n] = np.where(open_, here, 0)
    if not len(at):
        return key.T, np.zeros(0, np.int64)
    pairs = [key[n].astype(np.uint64) << np.uint64(32) | (key[n + 1] if n + 1 < longest else np.uint64(0)) for n in range(0, longest, 2)]
    order = np.lexsort(pairs[::-1])
    changed = np.zeros(len(at), bool)
    changed[0] = True
    for part in pairs:
        part = part[order]
        changed[1:] |= part[1:] != part[:-1]
    first = np.flatnonzero(changed)
    return key[:, order[first]].T, np.diff(np.append(first, len(at)))


def _binary(keys: np.ndarray, width: int) -> pa.Array:
    """Rows of numbers as binary values of width bytes a number that sort as the rows do."""
    size = width * keys.shape[1]
    offsets = np.arange(len(keys) + 1, dtype=np.int32) * size
    data = np.ascontiguousarray(keys.astype(">u4")).view(np.uint8).reshape(len(keys), keys.shape[1], 4)[:, :, 4 - width :]
    return pa.Array.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())])


def _numbers(column: pa.Array, longest: int, width: int) -> np.ndarray:
    """Rows of numbers of binary values."""
    column = column.cast(pa.binary())
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].reshape(len(column), longest, width)
    out = np.zeros((len(column), longest), np.uint32)
    for k in range(width):
        out = out << np.uint32(8) | data[:, :, k]
    return out


class Ranges:
    """Ranges of keys: a key's place among all, as if words followed each other by their frequencies alone.

    The place grows with the key, so ranges keep the keys' order; keys that agree in three words share a range."""

    def __init__(self, total: int, tasks: int) -> None:
        self.total, self.tasks = max(total, 1), tasks

    def of(self, before: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Range of keys by the frequencies before and of their first three words (columns)."""
        place = before[:, -1].astype(np.float64)
        for k in reversed(range(before.shape[1] - 1)):
            place = before[:, k] + own[:, k] * np.minimum(place / self.total, 1.0)
        return np.minimum(place / self.total * self.tasks, self.tasks - 1).astype(np.int32)


def _key_batch(ids: np.ndarray, before: np.ndarray, own: np.ndarray, longest: int, width: int, ranges: Ranges) -> pa.RecordBatch:
    """Keys of a slice; before and own hold frequencies by the places of words in ids."""
    keys, counts = keys_of(ids, longest)
    # Frequencies by number, for the numbers of this slice.
    known, first = np.unique(ids, return_index=True)
    heads = np.searchsorted(known, keys[:, :3])
    inside = keys[:, :3] > 0
    part = ranges.of(np.where(inside, before[first][np.minimum(heads, len(known) - 1)], 0), np.where(inside, own[first][np.minimum(heads, len(known) - 1)], 0))
    return pa.RecordBatch.from_arrays([pa.array(part), _binary(keys, width), pa.array(counts)], names=["part", "key", "n"])


def count_runs(batches: Iterator[tuple[np.ndarray, np.ndarray]], longest: int, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, prefixes and counts of the runs of equal prefixes in sorted keys: those of least or more, and the first and last of each length."""
    open_: dict[int, tuple[np.ndarray, int, bool]] = {}
    for keys, counts in batches:
        changed = np.zeros(len(keys), bool)
        changed[0] = True
        changed[1:] = keys[1:, 0] != keys[:-1, 0]
        for n in range(2, longest + 1):
            # Keys too short for n words stand before those of the same beginning that are not.
            changed[1:] |= keys[1:, n - 1] != keys[:-1, n - 1]
            there = keys[:, n - 1] > 0
            if not there.any():
                break
            first = np.flatnonzero(changed & there)
            held = counts[there]
            place = np.append(0, np.cumsum(there))[first]
            heads, sums = keys[first, :n], np.add.reduceat(held, place)
            edge = np.zeros(len(sums), bool)
            if n not in open_:
                edge[0] = True
            else:
                head, total, at_edge = open_[n]
                if (head == heads[0]).all():
                    sums[0] += total
                    edge[0] = at_edge
                else:
                    heads, sums, edge = np.vstack([head, heads]), np.append(total, sums), np.append(at_edge, edge)
            open_[n] = heads[-1], int(sums[-1]), bool(edge[-1])
            kept = np.flatnonzero((sums[:-1] >= least) | edge[:-1])
            yield n, heads[kept], sums[kept]
    for n, (head, total, _) in open_.items():
        yield n, head[None, :], np.array([total])


def _joined_keys(docs: DataFrame, frequent: DataFrame, longest: int, width: int, ranges: Ranges) -> DataFrame:
    """Keys by a numbering of any size: slices with numbers of their own meet their part of the numbering."""

    def block_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for k, (lang, words, _, at) in enumerate(_slices(batches)):
            lists = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pa.array(words, pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array([part << 32 | k]), pa.array([lang]), lists, pa.array([at.astype(np.int32).tobytes()])], names=["block", "lang", "words", "places"])

    def key_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                pairs, at = batch.column(1)[k].values, np.frombuffer(batch.column(0)[k].as_py(), np.int32)
                known = {name: np.zeros(int(at.max()) + 2, np.int64) for name in ("id", "before", "a")}
                for name, values in known.items():
                    values[pairs.field("place").to_numpy()] = pairs.field(name).to_numpy()
                # BREAK is the last place, whose number stays 0.
                yield _key_batch(known["id"][at], known["before"][at], known["a"][at], longest, width, ranges)

    blocks = written(docs.mapInArrow(block_task, "block long, lang string, words array<string>, places binary"), "collocation-slices", keep=True)
    own = blocks.select("block", "lang", F.posexplode("words").alias("place", "word")).join(frequent, ["lang", "word"])
    maps = own.groupBy("block").agg(F.collect_list(F.struct("place", "id", "before", "a")).alias("numbers"))
    return blocks.select("block", "places").join(maps, "block").select("places", "numbers").mapInArrow(key_task, "part int, key binary, n long")


def _broadcast_keys(docs: DataFrame, frequent: DataFrame, longest: int, width: int, ranges: Ranges) -> DataFrame:
    """Keys by a numbering of at most SMALL_WORDS words."""
    numbers: dict[str, dict[bytes, int]] = {}
    rows = frequent.select("lang", "word", "id", "before", "a").collect()
    before, own = np.zeros(len(rows) + 1, np.int64), np.zeros(len(rows) + 1, np.int64)
    for lang, word, number, earlier, count in rows:
        numbers.setdefault(lang, {})[word.encode("utf-8")] = number
        before[number], own[number] = earlier, count
    held = docs.sparkSession.sparkContext.broadcast((numbers, before, own))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, before, own = held.value
        for lang, words, _, at in _slices(batches):
            if known := numbers.get(lang):
                ids = np.array([known.get(w, 0) for w in words] + [0], np.int64)[at]
                yield _key_batch(ids, before[ids], own[ids], longest, width, ranges)

    return docs.mapInArrow(task, "part int, key binary, n long")


def numbered_words(counts: DataFrame, least: int) -> DataFrame:
    """lang, word, a, id and before (occurrences of the words of smaller numbers) of the words of least occurrences or more."""
    rows = numbered(counts.filter(F.col("a") >= least), "id", "collocation-numbers").withColumn("__group", F.shiftright("id", 16))
    groups = rows.groupBy("__group").agg(F.sum("a").alias("__sum"))
    # One row for 65,536 words.
    groups = groups.select("__group", F.coalesce(F.sum("__sum").over(W.orderBy("__group").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__base"))
    inside = W.partitionBy("__group").orderBy("id").rowsBetween(W.unboundedPreceding, -1)
    before = F.col("__base") + F.coalesce(F.sum("a").over(inside), F.lit(0))
    return written(rows.join(groups, "__group").withColumn("before", before).drop("__group", "__base"), "collocation-frequent", keep=True)


def _part(key: Column, start: int | Column, words: int | Column, longest: int) -> Column:
    """The key of some of a key's words: words of them from the one at start (from 0)."""
    size = F.lit(words) * 4 if isinstance(words, int) else words * 4
    cut = F.substring(key, F.lit(start) * 4 + 1 if isinstance(start, int) else start * 4 + 1, size)
    return F.rpad(cut, F.lit(4 * longest), F.lit(b"\x00"))


def phrase_counts(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, longest: int = LONGEST, small: int = SMALL_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words of least occurrences or more (lang, word, a, id), phrases of two words or more (key, words, a), and each language's number of words (lang, n)."""
    docs = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    counts = written(docs.mapInArrow(_count_task, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("a")), "collocation-words", keep=True)
    totals = counts.groupBy("lang").agg(F.sum("a").alias("n"))
    frequent = numbered_words(counts, least)
    size, length, total = frequent.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("word")), F.lit(0)), F.coalesce(F.sum("a"), F.lit(0))).first()
    if size >= 1 << 32:
        raise ValueError(f"{size} frequent words do not fit keys of 32 bits a word")
    width = max(1, (size.bit_length() + 7) // 8)
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_KEYS))
    keys = (_broadcast_keys if size <= small and length <= SMALL_BYTES else _joined_keys)(docs, frequent, longest, width, Ranges(total, tasks))

    def run_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacked = ((_numbers(batch.column(0), longest, width), batch.column(1).to_numpy()) for batch in batches if batch.num_rows)
        for n, heads, sums in count_runs(unpacked, longest, least):
            if len(heads):
                full = np.zeros((len(heads), longest), np.uint32)
                full[:, :n] = heads
                yield pa.RecordBatch.from_arrays([_binary(full, 4), pa.array(np.full(len(heads), n, np.int32)), pa.array(sums)], names=["key", "words", "n"])

    runs = keys.repartitionById(tasks, "part").select("key", "n").sortWithinPartitions("key").mapInArrow(run_task, "key binary, words int, n long")
    phrases = runs.groupBy("key", "words").agg(F.sum("n").alias("a")).filter(F.col("a") >= least)
    return frequent, written(phrases, "collocation-phrases", keep=True), totals


def _covered(phrases: DataFrame, longest: int) -> DataFrame:
    """For every phrase inside a longer one: key and the highest count of those."""
    parts = [
        phrases.filter(F.col("words") >= start + size + (start == 0)).select(_part(F.col("key"), start, size, longest).alias("key"), F.col("a").alias("longer"))
        for size in range(2, max(longest, 3)) for start in range(max(longest - size, 0) + 1)
    ]
    return reduce(DataFrame.unionByName, parts).groupBy("key").agg(F.max("longer").alias("longer"))


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, longest: int = LONGEST, top: int = TOP, cover: int = COVER, small: int = SMALL_WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the top phrases of each language.

    A phrase's score is that of its weakest cut: thousandths of a * n / (l * r), where l and r count its two parts.  Phrases
    inside a longer one of at least cover percent of their count are left out."""
    frequent, phrases, totals = phrase_counts(docs, lang, text, least, longest, small)
    key = F.col("key")
    word_key = F.rpad(F.unhex(F.lpad(F.hex("id"), 8, "0")), F.lit(4 * longest), F.lit(b"\x00"))
    counts = phrases.select("key", "a", F.lit(None).cast("string").alias("lang")).unionByName(frequent.select(word_key.alias("key"), "a", "lang"))
    counts = written(counts, "collocation-counts", keep=True)
    cuts = phrases.filter(F.col("words") >= 2).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumns({"left": _part(key, 0, F.col("k"), longest), "right": _part(key, F.col("k"), F.col("words") - F.col("k"), longest)})
    left = counts.select(key.alias("left"), F.col("a").alias("l"), "lang")
    right = counts.select(key.alias("right"), F.col("a").alias("r"))
    cuts = cuts.join(left, "left").join(right, "right")
    whole = cuts.groupBy("key", "words", "a").agg(F.collect_list(F.struct("k", "l", "r")).alias("cuts"), F.max("lang").alias("lang"))
    whole = whole.join(_covered(phrases, longest), "key", "left").filter(F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(cover) * F.col("a"))).join(totals, "lang")
    big = lambda c: c.cast("decimal(20,0)")
    score = lambda c: F.expr("cast(1000 as decimal(4,0))") * big(F.col("a")) * big(F.col("n"))
    scores = F.transform("cuts", lambda c: F.struct(F.call_function("div", score(c), big(c["l"]) * big(c["r"])).cast("long").alias("score"), c["k"].alias("k"), c["l"].alias("l"), c["r"].alias("r")))
    whole = whole.withColumn("best", F.array_min(scores)).select("lang", "key", "words", "a", "n", "best.l", "best.r", "best.score")
    # Ties at the edge stay until their phrases are read; Spark bounds the groups before it deals them out.
    order = [F.desc("score"), F.desc("a")]
    near = written(whole.withColumn("__near", F.rank().over(W.partitionBy("lang").orderBy(*order))).filter(F.col("__near") <= top).drop("__near"), "collocation-top", keep=True)
    ids = near.select("key", F.posexplode(F.transform(F.sequence(F.lit(0), F.col("words") - 1), lambda i: F.conv(F.hex(F.substring(key, i * 4 + 1, F.lit(4))), 16, 10).cast("long"))).alias("at", "id"))
    read = ids.join(frequent.select("id", "word"), "id").groupBy("key").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("parts"))
    named = near.join(read, "key").withColumn("phrase", F.array_join("parts.word", " "))
    named = named.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order, "phrase")).cast("long")).filter(F.col("rank") <= top)
    return named.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
