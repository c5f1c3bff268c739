"""Substring deduplication: words in passages that an earlier document holds go.

A window is WINDOW consecutive words.  A word goes if a window over it has the
same words as one that starts in a document of a smaller id; windows are judged
on the input.

Every window has a minimizer, the least hash of the GRAM-word grams in it, and
equal windows have equal ones.  A segment is a run of windows with the same
minimizer; segments whose minimizer one document alone has need no search.  The
others are routed to shards by it, each distinct segment once with the least
document that holds it.  A shard builds an FM-index over its segments; their
windows stream through backward search over its wavelet matrix, and every
interval of WINDOW matching words gives the least document among its rows.

A minimizer with more than HOT distinct segments (the edges of a passage that
very many documents share) is routed by the windows themselves: they are grouped
by hash, which finds the least document, and each distinct window is a unit that
the index merely hands back.  Texts are shuffled once, into a table in buckets by document; they
meet their segments, windows and removals there, and only those are shuffled.

Edge cases: null and empty texts have no words; a null id is neither smaller
nor larger than another, so its document keeps all words and covers none; rows
that repeat an id are compared with smaller ids alone; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .fm_index import FMIndex
from .shared import bucketed, passing, written

WINDOW = 50
GRAM = 8
HOT = 2048
SHARD_WORDS = 300_000


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least of every width consecutive values, the first of equals."""
    at = np.arange(len(values))
    span = 1
    while 2 * span <= width:
        left, right = at[:-span], at[span:]
        at = np.where(values[right] < values[left], right, left)
        span *= 2
    rest = width - span
    if rest:
        left, right = at[:-rest], at[rest:]
        at = np.where(values[right] < values[left], right, left)
    return at


def segments(hashes: np.ndarray, first: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """row, first word, windows, minimizer and hash of the segments of some rows' word hashes."""
    windows = tx.within(first, window, len(hashes))
    if not len(windows):
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    grams = tx.run_hashes(hashes, gram)
    least = _sliding_least(grams, window - gram + 1)[windows]
    row = np.searchsorted(first, windows, side="right") - 1
    opens = np.append(True, (least[1:] != least[:-1]) | (windows[1:] != windows[:-1] + 1) | (row[1:] != row[:-1]))
    begin = np.flatnonzero(opens)
    count = np.diff(np.append(begin, len(windows)))
    start = windows[begin]
    # A segment is its windows in order: each is hashed with its place before they are summed.
    place = np.arange(len(windows)) - np.repeat(begin, count)
    whole = tx.run_hashes(hashes, window)[windows]
    key = tx.mix(np.add.reduceat(tx.mix(whole + place.astype(np.uint64) * np.uint64(tx.STEP)), begin) + count.astype(np.uint64))
    return row[begin], start - first[row[begin]], count, grams[least[begin]], key


def _segment_task(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, data = tx.column_bytes(batch.column(2))
        ids, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for i, j in tx.slices(offsets):
            part = data[offsets[i] : offsets[j]]
            starts, ends, first = tx.word_spans(part, offsets[i : j + 1] - offsets[i])
            row, start, count, least, key = segments(tx.word_hashes(part, starts, ends), first, window, gram)
            if len(row):
                yield pa.RecordBatch.from_arrays([pa.array(ids[i:j][row]), pa.array(marks[i:j][row]), pa.array(tx.signed(least)), pa.array(tx.signed(key)), pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32))], names=["doc_id", "mark", "least", "seg", "start", "n"])


def _units_of(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.RecordBatch]]:
    """For slices of (text, units): bytes, word starts and ends, row and struct of each unit, words counted in the slice."""
    offsets, data = tx.column_bytes(batch.column(0))
    lists = batch.column(1)
    for i, j in tx.slices(offsets):
        part = data[offsets[i] : offsets[j]]
        some = lists.slice(i, j - i)
        counts = np.array(some.value_lengths().fill_null(0))
        if not counts.sum():
            continue
        starts, ends, first = tx.word_spans(part, offsets[i : j + 1] - offsets[i])
        yield part, starts, ends, first[:-1][np.repeat(np.arange(j - i), counts)], some.flatten()


def _extract_task(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The words of every unit of every document."""
    for batch in batches:
        for part, starts, ends, base, units in _units_of(batch):
            at = base + units.field("start").to_numpy()
            count = units.field("n").to_numpy() + window - 1
            row = np.repeat(np.arange(len(at)), count)
            word = np.repeat(at - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
            for a in range(0, len(at), 4096):
                sel = (row >= a) & (row < a + 4096) if len(at) > 4096 else slice(None)
                size = min(4096, len(at) - a)
                words = tx.join_words(part, starts[word[sel]], ends[word[sel]], row[sel] - a, size)
                yield pa.RecordBatch.from_arrays([units.field("shard").slice(a, size), units.field("unit").slice(a, size), units.field("least_doc").slice(a, size), words], names=["shard", "unit", "least_doc", "words"])


def _window_task(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The hash of every window of every unit."""
    for batch in batches:
        for part, starts, ends, base, units in _units_of(batch):
            hashes = tx.run_hashes(tx.word_hashes(part, starts, ends), window)
            n = units.field("n").to_numpy()
            row = np.repeat(np.arange(len(n)), n)
            offset = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            take = pa.array(row)
            keys = hashes[(base + units.field("start").to_numpy())[row] + offset]
            yield pa.RecordBatch.from_arrays([pa.array(tx.signed(keys)), units.field("unit").take(take), pa.array(offset.astype(np.int32)), units.field("least_doc").take(take), units.field("last_doc").take(take)], names=["win", "seg", "off", "least_doc", "last_doc"])


def search_shard(words: pa.ChunkedArray, least_doc: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows of the units with the least document that any equal window has: unit, first window, windows, document."""
    offsets, data = tx.column_bytes(words)
    offsets, data = offsets - offsets[0], data[offsets[0] : offsets[-1]]
    starts, ends, first = tx.word_spans(data, offsets)
    length = np.diff(first)
    texts = tx.distinct_spans(data, starts, ends - starts)[1].astype(np.int64) + 1
    index = FMIndex(texts, length, window)
    least = np.minimum.reduceat(least_doc[index.owner[index.suffixes]], index.group_start)
    n = length - window + 1
    base = np.cumsum(n) - n
    found = np.zeros(int(n.sum()), np.int64)
    seen = np.zeros(len(found), bool)
    for unit, place, row in index.matching(texts, length):
        found[base[unit] + place] = least[index.group[row]]
        seen[base[unit] + place] = True
    if not seen.all():
        raise RuntimeError("a window was not found in its own index")
    unit = np.repeat(np.arange(len(n)), n)
    opens = np.flatnonzero(np.append(True, (found[1:] != found[:-1]) | (unit[1:] != unit[:-1])))
    return unit[opens], opens - base[unit[opens]], np.diff(np.append(opens, len(found))), found[opens]


def _shard_task(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []

    def search() -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        unit, off, n, doc = search_shard(table.column("words"), table.column("least_doc").to_numpy(), window)
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(table.column("unit").to_numpy()[unit]), pa.array(off.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(doc)], names=["unit", "off", "n", "earliest"])

    last = None
    for batch in batches:
        shards = batch.column(0).to_numpy()
        edges = [0, *(np.flatnonzero(shards[1:] != shards[:-1]) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if a == b:
                continue
            if held and shards[a] != last:
                yield search()
            last = shards[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield search()


def _remove_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each text, those in its ranges gone."""
    for batch in batches:
        offsets, data = tx.column_bytes(batch.column(1))
        for i, j in tx.slices(offsets):
            part = data[offsets[i] : offsets[j]]
            starts, ends, first = tx.word_spans(part, offsets[i : j + 1] - offsets[i])
            ranges = batch.column(2).slice(i, j - i)
            counts = np.array(ranges.value_lengths().fill_null(0))
            flat = ranges.flatten()
            base = first[:-1][np.repeat(np.arange(j - i), counts)]
            delta = np.zeros(len(starts) + 1, np.int64)
            np.add.at(delta, base + flat.field("begin").to_numpy(), 1)
            np.add.at(delta, base + flat.field("end").to_numpy(), -1)
            keep = np.cumsum(delta[:-1]) == 0
            row = np.repeat(np.arange(j - i), np.diff(first))
            kept = tx.join_words(part, starts[keep], ends[keep], row[keep], j - i)
            n = np.diff(first)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(n), pa.array(n - np.bincount(row[keep], minlength=j - i)), kept], names=["doc_id", "n_words", "n_removed", "kept"])


def _ranges(docs: DataFrame, window: int, gram: int, hot: int, shard_words: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The texts in buckets by document, and each document's ranges of words that go."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).cast("string").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    texts = bucketed(texts, ["doc_id", "mark"], "texts", size, keep=True)
    found = texts.filter("doc_id IS NOT NULL").mapInArrow(lambda b: _segment_task(b, window, gram), "doc_id long, mark long, least long, seg long, start int, n int")
    shared = found.groupBy("least").agg(F.min("doc_id").alias("d0"), F.max("doc_id").alias("d1")).filter("d0 <> d1").select("least")
    # Read back from a table, so that Spark may split a hot minimizer's rows in the join.
    rows = written(found.join(written(shared, "shared-minimizers"), "least"), "segments")
    unit = F.min(F.struct("doc_id", "mark", "start", "n")).alias("u")
    distinct = written(rows.groupBy("least", "seg").agg(unit, F.max("doc_id").alias("last_doc")).select("least", "seg", "u.*", "last_doc"), "distinct-segments")
    crowd = distinct.groupBy("least").count().filter(F.col("count") > hot).select("least")
    crowded = distinct.join(crowd, "least", "left_semi")
    plain = distinct.join(crowd, "least", "left_anti").select(F.col("least").alias("shard"), F.col("seg").alias("unit"), F.col("doc_id").alias("least_doc"), "doc_id", "mark", "start", "n")

    def with_texts(units: DataFrame) -> DataFrame:
        """text and the units of every document; one array of a document's own units."""
        own = units.groupBy("doc_id", "mark").agg(F.collect_list(F.struct(*[c for c in units.columns if c not in ("doc_id", "mark")])).alias("units"))
        return texts.join(own, ["doc_id", "mark"], "left").select("text", "units")

    as_units = crowded.select(F.col("seg").alias("unit"), F.col("doc_id").alias("least_doc"), "last_doc", "doc_id", "mark", "start", "n")
    wins = None
    if crowd.limit(1).count():
        wins = written(with_texts(as_units).mapInArrow(lambda b: _window_task(b, window), "win long, seg long, off int, least_doc long, last_doc long"), "windows")
        # A window that one document alone holds needs no search; one segment may stand in many documents.
        best = wins.groupBy("win").agg(F.min(F.struct("least_doc", "seg", "off")).alias("w"), F.max("last_doc").alias("d1")).filter("w.least_doc <> d1").select("win", "w.*")
        at = crowded.select("seg", "doc_id", "mark", "start")
        single = best.join(at, "seg").select(F.col("win").alias("shard"), F.col("win").alias("unit"), "least_doc", "doc_id", "mark", (F.col("start") + F.col("off")).alias("start"), F.lit(1).alias("n"))
        plain = written(plain.unionByName(single), "units")
    total = plain.agg(F.sum(F.col("n") + (window - 1))).first()[0] or 0
    shards = max(1, -(-int(total) // shard_words))
    placed = plain.withColumn("shard", F.pmod(F.xxhash64("shard"), F.lit(shards)))
    cut = with_texts(placed).mapInArrow(lambda b: _extract_task(b, window), "shard long, unit long, least_doc long, words string")
    answers = cut.repartition("shard").sortWithinPartitions("shard").mapInArrow(lambda b: _shard_task(b, window), "unit long, off int, n int, earliest long")
    if wins is None:
        known = answers.select(F.col("unit").alias("seg"), "off", F.col("n").alias("run"), "earliest")
    else:
        answers = written(answers, "earliest")
        is_window = wins.select("win").distinct().withColumn("w", F.lit(True))
        split = answers.join(is_window, answers["unit"] == is_window["win"], "left")
        known = split.filter("w IS NULL").select(F.col("unit").alias("seg"), "off", F.col("n").alias("run"), "earliest")
        hot_known = wins.select("win", "seg", "off").join(answers.select(F.col("unit").alias("win"), "earliest"), "win").select("seg", "off", F.lit(1).alias("run"), "earliest")
        known = known.unionByName(hot_known)
    begin = F.col("start") + F.col("off")
    gone = rows.join(known, "seg").filter(F.col("earliest") < F.col("doc_id")).select("doc_id", "mark", begin.alias("begin"), (begin + F.col("run") + (window - 1)).alias("end"))
    # A document's own ranges, at most one a segment and run.
    ranges = gone.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("begin", "end")).alias("ranges"))
    return texts, written(ranges, "ranges", keep=True)


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT, shard_words: int = SHARD_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words that stay, joined by one space)."""
    with passing(docs.sparkSession):
        texts, ranges = _ranges(docs, window, gram, hot, shard_words, id_col, text_col)
    return texts.join(ranges, ["doc_id", "mark"], "left").select("doc_id", "text", "ranges").mapInArrow(_remove_task, "doc_id long, n_words long, n_removed long, kept string")
