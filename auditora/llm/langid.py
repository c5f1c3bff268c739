"""Language of whole texts, and of spans of mixed ones.

The scripts of a word's letters leave the languages that use them as
candidates.  Each candidate scores the word by the byte 2- to 4-grams of its
lower-cased form, with its borders, under a naive Bayes model.  Viterbi over
the words, a switch of language costing a penalty, labels the spans; the text
is in the language with most letters.

The model is fitted on at most sample_docs documents of each language (those of
the smallest hashes in expectation), so it is small whatever the corpus: one
table of buckets x languages, at most MOST_LANGUAGES of them.

Work goes in slices whose arrays are bounded whatever the texts and the number of
languages.  A text longer than a slice is read in parts that end behind a
separator (behind a character where a word is longer than a part, which then
counts as several words); Viterbi keeps its state before every part, and reads
the parts again from the last on to trace the labels back.

Edge cases: a text that is null or has no letter (Unicode category L) is "und"
with score 0, without spans; letters of scripts that no language uses count against the score; a text
of such letters alone gets the language seen most, with score 0; with no
training rows every text is "und".  Repeated rows get equal results, other
columns pass through, an empty table gives no rows.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as tx

BUCKETS = 1 << 15
SAMPLE_DOCS = 2000
SWITCH = 8.0
SCRIPT_SHARE = 0.01
MOST_LANGUAGES = 1000
ORDERS = (2, 3, 4)

# First code points of ranges and the script of the letters in them; letters of ranges of 0 are of OTHER.
RANGES = (
    (0x00, 0), (0x41, 1), (0x5B, 0), (0x61, 1), (0x7B, 0), (0xAA, 1), (0xAB, 0), (0xB5, 1), (0xB6, 0), (0xBA, 1), (0xBB, 0), (0xC0, 1),
    (0xD7, 0), (0xD8, 1), (0xF7, 0), (0xF8, 1), (0x2C2, 0), (0x370, 2), (0x400, 3), (0x483, 0), (0x48A, 3), (0x531, 4), (0x590, 0), (0x5D0, 5), (0x600, 0), (0x620, 6),
    (0x660, 0), (0x66E, 6), (0x700, 15), (0x900, 7), (0x980, 15), (0xE00, 8), (0xE80, 15), (0x10A0, 9), (0x1100, 10), (0x1200, 15), (0x1E00, 1), (0x1F00, 2), (0x2000, 0),
    (0x2C00, 15), (0x2E00, 0), (0x3040, 11), (0x3100, 15), (0x3130, 10), (0x3190, 15), (0x3400, 12), (0xA000, 15), (0xAC00, 10), (0xD7B0, 15), (0xF900, 12), (0xFB00, 15),
)
SCRIPTS, OTHER = 16, 15


@cache
def letter_scripts() -> np.ndarray:
    """Script of every code point that is a letter (Unicode category L), 0 for all others."""
    starts = np.array([r[0] for r in RANGES])
    script = np.array([r[1] or OTHER for r in RANGES], np.uint8)[np.searchsorted(starts, np.arange(0x110000), side="right") - 1]
    return np.where([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)], script, 0).astype(np.uint8)


def scripts_of_bytes(data: np.ndarray) -> np.ndarray:
    """Script at the lead byte of every letter, 0 elsewhere."""
    pad = np.append(data, np.zeros(3, np.uint8)).astype(np.int32)
    lead, a, b, c = pad[:-3], pad[1:-2] & 0x3F, pad[2:-1] & 0x3F, pad[3:] & 0x3F
    point = np.where(lead < 0x80, lead, np.where(lead < 0xC0, 0, np.where(lead < 0xE0, (lead & 0x1F) << 6 | a, np.where(lead < 0xF0, (lead & 0x0F) << 12 | a << 6 | b, (lead & 0x07) << 18 | a << 12 | b << 6 | c))))
    return letter_scripts()[point]


def grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: places and buckets of the byte n-grams; the words lie behind one space each in a row,
    word w from sum of earlier lengths + w on."""
    lengths = ends - starts
    begin = np.cumsum(lengths + 1) - lengths - 1
    total = int((lengths + 1).sum())
    row = np.full(total + 4, 0x20, np.uint64)
    at = np.arange(total - len(starts)) - np.repeat(begin - np.arange(len(starts)), lengths)
    row[np.repeat(begin + 1, lengths) + at] = tx.LOWER[data[np.repeat(starts, lengths) + at]]
    inside = np.ones(total, bool)
    value = row[:total].copy()
    for n in range(2, max(ORDERS) + 1):
        value = value << np.uint64(8) | row[n - 1 : total + n - 1]
        if n in ORDERS:
            places = np.flatnonzero(inside)
            yield places, (tx.mix(value[places] + np.uint64(n << 40)) % np.uint64(BUCKETS)).astype(np.int64)
        # The next order may not reach beyond the border behind the word.
        inside &= row[n - 1 : total + n - 1] != 0x20


def word_scripts(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters of each word, and the set of their scripts as bits; last, the script of every byte."""
    script = scripts_of_bytes(data)
    bits = np.where(script > 0, np.left_shift(1, script.astype(np.int32)), 0)
    return np.add.reduceat((script > 0).astype(np.int32), starts), np.bitwise_or.reduceat(bits, starts), script


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # buckets x languages, logarithms
    scripts: np.ndarray  # bits of the scripts that each language uses
    common: int  # the language seen most

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Scores (words x languages; 0 where no candidate), letters and whether scored, first word of each row."""
        starts, ends, first = tx.word_spans(data, offsets)
        scores = np.zeros((len(starts), len(self.languages)), np.float32)
        if not len(starts):
            return scores, np.zeros(0, np.int32), np.zeros(0, bool), first
        letters, bits, _ = word_scripts(data, starts)
        begin = np.cumsum(ends - starts + 1) - (ends - starts) - 1
        step = max(1, CELLS // max(1, len(self.languages)))
        for places, buckets in grams(data, starts, ends):
            for k in range(0, len(places), step):
                word = np.searchsorted(begin, places[k : k + step], side="right") - 1
                edge = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
                scores[word[edge]] += np.add.reduceat(self.weights[buckets[k : k + step]], edge, axis=0)
        allowed = (bits[:, None] & self.scripts[None, :]) > 0
        known = allowed.any(axis=1)
        scores = np.where(allowed, scores, np.where(known[:, None], scores.min(axis=1, keepdims=True) - 30, 0)).astype(np.float32)
        scores[known] -= scores[known].max(axis=1, keepdims=True)
        return scores, letters, known, first


def parts_of(data: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Ranges of at most limit bytes that tile data, behind a separator or else behind a character."""
    out, a = [], 0
    while a < len(data):
        b = min(a + limit, len(data))
        if b < len(data):
            gap = np.flatnonzero(tx.SEPARATOR[data[a:b]])
            if len(gap):
                b = a + int(gap[-1]) + 1
            else:
                while b > a + 1 and data[b] & 0xC0 == 0x80:
                    b -= 1
        out.append((a, b))
        a = b
    return out


def _follow(scores: np.ndarray, best: np.ndarray | None, switch: float) -> tuple[np.ndarray | None, np.ndarray, np.ndarray]:
    """Viterbi's state behind the words of one row, from the state before them, with where each label came from."""
    came, jumped = np.zeros(len(scores), np.int16), np.zeros(scores.shape, bool)
    for t, own in enumerate(scores):
        if best is None:
            best = own.copy()
            continue
        top = best.argmax()
        leap = best[top] - switch
        came[t], jumped[t] = top, best < leap
        best = np.maximum(best, leap) + own
    return best, came, jumped


def label_long(model: Model, data: np.ndarray, switch: float, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Runs (label, first word) of one long text, the letters of each language, and all its letters."""
    parts, states, best = parts_of(data, limit), [], None
    for a, b in parts:
        states.append(best)
        best = _follow(model.words(data[a:b], np.array([0, b - a]))[0], best, switch)[0]
    runs: list[tuple[np.ndarray, np.ndarray]] = []
    votes, every = np.zeros(len(model.languages)), 0
    now = 0 if best is None else int(best.argmax())
    for (a, b), before in zip(reversed(parts), reversed(states), strict=True):
        scores, letters, known, _ = model.words(data[a:b], np.array([0, b - a]))
        _, came, jumped = _follow(scores, before, switch)
        labels = np.zeros(len(scores), np.int16)
        for t in range(len(scores) - 1, -1, -1):
            labels[t] = now
            if jumped[t, now]:
                now = int(came[t])
        edge = np.flatnonzero(np.append(True, labels[1:] != labels[:-1])) if len(labels) else np.zeros(0, np.int64)
        runs.append((labels[edge], np.append(edge, len(labels))))
        np.add.at(votes, labels[known], letters[known])
        every += int(letters.sum())
    label, first, words = [np.zeros(0, np.int16)], [np.zeros(0, np.int64)], 0
    for own, edges in reversed(runs):
        label.append(own)
        first.append(edges[:-1] + words)
        words += int(edges[-1])
    label, first = np.concatenate(label), np.concatenate(first)
    keep = np.append(True, label[1:] != label[:-1])[: len(label)]
    return label[keep], np.append(first[keep], words), votes, every


def viterbi(scores: np.ndarray, first: np.ndarray, switch: float) -> np.ndarray:
    """Best label of every word, all rows in step; a change of label within a row costs switch."""
    total, n = scores.shape
    labels = np.zeros(total, np.int16)
    if not total:
        return labels
    counts = np.diff(first)
    rows = np.argsort(-counts, kind="stable")
    begin, longest = first[:-1][rows], int(counts.max())
    live = np.searchsorted(-counts[rows], -np.arange(longest), side="left")
    best = np.zeros((len(rows), n), np.float32)
    came = np.zeros(total, np.int16)
    jumped = np.zeros((total, n), bool)
    final = np.zeros(len(rows), np.int64)
    for t in range(longest):
        k = live[t]
        at = begin[:k] + t
        now = best[:k]
        if t:
            top = now.argmax(axis=1)
            leap = now[np.arange(k), top] - switch
            jump = now < leap[:, None]
            came[at], jumped[at] = top, jump
            now = np.where(jump, leap[:, None], now)
        best[:k] = now + scores[at]
    final[:] = best.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        k = live[t]
        at = begin[:k] + t
        labels[at] = final[:k]
        if t:
            final[:k] = np.where(jumped[at, final[:k]], came[at], final[:k])
    return labels


RESULT = "struct<lang:string, score:double, spans:array<struct<lang:string, first_word:int, n_words:int>>>"
_ARROW = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("spans", pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int32()), ("n_words", pa.int32())])))])
# Bytes of a slice times languages: of what is scored at once, of what Viterbi labels at once, and array cells of gram weights.
SCORED, LABELLED, CELLS = 4 << 20, 16 << 20, 2 << 20


def _runs(offsets: np.ndarray, small: int, wide: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most wide bytes; a row of more than small bytes is alone."""
    long = np.flatnonzero(np.diff(offsets) > small)
    at = 0
    for r in [*long.tolist(), len(offsets) - 1]:
        for i, j in tx.slices(offsets[at : r + 1], wide):
            yield at + i, at + j
        if r < len(offsets) - 1:
            yield r, r + 1
        at = r + 1


def predict(model: Model, column: pa.Array, switch: float = SWITCH, scored_bytes: int = SCORED, labelled_bytes: int = LABELLED) -> pa.Array:
    offsets, data = tx.column_bytes(column)
    n = len(offsets) - 1
    names, shares = np.full(n, "und", object), np.zeros(n)
    if not model.languages:
        return pa.array([{"lang": "und", "score": 0.0, "spans": []}] * n, _ARROW)
    span_counts, span_rows = np.zeros(n + 1, np.int32), []
    small, wide = max(4096, scored_bytes // len(model.languages)), max(4096, labelled_bytes // len(model.languages))

    def decide(r: int, votes: np.ndarray, every: float) -> None:
        if every:
            top = int(votes.argmax())
            names[r] = model.languages[top if votes[top] > 0 else model.common]
            shares[r] = votes[top] / every

    for lo, hi in _runs(offsets, small, wide):
        if offsets[hi] - offsets[lo] > small and hi == lo + 1:
            label, first, votes, every = label_long(model, data[offsets[lo] : offsets[hi]], switch, small)
            decide(lo, votes, every)
            if every:
                span_rows.append((label, first[:-1], np.diff(first)))
                span_counts[hi] += len(label)
            continue
        parts = [model.words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in ((lo + i, lo + j) for i, j in tx.slices(offsets[lo : hi + 1], small))]
        scores, letters, known = (np.concatenate([p[k] for p in parts]) for k in range(3))
        first = np.append(0, np.cumsum(np.concatenate([np.diff(p[3]) for p in parts])))
        labels = viterbi(scores, first, switch)
        row = np.repeat(np.arange(hi - lo), np.diff(first))
        votes = np.zeros((hi - lo, len(model.languages)))
        np.add.at(votes, (row[known], labels[known]), letters[known])
        every = np.bincount(row, weights=letters, minlength=hi - lo)
        for r in range(hi - lo):
            decide(lo + r, votes[r], every[r])
        lettered = every[row] > 0
        edge = np.flatnonzero(lettered & np.append(True, (labels[1:] != labels[:-1]) | (row[1:] != row[:-1]))) if len(row) else np.zeros(0, np.int64)
        if len(edge):
            stop = np.minimum(np.append(edge[1:], len(row)), first[1:][row[edge]])
            span_rows.append((labels[edge], edge - first[row[edge]], stop - edge))
            span_counts[1 + lo : 1 + hi] += np.bincount(row[edge], minlength=hi - lo).astype(np.int32)
    label, begin, count = (np.concatenate([s[k] for s in span_rows]) if span_rows else np.zeros(0, np.int64) for k in range(3))
    spans = pa.StructArray.from_arrays([pa.array([model.languages[k] for k in label.tolist()], pa.string()), pa.array(begin.astype(np.int32)), pa.array(count.astype(np.int32))], fields=list(_ARROW.field("spans").type.value_type))
    return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(shares), pa.ListArray.from_arrays(pa.array(np.cumsum(span_counts).astype(np.int32)), spans)], fields=list(_ARROW))


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (language, bucket, count) of a task; buckets from BUCKETS on are scripts."""
    seen: dict[str, np.ndarray] = {}
    for batch in batches:
        offsets, data = tx.column_bytes(batch.column(1))
        names = np.array(batch.column(0).to_pylist(), object)
        for i, j in tx.slices(offsets):
            for name in sorted(set(names[i:j])):
                rows = [r for r in range(i, j) if names[r] == name]
                part = np.concatenate([np.append(data[offsets[r] : offsets[r + 1]], np.uint8(0x20)) for r in rows])
                starts, ends, _ = tx.word_spans(part, np.array([0, len(part)]))
                if not len(starts):
                    continue
                _, bits, script = word_scripts(part, starts)
                lettered = bits > 0
                counts = seen.setdefault(name, np.zeros(BUCKETS + SCRIPTS, np.int64))
                counts[BUCKETS:] += np.bincount(script[script > 0], minlength=SCRIPTS)
                if lettered.any():
                    for _, buckets in grams(part, starts[lettered], ends[lettered]):
                        counts[:BUCKETS] += np.bincount(buckets, minlength=BUCKETS)
    for name, counts in seen.items():
        k = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(k), pa.string()), pa.array(k.astype(np.int32)), pa.array(counts[k])], names=["lang", "bucket", "n"])


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", sample_docs: int = SAMPLE_DOCS) -> Model:
    """Fits the model on the labelled rows of docs, at most about sample_docs of each language."""
    labelled = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.pmod(F.xxhash64(F.lit("sample"), id_col), F.lit(1 << 30)).alias("draw"))
    seen = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(seen) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = sorted(seen)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.int32), 0)
    below = F.element_at(F.create_map(*[F.lit(x) for name in languages for x in (name, min(1 << 30, int(sample_docs / seen[name] * (1 << 30))))]), F.col("lang"))
    counted = labelled.filter(F.col("draw") < below).select("lang", "text").mapInArrow(_count_task, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = counted.toArrow().to_pandas()
    counts = np.zeros((BUCKETS + SCRIPTS, len(languages)))
    counts[table["bucket"], table["lang"].map({name: k for k, name in enumerate(languages)})] = table["n"]
    gram = counts[:BUCKETS] + 0.5
    letters = counts[BUCKETS:]
    used = letters > SCRIPT_SHARE * np.maximum(1, letters.sum(axis=0))
    bits = (used * (1 << np.arange(SCRIPTS))[:, None]).sum(axis=0).astype(np.int32)
    return Model(languages, np.log(gram / gram.sum(axis=0)).astype(np.float32), bits, max(range(len(languages)), key=lambda k: seen[languages[k]]))


def identify(text: Column, model: Model, switch: float = SWITCH) -> Column:
    """struct of lang, score (share of the letters in that language) and spans (lang, first_word, n_words)."""

    @F.arrow_udf(RESULT)
    def predicted(column: pa.Array) -> pa.Array:
        return predict(model, column, switch)

    return predicted(text)
