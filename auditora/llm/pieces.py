"""SentencePiece BPE ids of whole texts, and texts of ids, by vectorised merge rounds.

A text becomes characters behind one word mark (U+2581, as which spaces count
too).  Two neighbours that stand side by side in no piece of the vocabulary can
never meet in one symbol, so the text is cut there into words, and each distinct
word of a slice is merged once.  The symbols of all words lie in flat arrays.  A
round takes each word's best pair, merges its occurrences from the left at once,
and closes the gaps; words without a pair leave, until none is left.

The library merges one pair at a time, the best score first and the leftmost of
equal ones.  Merging a pair's occurrences at once gives the same result unless a
merge makes a pair that is as good as it or better; such a word merges only its
leftmost occurrence in that round.

Edge cases: a null or empty text has no ids but the end id, and decodes to an
empty text; characters outside the vocabulary are written as the bytes of their
UTF-8; U+2581 in a text is a space after decoding, as in the library.  Null ids
decode to an empty text, and ids outside the vocabulary raise an error.  A word
of any length is merged whole.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as tx

DEFAULT_MODEL = "piece_bpe_32k.model"
SLICE_BYTES = 2 << 20
MARK = "▁"
# Fixed values of the model format: kinds of pieces, and the kind of model that merges pairs.
NORMAL, UNKNOWN, CONTROL, BYTE, BPE = 1, 2, 3, 6, 2
NO_PAIR = np.int32(-1)
LAST = np.int32(2**31 - 1)


def model_path(path: str | None = None) -> str:
    """Path of the model file; by default the public 32k vocabulary."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(DEFAULT_MODEL)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a serialised message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            at, value, shift = at + 1, value | (byte & 127) << shift, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = varint(at)
        if key & 7 == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


class Vocabulary:
    """Pieces of a model and the pairs of symbols that make them; symbols are piece ids, then characters that are no piece themselves."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            parts = list(_fields(file.read()))
        trainer, rules = (dict(_fields(next(v for k, v in parts if k == number))) for number in (2, 3))
        pieces = [dict(_fields(v)) for k, v in parts if k == 1]
        kinds = np.array([p.get(3, NORMAL) for p in pieces])
        if trainer.get(3) != BPE or not trainer.get(35) or rules.get(2) or not rules.get(3, 1) or rules.get(4, 1) or not rules.get(5, 1) or not np.isin(kinds, (NORMAL, UNKNOWN, CONTROL, BYTE)).all():
            raise ValueError("only pair merging with byte fallback, a word mark in front and no normalisation is supported")
        self.path, self.end_id = path, trainer.get(42, 2)
        names = [p[1].decode("utf-8") for p in pieces]
        scores = [struct.unpack("<f", p[2])[0] if 2 in p else 0.0 for p in pieces]
        symbols = {names[k]: k for k in np.flatnonzero(kinds == NORMAL).tolist()}
        normal = list(symbols.items())
        for character in sorted({c for name, _ in normal for c in name} - symbols.keys()):
            symbols[character] = len(names) + len(symbols) - len(normal)
        # Places of symbols among the characters that pieces hold; 0 is any other character.
        letters = sorted({c for name, _ in normal for c in name})
        self.letter = np.zeros(0x110000, np.uint16)
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.letter[0x20] = self.letter[ord(MARK)]
        self.letter_symbol = np.array([-1, *(symbols[c] for c in letters)], np.int32)
        self.beside = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        place = {c: k for k, c in enumerate(letters, 1)}
        self.byte_id = np.array([names.index(f"<0x{b:02X}>") for b in range(256)], np.int32)
        order = {s: k for k, s in enumerate(sorted({scores[k] for _, k in normal}, reverse=True))}
        self.rank = np.array([order.get(s, LAST) for s in scores] + [LAST], np.int32)
        made: dict[int, int] = {}
        for name, k in normal:
            for cut in range(1, len(name)):
                self.beside[place[name[cut - 1]], place[name[cut]]] = True
                left, right = symbols.get(name[:cut]), symbols.get(name[cut:])
                if left is not None and right is not None:
                    made[left << 32 | right] = k
        self._keep_pairs(np.array(sorted(made), np.int64), np.array([made[p] for p in sorted(made)], np.int32))
        # Characters that are no piece are written by their bytes in the end.
        self.loose = {k: np.array([self.byte_id[b] for b in s.encode("utf-8")], np.int32) for s, k in symbols.items() if k >= len(names)}
        surface = [b"" if kind == CONTROL else bytes([int(name[1:-1], 16)]) if kind == BYTE else name.replace(MARK, " ").encode("utf-8") for name, kind in zip(names, kinds.tolist(), strict=True)]
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.surface_stop = np.cumsum([len(s) for s in surface])
        self.surface_size = np.array([len(s) for s in surface])
        # What begins a decoded text: control pieces are passed over, and a piece with a mark loses it.
        self.marked = np.array([kind == NORMAL and name.startswith(MARK) for name, kind in zip(names, kinds.tolist(), strict=True)])
        self.control, self.unknown = kinds == CONTROL, kinds == UNKNOWN

    def _keep_pairs(self, pairs: np.ndarray, merged: np.ndarray) -> None:
        """A hash table of the pairs: each lies at the first free slot from its own on."""
        self.slot_bits = int(len(pairs) * 4).bit_length()
        self.slots = np.full((1 << self.slot_bits) + len(pairs), -1, np.int64)
        self.merged = np.full(len(self.slots), NO_PAIR)
        at, left = self._slot(pairs), np.arange(len(pairs))
        while len(left):
            # Of the pairs that want one slot the first has it, if it is free; the others go on to the next.
            _, first = np.unique(at[left], return_index=True)
            here = left[first][self.slots[at[left[first]]] < 0]
            self.slots[at[here]], self.merged[at[here]] = pairs[here], merged[here]
            left = left[self.slots[at[left]] != pairs[left]]
            at[left] += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(tx.STEP)) >> np.uint64(64 - self.slot_bits)).astype(np.int64)

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair of symbols makes, or NO_PAIR."""
        keys = left.astype(np.int64) << 32 | right
        at = self._slot(keys)
        found = self.slots[at]
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            at[open_] += 1
            found = self.slots[at[open_]]
            open_ = open_[(found != keys[open_]) & (found >= 0)]
        return np.where(self.slots[at] == keys, self.merged[at], NO_PAIR)

    def words(self, characters: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Where words begin: at rows, and between neighbours that no piece holds side by side."""
        letter = self.letter[characters]
        cut = np.ones(len(letter), bool)
        cut[1:] = ~self.beside[letter[:-1], letter[1:]]
        cut[edges[:-1][edges[:-1] < len(cut)]] = True
        return np.flatnonzero(cut)

    def merge(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and their words once no pair is left; words ascend."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        pair = np.full(len(symbols), NO_PAIR)
        same = np.flatnonzero(word[:-1] == word[1:])
        pair[same] = self.pair(symbols[same], symbols[same + 1])
        while len(symbols):
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            sizes = np.diff(np.append(starts, len(word)))
            rank = self.rank[pair]
            best = np.minimum.reduceat(rank, starts)
            open_ = np.repeat(best < LAST, sizes)
            if not open_.all():
                done.append((symbols[~open_], word[~open_]))
                symbols, word, pair, rank, best = symbols[open_], word[open_], pair[open_], rank[open_], np.repeat(best, sizes)[open_]
                if not len(symbols):
                    break
            else:
                best = np.repeat(best, sizes)
            hit = np.flatnonzero(rank == best)
            # Every second one of hits that overlap, from the left.
            run = np.append(True, (hit[1:] != hit[:-1] + 1) | (word[hit[1:]] != word[hit[:-1]]))
            first = np.flatnonzero(run)
            hit = hit[(np.arange(len(hit)) - np.repeat(first, np.diff(np.append(first, len(hit))))) % 2 == 0]
            hit = self._safe(hit, symbols, word, pair, best)
            symbols = symbols.copy()
            symbols[hit] = pair[hit]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            place = np.cumsum(keep) - 1
            symbols, word, pair = symbols[keep], word[keep], pair[keep]
            new = place[hit]
            pair[new] = NO_PAIR
            touched = np.zeros(len(word), bool)
            touched[new] = touched[np.maximum(new - 1, 0)] = True
            changed = np.flatnonzero(touched[:-1])
            inside = word[changed] == word[changed + 1]
            pair[changed[~inside]] = NO_PAIR
            changed = changed[inside]
            pair[changed] = self.pair(symbols[changed], symbols[changed + 1])
        if not done:
            return symbols, word
        symbols, word = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(word, kind="stable")
        return symbols[order], word[order]

    def _safe(self, hit: np.ndarray, symbols: np.ndarray, word: np.ndarray, pair: np.ndarray, best: np.ndarray) -> np.ndarray:
        """Hits to merge at once: all of a word, or its first where a merge makes a pair as good as the merged or better."""
        own, made, limit = word[hit], pair[hit], best[hit]
        several = np.append(False, own[1:] == own[:-1])
        if not several.any():
            return hit
        left, right = np.maximum(hit - 1, 0), np.minimum(hit + 2, len(symbols) - 1)
        before = symbols[left].copy()
        follows = np.flatnonzero(several & np.append(False, hit[1:] == hit[:-1] + 2))
        before[follows] = made[follows - 1]
        rank = lambda a, b, there: np.where(there, self.rank[self.pair(a, b)], LAST)
        risky = (rank(before, made, (hit > 0) & (word[left] == own)) <= limit) | (rank(made, symbols[right], (hit + 2 < len(symbols)) & (word[right] == own)) <= limit)
        if not risky.any():
            return hit
        return hit[~(several & np.isin(own, own[risky]))]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a slice of rows of bytes and each row's first id (rows + 1); offsets begin at 0."""
        filled = np.diff(offsets) > 0
        # A word mark before every row that is not empty; a space stands for it.
        data = np.insert(data, offsets[:-1][filled], 0x20)
        offsets = offsets + np.append(0, np.cumsum(filled))
        raw = data.tobytes()
        if MARK.encode() in raw:
            lost = np.cumsum(_mark_tails(data))
            data = _unmarked(data)
            offsets = offsets - np.append(0, lost)[offsets]
            raw = data.tobytes()
        if not raw:
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        characters = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        at = np.flatnonzero((data & 0xC0) != 0x80)
        first = self.words(characters, np.searchsorted(at, offsets))
        starts = at[first]
        lengths = np.diff(np.append(starts, len(data)))
        distinct, inverse = tx.distinct_spans(data, starts, lengths)
        ids, sizes = self._encode_words(characters, data, first[distinct], starts[distinct], lengths[distinct], np.diff(np.append(first, len(characters)))[distinct])
        begins = np.cumsum(sizes) - sizes
        counts = sizes[inverse]
        stops = np.cumsum(counts)
        out = ids[np.repeat(begins[inverse] - (stops - counts), counts) + np.arange(stops[-1])]
        return out, np.append(0, stops)[np.searchsorted(starts, offsets)]

    def _encode_words(self, characters: np.ndarray, data: np.ndarray, first: np.ndarray, starts: np.ndarray, lengths: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, one after the other, and how many each has."""
        letter = self.letter[characters[first]]
        known = letter > 0
        spread = lambda begin, size: np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        word = np.repeat(np.flatnonzero(known), sizes[known])
        symbols, word = self.merge(self.letter_symbol[self.letter[characters[spread(first[known], sizes[known])]]], word)
        # A character of no piece is a word of its own, written by its bytes.
        other = self.byte_id[data[spread(starts[~known], lengths[~known])]]
        word = np.append(word, np.repeat(np.flatnonzero(~known), lengths[~known]))
        ids = np.append(symbols, other)
        order = np.argsort(word, kind="stable")
        ids, word = ids[order], word[order]
        if self.loose and (loose := np.isin(ids, list(self.loose))).any():
            parts = [self.loose[i] if hit else np.array([i], np.int32) for i, hit in zip(ids.tolist(), loose.tolist(), strict=True)]
            word, ids = np.repeat(word, [len(p) for p in parts]), np.concatenate(parts)
        return ids, np.bincount(word, minlength=len(first))

    def decode(self, ids: np.ndarray, edges: np.ndarray) -> pa.Array:
        """Texts of rows of ids; edges: each row's first id (rows + 1)."""
        if len(ids) and not 0 <= ids.min() <= ids.max() < len(self.surface_size):
            raise ValueError("an id outside the vocabulary")
        sizes = self.surface_size[ids]
        stops = np.cumsum(sizes)
        flat = self.surface[np.repeat(self.surface_stop[ids] - stops, sizes) + np.arange(int(stops[-1]) if len(stops) else 0)]
        offsets = np.append(0, stops)[edges]
        rows = len(edges) - 1
        # The first piece that is no control piece gives up its mark; rows that begin otherwise, or hold pieces of other rules, go to the library.
        told = np.flatnonzero(~self.control[ids])
        begin = np.searchsorted(told, edges[:-1])
        filled = begin < np.searchsorted(told, edges[1:])
        head = told[begin[filled]]
        odd = np.zeros(rows, bool)
        odd[np.flatnonzero(filled)[~self.marked[ids[head]]]] = True
        if (strange := np.flatnonzero(self.unknown[ids])).size:
            odd[np.searchsorted(edges, strange, side="right") - 1] = True
        keep = np.ones(len(flat), bool)
        keep[(stops - sizes)[head[self.marked[ids[head]]]]] = False
        offsets = np.append(0, np.cumsum(keep))[offsets]
        raw = flat[keep].tobytes()
        try:
            raw.decode("utf-8")
            if not odd.any():
                return pa.LargeStringArray.from_buffers(rows, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw)).cast(pa.string())
        except UnicodeDecodeError:
            pass
        out = []
        for k in range(rows):
            part = raw[offsets[k] : offsets[k + 1]]
            try:
                out.append(None if odd[k] else part.decode("utf-8"))
            except UnicodeDecodeError:
                out.append(None)
        if None in out:
            from sentencepiece import SentencePieceProcessor

            library = SentencePieceProcessor(model_file=self.path)
            out = [library.decode(ids[edges[k] : edges[k + 1]].tolist()) if v is None else v for k, v in enumerate(out)]
        return pa.array(out, pa.string())


def _mark_heads(data: np.ndarray) -> np.ndarray:
    """Where the three bytes of the mark begin."""
    heads = np.zeros(len(data), bool)
    if len(data) > 2:
        heads[:-2] = (data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)
    return heads


def _mark_tails(data: np.ndarray) -> np.ndarray:
    """The second and third bytes of marks."""
    heads, tails = np.flatnonzero(_mark_heads(data)), np.zeros(len(data), bool)
    tails[heads + 1] = tails[heads + 2] = True
    return tails


def _unmarked(data: np.ndarray) -> np.ndarray:
    """data with a space for each mark."""
    out = data.copy()
    out[_mark_heads(data)] = 0x20
    return out[~_mark_tails(data)]


@lru_cache(maxsize=1)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _lists(ids: list[np.ndarray], counts: list[np.ndarray]) -> pa.Array:
    sizes = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)))


def encode_column(column: pa.Array, vocab: Vocabulary, end: bool = True) -> pa.Array:
    """Lists of ids of an Arrow text column, with the end id behind each."""
    offsets, data = tx.column_bytes(column)
    ids, counts = [], []
    for i, j in tx.slices(offsets, SLICE_BYTES):
        found, edges = vocab.encode(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        ids.append(np.insert(found, edges[1:], vocab.end_id) if end else found)
        counts.append(np.diff(edges) + end)
    return _lists(ids, counts)


def encode(text: Column, path: str | None = None, end: bool = True) -> Column:
    """Array of ids of a text column; with end the end id stands behind them."""
    path = model_path(path)

    @F.arrow_udf(T.ArrayType(T.IntegerType(), False))
    def ids_of(column: pa.Array) -> pa.Array:
        return encode_column(column, vocabulary(path), end)

    return ids_of(text)


def decode(ids: Column, path: str | None = None) -> Column:
    """Text of an array of ids."""
    path = model_path(path)

    @F.arrow_udf(T.StringType())
    def text_of(column: pa.Array) -> pa.Array:
        vocab = vocabulary(path)
        lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        sizes = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        edges = np.append(0, np.cumsum(sizes))
        # As many rows at a time as hold about SLICE_BYTES ids.
        parts = [vocab.decode(flat[edges[i] : edges[j]], edges[i : j + 1] - edges[i]) for i, j in tx.slices(edges, SLICE_BYTES)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return text_of(ids)
