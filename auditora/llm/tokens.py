"""Byte-level BPE ids of whole texts by the tokenizers library, each distinct chunk encoded once.

The pre-tokenizer of byte_bpe_50k starts a piece at every space that stands
before a visible character, where an ASCII letter gives way to another ASCII
character, at a line feed after a visible ASCII character and after such a line
feed when a visible ASCII character follows, whatever stands around: no alternative of its pattern crosses those places, and its look-ahead
sees the same there as at the end of a text.  So a text may be cut there and
the parts encoded apart; parts repeat often, so a bounded memo holds their ids.

The literal of an added token, such as <|endoftext|>, is that token's id, as in
the library at its defaults: it is a chunk of its own, and the text on either
side is encoded as if it began or ended there.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache
from threading import Lock, Timer

import numpy as np
import pyarrow as pa
import regex

from . import text as tx

# Fixed values of this vocabulary: its split pattern, and the characters its bytes are written as.
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_CHARS = {b: b for b in _PRINTED} | {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}
_LINE = chr(_BYTE_CHARS[0x0A])
# Characters whose classes every Unicode version shares; chunks with others go to the library whole.
_PLAIN = regex.compile(r"[\n\t\x20-\x7e\u00c0-\u024f]+")
# The same letters as bytes, after one space or none: one piece each.
_WORD = re.compile(rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|[\xc4-\xc8][\x80-\xbf]|\xc9[\x80-\x8f])+")
DEFAULT_TOKENIZER = "byte_bpe_50k.json"
MEMO_ENTRIES = 700_000
IDLE_SECONDS = 2.0
SLICE_BYTES = 4 << 20

_SOLID = np.zeros(256, bool)
_SOLID[0x21:0x7F] = True
# Lead bytes of multi-byte characters, less those under which white space lies (C2, E1, E2, E3).
_VISIBLE = _SOLID.copy()
_VISIBLE[0xC3:0xF5] = True
_VISIBLE[[0xE1, 0xE2, 0xE3]] = False
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_OTHER = ~_LETTER
_OTHER[0x80:] = False


def tokenizer_path(path: str | None = None) -> str:
    """Path of the tokenizer file; by default the public byte-level vocabulary."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(DEFAULT_TOKENIZER)


def chunk_starts(data: np.ndarray, offsets: np.ndarray, added: np.ndarray | None = None) -> np.ndarray:
    """Byte positions where a text may be cut without changing its ids; every row start is one.

    added: starts and ends of the literals of added tokens, which are chunks whole."""
    added = np.zeros((0, 2), np.int64) if added is None else added
    n = len(data)
    cut = np.zeros(n + 1, bool)
    if n > 1:
        visible, solid = _VISIBLE[data], _SOLID[data]
        cut[: n - 1] = (data[:-1] == 0x20) & visible[1:]
        cut[1:n] |= _LETTER[data[:-1]] & _OTHER[data[1:]]
        line = np.zeros(n, bool)
        line[1:] = (data[1:] == 0x0A) & solid[:-1]
        line[offsets[:-1][offsets[:-1] < n]] = False
        line[added[:, 1][added[:, 1] < n]] = False
        cut[:n] |= line
        cut[1:n] |= line[:-1] & solid[1:]
    for a, b in added.tolist():
        cut[a + 1 : b] = False
    cut[added] = True
    cut[offsets[:-1]] = True
    return np.flatnonzero(cut[:n])


class Encoder:
    """Encodes Arrow text columns; its memo of chunks is bounded."""

    turn = 0

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.words = Tokenizer(self.model)
        tokens = self.library.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word for t in tokens.values()):
            raise ValueError("added tokens that take in or ask for what stands around them are not supported")
        self.added = {t.content: k for k, t in tokens.items()}
        # The longest of those that begin at a place, as in the library.
        self.literals = {t.encode("utf-8") for t in self.added}
        self.literal = re.compile(b"|".join(map(re.escape, sorted(self.literals, key=len, reverse=True)))) if self.literals else None
        self.forget()

    def forget(self) -> None:
        self.place: dict[bytes, int] = {}
        self.pieces: dict[str, list[int]] = {}
        self.flat = np.zeros(0, np.uint32)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)

    def _ids(self, part: str) -> list[int]:
        """Ids of a chunk that is no word; plain ones are split by the pattern here and only new pieces reach the model."""
        if part in self.added:
            return [self.added[part]]
        if not _PLAIN.fullmatch(part):
            return self.library.encode(part, add_special_tokens=False).ids
        out: list[int] = []
        for piece in _PIECES.findall(part):
            ids = self.pieces.get(piece)
            if ids is None:
                ids = self.pieces[piece] = [t.id for t in self.model.tokenize(piece.encode("utf-8").decode("latin-1").translate(_BYTE_CHARS))]
            out += ids
        return out

    def _learn(self, parts: list[bytes]) -> None:
        plain = [_WORD.fullmatch(part) is not None and part not in self.literals for part in parts]
        words = [part for part, word in zip(parts, plain, strict=True) if word]
        others = [part for part, word in zip(parts, plain, strict=True) if not word]
        flat, lengths = [self.flat], [self.lengths]
        if words:
            # One call for all words, each a word of its own to the model.
            found = self.words.encode(b"\n".join(words).decode("latin-1").translate(_BYTE_CHARS).split(_LINE), is_pretokenized=True, add_special_tokens=False)
            flat.append(np.array(found.ids, np.uint32))
            lengths.append(np.bincount(np.array(found.word_ids, np.int64), minlength=len(words)))
        ids = [self._ids(part.decode("utf-8")) for part in others]
        flat.append(np.array([i for own in ids for i in own], np.uint32))
        lengths.append(np.array([len(own) for own in ids], np.int64))
        self.place.update(zip([*words, *others], range(len(self.place), len(self.place) + len(parts)), strict=True))
        self.lengths = np.concatenate(lengths)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.concatenate(flat)

    def _added(self, raw: bytes, offsets: np.ndarray) -> np.ndarray:
        """Starts and ends of the added tokens' literals inside rows."""
        found: list[tuple[int, int]] = []
        if self.literal and self.literal.search(raw):
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                found += [m.span() for m in self.literal.finditer(raw, a, b)]
        return np.array(found, np.int64).reshape(-1, 2)

    def _slice(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        starts = chunk_starts(data, offsets, self._added(raw, offsets))
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        ends = np.append(starts[1:], len(data))
        first, inverse = tx.distinct_spans(data, starts, ends - starts)
        parts = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
        if len(self.place) > MEMO_ENTRIES or len(self.flat) > 16 * MEMO_ENTRIES:
            self.forget()
        place = self.place
        fresh = [p for p in parts if p not in place]
        if fresh:
            self._learn(fresh)
        rows = np.array([place[p] for p in parts], np.int64)[inverse]
        counts = self.lengths[rows]
        ends_at = np.cumsum(counts)
        ids = self.flat[np.repeat(self.starts[rows] - (ends_at - counts), counts) + np.arange(ends_at[-1])]
        edge = np.append(0, ends_at)[np.searchsorted(starts, offsets)]
        return ids, edge

    def rows(self, column: pa.Array, end_id: int | None = 0):
        """Yields each row's ids as uint32, with end_id at the end unless it is None."""
        offsets, data = tx.column_bytes(column)
        for i, j in tx.slices(offsets, SLICE_BYTES):
            part = data[offsets[i] : offsets[j]]
            ids, edge = self._slice(part, offsets[i : j + 1] - offsets[i])
            for a, b in zip(edge[:-1], edge[1:], strict=True):
                yield ids[a:b] if end_id is None else np.append(ids[a:b], np.uint32(end_id))


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


_turn = Lock()


def _forget_idle(encoder: Encoder, turn: int) -> None:
    with _turn:
        if encoder.turn == turn:
            encoder.forget()


@contextmanager
def worker_encoder(path: str) -> Iterator[Encoder]:
    """The encoder of this Python worker: later tasks in it know the chunks that earlier ones have learned.

    A worker that has not encoded for IDLE_SECONDS gives the memo's memory back."""
    encoder = _encoder(path)
    with _turn:
        encoder.turn += 1
        turn = encoder.turn
    try:
        yield encoder
    finally:
        timer = Timer(IDLE_SECONDS, _forget_idle, (encoder, turn))
        timer.daemon = True
        timer.start()
