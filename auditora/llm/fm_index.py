"""FM-index over words: suffix order, Burrows-Wheeler transform and a wavelet matrix, in numpy.

Texts are sequences of word ids, each closed by a sentinel of its own.  Many
patterns are searched in step, so every operation is one on arrays.
"""

from __future__ import annotations

import numpy as np

U = np.uint64


class BitVector:
    """Bits in 64-bit words with counts before each word; rank by population count."""

    def __init__(self, bits: np.ndarray) -> None:
        n = len(bits)
        packed = np.packbits(np.append(bits, np.zeros(-n % 64 + 64, bool)), bitorder="little")
        self.words = packed.view(U)
        self.before = np.append(0, np.cumsum(np.bitwise_count(self.words).astype(np.int64)))[:-1].astype(np.int32)
        self.zeros = n - int(bits.sum())

    def rank1(self, i: np.ndarray) -> np.ndarray:
        word, bit = i >> 6, (i & 63).astype(U)
        return self.before[word] + np.bitwise_count(self.words[word] & ((U(1) << bit) - U(1))).astype(np.int64)


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, top: int) -> None:
        self.levels: list[tuple[int, BitVector]] = []
        now = symbols
        for shift in range(max(1, top.bit_length()) - 1, -1, -1):
            bits = (now >> shift & 1).astype(bool)
            self.levels.append((shift, BitVector(bits)))
            now = np.concatenate([now[~bits], now[bits]])
        # Where the occurrences of each symbol begin in the last level.
        self.begin = self._map(np.arange(top + 1), np.zeros(top + 1, np.int64))

    def _map(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for shift, bits in self.levels:
            ones = bits.rank1(i)
            i = np.where(symbol >> shift & 1, bits.zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place."""
        return self._map(symbol, i) - self.begin[symbol]


class FMIndex:
    """Index of texts of word ids from 1 on; window is the length that matches are cut to."""

    def __init__(self, texts: np.ndarray, lengths: np.ndarray, window: int) -> None:
        count = len(lengths)
        self.starts = np.cumsum(lengths + 1) - lengths - 1
        n = int(len(texts) + count)
        at = np.arange(len(texts)) + np.repeat(np.arange(count), lengths)
        self.symbols = np.zeros(n, np.int64)
        self.symbols[at] = texts
        self.owner = np.repeat(np.arange(count), lengths + 1)
        rank = self.symbols + count - 1
        rank[self.symbols == 0] = np.arange(count)  # every sentinel is less than any word, and its own
        parts = [1 << k for k in range(window.bit_length()) if window >> k & 1]
        kept: dict[int, np.ndarray] = {}
        length = 1
        while True:
            if length in parts:
                kept[length] = rank
            key = rank * (n + count + 2) + np.append(rank[length:], np.full(min(length, n), -1))[:n] + 1
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            fresh = np.append(True, ordered[1:] != ordered[:-1])[:n]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(fresh) - 1
            length *= 2
            if fresh.all() and length > max(parts):
                break
        self.suffixes = order
        self.bwt = self.symbols[order - 1]
        top = int(self.symbols.max(initial=0))
        self.less = np.append(0, np.cumsum(np.bincount(self.symbols, minlength=top + 1)))
        self.tree = WaveletMatrix(self.bwt, top)
        # Suffixes that agree in their first words, window of them, are a group of neighbours; sentinels never agree.
        differs = np.zeros(n, bool)
        differs[:1] = True
        offset = 0
        for part in sorted(parts, reverse=True):
            there = np.minimum(order + offset, n - 1)
            value = np.where(order + offset < n, kept[part][there], -1)
            differs[1:] |= value[1:] != value[:-1]
            offset += part
        self.group = np.cumsum(differs) - 1
        self.group_start = np.flatnonzero(differs)
        self.group_end = np.append(self.group_start[1:], n)
        self.window = window

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: intervals of suffixes for symbol before the patterns."""
        return self.less[symbol] + self.tree.rank(symbol, low), self.less[symbol] + self.tree.rank(symbol, high)

    def _longest(self, text: np.ndarray) -> tuple[int, int, int]:
        """Interval and length of the longest beginning of text that occurs; its first word does."""
        for length in range(len(text), 0, -1):
            low, high = np.zeros(1, np.int64), np.full(1, len(self.symbols), np.int64)
            for k in range(length - 1, -1, -1):
                low, high = self.extend(text[k : k + 1], low, high)
                if low[0] >= high[0]:
                    break
            else:
                return int(low[0]), int(high[0]), length
        raise ValueError("a word that is known does not occur")

    def matching(self, texts: np.ndarray, lengths: np.ndarray):
        """Streams texts from their ends; yields (text, place, interval's first row) wherever window words match.

        The matching statistic of a place is cut to window words: once a match is longer, its interval widens
        to that of its first words.  Where a word cannot go before a match, the match loses last words until it can."""
        begin = np.cumsum(lengths) - lengths
        order = np.argsort(-lengths, kind="stable")
        size = lengths[order]
        low, high = np.zeros(len(order), np.int64), np.full(len(order), len(self.symbols), np.int64)
        matched = np.zeros(len(order), np.int64)
        for step in range(int(size[0]) if len(size) else 0):
            live = int(np.searchsorted(-size, -step, side="left"))
            place = size[:live] - 1 - step
            symbol = texts[begin[order[:live]] + place]
            known = (symbol > 0) & (symbol < len(self.less) - 1)
            a, b = self.extend(np.where(known, symbol, 0), low[:live], high[:live])
            length = matched[:live] + 1
            for lane in np.flatnonzero(known & (a >= b)).tolist():
                at = begin[order[lane]] + place[lane]
                a[lane], b[lane], length[lane] = self._longest(texts[at : at + matched[lane]])
            long = length > self.window
            group = self.group[np.minimum(a, len(self.group) - 1)]
            low[:live] = np.where(known, np.where(long, self.group_start[group], a), 0)
            high[:live] = np.where(known, np.where(long, self.group_end[group], b), len(self.symbols))
            matched[:live] = np.where(known, np.minimum(length, self.window), 0)
            full = np.flatnonzero(matched[:live] == self.window)
            if len(full):
                yield order[full], place[full], low[full]
