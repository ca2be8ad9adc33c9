"""An FM-index over word symbols: suffix array, wavelet matrix, backward search and sampled positions, on whole arrays.

The text is a sequence of runs of symbols 1..V, each followed by the separator 0. Separators differ from each other by
their position, so comparing two suffixes ends at the first separator and ties are settled by position.
"""

from __future__ import annotations

import numpy as np

#: Every so many positions, and at every run's first symbol, the position is stored.
SAMPLE_EVERY = 8


def suffix_array(text: np.ndarray, bits: int) -> np.ndarray:
    """Positions in the order of their suffixes. Keys of as many symbols as 62 bits hold, then prefix doubling."""
    n = len(text)
    ends = np.flatnonzero(text == 0)
    left = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)  # symbols before the separator
    width = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for k in range(width):
        part = np.zeros(n, np.int64)
        part[:max(0, n - k)] = text[k:]
        part[left < k] = 0
        key = (key << bits) | part
    longest = int(left.max()) if n else 0
    while True:
        order = np.argsort(key, kind="stable")
        if width > longest:
            return order
        ordered = key[order]
        fresh = np.concatenate([[1], ordered[1:] != ordered[:-1]])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh)
        after = np.zeros(n, np.int64)
        after[:n - width] = rank[width:]
        after[left < width] = 0
        key = rank * (n + 2) + after
        width *= 2


class WaveletMatrix:
    """Ranks of symbols: each level holds one bit of every symbol, zeros before ones."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.levels = bits, []
        for level in range(bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            packed = np.packbits(bit.astype(np.uint8), bitorder="little")
            packed = np.concatenate([packed, np.zeros(-len(packed) % 8 + 8, np.uint8)]).view(np.uint64)
            ones = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])
            self.levels.append((packed, ones, len(symbols) - int(ones[-1])))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])
        self.first = self._moved(np.arange(1 << bits), np.zeros(1 << bits, np.int64))

    def _moved(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, (packed, ones, zeros) in enumerate(self.levels):
            word = at >> 6
            low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            before = ones[word] + np.bitwise_count(packed[word] & low)
            at = np.where((symbol >> (self.bits - 1 - k)) & 1, zeros + before, at - before)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before position `at`."""
        return self._moved(symbol, at) - self.first[symbol]


class FMIndex:
    def __init__(self, text: np.ndarray, n_symbols: int):
        """text: int64, runs of 1..n_symbols, each run followed by 0."""
        bits = max(1, int(n_symbols).bit_length())
        order = suffix_array(text, bits)
        self.last = text[order - 1]
        self.last[order == 0] = 0
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols + 1))])
        self.ranks = WaveletMatrix(self.last, bits)
        sampled = (order % SAMPLE_EVERY == 0) | (self.last == 0)
        self.sampled, self.sample_no, self.samples = sampled, np.cumsum(sampled) - 1, order[sampled]
        self.n = len(text)

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end row of the suffixes that start with each pattern (right-aligned, 0 before); equal if none."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n)
        for k in range(patterns.shape[1]):
            active = np.flatnonzero((k < lengths) & (low < high))
            symbol = patterns[active, patterns.shape[1] - 1 - k]
            low[active] = self.smaller[symbol] + self.ranks.rank(symbol, low[active])
            high[active] = self.smaller[symbol] + self.ranks.rank(symbol, high[active])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: step to the symbol before until a stored position is met."""
        rows, steps, found = rows.copy(), np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            done = self.sampled[rows[open_]]
            ready = open_[done]
            found[ready] = self.samples[self.sample_no[rows[ready]]] + steps[ready]
            open_ = open_[~done]
            symbol = self.last[rows[open_]]
            rows[open_] = self.smaller[symbol] + self.ranks.rank(symbol, rows[open_])
            steps[open_] += 1
        return found
