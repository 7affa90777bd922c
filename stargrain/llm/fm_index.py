"""An FM-index over a shard's words: suffix array, Burrows-Wheeler transform in a
wavelet matrix, backward search and sampled suffix positions, all in numpy.

Symbols are 12-bit folds of the word hashes (2..4095; 1 ends a document, 0 ends
the shard), so the alphabet is bounded whatever the vocabulary; a located
occurrence is compared word for word by the caller, which removes fold collisions.
"""

from __future__ import annotations

import numpy as np

BITS = 12
END, SEPARATOR, FIRST = 0, 1, 2
SAMPLE = 8


def fold(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64((1 << BITS) - FIRST)).astype(np.int64) + FIRST


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Sorted suffix positions by prefix tripling; every separator counts as a
    symbol of its own (by position), so no two suffixes are equal and no
    comparison runs past a document."""
    n = len(symbols)
    if n >= 1 << 20:
        raise ValueError("a shard holds fewer than 2**20 symbols")
    separators = np.flatnonzero(symbols <= SEPARATOR)
    # the end symbol first, separators by position, then the words
    rank = symbols + len(separators)
    rank[separators] = np.arange(1, len(separators) + 1)
    rank[-1] = 0
    padded = np.concatenate([rank, np.zeros(2, np.int64)])
    key = (padded[:n] << 42) | (padded[1:n + 1] << 21) | padded[2:n + 2]
    sa = np.argsort(key)
    sorted_key = key[sa]
    first = np.ones(n, dtype=bool)
    first[1:] = sorted_key[1:] != sorted_key[:-1]
    index = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(first, index, 0))
    slots = index[~(first & np.append(first[1:], True))]
    reach = 3
    while len(slots):
        at = sa[slots]
        key = (rank[at] << 42) | (rank[np.minimum(at + reach, n - 1)] << 21) | rank[np.minimum(at + 2 * reach, n - 1)]
        order = np.argsort(key)
        at, key = at[order], key[order]
        sa[slots] = at
        first = np.ones(len(at), dtype=bool)
        first[1:] = key[1:] != key[:-1]
        lead = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
        rank[at] = slots[lead]
        slots = slots[~(first & np.append(first[1:], True))]
        reach *= 3
    return sa


class FMIndex:
    """``symbols``: word symbols with a SEPARATOR after each document and END last."""

    def __init__(self, symbols: np.ndarray):
        n = self.n = len(symbols)
        sa = suffix_array(symbols)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=1 << BITS))]).astype(np.int64)
        level = symbols[sa - 1]  # for position 0 this wraps to END
        self.ones, self.zeros = [], []
        for bit in range(BITS - 1, -1, -1):
            b = (level >> bit) & 1
            count = np.zeros(n + 1, np.int32)
            np.cumsum(b, out=count[1:])
            self.ones.append(count)
            self.zeros.append(n - int(count[-1]))
            b = b.astype(bool)
            level = np.concatenate([level[~b], level[b]])
        # suffix positions kept at every SAMPLE-th position and at each document's first word
        kept = (sa % SAMPLE == 0) | (symbols[sa - 1] <= SEPARATOR)
        self.kept = kept
        self.kept_before = np.concatenate([[0], np.cumsum(kept)])
        self.positions = sa[kept]

    def _rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before ``at`` in the transform, plus the symbol's start in the last level."""
        for level in range(BITS):
            bit = ((symbol >> (BITS - 1 - level)) & 1).astype(bool)
            ones = self.ones[level][at]
            at = np.where(bit, self.zeros[level] + ones, at - ones)
        return at

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        base = self._rank(symbol, np.zeros(len(symbol), np.int64))
        start = self.first[symbol]
        return start + self._rank(symbol, low) - base, start + self._rank(symbol, high) - base

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of the patterns (rows of ``patterns``, of the given lengths), by backward search."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        live = np.flatnonzero(lengths > 0)
        high[lengths <= 0] = 0
        back = 1
        while len(live):
            symbol = patterns[live, lengths[live] - back].astype(np.int64)
            low[live], high[live] = self.step(symbol, low[live], high[live])
            back += 1
            live = live[(low[live] < high[live]) & (lengths[live] >= back)]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix-array rows: steps back to the nearest kept position."""
        rows, out = rows.copy(), np.zeros(len(rows), np.int64)
        live = np.arange(len(rows))
        steps = 0
        while len(live):
            here = rows[live]
            done = self.kept[here]
            out[live[done]] = self.positions[self.kept_before[here[done]]] + steps
            live = live[~done]
            at, symbol = rows[live], np.zeros(len(live), np.int64)
            base = np.zeros(len(live), np.int64)
            for level in range(BITS):
                ones, low = self.ones[level][at], self.ones[level][base]
                bit = (self.ones[level][at + 1] - ones).astype(bool)
                symbol = (symbol << 1) | bit
                at = np.where(bit, self.zeros[level] + ones, at - ones)
                base = np.where(bit, self.zeros[level] + low, base - low)
            rows[live] = self.first[symbol] + at - base
            steps += 1
        return out
