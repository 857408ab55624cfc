"""An FM-index over a sequence of small integers, with numpy.

Suffixes are sorted by prefix doubling, in which later rounds only sort suffixes that are still tied.
The Burrows-Wheeler transform is kept as a wavelet matrix; patterns are searched backwards, all at
once, and their places found by walking to the next sampled suffix position.
"""

from __future__ import annotations

import numpy as np

#: Every so many text positions a suffix position is kept.
SAMPLE = 16


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``text``; a shorter suffix comes before a longer one it begins."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    fresh = np.append(True, text[order][1:] != text[order][:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    tied = ~(fresh & np.append(fresh[1:], True))
    step = 1
    while tied.any():
        places = np.flatnonzero(tied)
        suffixes = order[places]
        later = suffixes + step
        second = np.where(later < n, rank[np.minimum(later, n - 1)] + 1, 0)
        first = rank[suffixes]
        by = np.lexsort((second, first))
        suffixes, first, second = suffixes[by], first[by], second[by]
        order[places] = suffixes
        fresh = np.append(True, (first[1:] != first[:-1]) | (second[1:] != second[:-1]))
        rank[suffixes] = np.maximum.accumulate(np.where(fresh, places, 0))
        tied[places] = ~(fresh & np.append(fresh[1:], True))
        step *= 2
    return order


class WaveletMatrix:
    """Symbols by bit, the highest first; ``rank`` counts a symbol in a prefix."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        for bit in range(bits - 1, -1, -1):
            ones = (symbols >> bit) & 1
            counts = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(ones, out=counts[1:])
            zeros = len(symbols) - int(counts[-1])
            self.levels.append((bit, counts, zeros))
            symbols = np.concatenate((symbols[ones == 0], symbols[ones == 1]))

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each end."""
        start = np.zeros_like(end)
        for bit, counts, zeros in self.levels:
            one = (symbol >> bit) & 1 == 1
            s, e = counts[start], counts[end]
            start, end = np.where(one, zeros + s, start - s), np.where(one, zeros + e, end - e)
        return end - start

    def access(self, at: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(at)
        for bit, counts, zeros in self.levels:
            before = counts[at]
            one = counts[at + 1] > before
            symbol |= one.astype(symbol.dtype) << bit
            at = np.where(one, zeros + before, at - before)
        return symbol


class FmIndex:
    """Index of ``text``, whose symbols are 1 to ``n_symbols``."""

    def __init__(self, text: np.ndarray, n_symbols: int):
        text = np.append(text.astype(np.int64), 0)  # the end, less than any symbol
        suffixes = suffix_array(text)
        self.first = np.zeros(n_symbols + 2, np.int64)
        np.cumsum(np.bincount(text, minlength=n_symbols + 1), out=self.first[1:])
        self.tree = WaveletMatrix(text[suffixes - 1], max(1, int(n_symbols).bit_length()))
        kept = suffixes % SAMPLE == 0
        self.sampled = np.zeros(len(text) + 1, np.int64)
        np.cumsum(kept, out=self.sampled[1:])
        self.positions = suffixes[kept]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of rows that begin with each pattern (a row of ``patterns``, filled at its end).

        A pattern with a symbol that is not in the text, or 0, has an empty range.
        """
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), len(self.sampled) - 1, np.int64)
        for place in range(patterns.shape[1] - 1, -1, -1):
            on = np.flatnonzero((place < lengths) & (low < high))
            symbol = patterns[on, place]
            low[on] = self.first[symbol] + self.tree.rank(symbol, low[on])
            high[on] = self.first[symbol] + self.tree.rank(symbol, high[on])
            gone = on[symbol == 0]
            high[gone] = low[gone]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row."""
        rows, walked = rows.copy(), np.zeros(len(rows), np.int64)
        found = np.full(len(rows), -1, np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            at = rows[open_]
            hit = self.sampled[at + 1] > self.sampled[at]
            done = open_[hit]
            found[done] = self.positions[self.sampled[rows[done]]] + walked[done]
            open_ = open_[~hit]
            at = rows[open_]
            symbol = self.tree.access(at)
            rows[open_] = self.first[symbol] + self.tree.rank(symbol, at)
            walked[open_] += 1
        return found
