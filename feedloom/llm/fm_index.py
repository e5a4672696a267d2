"""An FM-index over one shard's words: Burrows-Wheeler transform, wavelet ranks, sampled suffix positions.

The text is a sequence of runs of symbols 1, 2, …; runs are kept apart by
separators, which no search crosses.
"""

from __future__ import annotations

import numpy as np

#: Every so many positions of a run the suffix array is kept, and always at its start.
SAMPLE = 16


def _suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling the length that ranks tell apart. All symbols 0 differ from one another."""
    n = len(text)
    breaks = text == 0
    rank = np.where(breaks, np.cumsum(breaks) - 1, text + int(breaks.sum()))
    rank = np.unique(rank, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        after = np.zeros(n, np.int64)
        after[:-step] = rank[step:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        key = key[order]
        fresh = np.empty(n, np.int64)
        fresh[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        if fresh[order[-1]] == n - 1 or step >= n:
            return order
        rank, step = fresh, 2 * step


class FMIndex:
    def __init__(self, text: np.ndarray):
        """``text``: int64 symbols, 0 for separators; the first and the last must be separators."""
        order = _suffix_order(text)
        self._bwt = text[order - 1]
        counts = np.bincount(text)
        self._first = np.concatenate([[0], np.cumsum(counts)])
        # Place within the run: distance from the separator before it.
        breaks = np.flatnonzero(text == 0)
        place = np.arange(len(text)) - breaks[np.searchsorted(breaks, np.arange(len(text)), "right") - 1]
        sampled = (place % SAMPLE == 1)[order]
        self._position = np.where(sampled, order, -1)
        self._planes = []
        level = self._bwt
        for bit in reversed(range(max(1, int(text.max()).bit_length()))):
            ones = (level >> bit) & 1
            self._planes.append((bit, np.concatenate([[0], np.cumsum(ones)]), len(level) - int(ones.sum())))
            level = np.concatenate([level[ones == 0], level[ones == 1]])
        #: Where each symbol's stretch begins on the last plane.
        symbols, begins = np.unique(level, return_index=True)
        self._begin = np.zeros(len(counts) + 1, np.int64)
        self._begin[symbols] = begins

    def _rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol stands before a place of the transform."""
        at = places
        for bit, ones, zeros in self._planes:
            before = ones[at]
            at = np.where((symbols >> bit) & 1, zeros + before, at - before)
        return at - self._begin[symbols]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of patterns of one length (rows) -> (pattern, position) of every occurrence."""
        known = (patterns < len(self._first) - 1).all(1)
        which = np.flatnonzero(known)
        low, high = np.zeros(len(which), np.int64), np.full(len(which), len(self._bwt))
        for place in reversed(range(patterns.shape[1])):
            symbols = patterns[which, place]
            # A symbol that stands nowhere has no stretch on the last plane.
            low = self._first[symbols] + self._rank(symbols, low)
            high = self._first[symbols] + self._rank(symbols, high)
            left = (high > low) & (self._first[symbols + 1] > self._first[symbols])
            which, low, high = which[left], low[left], high[left]
            if not len(which):
                break
        counts = high - low
        first = np.cumsum(counts) - counts
        rows = np.repeat(low - first, counts) + np.arange(int(counts.sum()))
        return np.repeat(which, counts), self._locate(rows)

    def _locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: step left until a sampled one; a run's start is sampled, so no step leaves it."""
        found = np.zeros(len(rows), np.int64)
        waiting, steps = np.arange(len(rows)), 0
        while len(waiting):
            position = self._position[rows]
            there = position >= 0
            found[waiting[there]] = position[there] + steps
            waiting, rows = waiting[~there], rows[~there]
            symbols = self._bwt[rows]
            rows = self._first[symbols] + self._rank(symbols, rows)
            steps += 1
        return found
