"""An FM-index over whole numbers, with numpy.

The Burrows-Wheeler transform of the text is kept in a wavelet matrix, whose
rank query drives backward search. Text positions are kept for every
``SAMPLE``-th place only; others are found by stepping backward to one of them.
All queries work on arrays of patterns at once.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 16


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start of every suffix in sorted order, by doubling the sorted prefix."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    order, width = np.argsort(rank, kind="stable"), 1
    while True:
        following = np.zeros(n, np.int64)
        following[: max(n - width, 0)] = rank[width:] + 1
        key = rank * (n + 1) + following
        order = np.argsort(key, kind="stable")
        arranged = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate(([0], np.cumsum(arranged[1:] != arranged[:-1])))
        rank, width = new, 2 * width
        if n == 0 or rank.max() == n - 1:
            return order


class WaveletMatrix:
    """Rank and access on a sequence of whole numbers."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.ones, self.zeros = [], []
        for level in range(self.bits - 1, -1, -1):
            bit = (values >> level) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit))).astype(np.int32))
            self.zeros.append(int(len(values) - bit.sum()))
            values = np.concatenate((values[bit == 0], values[bit == 1]))

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each end."""
        start, stop = np.zeros_like(end), end
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            bit = (symbol >> (self.bits - 1 - level)) & 1
            start = np.where(bit, zeros + ones[start], start - ones[start])
            stop = np.where(bit, zeros + ones[stop], stop - ones[stop])
        return stop - start

    def at(self, place: np.ndarray) -> np.ndarray:
        """The values at these places."""
        value = np.zeros_like(place)
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            bit = ones[place + 1] - ones[place]
            value = 2 * value + bit
            place = np.where(bit, zeros + ones[place], place - ones[place])
        return value


class FMIndex:
    """Count and locate patterns in a text of numbers from 1 on."""

    def __init__(self, text: np.ndarray):
        text = np.append(text.astype(np.int64), 0)  # a unique last symbol
        order = suffix_array(text)
        self.bwt = WaveletMatrix(text[order - 1])
        counts = np.bincount(text, minlength=int(text.max()) + 2)
        self.first = np.concatenate(([0], np.cumsum(counts)))
        sampled = order % SAMPLE == 0
        self.sampled_before = np.concatenate(([0], np.cumsum(sampled)))
        self.positions = order[sampled]
        self.size = len(text)

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of the patterns, which are right-aligned and 0-padded."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.size, np.int64)
        known = len(self.first) - 2
        for step in range(patterns.shape[1]):
            symbol = patterns[:, patterns.shape[1] - 1 - step]
            live = np.flatnonzero((step < lengths) & (low < high))
            if not len(live):
                break
            s = symbol[live]
            absent = s >= known
            s = np.where(absent, 0, s)
            base = self.first[s]
            low[live] = base + self.bwt.rank(s, low[live])
            high[live] = np.where(absent, low[live], base + self.bwt.rank(s, high[live]))
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of index rows."""
        rows, steps = rows.astype(np.int64), np.zeros(len(rows), np.int64)
        found = np.zeros(len(rows), np.int64)
        live = np.arange(len(rows))
        while len(live):
            at = rows[live]
            hit = self.sampled_before[at + 1] > self.sampled_before[at]
            done = live[hit]
            found[done] = self.positions[self.sampled_before[rows[done]]] + steps[done]
            live = live[~hit]
            symbol = self.bwt.at(rows[live])
            rows[live] = self.first[symbol] + self.bwt.rank(symbol, rows[live])
            steps[live] += 1
        return found
