"""A compressed FM-index over integer symbols: suffix array by prefix doubling, Burrows-Wheeler transform in a wavelet matrix.

The order of suffixes is made as deep as the longest pattern; behind that it changes no interval of backward search. Bits are packed 64 to a word with one running count a word. All queries are vectorised: many patterns are searched at once.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """A packed bit vector with rank."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.zeros(len(self.words), np.int32)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        w = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & low)


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, sigma: int):
        self.n, self.levels, self.zeros = len(symbols), [], []
        self.depth = max(1, int(sigma - 1).bit_length())
        s = symbols
        for bit in range(self.depth - 1, -1, -1):
            one = (s >> bit & 1).astype(bool)
            self.levels.append(Bits(one))
            self.zeros.append(int(len(s) - one.sum()))
            s = np.concatenate([s[~one], s[one]])
        self.first = np.zeros(sigma, np.int64)  # where each symbol's run begins on the last level
        self.first = self._descend(np.arange(sigma), np.zeros(sigma, np.int64))

    def _descend(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for bit, level, zeros in zip(range(self.depth - 1, -1, -1), self.levels, self.zeros, strict=True):
            ones = level.rank(i)
            i = np.where(c >> bit & 1, zeros + ones, i - ones)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of c before position i."""
        return self._descend(c, i) - self.first[c]


def suffix_array(s: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols at least (None: all), by prefix doubling; one that ends is smaller than one
    that goes on. Each round sorts only the suffixes that are still equal to another."""
    n = len(s)
    order = np.argsort(s)
    new = np.r_[True, np.diff(s[order]) != 0][:n]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    open_ = np.flatnonzero(~(new & np.r_[new[1:], True][:n]))
    k = 1
    while len(open_) and k < (depth or n):
        at = order[open_]
        after = np.where(at + k < n, rank[np.minimum(at + k, n - 1)] + 1, 0)
        key = rank[at] * (n + 1) + after
        by = np.argsort(key)
        at, key = at[by], key[by]
        order[open_] = at
        new = np.r_[True, key[1:] != key[:-1]]
        rank[at] = open_[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        open_ = open_[~(new & np.r_[new[1:], True])]
        k *= 2
    return order


class FMIndex:
    """Index of several sequences of symbols 1 to sigma - 1; each has a weight, the number of texts it stands for."""

    def __init__(self, sequences: list[np.ndarray], weights: np.ndarray, sigma: int, depth: int | None = None):
        lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
        self.starts = np.r_[0, np.cumsum(lengths + 1)[:-1]]
        text = np.zeros(int((lengths + 1).sum()), np.int64)
        inner = np.ones(len(text), bool)
        inner[self.starts + lengths] = False
        text[inner] = np.concatenate(sequences)
        self.text = text
        # Every end is a symbol of its own below all others, so the order is total after a few doublings.
        ends = np.where(inner, text + len(sequences), 0)
        ends[~inner] = np.arange(len(sequences))
        order = suffix_array(ends, depth)
        self.bwt = WaveletMatrix(text[order - 1], sigma)
        self.below = np.r_[0, np.cumsum(np.bincount(text, minlength=sigma))][:sigma]
        owner = np.repeat(np.arange(len(sequences)), lengths + 1)
        self.weight = np.r_[0, np.cumsum(weights[owner[order]])]

    def matching(self, ends: np.ndarray, most: np.ndarray | int, least_count: int = 2) -> np.ndarray:
        """Matching statistics: for each end position of the text, the length, ``most`` at most, of the longest stretch before it
        that occurs ``least_count`` times or more, by backward search."""
        most = np.broadcast_to(np.asarray(most, np.int64), ends.shape)
        length = np.zeros(len(ends), np.int64)
        live = np.flatnonzero(most > 0)
        low, high = np.zeros(len(live), np.int64), np.full(len(live), len(self.text), np.int64)
        k = 0
        while len(live):
            at = ends[live] - 1 - k
            c = np.where(at >= 0, self.text[at], 0)
            rank = self.bwt.rank(np.r_[c, c], np.r_[low, high])
            low, high = self.below[c] + rank[: len(c)], self.below[c] + rank[len(c) :]
            k += 1
            on = (c > 0) & (self.weight[high] - self.weight[low] >= least_count)
            length[live[on]] = k
            on &= most[live] > k
            live, low, high = live[on], low[on], high[on]
        return length
