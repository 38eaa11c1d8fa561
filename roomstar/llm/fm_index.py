"""FM-index over integer sequences: suffix array, Burrows-Wheeler transform, wavelet-tree ranks,
backward search of many phrases at once, and locating by sampled suffix positions."""

from __future__ import annotations

import numpy as np

SAMPLE = 16  # every SAMPLE-th position, and each piece's first, is kept with its suffix


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling. Zeros are separators: each is a symbol of its own
    (the earlier one the smaller), so no comparison runs past one."""
    n = len(seq)
    zero = seq == 0
    rank = seq.astype(np.int64) + int(zero.sum())
    rank[zero] = np.arange(int(zero.sum()))
    step = 1
    while True:
        far = np.zeros(n, np.int64)
        far[:n - step] = rank[step:] + 1
        top = int(far.max(initial=0)) + 1
        key = rank * top + far
        order = np.argsort(key)
        sorted_key = key[order]
        new = np.ones(n, bool)
        new[1:] = sorted_key[1:] != sorted_key[:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        if new.all() or step >= n:
            return order
        step *= 2


class WaveletTree:
    """Ranks of symbols in a sequence: one bit vector per bit of the alphabet, from the most
    significant bit on, each level stably sorted by the bits above it."""

    def __init__(self, seq: np.ndarray, top: int) -> None:
        self.bits = max(1, int(top).bit_length())
        self.ones, self.zeros = [], []
        level = seq.astype(np.int64)
        for b in range(self.bits - 1, -1, -1):
            bit = (level >> b) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(int(len(bit) - bit.sum()))
            level = np.concatenate([level[bit == 0], level[bit == 1]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each end."""
        lo, hi = np.zeros(len(end), np.int64), end.astype(np.int64)
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            bit = ((symbol >> (self.bits - 1 - k)) & 1).astype(bool)
            lo_ones, hi_ones = ones[lo], ones[hi]
            lo = np.where(bit, zeros + lo_ones, lo - lo_ones)
            hi = np.where(bit, zeros + hi_ones, hi - hi_ones)
        return hi - lo


class FMIndex:
    """Index of a sequence of symbols 1..top in which zeros separate pieces."""

    def __init__(self, seq: np.ndarray, top: int) -> None:
        n = len(seq)
        order = suffix_array(seq)
        self.bwt = seq[order - 1].astype(np.int64)  # before position 0 stands the last symbol
        self.tree = WaveletTree(self.bwt, top)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=top + 1))])
        # Where a piece begins is sampled too: separators have no common order to step back by.
        kept = (order % SAMPLE == 0) | (self.bwt == 0)
        self.sampled = kept
        self.place = np.concatenate([[0], np.cumsum(kept)])
        self.position = order[kept]
        self.n = n

    def search(self, phrases: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix range [lo, hi) of every phrase (rows of symbols, the first length[i] count)."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n)
        for k in range(phrases.shape[1] - 1, -1, -1):
            live = np.flatnonzero((k < length) & (lo < hi))
            if not len(live):
                continue
            symbol = phrases[live, k]
            both = self.tree.rank(np.concatenate([symbol, symbol]), np.concatenate([lo[live], hi[live]]))
            lo[live] = self.before[symbol] + both[:len(live)]
            hi[live] = self.before[symbol] + both[len(live):]
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffix-array rows: step back through the text to a sampled position."""
        out = np.zeros(len(rows), np.int64)
        left, row, steps = np.arange(len(rows)), rows.copy(), 0
        while len(left):
            hit = self.sampled[row]
            out[left[hit]] = self.position[self.place[row[hit]]] + steps
            left, row = left[~hit], row[~hit]
            if len(left):
                symbol = self.bwt[row]
                row = self.before[symbol] + self.tree.rank(symbol, row)
                steps += 1
        return out
