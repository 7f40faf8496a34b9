"""A compressed FM-index over integer sequences: wavelet matrix with rank blocks, batched backward search."""

from __future__ import annotations

import numpy as np

SEPARATOR = 0


class WaveletMatrix:
    """Rank of a symbol in a prefix, for arrays of queries; one bit per symbol and level plus 32-bit block counts."""

    def __init__(self, seq: np.ndarray, n_symbols: int):
        self.levels = max(1, int(n_symbols - 1).bit_length())
        self.words, self.before, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            bit = ((seq >> level) & 1).astype(bool)
            padded = np.zeros((len(seq) // 64 + 1) * 64, bool)
            padded[:len(seq)] = bit
            words = np.packbits(padded, bitorder="little").view("<u8")
            counts = np.bitwise_count(words).astype(np.int64)
            self.words.append(words)
            self.before.append(np.concatenate(([0], np.cumsum(counts)[:-1])).astype(np.uint32))
            self.zeros.append(len(seq) - int(counts.sum()))
            seq = np.concatenate((seq[~bit], seq[bit]))
        symbols = np.arange(n_symbols)
        self.base = self._trace(symbols, np.zeros(n_symbols, np.int64))

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        block = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[level][block] + np.bitwise_count(self.words[level][block] & mask).astype(np.int64)

    def _trace(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for i in range(self.levels):
            one = ((symbol >> (self.levels - 1 - i)) & 1).astype(bool)
            ones = self._ones(i, at)
            at = np.where(one, self.zeros[i] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        return self._trace(symbol, at) - self.base[symbol]


def bounded_suffix_order(seq: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first ``depth`` (or more) symbols, by doubling."""
    rank, step = seq.astype(np.int64), 1
    while step < depth:
        ahead = np.concatenate((rank[step:] + 1, np.zeros(min(step, len(rank)), np.int64)))
        _, rank = np.unique(rank * (int(rank.max()) + 2) + ahead, return_inverse=True)
        step *= 2
    return np.argsort(rank, kind="stable")


class FMIndex:
    """Counts of patterns shorter than ``depth`` in a sequence of symbols below ``n_symbols``.

    Suffixes are ordered by ``depth`` symbols only; the interval borders of
    shorter patterns, and so every backward step among them, are those of the
    full order.
    """

    def __init__(self, seq: np.ndarray, n_symbols: int, depth: int):
        order = bounded_suffix_order(seq, depth)
        self.tree = WaveletMatrix(seq[order - 1], n_symbols)
        self.first = np.searchsorted(seq[order], np.arange(n_symbols + 1))

    def repeated(self, seq: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
        """Backward search of ``seq[p:p + length]`` for every p in ``at``.

        Returns the interval's lower border where the match statistic reaches
        ``length`` in at least two places, else -1.  A pattern leaves the
        search as soon as its interval holds a single suffix.
        """
        out = np.full(len(at), -1, np.int64)
        live = np.arange(len(at))
        c = seq[at + length - 1]
        lo, hi = self.first[c], self.first[c + 1]
        for t in range(length - 2, -1, -1):
            keep = hi - lo > 1
            live, lo, hi = live[keep], lo[keep], hi[keep]
            if not len(live):
                return out
            c = seq[at[live] + t]
            lo, hi = self.first[c] + self.tree.rank(c, lo), self.first[c] + self.tree.rank(c, hi)
        keep = hi - lo > 1
        out[live[keep]] = lo[keep]
        return out
