"""A compressed full-text index over a sequence of numbers, searched for many patterns at once."""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector with rank: packed words and the number of ones before each word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64))).astype(np.int32)

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        low = self.words[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return self.before[word] + np.bitwise_count(low)


class WaveletMatrix:
    """A wavelet tree with one bit vector per level, for ranks of a symbol in a prefix."""

    def __init__(self, symbols: np.ndarray):
        self.levels: list[tuple[int, Bits, int]] = []
        symbols = symbols.astype(np.uint32)
        top = int(symbols.max()).bit_length() if len(symbols) else 0
        for bit in range(top - 1, -1, -1):
            here = (symbols >> np.uint32(bit)) & np.uint32(1)
            zeros = int(len(here) - here.sum())
            self.levels.append((bit, Bits(here.astype(np.uint8)), zeros))
            symbols = np.concatenate((symbols[here == 0], symbols[here == 1]))

    def bounds(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of ``symbol``'s places inside ``[lo, hi)`` after all levels; the length is its count there."""
        for bit, bits, zeros in self.levels:
            one = ((symbol >> bit) & 1).astype(bool)
            a, b = bits.ones(lo), bits.ones(hi)
            lo = np.where(one, zeros + a, lo - a)
            hi = np.where(one, zeros + b, hi - b)
        return lo, hi


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``text`` in the order of what follows them, compared up to ``depth`` symbols at least."""
    n = len(text)
    rank = text.astype(np.int64)
    order = np.argsort(rank, kind="stable")
    step = 1
    while True:
        after = np.full(n, -1, np.int64)
        after[:n - step] = rank[step:]
        key = rank * (rank.max() + 2) + after + 1 if step < n else rank
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate(([0], np.cumsum(sorted_key[1:] != sorted_key[:-1])))
        rank, step = new, 2 * step
        if step >= depth or rank.max() == n - 1:
            return order


class FmIndex:
    """Burrows-Wheeler transform of ``text`` (numbers from 0, the last symbol unique) in a wavelet matrix.

    Places are sorted up to ``depth`` symbols, which is enough for patterns up to that length.
    """

    def __init__(self, text: np.ndarray, depth: int):
        order = suffix_order(text, depth)
        self.size = len(text)
        self.smaller = np.concatenate(([0], np.cumsum(np.bincount(text))))
        self.matrix = WaveletMatrix(text[order - 1])
        # Of each symbol, where its places would start in the last level of the matrix.
        symbols = np.arange(len(self.smaller) - 1)
        self.base = self.matrix.bounds(symbols, np.zeros_like(symbols), np.zeros_like(symbols))[0]

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: the ranges of the patterns with ``symbol`` put in front."""
        a, b = self.matrix.bounds(symbol, lo, hi)
        shift = self.smaller[symbol] - self.base[symbol]
        return a + shift, b + shift

    def matching(self, text: np.ndarray, ends: np.ndarray, longest: int, least: int = 2) -> np.ndarray:
        """Matching statistics: how many symbols before each end occur, as one string, at least ``least`` times.

        ``ends`` are places of ``text`` just behind the pattern; at most ``longest`` symbols are counted.
        """
        found = np.zeros(len(ends), np.int64)
        live = np.arange(len(ends))
        lo, hi = np.zeros(len(ends), np.int64), np.full(len(ends), self.size, np.int64)
        for step in range(1, longest + 1):
            lo, hi = self.extend(text[ends[live] - step], lo, hi)
            keep = hi - lo >= least
            live, lo, hi = live[keep], lo[keep], hi[keep]
            if not len(live):
                break
            found[live] = step
        return found
