"""An FM-index over numbered words: suffix order, wavelet matrix with ranks, sampled positions.

Symbols are small integers; 0 ends the text and 1 stands between its parts. All queries work
on arrays of patterns or rows at once.
"""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray, bits: int) -> np.ndarray:
    """Positions in the order of their suffixes, by prefix doubling over what is not yet apart.

    The first round compares as many symbols as fit into a word of 62 bits. The last symbol
    has to be the only 0.
    """
    n = len(text)
    depth = max(1, 62 // bits)
    padded = np.concatenate((text.astype(np.int64), np.zeros(depth, np.int64)))
    key = np.zeros(n, np.int64)
    for j in range(depth):
        key = (key << bits) | padded[j : j + n]
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    head = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    open_ = np.flatnonzero(~(head & np.append(head[1:], True)))
    while len(open_):
        at = order[open_]
        key = rank[at] * (n + 2) + rank[np.minimum(at + depth, n)] + 1
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[open_] = at
        head = np.concatenate(([True], key[1:] != key[:-1]))
        rank[at] = np.maximum.accumulate(np.where(head, open_, 0))
        open_ = open_[~(head & np.append(head[1:], True))]
        depth *= 2
    return order


class Bits:
    """A bit vector with ranks: 64 bits a word and a running count of ones per word."""

    def __init__(self, flags: np.ndarray):
        packed = np.packbits(flags, bitorder="little")
        self.words = np.concatenate((packed, np.zeros(16 - len(packed) % 8, np.uint8))).view(np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))
        self.zeros = len(flags) - int(self.before[-1])

    def ones(self, upto: np.ndarray) -> np.ndarray:
        word, bit = upto >> 6, (upto & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))

    def get(self, at: np.ndarray) -> np.ndarray:
        return ((self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


class FMIndex:
    def __init__(self, text: np.ndarray, symbols: int, sample: int = 16):
        """``text`` ends with its only 0; all symbols are below ``symbols``."""
        self.sample = sample
        bits = max(1, (symbols - 1).bit_length())
        order = suffix_order(text, bits)
        last = text[order - 1].astype(np.int64)
        self.smaller = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols))))
        sampled = order % sample == 0
        self.sampled = Bits(sampled)
        self.positions = order[sampled]
        self.levels = []
        for level in reversed(range(bits)):
            flags = (last >> level) & 1 == 1
            self.levels.append((level, Bits(flags)))
            last = np.concatenate((last[~flags], last[flags]))
        self.first = self._down(np.arange(symbols), np.zeros(symbols, np.int64))

    def _down(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        for level, bits in self.levels:
            ones = bits.ones(upto)
            upto = np.where((symbol >> level) & 1 == 1, bits.zeros + ones, upto - ones)
        return upto

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before row ``upto`` of the last column."""
        return self._down(symbol, upto) - self.first[symbol]

    def back(self, row: np.ndarray) -> np.ndarray:
        """The row of the suffix that is one symbol longer."""
        symbol, at = np.zeros_like(row), row
        for level, bits in self.levels:
            one, ones = bits.get(at), bits.ones(at)
            symbol |= one.astype(np.int64) << level
            at = np.where(one, bits.zeros + ones, at - ones)
        return self.smaller[symbol] + at - self.first[symbol]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of patterns, right-aligned in ``patterns``, by backward search."""
        width = patterns.shape[1]
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.smaller[-1], np.int64)
        for step in range(1, width + 1):
            some = np.flatnonzero((lengths >= step) & (low < high))
            if not len(some):
                break
            symbol = patterns[some, width - step]
            low[some] = self.smaller[symbol] + self.rank(symbol, low[some])
            high[some] = self.smaller[symbol] + self.rank(symbol, high[some])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: step back to the next sampled one, counting the steps."""
        found, steps = np.empty(len(rows), np.int64), 0
        left, row = np.arange(len(rows)), rows
        while len(left):
            hit = self.sampled.get(row)
            found[left[hit]] = self.positions[self.sampled.ones(row[hit])] + steps
            left, row, steps = left[~hit], self.back(row[~hit]), steps + 1
        return found
