"""A compressed FM-index of short word sequences: backward search over a wavelet matrix.

Rows are the positions of the text in the order of their next ``depth`` words (a Burrows-Wheeler transform of
bounded context), which is all that matching statistics up to ``depth`` need. The transform is stored
as one bit vector for each bit of the alphabet, packed, with a count for every 64 bits.
"""

from __future__ import annotations

import numpy as np


class BitVector:
    """Packed bits with constant-time counts."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        packed = np.packbits(np.concatenate([bits, np.zeros(-n % 64 + 64, bits.dtype)]), bitorder="little")
        self.words = packed.view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words).astype(np.int64))])
        self.ones = int(self.before[-1])
        self.zeros = n - self.ones

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        below = (np.uint64(1) << bit) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below).astype(np.int64)


class WaveletMatrix:
    """Ranks of symbols in a sequence."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels: list[tuple[int, BitVector]] = []
        now = symbols
        for shift in range(max(1, int(sigma - 1).bit_length()) - 1, -1, -1):
            bits = ((now >> shift) & 1).astype(np.uint8)
            self.levels.append((shift, BitVector(bits)))
            now = np.concatenate([now[bits == 0], now[bits == 1]])
        self.first = self._down(np.arange(sigma), np.zeros(sigma, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits in self.levels:
            ones = bits.rank(at)
            at = np.where((symbol >> shift) & 1, bits.zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each position."""
        return self._down(symbol, at) - self.first[symbol]


def _joined(a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """Ranks of longer prefixes: of ``a`` at each position, then ``b`` ``step`` positions on (cyclic)."""
    width = int(b.max()) + 1
    pairs = a.astype(np.int64) * width + np.roll(b, -step)
    return np.unique(pairs, return_inverse=True)[1].astype(np.int32)


class FMIndex:
    """Index of several sequences of word codes with an owner each."""

    def __init__(self, sequences: list[np.ndarray], depth: int = 13):
        if depth < 2:
            raise ValueError("an index needs a depth of two words or more")
        self.depth = depth
        self.lengths = np.array([len(s) for s in sequences], np.int64)
        self.begins = np.cumsum(self.lengths + 1) - self.lengths - 1
        codes = np.concatenate(sequences)
        _, dense = np.unique(codes, return_inverse=True)
        self.text = np.zeros(len(codes) + len(sequences), np.int32)  # 0 ends a sequence
        owner = np.repeat(np.arange(len(sequences)), self.lengths)
        self.text[np.arange(len(codes)) + owner] = dense + 1
        self.sigma = int(dense.max()) + 2
        ranks = {1: self.text}
        span = 1
        while span * 2 < depth - 1:
            ranks[span * 2] = _joined(ranks[span], ranks[span], span)
            span *= 2
        short = _joined(ranks[span], ranks[span], depth - 1 - span) if depth - 1 > span else ranks[span]
        full = _joined(short, short, 1)
        self.order = np.argsort(full, kind="stable")
        self._short, self._full = short, full
        row_short, row_full = short[self.order], full[self.order]
        self.short_of_row, self.full_of_row = row_short, row_full
        self.short_start = np.concatenate([[0], np.cumsum(np.bincount(row_short))])
        self.full_start = np.flatnonzero(np.concatenate([[True], row_full[1:] != row_full[:-1]]))
        self.less = np.concatenate([[0], np.cumsum(np.bincount(self.text, minlength=self.sigma))])
        self.wavelet = WaveletMatrix(self.text[self.order - 1], self.sigma)

    def least_owner(self, owners: np.ndarray) -> np.ndarray:
        """Per group of equal ``depth`` words, the least owner of its positions."""
        at = np.repeat(np.arange(len(self.lengths)), self.lengths + 1)
        return np.minimum.reduceat(owners[at][self.order], self.full_start)

    def groups_of_windows(self) -> list[np.ndarray]:
        """For each sequence, streamed backward through the index, the group of every window of ``depth`` words.

        The interval of a window's last ``depth - 1`` words is extended to the left by one backward step; the interval
        found is the window's matching statistic, and its parent interval goes on to the next word.
        """
        count = np.maximum(self.lengths - self.depth + 1, 0)
        out = np.full(len(self.text), -1, np.int64)
        order = np.argsort(-count, kind="stable")
        active = order[count[order] > 0]
        at = self.begins[active] + count[active]  # where the last depth - 1 words begin
        group = self._short[at]
        for step in range(int(count.max()) if len(count) else 0):
            alive = np.searchsorted(-count[active], -step, side="left")
            active, at, group = active[:alive], at[:alive] - 1, group[:alive]
            symbol = self.text[at]
            low = self.less[symbol] + self.wavelet.rank(symbol, self.short_start[group])
            high = self.less[symbol] + self.wavelet.rank(symbol, self.short_start[group + 1])
            if not (high > low).all():
                raise AssertionError("a sequence of the index was not found in it")
            out[at] = self.full_of_row[low]
            group = self.short_of_row[low]
        return [out[b : b + c] for b, c in zip(self.begins, count)]
