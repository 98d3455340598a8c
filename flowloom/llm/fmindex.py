"""A compressed FM-index over word symbols, for searches up to a fixed depth, with vectorised backward search.

The suffixes are ordered by their first ``depth`` symbols only (prefix doubling), which is all that patterns up to that length
need. The Burrows-Wheeler column is kept as a wavelet matrix of packed bit vectors with block counts.
"""

from __future__ import annotations

import numpy as np

#: windows that a long stretch is searched for at a time
PART = 96


class Bits:
    """A packed bit vector with rank."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))[:-1].astype(np.int32)
        self.zeros = len(bits) - int(bits.sum())

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word = at >> 6
        low = self.words[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return self.before[word] + np.bitwise_count(low)


class WaveletMatrix:
    def __init__(self, column: np.ndarray, symbols: int):
        self.levels = []
        for shift in range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1):
            bit = (column >> shift & 1).astype(bool)
            self.levels.append((shift, Bits(bit)))
            column = np.concatenate((column[~bit], column[bit]))
        every = np.arange(symbols)
        self.begin = self._descend(every, np.zeros(symbols, np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits in self.levels:
            ones = bits.rank(at)
            at = np.where(symbol >> shift & 1, bits.zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        return self._descend(symbol, at) - self.begin[symbol]


class FmIndex:
    """Index of segments (arrays of symbols >= 1); symbol 0 ends each of them."""

    def __init__(self, text: np.ndarray, depth: int):
        self.depth = depth
        n = len(text)
        symbols = int(text.max()) + 1 if n else 1
        ranks, width = text.astype(np.int64), 1

        def behind(values: np.ndarray, by: int) -> np.ndarray:
            return np.concatenate((values[by:], np.zeros(min(by, n), values.dtype)))[:n]

        while width * 2 <= depth:
            _, ranks = np.unique(ranks * (int(ranks.max()) + 2) + behind(ranks + 1, width), return_inverse=True)
            width *= 2
        key = ranks * (int(ranks.max()) + 2) + behind(ranks + 1, depth - width)
        self.suffixes = np.argsort(key, kind="stable")
        # rows that agree with the row above in depth - 1 symbols: a search leaves its last symbol by widening to these
        less = ranks * (int(ranks.max()) + 2) + behind(ranks + 1, depth - 1 - width) if depth - 1 > width else ranks
        less = less[self.suffixes]
        opens = np.concatenate(([True], less[1:] != less[:-1]))
        at = np.arange(n)
        self.block_start = np.maximum.accumulate(np.where(opens, at, 0)).astype(np.int32)
        starts = np.flatnonzero(opens)
        self.block_end = np.append(starts[1:], n)[np.cumsum(opens) - 1].astype(np.int32)
        before = text[self.suffixes - 1]  # the text is read as a circle; its last symbol is an end
        self.column = WaveletMatrix(before.astype(np.int64), symbols)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols))))
        self.text = text

    def matching(self, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every window of ``depth`` symbols in the given stretches of the text: (position, first row of its interval).

        All stretches are read from right to left at once, long ones in parts of ``PART`` windows. Each step drops the rightmost symbol by
        widening to the rows that share depth - 1 symbols, then extends to the left by one backward-search step.
        """
        parts = np.maximum(1, -(-(lengths - self.depth + 1) // PART))
        part = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
        starts = np.repeat(starts, parts) + part * PART
        lengths = np.minimum(np.repeat(lengths, parts) - part * PART, PART + self.depth - 1)
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        positions, rows = [], []
        low = np.zeros(len(starts), np.int64)
        high = np.full(len(starts), len(self.text), np.int64)
        for step in range(int(lengths[0]) if len(lengths) else 0):
            live = int(np.searchsorted(-lengths, -step, side="left"))  # stretches longer than the step
            low, high = low[:live], high[:live]
            at = starts[:live] + lengths[:live] - 1 - step
            symbol = self.text[at]
            if step >= self.depth:
                low, high = self.block_start[low].astype(np.int64), self.block_end[low].astype(np.int64)
            both = self.column.rank(np.concatenate((symbol, symbol)), np.concatenate((low, high))) + np.tile(self.first[symbol], 2)
            low, high = both[:live], both[live:]
            if step >= self.depth - 1:
                positions.append(at)
                rows.append(low)
        if not positions:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(positions), np.concatenate(rows)
