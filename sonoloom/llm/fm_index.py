"""A compressed FM-index over word sequences, searched for many patterns at once."""

from __future__ import annotations

import numpy as np

from sonoloom.llm.periodic import suffix_order


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of the suffixes; each 0 is a separator of its own, ordered by place."""
    separators = np.flatnonzero(symbols == 0)
    own = symbols.astype(np.int64) + len(separators) - 1
    own[separators] = np.arange(len(separators))
    return suffix_order(own, np.zeros(len(own), np.int64))


class BitVector:
    """Bits in 64-bit words with a count before each word: 1.5 bits a bit, rank in two reads."""

    def __init__(self, bits: np.ndarray):
        packed = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
        packed[: (len(bits) + 7) // 8] = np.packbits(bits, bitorder="little")
        self.words = packed.view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)[:-1]]).astype(np.int32)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each i."""
        word = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class FMIndex:
    """Burrows-Wheeler transform of `symbols` (0 separates sequences and ends the last) in a wavelet tree.

    The tree is kept level by level, one bit vector for each bit of a symbol, zeros before ones.
    """

    def __init__(self, symbols: np.ndarray):
        self.size = len(symbols)
        order = suffix_array(symbols)
        level = symbols[order - 1].astype(np.int64)
        top = int(symbols.max(initial=0))
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=top + 1))])
        self.bits, self.zeros, self.shifts = [], [], range(max(1, top.bit_length()) - 1, -1, -1)
        for shift in self.shifts:
            bit = (level >> shift & 1).astype(bool)
            self.bits.append(BitVector(bit))
            self.zeros.append(int(len(bit) - bit.sum()))
            level = np.concatenate([level[~bit], level[bit]])
        every = np.arange(top + 1)
        self.base = self._descend(every, np.zeros(top + 1, np.int64))

    def _descend(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for vector, zeros, shift in zip(self.bits, self.zeros, self.shifts):
            ones = vector.rank(i)
            i = np.where(symbol >> shift & 1, zeros + ones, i - ones)
        return i

    def all(self, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the suffixes that start with the symbols."""
        return self.first[symbol], self.first[symbol + 1]

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: intervals of the patterns with a symbol put in front."""
        ends = self._descend(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        start = self.first[symbol] - self.base[symbol]
        return start + ends[: len(symbol)], start + ends[len(symbol) :]


def repeated_windows(index: FMIndex, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, window: int) -> np.ndarray:
    """Which places of `symbols` start a window that occurs at least twice in the index.

    The sequences [start, end) are read from right to left, all at once, by their matching statistics: each
    match grows to the left while its interval keeps two suffixes. A match that cannot grow is maximal at its
    right end; if it is `window` long or more, all windows in it are marked, and the search goes on with the
    last end whose window is not decided.
    """
    marks = np.zeros(len(symbols) + 1, np.int32)
    keep = ends - starts >= window
    start, last = starts[keep], ends[keep] - 1
    depth, low, high = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
    while len(start):
        place = last - depth
        inside = place >= start
        symbol = symbols[np.maximum(place, 0)].astype(np.int64)
        new_low, new_high = np.zeros_like(low), np.zeros_like(high)
        fresh = depth == 0
        new_low[fresh], new_high[fresh] = index.all(symbol[fresh])
        grow = inside & ~fresh
        new_low[grow], new_high[grow] = index.extend(symbol[grow], low[grow], high[grow])
        grows = inside & (new_high - new_low >= 2)
        stuck = ~grows
        long = stuck & (depth >= window)
        np.add.at(marks, place[long] + 1, 1)
        np.add.at(marks, last[long] - window + 2, -1)
        last = np.where(stuck, np.minimum(last - 1, place + window - 1), last)
        depth = np.where(grows, depth + 1, 0)
        low, high = np.where(grows, new_low, 0), np.where(grows, new_high, 0)
        alive = grows | (inside & (last - window + 1 >= start))
        start, last, depth, low, high = start[alive], last[alive], depth[alive], low[alive], high[alive]
    return np.cumsum(marks[:-1]) > 0
