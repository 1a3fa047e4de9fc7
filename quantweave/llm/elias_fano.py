"""Monotone sequences in Elias-Fano form, read from bytes (a memory map, say) and queried many positions at a time."""

from __future__ import annotations

import numpy as np

FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
#: With more positions asked than one in so many words of 64 bits, the whole bit vector is unpacked.
DENSE = 1


class EliasFano:
    """A nondecreasing sequence of n integers below 2 ** 56 apart from a first value, in about 2 + log2(range / n) bits each.

    The high part of each value is a one in a bit vector, after as many zeros as the part says; the low parts are packed.
    Counts of ones and of zeros before every 64 bits make both selectable.
    """

    def __init__(self, head: np.ndarray, bits: np.ndarray, ones: np.ndarray, zeros: np.ndarray, low: np.ndarray) -> None:
        self.n, self.width, self.first = int(head[0]), int(head[1]), head[2]
        self.bits, self.ones, self.zeros, self.low = bits, ones, zeros, low

    @classmethod
    def arrays(cls, values: np.ndarray) -> list[np.ndarray]:
        """The five arrays of a sequence."""
        values = np.asarray(values, np.uint64)
        n = len(values)
        first = values[0] if n else np.uint64(0)
        rest = values - first
        span = int(rest[-1]) + 1 if n else 1
        width = min(56, max(0, (span // max(1, n)).bit_length() - 1))
        high = (rest >> np.uint64(width)).astype(np.int64)
        size = n + (int(high[-1]) if n else 0) + 1
        flags = np.zeros(-(-size // 64) * 64, np.uint8)
        flags[high + np.arange(n)] = 1
        bits = np.packbits(flags, bitorder="little").view(np.uint64)
        flags[:] = 0
        count = np.bitwise_count(bits).astype(np.int64)
        ones = np.r_[0, np.cumsum(count)[:-1]]
        zeros = 64 * np.arange(len(bits)) - ones
        low = np.zeros((n * width + 7) // 8 + 16, np.uint8)
        if width and n:
            for begin in range(0, n, 1 << 16):  # whole bytes: 65536 values at a time
                part = rest[begin : begin + (1 << 16)]
                matrix = (part[:, None] >> np.arange(width, dtype=np.uint64)[None, :]).astype(np.uint8) & 1
                packed = np.packbits(matrix.ravel(), bitorder="little")
                low[begin * width // 8 : begin * width // 8 + len(packed)] = packed
        head = np.array([n, width, first], np.uint64)
        return [head, bits, ones.astype(np.uint32), zeros.astype(np.uint32), low]

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(at), np.uint64)
        bit = at * self.width
        byte, shift = bit >> 3, (bit & 7).astype(np.uint64)
        value = np.zeros(len(at), np.uint64)
        for place in range((self.width + 14) // 8):
            value |= self.low[byte + place].astype(np.uint64) << np.uint64(8 * place)
        return (value >> shift) & np.uint64((1 << self.width) - 1)

    def _select(self, rank: np.ndarray, zero: bool) -> np.ndarray:
        if len(rank) * DENSE >= len(self.bits):
            flags = np.unpackbits((~self.bits if zero else self.bits).view(np.uint8), bitorder="little")
            return np.flatnonzero(flags.view(bool))[rank]
        before = self.zeros if zero else self.ones
        block = np.searchsorted(before, rank, "right") - 1
        word = self.bits[block] ^ (FULL if zero else np.uint64(0))
        left = (rank - before[block]).astype(np.int64)
        place = np.zeros(len(rank), np.int64)
        for step in (32, 16, 8, 4, 2, 1):
            here = np.bitwise_count(word & np.uint64((1 << step) - 1)).astype(np.int64)
            go = left >= here
            left = np.where(go, left - here, left)
            word = np.where(go, word >> np.uint64(step), word)
            place += step * go
        return block * 64 + place

    def get(self, at: np.ndarray) -> np.ndarray:
        """Values at these positions."""
        if not len(at):
            return np.empty(0, np.uint64)
        high = (self._select(at, False) - at).astype(np.uint64)
        return ((high << np.uint64(self.width)) | self._low(at)) + self.first

    def find(self, values: np.ndarray) -> np.ndarray:
        """Position of each value, or -1: the ones between two zeros share the high part, and are searched by the low."""
        found = np.full(len(values), -1, np.int64)
        if not self.n:
            return found
        last = int(self.get(np.array([self.n - 1]))[0])
        live = np.flatnonzero((values >= self.first) & (values <= np.uint64(last)))
        rest = values[live] - self.first
        high = (rest >> np.uint64(self.width)).astype(np.int64)
        low = rest & np.uint64((1 << self.width) - 1)
        before, after = np.split(self._select(np.r_[np.maximum(high - 1, 0), high], True), 2)
        start = np.where(high > 0, before - (high - 1), 0)
        stop = end = after - high
        while (open_ := start < stop).any():
            some = np.flatnonzero(open_)
            middle = (start[some] + stop[some]) // 2
            less = self._low(middle) < low[some]
            start[some] = np.where(less, middle + 1, start[some])
            stop = stop.copy()
            stop[some] = np.where(less, stop[some], middle)
        hit = np.flatnonzero(start < end)
        hit = hit[self._low(start[hit]) == low[hit]]
        found[live[hit]] = start[hit]
        return found
