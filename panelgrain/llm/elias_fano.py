"""Elias-Fano lists of non-decreasing integers with a select structure."""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
HEAD = struct.Struct("<QQBQQQ")  # count, bound, low bits, bytes of low part, of high part, of samples


class EliasFano:
    """n values in 0..bound take about n * (2 + log2(bound / n)) bits.

    The low bits of every value lie side by side; the high parts are in unary: value i sets bit
    (value >> low) + i. Select finds the i-th set bit from every 256th one's place, so a value
    or an offset is read without decoding the list.
    """

    def __init__(self, count: int, bound: int, low: int, lows: np.ndarray, highs: np.ndarray, samples: np.ndarray):
        self.count, self.bound, self.low, self.lows, self.highs, self.samples = count, bound, low, lows, highs, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        bound = int(values[-1]) if n else 0
        low = max(0, (bound // n).bit_length() - 1) if n else 0
        places = np.arange(low, dtype=np.uint64)
        lows = np.packbits(((values[:, None] >> places) & np.uint64(1)).astype(np.uint8).reshape(-1), bitorder="little")
        ones = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
        bits[ones] = 1
        return cls(n, bound, low, lows, np.packbits(bits, bitorder="little"), ones[::SAMPLE].astype(np.uint32))

    def to_bytes(self) -> bytes:
        parts = self.lows.tobytes(), self.highs.tobytes(), self.samples.astype("<u4").tobytes()
        return HEAD.pack(self.count, self.bound, self.low, *map(len, parts)) + b"".join(parts)

    @classmethod
    def from_bytes(cls, raw: bytes, at: int = 0) -> tuple[EliasFano, int]:
        """The list and the place after it."""
        count, bound, low, a, b, c = HEAD.unpack_from(raw, at)
        at += HEAD.size
        lows = np.frombuffer(raw, np.uint8, a, at)
        highs = np.frombuffer(raw, np.uint8, b, at + a)
        samples = np.frombuffer(raw, "<u4", c // 4, at + a + b)
        return cls(count, bound, low, lows, highs, samples), at + a + b + c

    def select(self, i: int) -> int:
        """Value i."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        place, seen = int(self.samples[i // SAMPLE]), i - i % SAMPLE
        byte = place >> 3
        mask = 0xFF & (0xFF << (place & 7))
        while True:
            bits = int(self.highs[byte]) & mask
            if seen + bits.bit_count() > i:
                break
            seen += bits.bit_count()
            byte, mask = byte + 1, 0xFF
        while seen < i:
            bits &= bits - 1
            seen += 1
        one = byte * 8 + (bits & -bits).bit_length() - 1
        low = 0
        for k in range(self.low):
            bit = i * self.low + k
            low |= (int(self.lows[bit >> 3]) >> (bit & 7) & 1) << k
        return (one - i) << self.low | low

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.highs, bitorder="little"))[: self.count]
        high = (ones - np.arange(self.count)).astype(np.uint64) << np.uint64(self.low)
        bits = np.unpackbits(self.lows, bitorder="little")[: self.count * self.low].reshape(self.count, self.low).astype(np.uint64)
        return high | (bits << np.arange(self.low, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
