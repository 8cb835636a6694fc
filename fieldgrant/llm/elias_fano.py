"""Elias-Fano encoding of a non-decreasing sequence, with select."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: A position is kept for every so many values.
SAMPLE = 128


@dataclass
class EliasFano:
    """``n`` values: the low ``width`` bits of each, packed, and the high parts in unary."""

    n: int
    width: int
    low: np.ndarray  # uint8, little bit order
    high: np.ndarray  # uint8, little bit order
    samples: np.ndarray  # uint32, bit position in ``high`` of every SAMPLE-th value

    @staticmethod
    def of(values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        width = max(0, (top // n).bit_length() - 1) if n else 0
        bits = ((values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        at = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(at[-1]) + 1 if n else 0, np.uint8)
        high[at] = 1
        pack = lambda b: np.packbits(b, bitorder="little")
        return EliasFano(n, width, pack(bits.ravel()), pack(high), at[::SAMPLE].astype(np.uint32))

    def select(self, i: int) -> int:
        """Value ``i``, found from the nearest sample before it."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = at // 8
        start = byte * 8
        skip = at - start
        while True:
            window = np.flatnonzero(np.unpackbits(self.high[byte : byte + 64], bitorder="little")[skip:])
            if left < len(window):
                position = start + skip + int(window[left])
                break
            left -= len(window)
            byte, start, skip = byte + 64, start + 512, 0
        return ((position - i) << self.width) | self._low(i)

    def _low(self, i: int) -> int:
        if not self.width:
            return 0
        first, last = i * self.width, (i + 1) * self.width
        bits = np.unpackbits(self.low[first // 8 : (last + 7) // 8], bitorder="little")[first % 8 :][: self.width]
        return sum(int(b) << k for k, b in enumerate(bits))

    def values(self) -> np.ndarray:
        """All values."""
        high = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n] - np.arange(self.n)
        bits = np.unpackbits(self.low, bitorder="little")[: self.n * self.width].reshape(self.n, self.width)
        low = (bits.astype(np.uint64) << np.arange(self.width, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return (high.astype(np.uint64) << np.uint64(self.width)) | low
