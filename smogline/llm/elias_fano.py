"""Non-decreasing integers in near-minimal space, with access to each by a select structure."""

from __future__ import annotations

import numpy as np

#: Ones of the upper part between two sampled places.
_SAMPLE = 256
_HEAD = np.dtype([("n", "<u8"), ("low_bits", "<u4"), ("samples", "<u4"), ("high_bytes", "<u8")])


class EliasFano:
    """n values of at most u take about n * (2 + log2(u / n)) bits.

    The low ``low_bits`` bits of each value lie side by side; the rest is a bit string with a one
    for each value and a zero for each step of the rest. Value i is found from the place of one
    number i: places of every 256th one are sampled in 32 bits, counted from the sample of the
    value; the bytes between are counted.
    """

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        rest = (values >> np.uint64(low_bits)).astype(np.int64)
        places = rest + np.arange(n)
        bits = np.zeros(int(places[-1]) + 1 if n else 0, bool)
        bits[places] = True
        if low_bits:
            shifts = np.arange(low_bits, dtype=np.uint64)
            low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel())
        else:
            low = np.zeros(0, np.uint8)
        return cls(n, low_bits, low, np.packbits(bits), places[::_SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        head = np.array([(self.n, self.low_bits, len(self.samples), len(self.high))], _HEAD)
        return b"".join([head.tobytes(), self.samples.tobytes(), self.high.tobytes(), self.low.tobytes()])

    @classmethod
    def read(cls, data, at: int = 0) -> tuple[EliasFano, int]:
        """From a buffer, and the place behind it. Nothing is copied."""
        head = np.frombuffer(data, _HEAD, 1, at)[0]
        n, low_bits = int(head["n"]), int(head["low_bits"])
        at += _HEAD.itemsize
        samples = np.frombuffer(data, "<u4", int(head["samples"]), at)
        at += samples.nbytes
        high = np.frombuffer(data, np.uint8, int(head["high_bytes"]), at)
        at += len(high)
        low = np.frombuffer(data, np.uint8, -(-n * low_bits // 8), at)
        return cls(n, low_bits, low, high, samples), at + len(low)

    def __len__(self) -> int:
        return self.n

    def select(self, i: int) -> int:
        """The place of one number i in the upper bits."""
        at = int(self.samples[i // _SAMPLE])
        left = i % _SAMPLE
        byte = at >> 3
        left += int(np.unpackbits(self.high[byte : byte + 1])[: at & 7].sum())
        while True:  # 64 bytes at a time
            block = self.high[byte : byte + 64]
            counts = np.cumsum(np.bitwise_count(block))
            if left < counts[-1]:
                inside = int(np.searchsorted(counts, left, "right"))
                left -= int(counts[inside - 1]) if inside else 0
                return (byte + inside) * 8 + int(np.flatnonzero(np.unpackbits(block[inside : inside + 1]))[left])
            left -= int(counts[-1])
            byte += 64

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        return ((self.select(i) - i) << self.low_bits) | int(self._lows(i, i + 1)[0])

    def _lows(self, lo: int, hi: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(hi - lo, np.uint64)
        first, last = lo * self.low_bits, hi * self.low_bits
        bits = np.unpackbits(self.low[first >> 3 : (last + 7) >> 3])[first & 7 :][: last - first]
        shifts = np.arange(self.low_bits, dtype=np.uint64)
        return (bits.reshape(hi - lo, self.low_bits).astype(np.uint64) << shifts).sum(axis=1, dtype=np.uint64)

    def selects(self, lo: int, hi: int) -> np.ndarray:
        """The places of ones lo to hi - 1, from the sample before the first of them on."""
        if lo >= hi:
            return np.zeros(0, np.int64)
        first = lo // _SAMPLE * _SAMPLE
        at = int(self.samples[lo // _SAMPLE])
        byte, end = at >> 3, (at >> 3) + (hi - first)
        while (found := int(np.bitwise_count(self.high[byte:end]).sum())) < hi - first + 8 and end < len(self.high):
            end += max(64, end - byte)
        ones = byte * 8 + np.flatnonzero(np.unpackbits(self.high[byte:end]))
        skip = int(np.searchsorted(ones, at)) + lo - first
        return ones[skip : skip + hi - lo]

    def between(self, lo: int, hi: int) -> np.ndarray:
        """Values lo to hi - 1; only the bytes that hold them are unpacked."""
        rest = (self.selects(lo, hi) - np.arange(lo, hi)).astype(np.uint64)
        return (rest << np.uint64(self.low_bits)) | self._lows(lo, hi)
