"""Words, shingles and their hashes for a batch of texts, in numpy over the UTF-8 bytes.

All functions work on the bytes of an Arrow string column, so a batch costs a few array
operations whatever the number of documents. Hashes are 64-bit and wrap.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes that separate words: [\x20\x09-\x0D]
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bytes taken into one block of array operations; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20

_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_POWERS: dict[tuple[int, bool], np.ndarray] = {}


def _powers(base: int, inverse: bool, n: int) -> np.ndarray:
    """base ** i for i < n, or its inverse, modulo 2 ** 64."""
    have = _POWERS.get((base, inverse))
    if have is None or len(have) < n:
        step = np.uint64(pow(base, -1, 1 << 64) if inverse else base)
        have = np.full(max(n, BLOCK_BYTES), step, np.uint64)
        have[0] = 1
        have = np.cumprod(have)
        if len(have) <= 8 * BLOCK_BYTES:  # a huge text does not stay in memory
            _POWERS[base, inverse] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spans_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """A hash of values[start:end] for each pair, from one pass of prefix sums."""
    base = int(_BASES[seed])
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(base, False, len(values)), out=sums[1:])
    raw = (sums[end] - sums[start]) * _powers(base, True, len(values) + 1)[start]
    return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


@dataclass
class Words:
    """The words of some whole texts.

    ``text``: all bytes; ``bounds``: text i is text[bounds[i]:bounds[i + 1]];
    ``start``, ``end``: bytes of each word; ``first``: words of text i are
    first[i]:first[i + 1].
    """

    text: np.ndarray
    bounds: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, seed: int = 0) -> np.ndarray:
        return spans_hash(self.text.astype(np.uint64) + np.uint64(1), self.start, self.end, seed)

    def windows(self, size: int) -> np.ndarray:
        """Index of the first word of every run of ``size`` words within one text."""
        left = np.repeat(self.first[1:], self.counts) - np.arange(len(self.start))
        return np.flatnonzero(left >= size)


def find_words(text: np.ndarray, bounds: np.ndarray, gaps: np.ndarray = SPACE) -> Words:
    """Maximal runs of bytes outside ``gaps``, texts kept apart."""
    inside = np.zeros(len(text) + 2, bool)
    inside[1:-1] = ~gaps[text]
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    cut = bounds[1:-1]
    cut = cut[(cut > 0) & (cut < len(text))]
    begins[cut] = inside[1:-1][cut]
    ends[cut - 1] = inside[1:-1][cut - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(text, bounds, start, end, np.searchsorted(start, bounds))


def blocks(column: pa.Array | pa.ChunkedArray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, words) of consecutive rows, about ``most`` bytes at a time; null is empty."""
    for at, part in _chunks(column):
        for lo, hi, text, bounds in _cut(part, most):
            yield at + lo, at + hi, find_words(text, bounds)


def _chunks(column):
    parts = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    at = 0
    for part in parts:
        yield at, part
        at += len(part)


def _cut(part: pa.Array, most: int):
    if not len(part):
        return
    if part.null_count:
        part = part.fill_null("")
    wide = pa.types.is_large_string(part.type) or pa.types.is_large_binary(part.type)
    _, offsets, data = part.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(offsets, kind)[part.offset : part.offset + len(part) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(part):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi
