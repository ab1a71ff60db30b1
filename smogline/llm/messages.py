"""Rows that tasks send each other in place of single values: packed sorted integers and bits.

A task that knows millions of small values (cells of a sketch, hashes) sends one binary value
per receiver. Receivers are slices of the value range, so their number follows the data while
the memory of each stays the same.
"""

from __future__ import annotations

import numpy as np

_STEP = 0xFFFF


def pack_sorted(values: np.ndarray) -> bytes:
    """Non-decreasing integers as 16-bit steps; a step of 0xFFFF adds that much and is no value.

    Low and high bytes lie apart, so that the high ones, mostly 0, compress.
    """
    if not len(values):
        return b""
    values = values.astype(np.int64)
    steps = np.diff(values, prepend=0)
    fill, rest = np.divmod(steps, _STEP)
    out = np.full(len(values) + int(fill.sum()), _STEP, np.uint16)
    out[np.arange(len(values)) + np.cumsum(fill)] = rest
    return (out & 0xFF).astype(np.uint8).tobytes() + (out >> 8).astype(np.uint8).tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    half = len(raw) // 2
    steps = raw[:half].astype(np.int64) | (raw[half:].astype(np.int64) << 8)
    return np.cumsum(steps)[steps != _STEP]


def pack_bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def unpack_bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def cut_points(keys: np.ndarray) -> np.ndarray:
    """Start of each run of equal values in a sorted array, and its length at the end."""
    if not len(keys):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
