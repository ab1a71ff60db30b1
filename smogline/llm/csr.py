"""Sparse matrices in compressed rows, and their products row by row.

A product follows Gustavson: row i of A.B is the sum of the rows of B that the entries of row i of A
name. All rows of a block are expanded at once; partial products that meet in one place are added up.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Partial products of one block of rows; a row with more is a block of its own.
PARTIAL = 1 << 22


@dataclass
class Csr:
    """Row i holds ``values[start[i]:start[i + 1]]`` in the columns ``columns[...]``; no values: all are 1."""

    start: np.ndarray
    columns: np.ndarray
    width: int
    values: np.ndarray | None = None

    @property
    def height(self) -> int:
        return len(self.start) - 1

    def transposed(self) -> Csr:
        order = np.argsort(self.columns, kind="stable")
        rows = np.repeat(np.arange(self.height), np.diff(self.start))
        start = np.zeros(self.width + 1, np.int64)
        np.cumsum(np.bincount(self.columns, minlength=self.width), out=start[1:])
        return Csr(start, rows[order], self.height, None if self.values is None else self.values[order])


def spans(ends: np.ndarray, width: int) -> Csr:
    """Row i has a 1 in each column from the end of row i - 1 up to its own end."""
    return Csr(np.concatenate([[0], ends]), np.arange(width), width)


def members(owner: np.ndarray, width: int) -> Csr:
    """Row i has one 1, in column ``owner[i]``."""
    return Csr(np.arange(len(owner) + 1), owner, width)


def row_products(a: Csr, b: Csr, most: int = PARTIAL) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, columns, values) of A.B in row order, block of rows by block of rows."""
    reach = np.diff(b.start)[a.columns]
    before = np.concatenate([[0], np.cumsum(reach)])[a.start]  # partial products before each row
    lo = 0
    while lo < a.height:
        hi = max(lo + 1, int(np.searchsorted(before, before[lo] + most, "right")) - 1)
        entries = slice(int(a.start[lo]), int(a.start[hi]))
        yield _block(a, b, lo, hi, entries, reach[entries])
        lo = hi


def _block(a: Csr, b: Csr, lo: int, hi: int, entries: slice, reach: np.ndarray):
    ends = np.cumsum(reach)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total) + np.repeat(b.start[a.columns[entries]] - (ends - reach), reach)
    rows = np.repeat(np.repeat(np.arange(lo, hi), np.diff(a.start[lo : hi + 1])), reach)
    columns = b.columns[at]
    values = np.ones(total, np.int64)
    if a.values is not None:
        values *= np.repeat(a.values[entries], reach)
    if b.values is not None:
        values *= b.values[at]
    place = rows * b.width + columns
    if total and (np.diff(place) < 0).any():
        order = np.argsort(place, kind="stable")
        place, values = place[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], np.diff(place) != 0])) if total else np.zeros(0, np.int64)
    place, values = place[first], np.add.reduceat(values, first) if total else values
    return place // b.width, place % b.width, values
