"""Rise detection per sensor window: mean of the last edge against mean of the first edge.

With n rows in arrival order an edge holds 1 + n div 10 rows. The flag is set
when n > 1 and the last edge lies more than 10 above the first one. The streaming
form adds the values of an edge from the first to the last; the batch form adds partial
sums in any order, so means may differ in their last bits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from smogline.functions.grid import int_div
from smogline.params import EDGE_DIVISOR, RISE_THRESHOLD


def edge_rows(n: Column) -> Column:
    return int_div(n, EDGE_DIVISOR) + 1


def rise_flag(n: Column, first_sum: Column, last_sum: Column) -> Column:
    size = edge_rows(n)
    return (n > 1) & (last_sum / size - first_sum / size > F.lit(RISE_THRESHOLD))


def in_first_edge(rank: Column, n: Column) -> Column:
    return rank <= edge_rows(n)


def in_last_edge(rank: Column, n: Column) -> Column:
    return rank > n - edge_rows(n)


def rise_of_sorted(values: Column) -> Column:
    """The flag for an array of values in arrival order (streaming form)."""
    n = F.size(values)
    size = edge_rows(n).cast("int")

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0.0), lambda acc, x: acc + x)

    first = total(F.slice(values, F.lit(1), size))
    last = total(F.slice(values, n - size + 1, size))
    return rise_flag(n, first, last)
