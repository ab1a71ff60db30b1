"""Position of rows in sliding windows, by panes of time.

A pane is a piece of time that divides the slide and the size, so every window is a run of whole
panes. Rows are shuffled by (key, pane) and ranked inside their pane once, whatever the number of
windows they lie in; the position of a row in a window is its rank plus the rows of the panes before
it, which are sums over pane counts. A key that sends a large part of all rows is spread over its
panes: one pane of one key is the unit of work of a task, and its sort spills.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smogline.operators.windows import micros


def pane_micros(size: str, slide: str, pane: str | None = None) -> int:
    """Length of a pane: the longest that divides both, or a given one that does."""
    longest = math.gcd(micros(size), micros(slide))
    length = micros(pane) if pane else longest
    if length <= 0 or longest % length:
        raise ValueError(f"a pane of {pane!r} does not divide windows of {size!r} every {slide!r}")
    return length


def assign_panes(rows: DataFrame, length: int, ts: str = "ts") -> DataFrame:
    """Add ``pane``, the microsecond at which the pane of a row starts; rows without time go."""
    instant = F.unix_micros(ts)
    return rows.where(F.col(ts).isNotNull()).withColumn("pane", instant - F.pmod(instant, F.lit(length)))


def ranked(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Add ``rank`` (1-based) within (key, pane): the one shuffle and the one sort of the rows."""
    pane = Window.partitionBy(key, "pane").orderBy(*order)
    return rows.repartition(key, "pane").withColumn("rank", F.row_number().over(pane))


def window_starts(size: str, slide: str) -> Column:
    """The starts of all windows that contain the pane of a row."""
    span, step = micros(size), micros(slide)
    latest = F.col("pane") - F.pmod(F.col("pane"), F.lit(step))
    starts = F.array(*[latest - F.lit(i * step) for i in range(-(-span // step))])
    return F.filter(starts, lambda s: s > F.col("pane") - F.lit(span))
