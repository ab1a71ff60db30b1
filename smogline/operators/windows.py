"""Window assignment in event time, epoch-aligned, start inclusive, end exclusive."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def assign_windows(rows: DataFrame, size: str, slide: str | None = None, ts: str = "ts") -> DataFrame:
    """Add ``window_start`` and ``window_end``; a sliding window repeats each row size/slide times."""
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    return (
        rows.withColumn("_w", window)
        .withColumns({"window_start": F.col("_w.start"), "window_end": F.col("_w.end")})
        .drop("_w")
    )


# Microseconds per unit of a duration string.
MICROS = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
    "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000,
}


def micros(duration: str) -> int:
    """Length of a duration such as ``60 seconds`` or ``1 minute 30 seconds``."""
    words = duration.split()
    if not words or len(words) % 2:
        raise ValueError(f"not a duration: {duration!r}")
    return sum(
        int(amount) * MICROS[unit.lower().removesuffix("s")]
        for amount, unit in zip(words[::2], words[1::2])
    )


def last_instant(window_end: Column) -> Column:
    """Event time of a window's result: the last microsecond that belongs to it."""
    return window_end - F.expr("INTERVAL '0.000001' SECOND")


def arrival(ts: str = "ts", seq: str = "seq") -> Column:
    return F.struct(ts, seq)


def arrival_number(ts: str = "ts", seq: str = "seq") -> Column:
    """(ts, seq) as one decimal that sorts the same way.

    A fixed-width ordering keeps ``min_by`` in hash aggregation, where a struct
    would force a sort before the partial aggregate. One microsecond is worth
    more than the whole range of a BIGINT sequence.
    """
    shift = F.lit(2 * Decimal(10) ** 19)
    return (
        F.unix_micros(ts).cast("decimal(18,0)") * shift + F.col(seq).cast("decimal(19,0)")
    ).cast("decimal(38,0)")
