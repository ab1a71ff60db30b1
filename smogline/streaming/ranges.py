"""Results of a closed range of time from a landed table, without window state in the stream.

Where sensors send a large part of a stream, the stream only lands its rows in a table partitioned by
day, and the batch operators run over a range of it that the caller has closed. Nothing here keeps a
watermark: the caller says which windows are complete, as a scheduler does when a day is over.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from smogline.operators import areas, trend
from smogline.operators.sensor_windows import sensor_windows
from smogline.operators.windows import micros
from smogline.params import Windows
from smogline.streaming.sinks import append_table


def land(rows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Write a stream of readings or observations to a table partitioned by day of ``ts``."""
    return append_table(rows, path, checkpoint, "ts", trigger)


def rows_of(table: DataFrame, lower: datetime | None, upper: datetime, reach: str) -> DataFrame:
    """The rows that windows ending in (lower, upper] can hold; days outside are not read."""
    out = table.where((F.col("ts") < F.lit(upper)) & (F.col("date") <= F.to_date(F.lit(upper))))
    if lower is not None:
        first = F.timestamp_micros(F.unix_micros(F.lit(lower)) - F.lit(micros(reach)))
        out = out.where((F.col("ts") >= first) & (F.col("date") >= F.to_date(first)))
    return out.drop("date")


def _ended(result: DataFrame, lower: datetime | None, upper: datetime) -> DataFrame:
    result = result.where(F.col("window_end") <= F.lit(upper))
    return result if lower is None else result.where(F.col("window_end") > F.lit(lower))


def sensor_windows_of(table: DataFrame, lower: datetime | None, upper: datetime, windows: Windows) -> DataFrame:
    """The sensor windows that end in (lower, upper]."""
    return _ended(sensor_windows(rows_of(table, lower, upper, windows.size), windows), lower, upper)


def area_trend_of(emitted: DataFrame, lower: datetime | None, upper: datetime, windows: Windows) -> DataFrame:
    """The area windows that end in (lower, upper], from sensor windows that were emitted."""
    return _ended(areas.area_trend(emitted, windows), lower, upper)


def trend_of(table: DataFrame, lower: datetime | None, upper: datetime, windows: Windows) -> DataFrame:
    """The trend of the windows that end in (lower, upper]."""
    return _ended(trend.trend(rows_of(table, lower, upper, windows.trend), windows), lower, upper)
