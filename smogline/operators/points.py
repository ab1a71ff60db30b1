"""Time-series points: one typed table per measurement, tags as text, fields typed, one ``ts``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ts(ts: Column | str | None) -> Column:
    """Point time: the wall clock unless a column is given (batch results should repeat)."""
    if ts is None:
        return F.current_timestamp().alias("ts")
    return (F.col(ts) if isinstance(ts, str) else ts).alias("ts")


def pollution(
    readings: DataFrame, ts: Column | str | None = None, with_position: bool = True
) -> DataFrame:
    """``Pollution``: every reading. The queue jobs write it without the position tags."""
    position = [F.col("lat").alias("latitude"), F.col("lon").alias("longitude")]
    return readings.select(
        F.lit("Pollution").alias("measurement"),
        _ts(ts),
        "id",
        "area",
        *(position if with_position else []),
        "pm2",
        "humidity",
        "tempC",
    )


def sensor_data(sensor_windows: DataFrame, ts: Column | str | None = None) -> DataFrame:
    """``SensorData``: one point per sensor window."""
    return sensor_windows.select(
        F.lit("SensorData").alias("measurement"), _ts(ts), "id", "area", "pm2tooHigh", "avgPM2",
        "elementsInWindow", "sumPM2", "tempC", "tempF", "humidity",
    )


def area_trend_points(area_trend: DataFrame, ts: Column | str | None = None) -> DataFrame:
    """``AreaTrend``: one point per area result."""
    return area_trend.select(
        F.lit("AreaTrend").alias("measurement"), _ts(ts), "area", "sensorsReportingTrend"
    )


def map_sensors(sensor_windows: DataFrame, ts: Column | str | None = None) -> DataFrame:
    """``sensors``: average and position of a sensor, for the map."""
    return sensor_windows.select(
        F.lit("sensors").alias("measurement"), _ts(ts), F.col("id").alias("sensorino"), "avgPM2",
        "id", "lat", "lon",
    )


def map_areas(area_trend: DataFrame, ts: Column | str | None = None) -> DataFrame:
    """``areas``: reports per area, for the map."""
    return area_trend.select(
        F.lit("areas").alias("measurement"), _ts(ts), "area",
        F.col("sensorsReportingTrend").alias("tooHigh"),
    )


def raw(observations: DataFrame, ts: Column | str | None = None) -> DataFrame:
    """``pollutionRaw``: every record as it came, all its fields."""
    fields = ["sensorId", "lon", "lat", "temperature", "humidity", "pm2"]
    return observations.select(
        F.lit("pollutionRaw").alias("point"), _ts(ts), *fields, "measurement"
    )


def trend_points(trend: DataFrame, ts: Column | str | None = None) -> DataFrame:
    """``pollution``: the trend record without its nested field."""
    flat = trend.drop("pair")
    names = [c for c in flat.columns if c not in ("key", "window_start", "window_end")]
    return flat.select(F.lit("pollution").alias("point"), _ts(ts), *names)


def in_time_range(points: DataFrame, start: str, end: str) -> DataFrame:
    """Points with start <= ts < end, as the dashboard asks for them.

    On a table partitioned by day (``date``) only the days in question are read.
    """
    lower, upper = (F.lit(t).cast("timestamp") for t in (start, end))
    ranged = points.filter((F.col("ts") >= lower) & (F.col("ts") < upper))
    if "date" in points.columns:
        ranged = ranged.filter(F.col("date").between(F.to_date(lower), F.to_date(upper)))
    return ranged
