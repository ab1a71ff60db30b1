"""Sliding-window statistics and the rise flag per sensor (pipeline A)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smogline.functions.scalars import fahrenheit
from smogline.operators.panes import assign_panes, pane_micros, ranked, window_starts
from smogline.operators.rise import in_first_edge, in_last_edge, rise_flag
from smogline.operators.windows import arrival_number, assign_windows, micros
from smogline.params import Windows

KEYS = ["id", "window_start", "window_end"]
ORDER = ["ts", "seq"]
CLIMATE = ["tempC", "humidity"]


def sensor_statistics(readings: DataFrame, windows: Windows = Windows()) -> DataFrame:
    """Count, sum, average, maxima and first area per (sensor, window), without the flag.

    Everything here combines before the shuffle. The area is the one the reading carries.
    """
    rows = assign_windows(
        readings.select(
            "id", "pm2", "tempC", "humidity", "ts", "area", arrival_number().alias("_order")
        ),
        windows.size, windows.slide,
    )
    stats = rows.groupBy(*KEYS).agg(
        F.min_by("area", "_order").alias("area"),
        F.count(F.lit(1)).alias("_n"),
        F.sum("pm2").alias("sumPM2"),
        F.max("tempC").alias("tempC"),
        F.max("humidity").alias("humidity"),
    )
    return stats.select(
        *KEYS,
        "area",
        (F.col("sumPM2") / F.col("_n")).alias("avgPM2"),
        F.col("_n").cast("int").alias("elementsInWindow"),
        "sumPM2",
        "tempC",
        fahrenheit(F.col("tempC")).alias("tempF"),
        "humidity",
    )


def _result_columns(keys: list, flag: Column, carry: tuple = ("lat", "lon"), climate: bool = True) -> list:
    return [
        *keys,
        flag.alias("pm2tooHigh"),
        "area",
        (F.col("sumPM2") / F.col("_n")).alias("avgPM2"),
        F.col("_n").cast("int").alias("elementsInWindow"),
        "sumPM2",
        *(["tempC", fahrenheit(F.col("tempC")).alias("tempF"), "humidity"] if climate else []),
        *carry,
    ]


def sensor_windows(
    readings: DataFrame, windows: Windows = Windows(), carry: tuple = ("lat", "lon"), pane: str | None = None
) -> DataFrame:
    """One row per (sensor, window) with statistics and the rise flag (batch form).

    One algorithm for every size. Counts, sums, maxima and first labels per (sensor, pane)
    combine before their shuffle; those of windows follow from them. For the edges, the four
    columns that a rank needs are shuffled and sorted by (sensor, pane) once, whatever the number
    of windows of a row; only panes that hold a part of an edge are joined with their rows, and
    only rows of an edge are added up. ``carry`` names the columns of the first row to keep
    beside its area. Readings without temperature and humidity, as the map job decodes them,
    give windows without. The input is read twice, so decode it once and land it before.
    """
    climate = [name for name in CLIMATE if name in readings.columns]
    labels = ["area", *carry]
    rows = assign_panes(
        readings.select("id", "pm2", *labels, *climate, *ORDER),
        pane_micros(windows.size, windows.slide, pane),
    )
    first_labels = F.min_by(F.struct(*labels), arrival_number()).alias("first")
    panes = rows.groupBy("id", "pane").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("pm2").alias("pm2"),
        *[F.max(name).alias(name) for name in climate], first_labels,
    ).select("*", "first.*").drop("first")
    rows = ranked(rows.select("id", "pane", "pm2", *ORDER), "id", ORDER)
    opened = panes.withColumn("start", F.explode(window_starts(windows.size, windows.slide)))
    ordered = Window.partitionBy("id", "start").orderBy("pane")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    placed = opened.select(
        "id", "pane", "start", "rows", *labels,
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"),
        F.sum("rows").over(whole).alias("_n"),
        F.sum("pm2").over(whole).alias("sumPM2"),
        *[F.max(name).over(whole).alias(name) for name in climate],
    )
    first, last = F.col("before") + 1, F.col("before") + F.col("rows")
    touched = placed.where(in_first_edge(first, F.col("_n")) | in_last_edge(last, F.col("_n")))
    n, position = F.col("_n"), F.col("before") + F.col("rank")
    edges = (
        rows.select("id", "pane", "pm2", "rank")
        .join(touched.select("id", "pane", "start", "before", "_n"), ["id", "pane"])
        .where(in_first_edge(position, n) | in_last_edge(position, n))
        .groupBy("id", "start").agg(
            F.sum(F.when(in_first_edge(position, n), F.col("pm2"))).alias("_first"),
            F.sum(F.when(in_last_edge(position, n), F.col("pm2"))).alias("_last"),
        )
    )
    stats = placed.where("before = 0").drop("pane", "rows", "before").join(edges, ["id", "start"])
    named = stats.withColumns({
        "window_start": F.timestamp_micros("start"),
        "window_end": F.timestamp_micros(F.col("start") + F.lit(micros(windows.size))),
    })
    flag = rise_flag(n, F.col("_first"), F.col("_last"))
    return named.select(*_result_columns(KEYS, flag, carry, bool(climate)))


def sensor_flags(sensor_windows: DataFrame) -> DataFrame:
    """The second output of the window operator: one 0/1 flag per sensor window, with its area."""
    return sensor_windows.withColumn("flag", F.col("pm2tooHigh").cast("int"))
