"""Tumbling-window trend per message key (pipeline B)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogline.functions.grid import block_area
from smogline.functions.scalars import fahrenheit
from smogline.operators.fold import fold_groups, state_columns
from smogline.operators.windows import arrival, assign_windows
from smogline.params import Windows

KEYS = ["key", "window_start", "window_end"]

# Fixed value: maxima start here in every unit.
FLOOR = -1


def keyed(observations: DataFrame) -> DataFrame:
    """Rows without a message key take no part in grouping."""
    return observations.filter(F.col("key").isNotNull())


def _floored(column: Column, floor: Column) -> Column:
    return F.greatest(floor, column)


def _aggregates() -> list[Column]:
    last = F.struct("sensorId", "measurement", block_area(F.col("lon"), F.col("lat")).alias("area"))
    return [
        F.max_by(last, arrival()).alias("_last"),
        F.count(F.lit(1)).cast("int").alias("countUsecase"),
        F.sum("pm2").alias("sumPm2"),
        F.max("pm2").alias("_pm2"),
        F.max("temperature").alias("_temperature"),
        F.max("humidity").alias("_humidity"),
    ]


def _statistics() -> list[Column]:
    floor = F.lit(float(FLOOR))
    return [
        F.col("_last.sensorId").alias("sensorId"),
        F.col("_last.measurement").alias("measurement"),
        F.col("_last.area").alias("area"),
        (F.col("sumPm2") / F.col("countUsecase")).alias("avgPm2"),
        F.col("countUsecase"),
        F.col("sumPm2"),
        _floored(F.col("_pm2"), floor).alias("maxPm2"),
        _floored(F.col("_temperature"), floor).alias("temperatureCMax"),
        _floored(fahrenheit(F.col("_temperature")), floor).alias("temperatureFMax"),
        _floored(F.col("_humidity"), F.lit(FLOOR)).alias("humidityMax"),
    ]


def trend_statistics(observations: DataFrame, windows: Windows = Windows()) -> DataFrame:
    """The part of the trend that combines before the shuffle: counts, sums, maxima, last labels."""
    rows = assign_windows(keyed(observations), windows.trend)
    return rows.groupBy(*KEYS).agg(*_aggregates()).select(*KEYS, *_statistics())


def trend_fold(observations: DataFrame, windows: Windows = Windows()) -> DataFrame:
    """Only the state machine: flag, counter and the three differences per (key, window)."""
    rows = assign_windows(keyed(observations).select("key", "pm2", "ts", "seq"), windows.trend)
    return fold_groups(rows.repartition(*KEYS), KEYS).select(*KEYS, *state_columns())


def trend(observations: DataFrame, windows: Windows = Windows()) -> DataFrame:
    """The full trend record per (key, window).

    Statistics combine before their shuffle; only the five columns that the state machine
    needs are shuffled row by row. One row per group on each side meets in a join.
    """
    rows = assign_windows(keyed(observations), windows.trend)
    statistics = rows.groupBy(*KEYS).agg(*_aggregates())
    states = fold_groups(rows.repartition(*KEYS), KEYS)
    return statistics.join(states, KEYS).select(*KEYS, *_statistics(), *state_columns())


def too_high(trend: DataFrame) -> DataFrame:
    return trend.filter("tooHigh")
