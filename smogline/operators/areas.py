"""Roll-ups per area: tumbling sums of rise flags, running counts of flagged trends."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smogline.operators.sensor_windows import sensor_flags
from smogline.operators.windows import last_instant
from smogline.params import Windows

COUNT_BLOCK = 10_000  # counts listed by one task at a time


def area_trend(sensor_windows: DataFrame, windows: Windows = Windows()) -> DataFrame:
    """Sensors that report a rise, per area and tumbling window over the window results.

    A result counts at the last instant of its sensor window. Areas without a
    single flag appear with 0. There are few areas, so the sum relies on the
    partial aggregation in front of the shuffle.
    """
    flags = sensor_flags(sensor_windows).select(
        "area", "flag", F.window(last_instant(F.col("window_end")), windows.area).alias("_w")
    )
    return (
        flags.groupBy("area", "_w").agg(F.sum("flag").alias("sensorsReportingTrend"))
        .select(
            "area",
            F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"),
            "sensorsReportingTrend",
        )
    )


def area_totals(parts: DataFrame) -> DataFrame:
    """Sums per (area, window) from the results of :func:`area_trend` over parts of the sensor windows."""
    return parts.groupBy("area", "window_start", "window_end").agg(
        F.sum("sensorsReportingTrend").alias("sensorsReportingTrend")
    )


def area_running_count(too_high: DataFrame) -> DataFrame:
    """Flagged sensor windows per area since the start (batch total, or stream in ``update`` mode)."""
    return too_high.groupBy("area").agg(F.count(F.lit(1)).alias("count"))


def area_count_updates(too_high: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Every value the running count takes, with the end of the window that caused it.

    ``before`` (area, count) is what was counted earlier; a stream carries it from batch to batch.

    Rows are counted per (area, window) first; only these counts are summed up
    in order. The values between two sums are then listed in blocks, so that
    one window with very many flags is listed by many tasks.
    """
    counts = too_high.groupBy("area", "window_end").agg(F.count(F.lit(1)).alias("_n"))
    until = Window.partitionBy("area").orderBy("window_end").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    summed = counts.withColumn("_to", F.sum("_n").over(until))
    if before is not None:
        summed = summed.join(before.withColumnRenamed("count", "_before"), "area", "left").withColumn(
            "_to", F.col("_to") + F.coalesce("_before", F.lit(0))
        ).drop("_before")
    return (
        summed
        .withColumn("_from", F.col("_to") - F.col("_n") + 1)
        .withColumn("_block", F.explode(F.sequence("_from", "_to", F.lit(COUNT_BLOCK))))
        .repartition("area", "_block")
        .select(
            "area",
            "window_end",
            F.explode(
                F.sequence("_block", F.least("_to", F.col("_block") + F.lit(COUNT_BLOCK - 1)))
            ).alias("count"),
        )
    )
