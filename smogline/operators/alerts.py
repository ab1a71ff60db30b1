"""Alarms and alert texts. Alerts are rows of a table; delivery is left to its readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogline.params import AREAS, SENSORS, alarm_threshold, sensors_per_area

BOTH = "both"
ABOVE_ONLY = "above_only"
EVERY_UPDATE = "every_update"


def above_threshold(count: Column, sensors: int = SENSORS, areas: int = AREAS) -> Column:
    return count > F.lit(alarm_threshold(sensors, areas))


def area_alarms(area_trend: DataFrame, sensors: int = SENSORS, areas: int = AREAS) -> DataFrame:
    """Area results above the alarm threshold."""
    return area_trend.filter(
        above_threshold(F.col("sensorsReportingTrend"), sensors, areas)
    ).withColumn("threshold", F.lit(alarm_threshold(sensors, areas)))


# Alert wordings. {area}, {count} and {registered} are filled in per row.
TEXT_ABOVE = "Area: {area} registered a high increase of PM2,5. {count} of {registered} registered sensors reported."
TEXT_BELOW = (
    "Area: {area} registered a too high increase of PM2,5 concentration: "
    "{count} of {registered} registered sensors reported."
)
TEXT_ALARM = "ALARM !!! " + TEXT_ABOVE
TEXT_UPDATE = "In {area}was registred a too high Pm2.5 concentration{count}"


def _fill(template: str, registered: int, count: str) -> Column:
    pattern = template.replace("{registered}", str(registered))
    pattern = pattern.replace("{area}", "%1$s").replace("{count}", "%2$s")
    return F.format_string(pattern, F.col("area"), F.col(count).cast("string"))


def area_messages(
    area_trend: DataFrame, policy: str = BOTH, sensors: int = SENSORS, areas: int = AREAS
) -> DataFrame:
    """One message per area result (``both``) or only for alarms (``above_only``)."""
    count = "sensorsReportingTrend"
    registered = sensors_per_area(sensors, areas)
    above = above_threshold(F.col(count), sensors, areas)
    if policy == BOTH:
        rows = area_trend
        text = F.when(above, _fill(TEXT_ABOVE, registered, count)).otherwise(
            _fill(TEXT_BELOW, registered, count)
        )
    elif policy == ABOVE_ONLY:
        rows = area_trend.filter(above)
        text = _fill(TEXT_ALARM, registered, count)
    else:
        raise ValueError(f"unknown alert policy {policy}")
    return rows.select(
        "area",
        "window_end",
        F.col(count).alias("count"),
        F.lit(alarm_threshold(sensors, areas)).alias("threshold"),
        F.when(above, "above").otherwise("below").alias("severity"),
        text.alias("message"),
    )


def update_messages(count_updates: DataFrame) -> DataFrame:
    """One message per new running count (``every_update``), no threshold."""
    return count_updates.select(
        *count_updates.columns, _fill(TEXT_UPDATE, 0, "count").alias("message")
    )
