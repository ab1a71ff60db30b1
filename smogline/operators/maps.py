"""The two map layers of the dashboard."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogline.functions.geo import degree_steps, to_latitude, to_longitude
from smogline.functions.scalars import colour
from smogline.params import GREEN_BELOW_PM2, GREEN_BELOW_REPORTS, MAP_AREAS, MAP_ORIGIN


def sensor_layer(sensor_points: DataFrame) -> DataFrame:
    """Marker position and colour for each point of the ``sensors`` table."""
    return sensor_points.select(
        "id",
        "avgPM2",
        F.col("lat").cast("double").alias("lat"),
        F.col("lon").cast("double").alias("long"),
        to_latitude(F.col("lat")).alias("lat_deg"),
        to_longitude(F.col("lon")).alias("lng_deg"),
        colour(F.col("avgPM2"), GREEN_BELOW_PM2).alias("color"),
    )


def _label_number(position: int) -> Column:
    return F.regexp_extract("area", r"\((-?\d+),(-?\d+)\)", position).cast("int")


def area_layer(
    area_points: DataFrame, sensors: DataFrame, areas: int = MAP_AREAS
) -> DataFrame:
    """Rectangle and colour for each point of the ``areas`` table.

    The edge of a rectangle follows from the number of different sensors on the
    map, which joins in as a scalar.
    """
    side = math.sqrt(areas)
    step_lat, step_lng = degree_steps()
    count = sensors.select(F.countDistinct("id").cast("double").alias("n")).scalar()
    edge = (F.sqrt(F.col("_sensors")) + F.lit(side - 1)) / F.lit(side) - F.lit(1.0)
    height, width = edge * F.lit(step_lat), edge * F.lit(step_lng)
    start_lat = F.lit(MAP_ORIGIN[0]) + height * _label_number(1)
    start_lng = F.lit(MAP_ORIGIN[1]) + width * _label_number(2)
    return (
        area_points.select("area", "tooHigh")
        .withColumn("_sensors", count)
        .select(
            "area",
            "tooHigh",
            start_lat.alias("start_lat"),
            start_lng.alias("start_lng"),
            (start_lat + height).alias("end_lat"),
            (start_lng + width).alias("end_lng"),
            colour(F.col("tooHigh"), GREEN_BELOW_REPORTS).alias("color"),
        )
    )
