"""Grid coordinates to degrees for the dashboard map."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from smogline.params import EARTH_RADIUS_M, MAP_ORIGIN, MAP_SPACING_M


def degree_steps(
    origin: tuple[float, float] = MAP_ORIGIN, spacing_m: float = MAP_SPACING_M
) -> tuple[float, float]:
    """Degrees per grid step on both axes.

    The dashboard shrinks the earth radius by the *sine* of the latitude. That
    is kept, because the drawn positions must stay where they are.
    """
    latitude = math.radians(origin[0])
    step_lat = spacing_m * (180.0 / (EARTH_RADIUS_M * math.sin(latitude) * math.pi))
    return step_lat, step_lat / math.cos(latitude)


def to_latitude(lat: Column, origin=MAP_ORIGIN, spacing_m: float = MAP_SPACING_M) -> Column:
    return F.lit(origin[0]) + lat.cast("double") * F.lit(degree_steps(origin, spacing_m)[0])


def to_longitude(lon: Column, origin=MAP_ORIGIN, spacing_m: float = MAP_SPACING_M) -> Column:
    return F.lit(origin[1]) + lon.cast("double") * F.lit(degree_steps(origin, spacing_m)[1])
