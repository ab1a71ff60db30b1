"""Parameters of the two pipelines. Defaults are the production settings; tests pass larger windows."""

from __future__ import annotations

import math
from dataclasses import dataclass

# Fixed values ---------------------------------------------------------------
SENSORS = 10_000          # registered sensors
AREAS = 16                # areas of the grid, a perfect square
EXTENT = 100              # coordinates run from 1 to EXTENT on both axes
BLOCK = 25                # edge of a block label, pipeline B
RISE_THRESHOLD = 10.0     # mean(last edge) - mean(first edge) must exceed this
EDGE_DIVISOR = 10         # an edge holds 1 + n div EDGE_DIVISOR rows
ALARM_DIVISOR = 10        # alarm above sensors div areas div ALARM_DIVISOR
MAP_AREAS = 4             # areas drawn by the dashboard
MAP_ORIGIN = (47.063, 15.44)   # latitude, longitude in degrees
MAP_SPACING_M = 100.0     # metres between neighbouring sensors
EARTH_RADIUS_M = 6371000.0
GREEN_BELOW_PM2 = 15.0    # sensor marker
GREEN_BELOW_REPORTS = 2   # area rectangle
JDBC_BATCH_ROWS = 5000


@dataclass(frozen=True)
class Grid:
    """A square city grid cut into ``areas`` equal areas."""

    areas: int = AREAS
    extent: int = EXTENT

    @property
    def side(self) -> int:
        side = math.isqrt(self.areas) if self.areas > 0 else 0
        if side * side != self.areas or side == 0:
            raise ValueError(f"the number of areas must be a perfect square, got {self.areas}")
        return side

    @property
    def cell(self) -> int:
        cell = self.extent // self.side
        if cell == 0:
            raise ValueError(f"{self.areas} areas do not fit on a grid of extent {self.extent}")
        return cell


@dataclass(frozen=True)
class Windows:
    """Window sizes as Spark duration strings."""

    size: str = "60 seconds"        # sliding window per sensor
    slide: str = "30 seconds"
    area: str = "15 seconds"        # tumbling window per area
    trend: str = "60 seconds"       # tumbling window per message key
    grace: str = "10 seconds"       # lateness accepted by the trend window
    delay: str = "0 seconds"        # lateness accepted by the sliding window


def sensors_per_area(sensors: int, areas: int) -> int:
    return sensors // areas


def alarm_threshold(sensors: int, areas: int) -> int:
    return sensors_per_area(sensors, areas) // ALARM_DIVISOR
