"""Area labels. The two pipelines label the same point differently; nothing is shared on purpose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from smogline.params import BLOCK, Grid


def int_div(value: Column, divisor: int) -> Column:
    """Integer division truncating toward zero (SQL ``div``)."""
    return F.call_function("div", value, F.lit(divisor))


def grid_row(lat: Column, grid: Grid) -> Column:
    return int_div(lat - 1, grid.cell)


def grid_column(lon: Column, grid: Grid) -> Column:
    return int_div(lon - 1, grid.cell)


def grid_label(row: Column, column: Column) -> Column:
    return F.concat(
        F.lit("("), row.cast("string"), F.lit(","), column.cast("string"), F.lit(")")
    )


def grid_area(lat: Column, lon: Column, grid: Grid = Grid()) -> Column:
    """Pipeline A: 1-based coordinates, latitude first, ``(row,column)``.

    An extent that is no multiple of the cell leaves a narrower last row and
    column; the label is not clamped.
    """
    return grid_label(grid_row(lat, grid), grid_column(lon, grid))


def block_area(lon: Column, lat: Column, block: int = BLOCK) -> Column:
    """Pipeline B: 0-based coordinates, longitude first, ``Area [x, y]``."""
    return F.concat(
        F.lit("Area ["),
        int_div(lon, block).cast("string"),
        F.lit(", "),
        int_div(lat, block).cast("string"),
        F.lit("]"),
    )
