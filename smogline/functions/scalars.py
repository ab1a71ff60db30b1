"""Small scalar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fahrenheit(celsius: Column) -> Column:
    return celsius * F.lit(1.8) + F.lit(32.0)


def colour(value: Column, green_below: float) -> Column:
    """Traffic light with the limit itself counting as red."""
    return F.when(value < F.lit(green_below), F.lit("green")).otherwise(F.lit("red"))
