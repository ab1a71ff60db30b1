"""Analytics for grids of environmental sensors, written as Spark DataFrame transformations."""
