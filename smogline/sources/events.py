"""The ``events`` table as sensor readings, and the same rows as wire text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogline.functions.grid import grid_area
from smogline.params import Grid

# The file stores wall-clock micros; declaring TIMESTAMP reads them as UTC
# instants, which lets range filters reach the scan and allows watermarks.
EVENTS_SCHEMA = (
    "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def events_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int = 1000) -> DataFrame:
    """The same table, one file or a folder of files, as a file stream.

    A streaming source takes a folder or a pattern; the brackets make the table's name a pattern
    that matches nothing else.
    """
    return (
        spark.readStream.schema(EVENTS_SCHEMA)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(f"{sf_dir}/[e]vents.parquet")
    )


def observations(events: DataFrame) -> DataFrame:
    """Pipeline B rows: message key, named fields, event time and arrival sequence."""
    user = F.col("user_id")
    return events.select(
        F.concat(F.lit('{"sensor":'), user.cast("string"), F.lit("}")).alias("key"),
        user.cast("string").alias("sensorId"),
        (user * 61 % 100 + 1).cast("int").alias("lon"),
        (user * 37 % 100 + 1).cast("int").alias("lat"),
        (F.col("event_id") % 45 - F.lit(10.0)).alias("temperature"),
        F.get_json_object("props", "$.k").cast("int").alias("humidity"),
        F.col("value").alias("pm2"),
        F.lit("pollution").alias("measurement"),
        "ts",
        F.col("event_id").alias("seq"),
    )


def readings(events: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """Pipeline A rows: coordinates stay text, humidity is a double."""
    return observations(events).select(
        F.col("sensorId").alias("id"),
        "pm2",
        grid_area(F.col("lat"), F.col("lon"), grid).alias("area"),
        F.col("lat").cast("string").alias("lat"),
        F.col("lon").cast("string").alias("lon"),
        F.col("temperature").alias("tempC"),
        F.col("humidity").cast("double").alias("humidity"),
        "ts",
        "seq",
    )


def wire_a(observations: DataFrame) -> DataFrame:
    """The text a sensor sends to pipeline A."""
    text = F.concat(
        F.lit('{"measurement":"pollution", "id": '), F.col("sensorId"),
        F.lit(', "long": '), F.col("lon").cast("string"),
        F.lit(', "lat": '), F.col("lat").cast("string"),
        F.lit(', "humidity": '), F.col("humidity").cast("string"),
        F.lit(', "temperature": '), F.col("temperature").cast("string"),
        F.lit(', "pm2": '), F.col("pm2").cast("string"), F.lit("}"),
    )
    return observations.select("key", text.alias("value"), "ts", "seq")


def wire_b(observations: DataFrame) -> DataFrame:
    """The JSON a sensor sends to pipeline B."""
    record = F.struct("sensorId", "lon", "lat", "temperature", "humidity", "pm2", "measurement")
    return observations.select("key", F.to_json(record).alias("value"), "ts", "seq")


def wire_c(observations: DataFrame) -> DataFrame:
    """The text the store job reads: id first, epoch milliseconds third, pm2 sixth."""
    text = F.concat(
        F.lit('{"id":'), F.col("sensorId"),
        F.lit(',"measurement":pollution,"ts":'), F.unix_millis("ts").cast("string"),
        F.lit(',"lon":'), F.col("lon").cast("string"),
        F.lit(',"lat":'), F.col("lat").cast("string"),
        F.lit(',"pm2":'), F.col("pm2").cast("string"),
        F.lit(',"unit":ug}'),
    )
    return observations.select(text.alias("value"), "seq")
