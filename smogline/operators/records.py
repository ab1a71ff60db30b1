"""Records as text: trend topic, store payload."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: field order of the trend record.
TREND_FIELDS = [
    "sensorId", "measurement", "tooHigh", "tooHighCount", "area", "avgPm2", "countUsecase", "pair",
    "sumPm2", "maxPm2", "temperatureCMax", "temperatureFMax", "humidityMax",
]


def encode_trend(trend: DataFrame) -> DataFrame:
    """(key, value) text for the trend topic; the key holds message key and window start."""
    key = F.struct(
        "key",
        F.unix_millis("window_start").alias("window_start"),
        F.unix_millis("window_end").alias("window_end"),
    )
    return trend.select(
        F.to_json(key).alias("key"), F.to_json(F.struct(*TREND_FIELDS)).alias("value")
    )


def decode_trend(encoded: DataFrame) -> DataFrame:
    """Back from the trend topic to typed columns."""
    key = F.from_json("key", "key STRING, window_start BIGINT, window_end BIGINT")
    schema = (
        "sensorId STRING, measurement STRING, tooHigh BOOLEAN, tooHighCount INT, area STRING, "
        "avgPm2 DOUBLE, countUsecase INT, pair STRUCT<first: DOUBLE, second: DOUBLE, third: DOUBLE>, "
        "sumPm2 DOUBLE, maxPm2 DOUBLE, temperatureCMax DOUBLE, temperatureFMax DOUBLE, humidityMax INT"
    )
    return encoded.select(key.alias("_k"), F.from_json("value", schema).alias("_v")).select(
        F.col("_k.key").alias("key"),
        F.timestamp_millis("_k.window_start").alias("window_start"),
        F.timestamp_millis("_k.window_end").alias("window_end"),
        "_v.*",
    )


def encode_counts(counts: DataFrame) -> DataFrame:
    """(key, value) text for the running-count topic."""
    return counts.select(F.col("area").alias("key"), F.col("count").cast("string").alias("value"))


def store_payload(stored: DataFrame) -> DataFrame:
    """The one-column row of the store sink."""
    return stored.select(F.to_json(F.struct("id", "pm2", "ts")).alias("payload"))
