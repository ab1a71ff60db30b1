"""Streaming sources. All of them give ``value`` (text), ``ts`` and ``seq``; keyed ones also ``key``."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD_SCHEMA = "key STRING, value STRING, timestamp TIMESTAMP, seq BIGINT"


def _kafka(spark: SparkSession, servers: str, topic: str, starting: str, options: dict) -> DataFrame:
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
        .load()
    )


def from_kafka_frame(frame: DataFrame) -> DataFrame:
    """Key and value as text, record time as event time, partition and offset as arrival sequence.

    A key always lands in the same topic partition, so offsets order its rows. Records without
    a key are spread over partitions; the partition in the upper 15 bits keeps (ts, seq) unique.
    """
    return frame.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("ts"),
        (F.shiftleft(F.col("partition").cast("long"), 48) + F.col("offset")).alias("seq"),
    )


def kafka_text(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Text records from now on (needs the Kafka package on the class path)."""
    return from_kafka_frame(_kafka(spark, servers, topic, "latest", options)).drop("key")


def kafka_keyed(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Keyed records from the earliest offset on."""
    return from_kafka_frame(_kafka(spark, servers, topic, "earliest", options))


def file_records(
    spark: SparkSession, path: str, file_format: str = "parquet", files_per_trigger: int = 1000
) -> DataFrame:
    """Records landed as JSON or Parquet files, in the shape of a Kafka record."""
    return (
        spark.readStream.format(file_format)
        .schema(RECORD_SCHEMA)
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(path)
        .withColumnRenamed("timestamp", "ts")
    )


def file_text(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """Plain text files, one message per line; the file's time stands in for the arrival time.

    ``seq`` is the place of a line in its file (the start of the block that a task reads, and the number
    of the line in it), below 23 bits from the name of the file. So lines of a file keep their order however
    the file is split, and files of the same millisecond are not mixed.
    """
    found = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path).select(
        "value",
        F.col("_metadata.file_modification_time").alias("ts"),
        F.shiftrightunsigned(F.xxhash64("_metadata.file_path"), 41).alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
    )
    return found.mapInArrow(_numbered, "value STRING, ts TIMESTAMP, seq BIGINT")


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the lines of each block; a task reads blocks one after the other, each from its start."""
    last, count = None, 0
    for batch in batches:
        file, start = (batch[c].to_numpy() for c in ("file", "start"))
        cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(start) != 0)) + 1
        place = np.empty(len(file), np.int64)
        for lo, hi in zip([0, *cuts], [*cuts, len(file)]):
            if hi > lo:
                if (file[lo], start[lo]) != last:
                    last, count = (file[lo], start[lo]), 0
                place[lo:hi] = np.arange(count, count + hi - lo)
                count += hi - lo
        yield pa.record_batch({"value": batch["value"], "ts": batch["ts"], "seq": pa.array((file << 40) + start + place)})
