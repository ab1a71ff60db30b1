"""Streaming forms run over the events that are there, into tables in the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smogline.params import Windows
from smogline.session import scratch_path, stored
from smogline.sources.events import events, events_stream, observations, readings
from smogline.sources.streams import file_text
from smogline.streaming import jobs, ranges, store
from smogline.streaming.sinks import table_of


def detection_table(spark: SparkSession, sf_dir: str, windows: Windows, name: str) -> DataFrame:
    """A table of the detection job over the events: what follows from the windows that have closed."""
    root = scratch_path(spark, "detection")
    stage = jobs.window_stage(readings(events_stream(spark, sf_dir)), root, windows)
    jobs.run_available({"sensor_window": stage})
    return table_of(spark, f"{root}/{name}")


def trend_table(spark: SparkSession, sf_dir: str, windows: Windows, name: str) -> DataFrame:
    """A table of the trend job over the events: ``trend``, ``area_count``, ..."""
    return table_of(spark, f"{_trend_root(spark, sf_dir, windows)}/{name}")


def _trend_root(spark: SparkSession, sf_dir: str, windows: Windows) -> str:
    root = scratch_path(spark, "trend")
    jobs.run_available({"trend": jobs.trend_stage(observations(events_stream(spark, sf_dir)), root, windows)})
    return root


def trend_with_open(spark: SparkSession, sf_dir: str, windows: Windows) -> DataFrame:
    """Closed windows from the table and open ones from the named store of the stopped query."""
    root = _trend_root(spark, sf_dir, windows)
    closed = table_of(spark, f"{root}/trend").withColumn("open", F.lit(False))
    return closed.unionByName(store.open_trends(spark, f"{root}/_checkpoints/trend").withColumn("open", F.lit(True)))


def split_table(
    spark: SparkSession, messages: DataFrame, mark: Callable[[DataFrame], DataFrame], good: str, bad: str
) -> DataFrame:
    """Messages landed as files, decoded by a streaming job: (seq, value of a bad one or null)."""
    root = scratch_path(spark, "split")
    messages.write.parquet(f"{root}/in")
    source = spark.readStream.schema(messages.schema).parquet(f"{root}/in")
    jobs.run_available({"split": jobs.decoded_stage(mark(source), root, good, bad=bad)})
    fine = table_of(spark, f"{root}/{good}").select("seq", F.lit(None).cast("string").alias("value"))
    return fine.unionByName(table_of(spark, f"{root}/{bad}").select("seq", "value"))


def replayed(spark: SparkSession, rows: DataFrame, file_of: Column, files: int) -> DataFrame:
    """Rows as a stream of ``files`` files, one per micro-batch, in the order of ``file_of`` (from 0)."""
    path = scratch_path(spark, "replay")
    numbered = stored(rows.withColumn("file", file_of), "numbered")
    for number in range(files):  # files are taken up in the order in which they were written
        numbered.where(F.col("file") == number).drop("file").coalesce(1).write.parquet(f"{path}/{number:06d}")
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")


def late_rows(spark: SparkSession, sf_dir: str, windows: Windows, late: Column, files: int, by: int) -> DataFrame:
    """(seq, counted) for rows that come ``by`` files later than their time says.

    Events are dealt over ``files`` files by their number. A row counted if the trend job did not hand it
    on as too late; its windows are open until the watermark, which moves after each file, passes them.
    """
    rows = observations(events(spark, sf_dir))
    n = rows.agg(F.max("seq") + 1).scalar()
    place = F.floor(F.col("seq") * files / n).cast("int")
    source = replayed(spark, rows, F.least(place + F.when(late, by).otherwise(0), F.lit(files - 1)), files)
    root = scratch_path(spark, "late")
    jobs.run_available({"trend": jobs.trend_stage(source, root, windows)})
    lost = table_of(spark, f"{root}/late_observations").select("seq", F.lit(True).alias("lost"))
    return rows.where(late).join(lost, "seq", "left").select("seq", F.col("lost").isNull().alias("counted"))


def map_area_layer(spark: SparkSession, sf_dir: str, windows: Windows) -> DataFrame:
    """The area layer after a detection job over the events."""
    root = scratch_path(spark, "map")
    jobs.run_available(jobs.detection_stages(readings(events_stream(spark, sf_dir)), root, windows))
    return jobs.map_layer(spark, root)


def sorted_parts(rows: DataFrame, order: str) -> DataFrame:
    """Rows in order, sorted by as many tasks as there are parts, and kept on disk.

    One task can then read the parts one after the other; without the disk between, it would hold
    the sorts of all of them.
    """
    parts = rows.orderBy(order).persist(StorageLevel.DISK_ONLY)
    parts.count()
    return parts


def text_lines(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Messages written as one text file, in order, and landed from it by a stream: value, ts, seq."""
    root = scratch_path(spark, "lines")
    parts = sorted_parts(rows.select("seq", "value"), "seq")
    parts.select("value").coalesce(1).write.text(f"{root}/in")
    parts.unpersist()
    source = file_text(spark, f"{root}/in")
    jobs.run_available({"lines": jobs.landed_stage(source, root, "lines", {})})
    return table_of(spark, f"{root}/lines")


def closed_table(spark: SparkSession, sf_dir: str, windows: Windows, name: str) -> DataFrame:
    """``sensor_window``, ``area_trend`` or ``trend`` of the landed rows, up to where a stream would be.

    The range ends where the latest row, less the lateness that is waited for, has closed windows.
    """
    source = events_stream(spark, sf_dir)
    rows, delay = (observations(source), windows.grace) if name == "trend" else (readings(source), windows.delay)
    root = scratch_path(spark, "landed")
    ranges.land(rows, f"{root}/rows", f"{root}/_checkpoint").awaitTermination()
    table = spark.read.schema(f"{rows._jdf.schema().toDDL()}, date DATE").parquet(f"{root}/rows")
    latest = table.agg(F.max("ts") - F.expr(f"INTERVAL {delay}")).first()[0]
    if name == "trend":
        return ranges.trend_of(table, None, latest, windows)
    emitted = ranges.sensor_windows_of(table, None, latest, windows)
    return emitted if name == "sensor_window" else ranges.area_trend_of(emitted, None, latest, windows)
