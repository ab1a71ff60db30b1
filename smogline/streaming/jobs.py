"""The streaming jobs, wired from source to tables.

A job is a few streaming queries, each with its own checkpoint under ``root``. The first one decodes the
source, once, and writes points, decoded rows and bad rows; the next one runs the windows over the
decoded rows and writes everything that follows from them, so window state is held once. Whatever a
query carries from batch to batch (open area windows, running counts) is a small table of its own,
one folder per batch. Started again on the same ``root``, every query goes on from its checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from smogline.functions import decode
from smogline.operators import alerts, areas, maps, points, records
from smogline.operators.trend import too_high
from smogline.params import AREAS, MAP_AREAS, SENSORS, Windows
from smogline.session import prepare
from smogline.streaming.sinks import Batch, jdbc_writer, kafka_topic, made, several_tables
from smogline.streaming.stateful import sensor_windows_and_late, trend_and_late

Stage = Callable[[dict | None], StreamingQuery]

AREA_TREND_SCHEMA = (
    "area STRING, window_start TIMESTAMP, window_end TIMESTAMP, sensorsReportingTrend BIGINT"
)
TREND_SCHEMA = (
    "key STRING, window_start TIMESTAMP, window_end TIMESTAMP, sensorId STRING, "
    "measurement STRING, area STRING, avgPm2 DOUBLE, countUsecase INT, sumPm2 DOUBLE, "
    "maxPm2 DOUBLE, temperatureCMax DOUBLE, temperatureFMax DOUBLE, humidityMax INT, "
    "tooHigh BOOLEAN, tooHighCount INT, pair STRUCT<first: DOUBLE, second: DOUBLE, third: DOUBLE>"
)
COUNT_SCHEMA = "area STRING, count BIGINT"


def _table_stream(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """A table as a stream; its folders give no columns, as it may have none yet."""
    made(spark, path)
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def _checkpoint(root: str, name: str) -> str:
    return f"{root}/_checkpoints/{name}"


def decoded_stage(
    marked: DataFrame, root: str, good: str, shapes: dict[str, Callable[[DataFrame], DataFrame]] | None = None,
    bad: str = "bad_records",
) -> Stage:
    """Split a decoded stream with its ``ok`` flag: good rows to ``good``, bad ones to ``bad``.

    ``shapes`` are further tables made of the good rows. Each message is decoded once, for all tables.
    """
    def tables(rows: DataFrame, batch: Batch) -> dict:
        fine = rows.where("ok").drop("ok", "value")
        date_of = "ts" if dict(rows.dtypes).get("ts") == "timestamp" else None  # wire C has text there
        passed = [c for c in ("key", date_of, "seq") if c in rows.columns]
        return {
            good: (fine, date_of), bad: (decode.quarantine(rows, *passed), date_of),
            **{name: (shape(fine), "ts") for name, shape in (shapes or {}).items()},
        }

    return lambda trigger=None: several_tables(marked, tables, root, _checkpoint(root, good), trigger)


def landed_stage(rows: DataFrame, root: str, good: str, shapes: dict[str, Callable[[DataFrame], DataFrame]]) -> Stage:
    """The same for rows that come decoded."""
    def tables(kept: DataFrame, batch: Batch) -> dict:
        return {good: (kept, "ts"), **{name: (shape(kept), "ts") for name, shape in shapes.items()}}

    return lambda trigger=None: several_tables(rows, tables, root, _checkpoint(root, good), trigger)


def window_stage(
    readings: DataFrame, root: str, windows: Windows = Windows(), sensors: int = SENSORS,
    number_of_areas: int = AREAS, policy: str = alerts.BOTH,
) -> Stage:
    """All that follows from sensor windows: both outputs of the window operator, points, areas, alerts.

    An area window is closed when the watermark has passed its end, as all sensor windows in it
    are out by then; until then its sum so far is carried in ``carried_area_open``.
    """
    def tables(found: DataFrame, batch: Batch) -> dict:
        closed = found.where("late_ts IS NULL").drop("late_ts", "late_seq")
        before = batch.before("carried_area_open", AREA_TREND_SCHEMA)
        sums = batch.keep(areas.area_totals(areas.area_trend(closed, windows).unionByName(before)))
        ended = F.unix_micros("window_end") <= F.lit(batch.watermark_us)
        area = sums.where(ended)
        flags = closed.select("id", "window_end", F.col("pm2tooHigh").cast("int").alias("flag"), "area")
        return {
            "sensor_window": (closed, "window_end"),
            "sensor_flag": (flags, "window_end"),
            "SensorData": (points.sensor_data(closed, "window_end"), "ts"),
            "sensors": (points.map_sensors(closed, "window_end"), "ts"),
            "late_readings": (found.where("late_ts IS NOT NULL").select("id", F.col("late_ts").alias("ts"), F.col("late_seq").alias("seq")), None),
            "area_trend": (area, "window_end"),
            "AreaTrend": (points.area_trend_points(area, "window_end"), "ts"),
            "areas": (points.map_areas(area, "window_end"), "ts"),
            "alerts": (alerts.area_messages(area, policy, sensors, number_of_areas), "window_end"),
            "carried_area_open": (sums.where(~ended), None),
        }

    def stage(trigger: dict | None = None) -> StreamingQuery:
        found = sensor_windows_and_late(readings.withWatermark("ts", windows.delay), windows)
        return several_tables(found, tables, root, _checkpoint(root, "sensor_window"), trigger)

    return stage


def sensor_id_stage(readings: DataFrame, root: str, horizon: str = "30 days") -> Stage:
    """``sensor_ids``: each sensor once per horizon, for the map's number of sensors.

    The state holds ids only, and drops one when nothing of the sensor came for ``horizon``.
    """
    def tables(rows: DataFrame, batch: Batch) -> dict:
        return {"sensor_ids": (rows, None)}

    def stage(trigger: dict | None = None) -> StreamingQuery:
        seen = readings.select("id", "ts").withWatermark("ts", horizon).dropDuplicatesWithinWatermark(["id"])
        return several_tables(seen, tables, root, _checkpoint(root, "sensor_ids"), trigger)

    return stage


def detection_stages(
    readings: DataFrame, root: str, windows: Windows = Windows(), sensors: int = SENSORS,
    number_of_areas: int = AREAS, policy: str = alerts.BOTH, horizon: str = "30 days",
) -> dict[str, Stage]:
    """Pipeline A on a stream of readings, or of decoded messages with their ``ok`` flag."""
    spark = prepare(readings.sparkSession)
    rows = _table_stream(spark, f"{root}/readings", readings.drop("ok", "value").schema)
    first = decoded_stage if "ok" in readings.columns else landed_stage
    return {
        "readings": first(readings, root, "readings", {"Pollution": lambda r: points.pollution(r, "ts")}),
        "sensor_window": window_stage(rows, root, windows, sensors, number_of_areas, policy),
        "sensor_ids": sensor_id_stage(rows, root, horizon),
    }


def trend_stage(observations: DataFrame, root: str, windows: Windows = Windows()) -> Stage:
    """All that follows from the trend: the records, points, rows that came too late, every running count.

    What was counted per area so far is carried in ``carried_area_total``, so each value of a count is a row of
    ``area_count``, whatever the number of windows that close in one batch.
    """
    def tables(found: DataFrame, batch: Batch) -> dict:
        closed = found.where("late_ts IS NULL").drop("late_ts", "late_seq")
        before, flagged = batch.before("carried_area_total", COUNT_SCHEMA), too_high(closed)
        late = found.where("late_ts IS NOT NULL").select("key", F.col("late_ts").alias("ts"), F.col("late_seq").alias("seq"))
        counts = areas.area_running_count(flagged).unionByName(before)
        return {
            "trend": (closed, "window_end"),
            "pollution": (points.trend_points(closed, "window_end"), "ts"),
            "late_observations": (late, None),
            "area_count": (alerts.update_messages(areas.area_count_updates(flagged, before)), None),
            "carried_area_total": (counts.groupBy("area").agg(F.sum("count").alias("count")), None),
        }

    def stage(trigger: dict | None = None) -> StreamingQuery:
        found = trend_and_late(observations.withWatermark("ts", windows.grace), windows)
        return several_tables(found, tables, root, _checkpoint(root, "trend"), trigger)

    return stage


def trend_stages(
    observations: DataFrame, root: str, windows: Windows = Windows()
) -> dict[str, Stage]:
    """Pipeline B on a stream of keyed observations, or of decoded messages with their ``ok`` flag."""
    spark = prepare(observations.sparkSession)
    rows = _table_stream(spark, f"{root}/observations", observations.drop("ok", "value").schema)
    first = decoded_stage if "ok" in observations.columns else landed_stage
    return {
        "observations": first(observations, root, "observations", {"pollutionRaw": lambda r: points.raw(r, "ts")}),
        "trend": trend_stage(rows, root, windows),
    }


def store_stage(text: DataFrame, root: str) -> Stage:
    """The store job: wire C text to a table of payloads, bad messages to a table of their own."""
    prepare(text.sparkSession)
    return decoded_stage(
        decode.mark_store(text.drop("ts")), root, "store_readings", bad="bad_store_records",
    )


def payload_stage(spark: SparkSession, root: str, url: str, table: str, **options: str) -> Stage:
    """The payloads of the store job to a column of a database table, at least once."""
    schema = "seq BIGINT, id STRING, ts STRING, pm2 STRING"

    def stage(trigger: dict | None = None) -> StreamingQuery:
        rows = records.store_payload(_table_stream(spark, f"{root}/store_readings", schema))
        writer = rows.writeStream.option("checkpointLocation", _checkpoint(root, "payload"))
        return writer.foreachBatch(jdbc_writer(url, table, **options)).trigger(**(trigger or {"availableNow": True})).start()

    return stage


def topic_stages(root: str, spark: SparkSession, servers: str, trend_topic: str, count_topic: str) -> dict[str, Stage]:
    """Publish the trend records and every running count (needs the Kafka package on the class path)."""

    def publish(table: str, schema: str, encode: Callable[[DataFrame], DataFrame], topic: str, name: str) -> Stage:
        def stage(trigger: dict | None = None) -> StreamingQuery:
            rows = encode(_table_stream(spark, f"{root}/{table}", schema))
            return kafka_topic(rows, servers, topic, _checkpoint(root, name), "append", trigger)

        return stage

    return {
        "trend_topic": publish("trend", TREND_SCHEMA, records.encode_trend, trend_topic, "trend_topic"),
        "count_topic": publish("area_count", COUNT_SCHEMA, records.encode_counts, count_topic, "count_topic"),
    }


def map_layer(spark: SparkSession, root: str, number_of_areas: int = MAP_AREAS) -> DataFrame:
    """The area layer of the map, from the points and the sensors that the detection job has written."""
    read = lambda name, schema: spark.read.schema(schema).parquet(f"{root}/{name}")
    areas_of = read("areas", "measurement STRING, ts TIMESTAMP, area STRING, tooHigh BIGINT")
    return maps.area_layer(areas_of, read("sensor_ids", "id STRING, ts TIMESTAMP"), number_of_areas)


def run_available(stages: dict[str, Stage]) -> None:
    """Run the stages one after the other over the data that is there now."""
    for stage in stages.values():
        stage({"availableNow": True}).awaitTermination()


def start(stages: dict[str, Stage], every: str = "1 second") -> list[StreamingQuery]:
    """Start all stages side by side."""
    return [stage({"processingTime": every}) for stage in stages.values()]
