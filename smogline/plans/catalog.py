"""The registered queries: every operator over the whole ``events`` table.

Events arrive about twice a day per user, so the windows are days, not seconds.
Doubles that were added up are rounded, as the order of addition is not fixed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogline.functions import decode
from smogline.functions.grid import block_area, grid_area
from smogline.functions.scalars import fahrenheit
from smogline.operators import alerts, areas, maps, points, records
from smogline.operators import sensor_windows as sw
from smogline.operators import trend as tr
from smogline.params import Windows
from smogline.plans import streams
from smogline.session import prepare
from smogline.sources.events import events, observations, readings, wire_a, wire_b, wire_c

DAYS = Windows(size="10 days", slide="5 days", area="60 hours", trend="2 days", grace="1 day",
               delay="1 day")
ALARM_SENSORS = 640
LATE_FILES = 6
PLACES = 7


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, PLACES) for name in names})


def _observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(events(prepare(spark), sf_dir))


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(events(prepare(spark), sf_dir))


def _sensor_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sw.sensor_windows(_readings(spark, sf_dir), DAYS)


def _area_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = sw.sensor_windows(_readings(spark, sf_dir), DAYS, carry=())
    return areas.area_trend(flags, DAYS)


def _trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.trend(_observations(spark, sf_dir), DAYS)


# decoding -------------------------------------------------------------------

def decode_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = wire_a(_observations(spark, sf_dir)).select("value", "seq")
    return decode.decode_positional(text)


def decode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third message has its humidity quoted, every fifth lacks the temperature."""
    rows = _observations(spark, sf_dir)
    bare = F.to_json(F.struct("sensorId", "lon", "lat", "temperature", "humidity", "pm2", "measurement"))
    quoted = F.to_json(F.struct(
        "sensorId", "lon", "lat", "temperature", F.col("humidity").cast("string").alias("humidity"),
        "pm2", "measurement"))
    partial = F.to_json(F.struct("sensorId", "lon", "lat", "humidity", "pm2", "measurement"))
    value = F.when(F.col("seq") % 5 == 0, partial).when(F.col("seq") % 3 == 0, quoted).otherwise(bare)
    return decode.decode_json(rows.select("key", value.alias("value"), "seq"))


def decode_store_reading(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.decode_store(wire_c(_observations(spark, sf_dir)))


def damaged(wire: DataFrame) -> DataFrame:
    """Four of ten messages damaged in different ways, chosen by arrival number."""
    kind = F.col("seq") % 10
    value = F.col("value")
    return wire.withColumn(
        "value",
        F.when(kind == 3, F.regexp_replace(value, '"lat": ([0-9]+)', '"lat": $1.0'))
        .when(kind == 5, F.regexp_replace(value, '"pm2": .*', '"pm2": abc}'))
        .when(kind == 7, F.substring_index(value, ",", 4))
        .when(kind == 9, F.lit(""))
        .otherwise(value),
    )


def bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = damaged(wire_a(_observations(spark, sf_dir)).select("value", "seq"))
    return decode.quarantine(decode.mark_positional(text), "seq")


def good_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = damaged(wire_a(_observations(spark, sf_dir)).select("value", "seq"))
    return decode.decode_positional(text, mode=decode.SKIP)


def damaged_json(wire: DataFrame) -> DataFrame:
    value = F.col("value")
    text = F.when(F.col("seq") % 7 == 0, F.left(value, F.lit(20))).when(
        F.col("seq") % 9 == 0, F.regexp_replace(value, '"lon":([0-9]+)', '"lon":$1.5')
    ).otherwise(value)
    return wire.withColumn("value", text)


def damaged_store(wire: DataFrame) -> DataFrame:
    short = F.substring_index("value", ",", 4)
    return wire.withColumn("value", F.when(F.col("seq") % 10 == 7, short).otherwise(F.col("value")))


def bad_json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh message cut short, every ninth with a fraction in a whole number."""
    marked = decode.mark_json(damaged_json(wire_b(_observations(spark, sf_dir)).select("key", "value", "seq")))
    return decode.quarantine(marked, "seq")


def bad_store_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.quarantine(decode.mark_store(damaged_store(wire_c(_observations(spark, sf_dir)))), "seq")


# projections ----------------------------------------------------------------

def area_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _observations(spark, sf_dir).select(
        "seq", "lat", "lon", grid_area(F.col("lat"), F.col("lon")).alias("area")
    )


def area_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _observations(spark, sf_dir).select(
        "seq", "lat", "lon", block_area(F.col("lon"), F.col("lat")).alias("area")
    )


def temp_fahrenheit(spark: SparkSession, sf_dir: str) -> DataFrame:
    celsius = F.col("temperature")
    return _observations(spark, sf_dir).select(
        "seq", celsius.alias("tempC"), F.round(fahrenheit(celsius), PLACES).alias("tempF")
    )


# pipeline A -----------------------------------------------------------------

def sensor_window_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(sw.sensor_statistics(_readings(spark, sf_dir), DAYS), "avgPM2", "sumPM2", "tempF")


def sensor_rise(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = _sensor_windows(spark, sf_dir).drop("lat", "lon")
    return rounded(result, "avgPM2", "sumPM2", "tempF")


def sensor_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sw.sensor_flags(_sensor_windows(spark, sf_dir)).select("id", "window_end", "flag", "area")


def area_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _area_trend(spark, sf_dir)


def area_alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.area_alarms(_area_trend(spark, sf_dir), ALARM_SENSORS)


def alert_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.area_messages(_area_trend(spark, sf_dir), alerts.BOTH, ALARM_SENSORS)


def alert_messages_above(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.area_messages(_area_trend(spark, sf_dir), alerts.ABOVE_ONLY, ALARM_SENSORS)


# pipeline B -----------------------------------------------------------------

def trend_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = tr.trend_statistics(_observations(spark, sf_dir), DAYS)
    return rounded(result, "avgPm2", "sumPm2", "temperatureFMax")


def _flat_pair(df: DataFrame) -> DataFrame:
    differences = {f"pair_{c}": F.round(F.col(f"pair.{c}"), PLACES) for c in ("first", "second", "third")}
    return df.withColumns(differences).drop("pair")


def trend_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_pair(tr.trend_fold(_observations(spark, sf_dir), DAYS))


def trend_too_high(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tr.too_high(_trend(spark, sf_dir)), "avgPm2").select(
        "key", "window_start", "window_end", "area", "tooHighCount", "avgPm2"
    )


def area_running_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return areas.area_running_count(tr.too_high(_trend(spark, sf_dir)))


def alert_messages_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.update_messages(areas.area_count_updates(tr.too_high(_trend(spark, sf_dir))))


def encode_trend_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """To the topic and back, as the text of a double differs between engines."""
    back = records.decode_trend(records.encode_trend(_trend(spark, sf_dir)))
    return rounded(_flat_pair(back), "avgPm2", "sumPm2", "temperatureFMax")


def encode_trend_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text on the topic itself; numbers as decimals of six places, which print alike everywhere."""
    trend = _trend(spark, sf_dir)
    plain = lambda c: F.round(c, 6).cast("decimal(18,6)")
    names = ("avgPm2", "sumPm2", "maxPm2", "temperatureCMax", "temperatureFMax")
    pair = F.struct(*[plain(F.col(f"pair.{c}")).alias(c) for c in ("first", "second", "third")])
    return records.encode_trend(trend.withColumns({**{c: plain(F.col(c)) for c in names}, "pair": pair}))


def encode_counts_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of the running counts as it goes to the topic."""
    return records.encode_counts(areas.area_count_updates(tr.too_high(_trend(spark, sf_dir))))


# points and payloads --------------------------------------------------------

def points_pollution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points.pollution(_readings(spark, sf_dir), "ts")


def points_pollution_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points.pollution(_readings(spark, sf_dir), "ts", with_position=False)


def points_sensor_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = points.sensor_data(_sensor_windows(spark, sf_dir), "window_end")
    return rounded(result, "avgPM2", "sumPM2", "tempF")


def points_area_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points.area_trend_points(_area_trend(spark, sf_dir), "window_end")


def points_map_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(points.map_sensors(_sensor_windows(spark, sf_dir), "window_end"), "avgPM2")


def points_map_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points.map_areas(_area_trend(spark, sf_dir), "window_end")


def raw_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points.raw(_observations(spark, sf_dir), "ts")


def trend_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = points.trend_points(_trend(spark, sf_dir), "window_end")
    return rounded(result, "avgPm2", "sumPm2", "temperatureFMax")


def store_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.store_payload(decode_store_reading(spark, sf_dir))


def points_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    pollution = points.pollution(_readings(spark, sf_dir), "ts")
    return points.in_time_range(pollution, "2024-01-08 00:00:00", "2024-01-15 00:00:00")


# map layers -----------------------------------------------------------------

def map_sensor_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    layer = maps.sensor_layer(points.map_sensors(_sensor_windows(spark, sf_dir), "window_end"))
    return rounded(layer, "avgPM2", "lat_deg", "lng_deg")


def map_layer_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The map job end to end: wire A text without temperature and humidity to markers."""
    text = wire_a(_observations(spark, sf_dir)).select("value", "ts", "seq")
    windows = sw.sensor_windows(decode.decode_positional(text, climate=False), DAYS)
    layer = maps.sensor_layer(points.map_sensors(windows, "window_end"))
    return rounded(layer, "avgPM2", "lat_deg", "lng_deg")


def map_area_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sensor with a reading has a window, so sensors are counted on the readings."""
    area_points = points.map_areas(_area_trend(spark, sf_dir), "window_end")
    layer = maps.area_layer(area_points, _readings(spark, sf_dir))
    return rounded(layer, "start_lat", "start_lng", "end_lat", "end_lng")


# streaming forms ------------------------------------------------------------

def sensor_rise_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = streams.detection_table(prepare(spark), sf_dir, DAYS, "sensor_window")
    return rounded(result.drop("lat", "lon"), "avgPM2", "sumPM2", "tempF")


def sensor_flag_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second output of the window operator, from the same state and query as the first."""
    return streams.detection_table(prepare(spark), sf_dir, DAYS, "sensor_flag")


def area_trend_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams.detection_table(prepare(spark), sf_dir, DAYS, "area_trend")


def map_area_layer_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    layer = streams.map_area_layer(prepare(spark), sf_dir, DAYS)
    return rounded(layer, "start_lat", "start_lng", "end_lat", "end_lng")


def trend_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = streams.trend_table(prepare(spark), sf_dir, DAYS, "trend")
    return rounded(_flat_pair(result), "avgPm2", "sumPm2", "temperatureFMax")


def trend_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed windows of the stream and those that its named store still holds."""
    result = streams.trend_with_open(prepare(spark), sf_dir, DAYS)
    return rounded(_flat_pair(result), "avgPm2", "sumPm2", "temperatureFMax")


def area_running_count_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last update of each area."""
    updates = streams.trend_table(prepare(spark), sf_dir, DAYS, "area_count")
    return updates.groupBy("area").agg(F.max("count").alias("count"))


def alert_messages_updates_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams.trend_table(prepare(spark), sf_dir, DAYS, "area_count")


def late_rows_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every eleventh event comes one file late, of six; did it still count?"""
    return streams.late_rows(prepare(spark), sf_dir, DAYS, F.col("seq") % 11 == 0, LATE_FILES, 1)


def bad_records_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and bad rows of a running job over damaged text."""
    text = damaged(wire_a(_observations(spark, sf_dir)).select("value", "seq"))
    return streams.split_table(spark, text, decode.mark_positional, "readings", "bad_records")


def bad_json_records_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = damaged_json(wire_b(_observations(spark, sf_dir)).select("key", "value", "seq"))
    return streams.split_table(spark, text, decode.mark_json, "observations", "bad_records")


def bad_store_records_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = damaged_store(wire_c(_observations(spark, sf_dir)))
    return streams.split_table(spark, text, decode.mark_store, "store_readings", "bad_store_records")


def rise_from_text_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wire A lines of one file, in its order; the file has one time, so a sensor has windows of all its rows."""
    lines = streams.text_lines(spark, wire_a(_observations(spark, sf_dir)))
    windows = sw.sensor_windows(decode.decode_positional(lines), Windows("1 day", "1 day"))
    return rounded(windows, "sumPM2").select("id", "elementsInWindow", "pm2tooHigh", "sumPM2", "area", "lat", "lon")


def sensor_rise_closing(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = streams.closed_table(prepare(spark), sf_dir, DAYS, "sensor_window")
    return rounded(result.drop("lat", "lon"), "avgPM2", "sumPM2", "tempF")


def area_trend_closing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams.closed_table(prepare(spark), sf_dir, DAYS, "area_trend")


def trend_closing(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = streams.closed_table(prepare(spark), sf_dir, DAYS, "trend")
    return rounded(_flat_pair(result), "avgPm2", "sumPm2", "temperatureFMax")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        decode_positional, decode_json, decode_store_reading, bad_records, good_records,
        bad_json_records, bad_store_records,
        area_grid, area_block, temp_fahrenheit,
        sensor_window_sliding, sensor_rise, sensor_flag, area_trend, area_alarms,
        alert_messages, alert_messages_above,
        trend_window, trend_fold, trend_too_high, area_running_count, alert_messages_updates,
        encode_trend_json, encode_trend_text,
        points_pollution, points_pollution_plain, points_sensor_data, points_area_trend,
        points_map_sensors, points_map_areas, raw_points, trend_points, store_payload,
        points_time_range,
        map_sensor_layer, map_layer_from_text, map_area_layer,
        encode_counts_text,
        sensor_rise_stream, sensor_flag_stream, area_trend_stream, map_area_layer_stream,
        trend_stream, trend_store, area_running_count_stream, alert_messages_updates_stream, late_rows_stream,
        bad_records_stream, bad_json_records_stream, bad_store_records_stream, rise_from_text_file,
        sensor_rise_closing, area_trend_closing, trend_closing,
    )
}
