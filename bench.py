"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
data and cores. Each query runs once to warm up, then the best of three counts.
Batch results go to the ``noop`` sink, so all columns are computed.

``python bench.py --events 10000000`` times the operators over so many events instead, made from the table by
repeating it with other sensors, and once more with a third of all rows from one sensor.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from smogline.operators import areas, sensor_windows, trend
from smogline.plans import catalog
from smogline.session import prepare, scratch_path
from smogline.sources.events import events, events_stream, observations, readings
from smogline.streaming import jobs

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = 3

HEADLINE = [
    "decode_positional", "decode_json", "sensor_window_sliding", "sensor_rise", "area_trend",
    "alert_messages", "trend_window", "trend_fold", "trend_points", "area_running_count",
    "points_pollution", "points_time_range", "map_sensor_layer", "map_area_layer", "encode_trend_json",
]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def best(run) -> float:
    run()
    times = []
    for _ in range(REPEATS):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return min(times)


def stream_rate(spark: SparkSession, name: str) -> tuple[float, float, int]:
    """Seconds, rows per second and state rows of the sensor-window or trend stage over all events."""
    source, root = events_stream(spark, SF_DIR), scratch_path(spark, "bench")
    if name == "trend":
        stage = jobs.trend_stage(observations(source), root, catalog.DAYS)
    else:
        stage = jobs.window_stage(readings(source), root, catalog.DAYS)
    start = time.perf_counter()
    query = stage({"availableNow": True})
    query.awaitTermination()
    seconds = time.perf_counter() - start
    progress = query.recentProgress
    rows = sum(p["numInputRows"] for p in progress)
    state = max(op["numRowsTotal"] for p in progress for op in p["stateOperators"])
    return seconds, rows / seconds, state


def main() -> None:
    spark = session()
    queries = {}
    for name in HEADLINE:
        query = catalog.QUERIES[name]
        queries[name] = round(
            best(lambda: query(spark, SF_DIR).write.format("noop").mode("overwrite").save()), 3
        )
    rows = catalog.events(spark, SF_DIR).count()
    rates = {}
    for name in ("sensor_window", "trend"):
        stream_rate(spark, name)
        seconds, rate, state = stream_rate(spark, name)
        queries[f"{name}_stage"] = round(seconds, 3)
        rates[name] = round(rate)
        if name == "sensor_window":
            state_rows = state
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": SF_DIR.rsplit("sf", 1)[-1].strip("/"),
        "cpus": int(CPUS),
        "events": rows,
        "decode_rows_per_sec": round(rows / queries["decode_positional"]),
        "stream_rows_per_sec": rates["sensor_window"],
        "trend_stream_rows_per_sec": rates["trend"],
        "stream_state_rows": state_rows,
    }))
    spark.stop()


def large(count: int) -> None:
    spark = session()
    table = events(spark, SF_DIR)
    copies = max(1, count // table.count())
    many = table.crossJoin(F.broadcast(spark.range(copies).withColumnRenamed("id", "copy"))).select(
        (F.col("event_id") * copies + F.col("copy")).alias("event_id"), "ts",
        (F.col("user_id") + F.col("copy") * 10_000).alias("user_id"), "event_type", "value", "props",
    )
    found = {}
    for form in ("even", "one_sensor_a_third"):
        rows = many if form == "even" else many.withColumn(
            "user_id", F.when(F.col("event_id") % 3 == 0, F.lit(1)).otherwise(F.col("user_id")))
        path = scratch_path(spark, form)
        rows.repartition(16).write.parquet(f"{path}/events.parquet")
        obs, read = observations(events(spark, path)), readings(events(spark, path))
        windows = sensor_windows.sensor_windows(read, catalog.DAYS)
        found[form] = {}
        for name, frame in {
            "sensor_statistics": sensor_windows.sensor_statistics(read, catalog.DAYS), "sensor_windows": windows,
            "area_trend": areas.area_trend(windows, catalog.DAYS), "trend_statistics": trend.trend_statistics(obs, catalog.DAYS),
            "trend_fold": trend.trend_fold(obs, catalog.DAYS), "trend": trend.trend(obs, catalog.DAYS),
        }.items():
            start = time.perf_counter()
            frame.write.format("noop").mode("overwrite").save()
            found[form][name] = round(time.perf_counter() - start, 1)
    print(json.dumps({"events": copies * table.count(), "seconds": found}))
    spark.stop()


if __name__ == "__main__":
    if "--events" in sys.argv:
        large(int(sys.argv[sys.argv.index("--events") + 1]))
    else:
        main()
