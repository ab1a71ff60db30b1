"""Streaming forms: late data, restart, batch = stream, sources."""

import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F

from smogline.functions import decode
from smogline.operators import alerts, maps, points
from smogline.operators.areas import area_count_updates, area_trend
from smogline.operators.sensor_windows import sensor_flags, sensor_windows
from smogline.operators.trend import too_high, trend
from smogline.params import Windows
from smogline.plans import streams as plan_streams
from smogline.sources import streams
from smogline.sources.events import events, observations, readings, wire_a, wire_b
from smogline.streaming import jobs, ranges, stateful, store
from smogline.streaming.sinks import append_table, batch_table, jdbc_writer, table_of

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
DAYS = Windows("10 days", "5 days", "60 hours", "2 days", "1 day", "1 day")


class Landing:
    """A folder of record files; files are taken up in the order they were landed."""

    def __init__(self, spark, path):
        self.spark, self.path, self.number = spark, str(path), 0

    def land(self, frame):
        """``frame``: key, value, ts, seq."""
        target = os.path.join(self.path, f"part{self.number:04d}")
        frame.withColumnRenamed("ts", "timestamp").coalesce(1).write.parquet(target)
        for name in os.listdir(target):
            os.utime(os.path.join(target, name), (1_700_000_000 + self.number,) * 2)
        self.number += 1

    def stream(self, files=1):
        return streams.file_records(self.spark, f"{self.path}/part*", files_per_trigger=files)


def message(spark, *seconds, pm2=None):
    rows = [('{"sensor":1}', f'{{"sensorId":"1","lon":3,"lat":4,"pm2":{s if pm2 is None else pm2}}}',
             START + dt.timedelta(seconds=s), int(s * 10)) for s in seconds]
    return spark.createDataFrame(rows, "key string, value string, ts timestamp, seq long")


def test_late_rows(spark, tmp_path):
    landing = Landing(spark, tmp_path / "in")
    os.makedirs(landing.path)
    for seconds in ([0, 30, 59], [65], [58], [69], [50], [71], [57], [200]):
        # run up to each file: a window closes in the batch after the one that moved the watermark
        landing.land(message(spark, *seconds))
        jobs.run_available(jobs.trend_stages(decode.decode_json(landing.stream()), str(tmp_path / "out")))
    rows = table_of(spark, str(tmp_path / "out/trend")).orderBy("window_start").collect()
    # 58 came within the grace, 50 before the watermark (59) but into an open window, 57 after it had closed
    assert [(r.countUsecase, r.sumPm2) for r in rows] == [(5, 197.0), (3, 205.0)]
    assert rows[0].area == "Area [0, 0]" and rows[0].tooHigh
    late = table_of(spark, str(tmp_path / "out/late_observations")).collect()
    assert [(r.key, r.seq) for r in late] == [('{"sensor":1}', 570)]


def test_a_late_row_counts_when_it_comes(spark, tmp_path):
    landing = Landing(spark, tmp_path / "in")
    os.makedirs(landing.path)
    for seconds in ([10], [30], [20], [200]):
        landing.land(message(spark, *seconds))
    stage = jobs.trend_stage(decode.decode_json(landing.stream()), str(tmp_path / "out"))
    jobs.run_available({"trend": stage})
    arrived = table_of(spark, str(tmp_path / "out/trend")).first().pair
    assert (arrived.first, arrived.second) == (10.0, 20.0)  # 10, 30, 20


def test_windows_of_a_sensor_take_late_rows_in_while_they_are_open(spark, tmp_path):
    """60 s every 30 s; a late row counts in the open ones of its windows only."""
    landing = Landing(spark, tmp_path / "in")
    os.makedirs(landing.path)
    for seconds in ([0, 31, 40], [61], [35, 5], [150], [20, 62], [400]):
        landing.land(message(spark, *seconds))
    rows = decode.decode_json(landing.stream()).selectExpr(
        "sensorId AS id", "pm2", "temperature AS tempC", "double(humidity) AS humidity", "'(0,0)' AS area",
        "string(lat) AS lat", "string(lon) AS lon", "ts", "seq")
    jobs.run_available({"w": jobs.window_stage(rows, str(tmp_path / "out"))})
    found = table_of(spark, str(tmp_path / "out/sensor_window")).orderBy("window_start").collect()
    starts = [int((r.window_start.replace(tzinfo=dt.timezone.utc) - START).total_seconds()) for r in found]
    # 35 came after 61: its window from 0 had closed, that from 30 had not
    assert list(zip(starts, [r.elementsInWindow for r in found], [r.sumPM2 for r in found])) == [
        (-30, 1, 0.0), (0, 3, 71.0), (30, 4, 167.0), (60, 1, 61.0), (120, 1, 150.0), (150, 1, 150.0)]
    late = table_of(spark, str(tmp_path / "out/late_readings")).orderBy("seq").collect()
    assert [r.seq for r in late] == [50, 200, 620]
    assert [r.pm2tooHigh for r in found] == [False, True, True, False, False, False]


def closed(frame, column, limit):
    return frame.filter(F.col(column) <= F.lit(limit))


def rows_of(frame, *drop):
    frame = frame.drop("date", *drop)
    rounded = {c: F.round(c, 6) for c, t in frame.dtypes if t == "double"}
    return sorted(map(str, frame.withColumns(rounded).select(*sorted(frame.columns)).collect()))


@pytest.fixture(scope="module")
def landed(spark, small, tmp_path_factory):
    """The events as wire B records in six files, each a few days long, and one file as wire A text."""
    landing = Landing(spark, tmp_path_factory.mktemp("landed"))
    rows = observations(events(spark, small))
    for day in range(0, 30, 5):
        landing.land(wire_b(rows).filter(
            (F.dayofmonth("ts") > day) & (F.dayofmonth("ts") <= day + 5)))
    return landing


def last_closed(spark, small):
    return events(spark, small).agg(F.max("ts")).first()[0] - dt.timedelta(days=1)


def test_trend_job_equals_batch(spark, small, landed, tmp_path):
    root = str(tmp_path)
    jobs.run_available(jobs.trend_stages(decode.decode_json(landed.stream()), root, DAYS))
    batch = closed(trend(observations(events(spark, small)), DAYS), "window_end", last_closed(spark, small))
    assert rows_of(table_of(spark, f"{root}/trend")) == rows_of(batch)
    counts = table_of(spark, f"{root}/area_count")
    assert rows_of(counts) == rows_of(alerts.update_messages(area_count_updates(too_high(batch))))
    assert table_of(spark, f"{root}/pollutionRaw").count() == 1000
    flat = table_of(spark, f"{root}/pollution")
    assert flat.count() == batch.count() and "pair" not in flat.columns


def test_the_named_store_holds_the_open_windows(spark, small, landed, tmp_path):
    root = str(tmp_path)
    jobs.run_available(jobs.trend_stages(decode.decode_json(landed.stream()), root, DAYS))
    checkpoint = f"{root}/_checkpoints/trend"
    named = store.stores(spark, checkpoint).collect()
    assert {r.operatorName for r in named} == {"transformWithStateInPySparkExec"}
    whole = trend(observations(events(spark, small)), DAYS)
    still = whole.filter(F.col("window_end") > F.lit(last_closed(spark, small)))
    assert rows_of(store.open_trends(spark, checkpoint)) == rows_of(still) != []


def detection_source(spark, small, tmp_path, damage=False):
    """The events as wire A text in two files; every tenth message is cut short if they are damaged."""
    landing = Landing(spark, tmp_path / "in")
    os.makedirs(landing.path)
    rows = wire_a(observations(events(spark, small)))
    if damage:
        rows = rows.withColumn("value", F.when(F.col("seq") % 10 == 3, F.left("value", F.lit(30))).otherwise(F.col("value")))
    return landing, [rows.filter((F.dayofmonth("ts") > first) & (F.dayofmonth("ts") <= last)) for first, last in ((0, 12), (12, 31))]


def test_detection_job_equals_batch(spark, small, tmp_path):
    """From wire A text to points, windows, area results, alerts and the map; decoded once, one window state."""
    landing, files = detection_source(spark, small, tmp_path)
    for file in files:
        landing.land(file)
    source = decode.decode_positional(landing.stream()).drop("key")
    root = str(tmp_path / "out")
    jobs.run_available(jobs.detection_stages(source, root, DAYS, sensors=640))
    last = last_closed(spark, small)
    expected = readings(events(spark, small))
    windows = closed(sensor_windows(expected, DAYS), "window_end", last)
    areas = closed(area_trend(windows, DAYS), "window_end", last)
    read = lambda name: table_of(spark, f"{root}/{name}")
    assert read("Pollution").count() == 1000
    assert rows_of(read("sensor_window")) == rows_of(windows)
    assert rows_of(read("sensor_flag")) == rows_of(sensor_flags(windows).select("id", "window_end", "flag", "area"))
    assert rows_of(read("area_trend")) == rows_of(areas)
    for name, table in (("SensorData", windows), ("sensors", windows), ("AreaTrend", areas), ("areas", areas)):
        assert read(name).count() == table.count()
        assert read(name).filter("ts IS NULL").count() == 0
    assert rows_of(read("alerts")) == rows_of(alerts.area_messages(areas, alerts.BOTH, 640))
    assert rows_of(jobs.map_layer(spark, root)) == rows_of(maps.area_layer(points.map_areas(areas, "window_end"), expected))
    assert len(os.listdir(f"{root}/_checkpoints")) == 3


def test_panes_hold_each_row_once(spark, small, tmp_path):
    landing, files = detection_source(spark, small, tmp_path)
    landing.land(files[0])
    source = decode.decode_positional(landing.stream()).drop("key")
    jobs.run_available({"w": jobs.window_stage(source, str(tmp_path / "out"), DAYS)})
    panes = store.open_panes(spark, f"{tmp_path}/out/_checkpoints/sensor_window")
    rows = readings(events(spark, small)).filter("dayofmonth(ts) <= 12")
    mark = rows.agg(F.max("ts") - F.expr("INTERVAL 1 DAY")).first()[0]
    last_end = F.timestamp_seconds(F.expr("unix_seconds(ts) div 432000 * 432000 + 864000"))
    held = panes.agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes")).first()
    assert held.rows == rows.filter(last_end > F.lit(mark)).count() > 0 and held.bytes == 24 * held.rows


def test_good_and_bad_rows_are_all_rows(spark, small, tmp_path):
    """Bad messages neither stop a job nor vanish, also over a restart."""
    landing, files = detection_source(spark, small, tmp_path, damage=True)
    root = str(tmp_path / "out")
    for file in files:
        landing.land(file)
        marked = decode.mark_positional(landing.stream()).drop("key")
        jobs.run_available(jobs.detection_stages(marked, root, DAYS))
    good, bad = table_of(spark, f"{root}/readings"), table_of(spark, f"{root}/bad_records")
    assert (good.count(), bad.count()) == (900, 100)
    assert bad.filter("seq % 10 <> 3 OR length(value) <> 30 OR ts IS NULL").count() == 0
    expected = readings(events(spark, small)).filter("seq % 10 <> 3")
    windows = closed(sensor_windows(expected, DAYS), "window_end", expected.agg(F.max("ts")).first()[0] - dt.timedelta(days=1))
    assert rows_of(table_of(spark, f"{root}/sensor_window")) == rows_of(windows)


def test_restart_goes_on_from_the_checkpoint(spark, small, tmp_path):
    landing = Landing(spark, tmp_path / "in")
    os.makedirs(landing.path)
    rows = wire_b(observations(events(spark, small)))
    once, twice = str(tmp_path / "once"), str(tmp_path / "twice")

    def run(root):
        jobs.run_available(jobs.trend_stages(decode.decode_json(landing.stream()), root, DAYS))

    landing.land(rows.filter("dayofmonth(ts) <= 13"))
    run(twice)
    before = table_of(spark, f"{twice}/trend").count()
    landing.land(rows.filter("dayofmonth(ts) > 13 and dayofmonth(ts) <= 20"))
    landing.land(rows.filter("dayofmonth(ts) > 20"))
    run(twice)
    run(once)
    after = table_of(spark, f"{twice}/trend")
    assert 0 < before < after.count()
    for name in ("trend", "area_count"):
        assert rows_of(table_of(spark, f"{twice}/{name}")) == rows_of(table_of(spark, f"{once}/{name}"))


def test_a_repeated_batch_writes_what_is_missing(spark, small, tmp_path):
    """Fail after some tables of a batch have been written: the rest is written, nothing twice."""
    landing, files = detection_source(spark, small, tmp_path)
    root = str(tmp_path / "out")
    checkpoint = f"{root}/_checkpoints/sensor_window"

    def run():
        source = decode.decode_positional(landing.stream()).drop("key")
        jobs.run_available({"w": jobs.window_stage(source, root, DAYS)})

    landing.land(files[0])
    run()
    tables = ("sensor_window", "area_trend", "carried_area_open", "alerts")
    before = {name: rows_of(table_of(spark, f"{root}/{name}")) for name in tables}
    last = max(int(n) for n in os.listdir(f"{checkpoint}/commits") if n.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        path = f"{checkpoint}/commits/{name}"
        if os.path.exists(path):
            os.remove(path)
    for name in ("area_trend", "alerts"):
        (folder,) = [d for d in os.listdir(f"{root}/{name}") if d.endswith(f"-{last:09d}")]
        shutil.rmtree(f"{root}/{name}/{folder}")
    run()
    assert {name: rows_of(table_of(spark, f"{root}/{name}")) for name in tables} == before
    assert before["alerts"] and not [n for n in os.listdir(f"{root}/_staging/alerts") if n.startswith("part")]


def test_open_area_windows_are_carried(spark, tmp_path):
    """Area windows longer than the slide: their sensor windows come out in several batches."""
    windows = Windows("60 seconds", "30 seconds", "120 seconds")
    landing = Landing(spark, tmp_path / "in")
    os.makedirs(landing.path)
    spans = ([1, 20, 45, 55], [65, 70, 100], [130, 170], [200, 201], [300], [500])
    for seconds in spans:
        landing.land(reading_rows(spark, *seconds).drop("date").withColumn("seq", F.unix_seconds("ts")).coalesce(1))
    schema = reading_rows(spark, 1).drop("date").withColumnRenamed("ts", "timestamp").schema
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{landing.path}/part*").withColumnRenamed("timestamp", "ts")
    jobs.run_available({"w": jobs.window_stage(source, str(tmp_path / "out"), windows)})
    rows = reading_rows(spark, *[s for span in spans for s in span]).drop("date").withColumn("seq", F.unix_seconds("ts"))
    mark = START + dt.timedelta(seconds=500)
    want = closed(area_trend(closed(sensor_windows(rows, windows), "window_end", mark), windows), "window_end", mark)
    assert rows_of(table_of(spark, str(tmp_path / "out/area_trend"))) == rows_of(want) != []


def test_batch_table_overwrites_a_repeated_batch(spark, tmp_path):
    landing = Landing(spark, tmp_path / "in")
    os.makedirs(landing.path)
    landing.land(message(spark, 1, 2, 3))
    path = str(tmp_path / "table")
    for checkpoint in ("a", "b"):  # the second run repeats batch 0
        batch_table(landing.stream(), path, str(tmp_path / checkpoint), "append").awaitTermination()
    assert spark.read.parquet(path).count() == 3


def test_text_files_as_source(spark, small, tmp_path):
    """Lines keep the order of their file, also where a file is read in blocks."""
    rows = wire_a(observations(events(spark, small)))
    for number, part in enumerate(("seq < 700", "seq >= 700")):
        rows.filter(part).orderBy("seq").select("value").coalesce(1).write.text(str(tmp_path / f"in/{number}"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        source = decode.decode_positional(streams.file_text(spark, str(tmp_path / "in/*")))
        append_table(source, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    written = spark.read.parquet(str(tmp_path / "out"))
    expected = readings(events(spark, small))
    columns = ["id", "pm2", "area", "lat", "lon", "tempC", "humidity"]
    assert rows_of(written.select(columns)) == rows_of(expected.select(columns))
    assert written.select("ts", "seq").distinct().count() == 1000
    values = lambda frame, *order: [r.pm2 for r in frame.orderBy(*order).collect()]
    assert values(written, "ts", "seq") == values(expected, "seq")
    # rise and trend over lines are those over records in the same order
    records = expected.withColumn("ts", F.lit(START))
    long = Windows("1 day", "1 day", trend="1 day")
    flags = lambda frame: rows_of(sensor_windows(frame.withColumn("ts", F.lit(START)), long))
    first = written.filter(f"seq >> 40 = {written.orderBy('ts', 'seq').first().seq >> 40}")
    assert first.count() == 700 and flags(first) == flags(records.filter("seq < 700"))
    keyed = lambda frame: frame.selectExpr(
        "id AS key", "id AS sensorId", "'p' AS measurement", "int(lon) AS lon", "int(lat) AS lat", "tempC AS temperature",
        "int(humidity) AS humidity", "pm2", "seq").withColumn("ts", F.lit(START))
    assert rows_of(trend(keyed(first), long)) == rows_of(trend(keyed(expected.filter("seq < 700")), long))


def test_json_files_as_source(spark, tmp_path):
    message(spark, 1, 2).withColumnRenamed("ts", "timestamp").write.json(str(tmp_path / "in"))
    source = streams.file_records(spark, str(tmp_path / "in"), "json")
    append_table(source, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert rows_of(spark.read.parquet(str(tmp_path / "out"))) == rows_of(message(spark, 1, 2))


def test_kafka_frame_contract(spark):
    """No Kafka package here: only the shape of its frame can be checked."""
    frame = spark.createDataFrame(
        [(bytearray(b'{"sensor":1}'), bytearray(b"{}"), "t", 0, 17, START, 0),
         (None, bytearray(b"{}"), "t", 3, 17, START, 0)],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int")
    shaped = streams.from_kafka_frame(frame)
    assert shaped.dtypes == [("key", "string"), ("value", "string"), ("ts", "timestamp"), ("seq", "bigint")]
    assert [(r.key, r.seq) for r in shaped.orderBy("seq").collect()] == [
        ('{"sensor":1}', 17), (None, 3 * 2**48 + 17)]  # the same offset of two partitions


def test_jdbc_writer_needs_the_payload_column(spark):
    with pytest.raises(Exception, match="payload"):
        jdbc_writer("jdbc:none", "t")(spark.range(1), 0)


def test_ranges_of_a_landed_table_equal_batch(spark, small, landed, tmp_path):
    """Two ranges one after the other give what the batch operators give over all rows."""
    root = str(tmp_path)
    ranges.land(decode.decode_json(landed.stream()).select("*"), f"{root}/rows", f"{root}/cp").awaitTermination()
    table = spark.read.parquet(f"{root}/rows")
    rows = observations(events(spark, small))
    last = rows.agg(F.max("ts")).first()[0]
    middle = last - dt.timedelta(days=11)
    parts = [ranges.trend_of(table, None, middle, DAYS), ranges.trend_of(table, middle, last, DAYS)]
    assert all(p.count() for p in parts)
    assert rows_of(parts[0].union(parts[1])) == rows_of(closed(trend(rows, DAYS), "window_end", last))
    assert "PartitionFilters: [isnotnull(date" in parts[1]._jdf.queryExecution().executedPlan().toString()


def reading_rows(spark, *seconds):
    rows = [(s % 2 * 20.0 + s, "(0,0)", "1", "1", START + dt.timedelta(seconds=s), i) for i, s in enumerate(seconds)]
    frame = spark.createDataFrame(rows, "pm2 double, area string, lat string, lon string, ts timestamp, seq long")
    return frame.selectExpr("'s' as id", "*", "1.0D as tempC", "1.0D as humidity", "to_date(ts) as date")


@pytest.mark.parametrize("windows", [Windows("50 seconds", "20 seconds", "20 seconds"), Windows("60 seconds", "30 seconds", "120 seconds")])
def test_area_results_are_sums_of_emitted_windows(spark, windows):
    """Window ends that are no multiple of the slide, and a row that comes after others of its window."""
    table = reading_rows(spark, 1, 45, 55, 65, 70, 55, 200, 201, 300)
    ends = [START + dt.timedelta(seconds=s) for s in (50, 60, 110, 260)]
    emitted = None
    for lower, upper in zip([None, *ends], ends):
        part = ranges.sensor_windows_of(table, lower, upper, windows)
        emitted = part if emitted is None else emitted.union(part)
    whole = closed(sensor_windows(table.drop("date"), windows), "window_end", ends[-1])
    assert rows_of(emitted) == rows_of(whole)
    found = ranges.area_trend_of(emitted, None, START + dt.timedelta(seconds=1000), windows)
    flags = emitted.agg(F.sum(F.col("pm2tooHigh").cast("int"))).first()[0]
    assert found.agg(F.sum("sensorsReportingTrend")).first()[0] == flags


def test_kafka_is_asked_for(spark, tmp_path):
    """Without its package Spark can only say that it does not know the source and the sink."""
    with pytest.raises(Exception, match="(?i)kafka"):
        streams.kafka_keyed(spark, "localhost:9092", "t")
    empty = spark.createDataFrame([], jobs.TREND_SCHEMA)
    empty.write.parquet(str(tmp_path / "trend"))
    for stage in jobs.topic_stages(str(tmp_path), spark, "localhost:9092", "a", "b").values():
        with pytest.raises(Exception, match="(?i)kafka"):
            stage()


def test_many_keys_share_a_state_value(spark, tmp_path, monkeypatch):
    """Seven keys in three groups: one state value a group, and every key has its own windows and late rows."""
    monkeypatch.setattr(stateful, "BUCKETS", 3)
    monkeypatch.setattr(stateful, "LATE_ROWS", 2)
    landing = Landing(spark, tmp_path / "in")
    os.makedirs(landing.path)

    def land(second):
        rows = [(f"k{k}", f'{{"sensorId":"{k}","lon":3,"lat":4,"pm2":{k + second}}}',
                 START + dt.timedelta(seconds=second), 1000 * k + second) for k in range(7)]
        landing.land(spark.createDataFrame(rows, "key string, value string, ts timestamp, seq long"))

    for second in (10, 200, 20, 210):  # the rows of 20 come after their window has closed
        land(second)
    stage = jobs.trend_stage(decode.decode_json(landing.stream()), str(tmp_path / "out"))
    jobs.run_available({"trend": stage})
    closed = table_of(spark, f"{tmp_path}/out/trend").orderBy("key").collect()
    assert [(r.key, r.countUsecase, r.sumPm2) for r in closed] == [(f"k{k}", 1, k + 10.0) for k in range(7)]
    late = table_of(spark, f"{tmp_path}/out/late_observations").orderBy("key").collect()
    assert [(r.key, r.ts, r.seq) for r in late] == [
        (f"k{k}", (START + dt.timedelta(seconds=20)).replace(tzinfo=None), 1000 * k + 20) for k in range(7)]
    checkpoint = f"{tmp_path}/out/_checkpoints/trend"
    assert store.store(spark, checkpoint, stateful.OPEN).count() <= 3
    still = store.open_trends(spark, checkpoint).orderBy("key").collect()
    assert [(r.key, r.countUsecase, r.sumPm2) for r in still] == [(f"k{k}", 2, 2 * k + 410.0) for k in range(7)]


def test_one_file_is_written_from_parts_sorted_apart(spark):
    rows = spark.range(0, 2000, 1, 5).selectExpr("id * 7919 % 2000 AS seq", "cast(id AS string) AS value")
    parts = plan_streams.sorted_parts(rows, "seq")
    assert parts.storageLevel.useDisk and not parts.storageLevel.useMemory
    assert "InMemoryTableScan" in parts.coalesce(1)._jdf.queryExecution().executedPlan().toString()
    assert [r.seq for r in parts.coalesce(1).collect()] == list(range(2000))
    parts.unpersist()
