"""Both rules against plain loops on random data, and groups that do not fit one task."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import plain
from smogline.operators.areas import area_count_updates, area_running_count
from smogline.operators.fold import fold
from smogline.operators.panes import pane_micros
from smogline.operators.rise import rise_of_sorted
from smogline.operators.sensor_windows import sensor_statistics, sensor_windows
from smogline.operators.trend import trend, trend_fold, trend_statistics
from smogline.operators.windows import micros
from smogline.params import Windows

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def random_series(rng):
    kind = rng.randrange(4)
    n = rng.randrange(1, 60)
    if kind == 0:
        return [rng.uniform(0, 60) for _ in range(n)]
    if kind == 1:  # whole steps: differences of exactly -1 come up
        return [float(rng.randrange(0, 6)) for _ in range(n)]
    if kind == 2:  # decimals: rounding decides
        return [rng.randrange(0, 50) / 10 for _ in range(n)]
    return [rng.choice([-3000.0, -1500.0, -1000.0, -999.0, -1.0, 0.0, 2.0, 5.0]) for _ in range(n)]


@pytest.fixture(scope="module")
def series():
    rng = random.Random(7)
    return [random_series(rng) for _ in range(400)]


def test_fold_on_random_series(series):
    for values in series:
        first, second, third, high, count = fold(values)
        assert (high, count, first, second, third) == plain.fold(values), values
        gaps = [x for v in values for x in (None, v, float("nan"))]
        assert fold(gaps) == fold(values) == fold(values[3:], fold(values[:3]))


def test_rise_on_random_series(spark, series):
    frame = spark.createDataFrame(list(enumerate(series)), "i int, v array<double>")
    for row in frame.select("i", rise_of_sorted(F.col("v")).alias("f")).collect():
        assert row.f is plain.rise(series[row.i])


@pytest.fixture(scope="module")
def skewed(spark):
    """Six minutes of observations; one sensor sends more than a third of them, partly at one instant."""
    rng = random.Random(11)
    rows = []
    for seq in range(6000):
        hot = seq % 5 < 2
        sensor = 0 if hot else rng.randrange(1, 40)
        at = START + dt.timedelta(milliseconds=seq * 60)
        if hot and 2000 < seq < 3000:
            at = START + dt.timedelta(seconds=150)
        rows.append((f'{{"sensor":{sensor}}}', str(sensor), sensor % 100 + 1, 2 * sensor % 100 + 1,
                     rng.randrange(-10, 30) / 2, rng.randrange(100), rng.randrange(0, 600) / 10,
                     "pollution", at, seq))
    rng.shuffle(rows)
    return spark.createDataFrame(
        rows, "key string, sensorId string, lon int, lat int, temperature double, humidity int, "
              "pm2 double, measurement string, ts timestamp, seq long"
    ).repartition(4).cache()


def as_readings(observations):
    return observations.select(
        F.col("sensorId").alias("id"), "pm2", F.concat(F.lit("("), "lat", F.lit(")")).alias("area"),
        F.col("lat").cast("string").alias("lat"), F.col("lon").cast("string").alias("lon"),
        F.col("temperature").alias("tempC"), F.col("humidity").cast("double").alias("humidity"), "ts", "seq",
    )


def windows_by_hand(observations, size, slide):
    """(sensor, window start in seconds) -> values in arrival order."""
    rows = sorted(observations.select("sensorId", "pm2", F.unix_micros("ts").alias("us"), "seq").collect(),
                  key=lambda r: (r.us, r.seq))
    size, slide = micros(size), micros(slide)
    result = {}
    for r in rows:
        start = r.us - r.us % slide
        while start > r.us - size:
            result.setdefault((r.sensorId, start), []).append(r.pm2)
            start -= slide
    return result


@pytest.mark.parametrize("windows", [Windows(), Windows("50 seconds", "20 seconds"), Windows("30 seconds", "30 seconds")])
@pytest.mark.parametrize("pane", [None, "5 seconds"])
def test_rise_with_one_sensor_of_a_third_of_all_rows(spark, skewed, windows, pane):
    expected = windows_by_hand(skewed, windows.size, windows.slide)
    result = sensor_windows(as_readings(skewed), windows, pane=pane).withColumn(
        "us", F.unix_micros("window_start")).collect()
    assert len(result) == len(expected)
    for row in result:
        values = expected[row.id, row.us]
        assert row.elementsInWindow == len(values)
        assert row.pm2tooHigh is plain.rise(values)
        assert row.sumPM2 == pytest.approx(sum(values), abs=1e-6)


def test_panes_divide_the_windows():
    assert pane_micros("50 seconds", "20 seconds") == 10_000_000
    assert pane_micros("50 seconds", "20 seconds", "2 seconds") == 2_000_000
    with pytest.raises(ValueError):
        pane_micros("50 seconds", "20 seconds", "20 seconds")


def jobs_of(spark, run):
    """The number of Spark jobs that a call starts."""
    group = f"counted-{id(run)}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_no_job_runs_while_a_plan_is_built(spark, skewed):
    readings = as_readings(skewed)
    assert jobs_of(spark, lambda: (sensor_windows(readings), trend(skewed), trend_fold(skewed))) == 0


def test_as_many_jobs_for_one_large_group(spark, skewed):
    one = skewed.withColumn("key", F.lit("k")).withColumn("ts", F.lit(START)).cache()
    one.count()
    few = one.where("seq < 50").cache()
    few.count()
    assert jobs_of(spark, trend_fold(one).collect) == jobs_of(spark, trend_fold(few).collect)


@pytest.mark.parametrize("batch_rows", [10_000, 7])
def test_fold_whatever_the_group_size(spark, skewed, batch_rows):
    expected = windows_by_hand(skewed, "60 seconds", "60 seconds")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch_rows)
    try:
        result = trend_fold(skewed).withColumn("us", F.unix_micros("window_start")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(result) == len(expected)
    for row in result:
        sensor = row.key.split(":")[1].rstrip("}")
        got = (row.tooHigh, row.tooHighCount, row.pair.first, row.pair.second, row.pair.third)
        assert got == plain.fold(expected[sensor, row.us])


def comparable(frame):
    rounded = {c: F.round(c, 6) for c, t in frame.dtypes if t == "double"}
    return sorted(map(str, frame.withColumns(rounded).select(*sorted(frame.columns)).collect()))


def test_trend_has_statistics_and_state(spark, skewed):
    whole, statistics, state = trend(skewed), trend_statistics(skewed), trend_fold(skewed)
    assert comparable(whole.select(statistics.columns)) == comparable(statistics)
    assert comparable(whole.select(state.columns)) == comparable(state)


def test_statistics_agree_with_ranked_windows(spark, skewed):
    left = sensor_statistics(as_readings(skewed))
    right = sensor_windows(as_readings(skewed)).select(left.columns)
    assert comparable(left) == comparable(right)


def test_first_area_of_a_moving_sensor(spark):
    rows = [("s", 1.0, "(3,3)", "-30", "250", 1.0, 1.0, START, 2), ("s", 1.0, "(0,0)", "1", "1", 1.0, 1.0, START, 3)]
    frame = spark.createDataFrame(
        rows, "id string, pm2 double, area string, lat string, lon string, tempC double, "
              "humidity double, ts timestamp, seq long")
    # both take the area that the first reading carries
    assert {r.area for r in sensor_statistics(frame).collect()} == {"(3,3)"}
    assert {r.area for r in sensor_windows(frame).collect()} == {"(3,3)"}


def test_windows_without_climate_and_labels(spark, skewed):
    whole = sensor_windows(as_readings(skewed))
    bare = sensor_windows(as_readings(skewed).drop("tempC", "humidity"), carry=())
    assert not {"tempC", "tempF", "humidity", "lat"} & set(bare.columns)
    assert comparable(bare) == comparable(whole.select(bare.columns))


def test_every_count_is_listed_once(spark):
    rows = [("a", 1)] * 25_000 + [("a", 2)] * 3 + [("b", 2)]
    flagged = spark.createDataFrame(rows, "area string, window_end int")
    updates = area_count_updates(flagged)
    listed = updates.groupBy("area").agg(
        F.count("*").alias("rows"), F.countDistinct("count").alias("different"), F.max("count").alias("count"))
    totals = {r.area: r["count"] for r in area_running_count(flagged).collect()}
    for row in listed.collect():
        assert row.rows == row.different == row["count"] == totals[row.area]
    assert {r["count"] for r in updates.filter("area = 'a' and window_end = 2").collect()} == {25001, 25002, 25003}


def test_durations():
    assert micros("60 seconds") == micros("1 minute") == 60_000_000
    assert micros("1 minute 30 seconds") == 90_000_000
    for text in ("", "60", "1 minute 30"):
        with pytest.raises(ValueError):
            micros(text)
