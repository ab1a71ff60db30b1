"""Hand-computed cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import plain
from smogline.functions import decode
from smogline.functions.geo import degree_steps
from smogline.functions.grid import block_area, grid_area
from smogline.functions.scalars import colour
from smogline.operators import alerts, maps
from smogline.operators.fold import fold
from smogline.operators.rise import rise_of_sorted
from smogline.operators.sensor_windows import sensor_windows
from smogline.operators.trend import trend
from smogline.params import Grid, alarm_threshold

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)

FOLDS = [
    ([7.0], (False, 0, 0.0, 7.0, -1000.0)),
    ([0.5, 1.0, 1.5, 2.0], (True, 2, 1.5, 2.0, -1000.0)),
    ([5.0, 4.0, 5.5, 6.0], (False, 0, 0.5, 6.0, -1000.0)),
    ([5.0, 50.0, 10.0, 60.0], (True, 2, 55.0, 60.0, -1000.0)),
    ([3.0, 4.0, 3.5, 3.9], (True, 1, 0.8999999999999999, 3.9, -1000.0)),
    ([-5.0, -3.0], (False, 0, -1.0, 0.0, -1000.0)),
    ([-2000.0, -500.0], (False, 0, -1.0, -500.0, 1500.0)),
    ([0.0, 2.0, -1500.0, -100.0], (False, 1, 2.0, -100.0, 1400.0)),
]

RISES = [
    ([100.0], False),
    ([0.0, 10.0], False),
    ([0.0, 10.5], True),
    ([0.5 * j for j in range(1, 13)], False),
    ([0.0] * 9 + [20.0], False),
    ([0.0] * 8 + [20.0, 20.0], True),
    ([0.5 * j for j in range(1, 601)], True),
]


@pytest.mark.parametrize("values,expected", FOLDS)
def test_fold(values, expected):
    first, second, third, high, count = fold(values)
    assert (high, count, first, second, third) == expected
    assert plain.fold(values) == expected


@pytest.mark.parametrize("values,expected", RISES)
def test_rise_of_array(spark, values, expected):
    row = spark.createDataFrame([(values,)], "v array<double>").select(rise_of_sorted(F.col("v")))
    assert row.first()[0] is expected
    assert plain.rise(values) is expected


def readings_of(spark, series):
    rows = []
    for number, values in enumerate(series):
        for j, v in enumerate(values):
            rows.append((str(number), v, "(0,0)", "1", "1", -20.0 + (j % 2), 40.0,
                         START + dt.timedelta(milliseconds=10 * j), j))
    return spark.createDataFrame(
        rows, "id string, pm2 double, area string, lat string, lon string, tempC double, "
              "humidity double, ts timestamp, seq long"
    )


def test_rise_of_windows(spark):
    result = sensor_windows(readings_of(spark, [v for v, _ in RISES])).collect()
    # every reading lies in two windows with the same content
    assert len(result) == 2 * len(RISES)
    for row in result:
        values, expected = RISES[int(row.id)]
        assert row.pm2tooHigh is expected and row.elementsInWindow == len(values)
        if len(values) > 1:
            assert row.tempC == -19.0 and abs(row.tempF - -2.2) < 1e-9


def test_floor_of_maxima(spark):
    rows = [('{"sensor":1}', "1", 1, 1, t, 5, 3.0, "pollution", START + dt.timedelta(seconds=i), i)
            for i, t in enumerate((-20.0, -19.0))]
    rows.append((None, "1", 1, 1, 30.0, 5, 3.0, "pollution", START, 9))  # no key: not grouped
    frame = spark.createDataFrame(
        rows, "key string, sensorId string, lon int, lat int, temperature double, humidity int, "
              "pm2 double, measurement string, ts timestamp, seq long"
    )
    [row] = trend(frame).collect()
    assert (row.temperatureCMax, row.temperatureFMax, row.countUsecase) == (-1.0, -1.0, 2)


@pytest.mark.parametrize("lat,lon,areas,grid,block", [
    (99, 99, 16, "(3,3)", "Area [3, 3]"),
    (25, 26, 16, "(0,1)", "Area [1, 1]"),
    (0, 1, 16, "(0,0)", "Area [0, 0]"),
    (100, 100, 16, "(3,3)", "Area [4, 4]"),
    (100, 1, 9, "(3,0)", None),
])
def test_area_labels(spark, lat, lon, areas, grid, block):
    row = spark.createDataFrame([(lat, lon)], "lat int, lon int").select(
        grid_area(F.col("lat"), F.col("lon"), Grid(areas)), block_area(F.col("lon"), F.col("lat"))
    ).first()
    assert row[0] == grid
    assert block is None or row[1] == block


@pytest.mark.parametrize("areas", [0, 10, 15])
def test_number_of_areas_is_a_square(areas):
    with pytest.raises(ValueError):
        Grid(areas).cell


SAMPLE = ('{"measurement":"pollution", "id": 12345678, "long": 99, "lat": 99, "humidity": 50, '
          '"temperature": 25.0, "pm2": 20.5}')
QUOTED = ('{"measurement": "pollution", "sensorId": "7", "lon": 8, "lat": 1, "humidity": 50, '
          '"temperature" : 0.5, "pm2": 0.5}')


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_decode_sample(spark):
    [row] = decode.decode_positional(texts(spark, SAMPLE)).collect()
    assert row.asDict() == {"id": "12345678", "pm2": 20.5, "area": "(3,3)", "lat": "99", "lon": "99",
                            "tempC": 25.0, "humidity": 50.0}


def test_decode_keeps_quotes(spark):
    assert decode.decode_positional(texts(spark, QUOTED)).first().id == '"7"'
    assert decode.decode_positional(texts(spark, QUOTED), strip_quotes=True).first().id == "7"


def test_decode_for_the_map_ignores_climate(spark):
    broken = SAMPLE.replace("25.0", "warm")
    frame = decode.decode_positional(texts(spark, broken), climate=False)
    assert frame.columns == ["id", "pm2", "area", "lat", "lon"] and frame.first().pm2 == 20.5


BAD = ["", ",".join(SAMPLE.split(",")[:4]), SAMPLE.replace('"lat": 99', '"lat": 12.0'),
       SAMPLE.replace("20.5", "abc"), SAMPLE.replace("12345678", "").replace('"id": ', '"id":'), None]


def test_bad_records_are_quarantined(spark):
    marked = decode.mark_positional(texts(spark, SAMPLE, *BAD))
    assert [r.value for r in decode.quarantine(marked).collect()] == BAD
    assert decode.decode_positional(texts(spark, SAMPLE, *BAD), mode=decode.SKIP).count() == 1


@pytest.mark.parametrize("bad", BAD)
def test_bad_record_stops_the_job(spark, bad):
    with pytest.raises(Exception, match="bad record"):
        decode.decode_positional(texts(spark, bad)).collect()


@pytest.mark.parametrize("text,ok,values", [
    (SAMPLE, True, (None, 0, 99, 25.0, 50, 20.5)),
    ('{"sensorId":"4","lon":"7","lat":8.0,"pm2":"1.5"}', True, ("4", 7, 8, 0.0, 0, 1.5)),
    ('{"sensorId":null,"lon":null}', True, (None, 0, 0, 0.0, 0, 0.0)),
    ('{"lon":7.5}', False, None),
    ('{"pm2":"abc"}', False, None),
    ('{"pm2":', False, None),
])
def test_decode_json(spark, text, ok, values):
    row = decode.mark_json(texts(spark, text)).first()
    assert row.ok is ok
    if ok:
        assert (row.sensorId, row.lon, row.lat, row.temperature, row.humidity, row.pm2) == values


def test_decode_store_keeps_text(spark):
    row = decode.decode_store(texts(spark, '{"id": 8,"m":x,"ts": 17,"a":1,"b":2,"pm2": 6.5}')).first()
    assert (row.id, row.ts, row.pm2) == (" 8", " 17", " 6.5}")
    short = texts(spark, '{"id":8,"m":x,"ts":17,"a":1,"b":2')
    assert decode.decode_store(short, mode=decode.SKIP).count() == 0


def test_degree_steps():
    assert degree_steps() == (0.0012284083177272593, 0.001803316984376231)


def test_colours(spark):
    row = spark.createDataFrame([(14.99, 15.0)], "a double, b double").select(
        colour(F.col("a"), 15.0), colour(F.col("b"), 15.0)).first()
    assert tuple(row) == ("green", "red")


def test_area_layer_reads_labels_of_any_length(spark):
    points = spark.createDataFrame([("(0,0)", 1), ("(11,2)", 2)], "area string, tooHigh long")
    sensors = spark.createDataFrame([(str(i % 9),) for i in range(20)], "id string")
    first, second = maps.area_layer(points, sensors).collect()
    step_lat, step_lng = degree_steps()
    edge = (3 + 1) / 2 - 1  # nine sensors, four areas
    assert (first.start_lat, first.start_lng, first.color) == (47.063, 15.44, "green")
    assert second.start_lat == pytest.approx(47.063 + 11 * edge * step_lat, abs=1e-12)
    assert second.end_lng == pytest.approx(15.44 + 3 * edge * step_lng, abs=1e-12)
    assert second.color == "red"


def test_threshold_divides_twice():
    assert [alarm_threshold(n, 16) for n in (10000, 380, 150, 640)] == [62, 2, 0, 4]


def test_messages(spark):
    rows = spark.createDataFrame(
        [("(1,2)", START, START, 5), ("(0,0)", START, START, 4)],
        "area string, window_start timestamp, window_end timestamp, sensorsReportingTrend long",
    )
    both = [r.message for r in alerts.area_messages(rows, alerts.BOTH, 640).collect()]
    assert both == [
        "Area: (1,2) registered a high increase of PM2,5. 5 of 40 registered sensors reported.",
        "Area: (0,0) registered a too high increase of PM2,5 concentration: 4 of 40 registered sensors reported.",
    ]
    above = [r.message for r in alerts.area_messages(rows, alerts.ABOVE_ONLY, 640).collect()]
    assert above == ["ALARM !!! " + both[0]]
    counts = spark.createDataFrame([("Area [3, 3]", 7)], "area string, count long")
    assert alerts.update_messages(counts).first().message == (
        "In Area [3, 3]was registred a too high Pm2.5 concentration7"
    )
