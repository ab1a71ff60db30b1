"""Every registered query against its SQL, and the plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import oracle_check
from smogline.functions import decode
from smogline.operators import areas, points
from smogline.operators import sensor_windows as sw
from smogline.operators import trend as tr
from smogline.plans import catalog
from smogline.plans.oracle import ORACLE
from smogline.sources.events import events, observations, readings, wire_a, wire_b

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return oracle_check.connect(SF_DIR)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = catalog.QUERIES[name](spark, SF_DIR).toPandas()
    expected = duck.sql(ORACLE[name]).df()
    assert len(result) > 0
    assert oracle_check.differences(result, expected) is None


def test_every_query_is_registered_with_sql():
    assert set(catalog.QUERIES) == set(ORACLE)
    assert set(catalog.QUERIES) <= set(__spark_entry__.queries())
    assert set(ORACLE) <= set(__spark_entry__.oracle_sql())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 120


def test_known_totals(spark):
    windows = catalog._sensor_windows(spark, SF_DIR)
    assert (windows.count(), windows.filter("pm2tooHigh").count()) == (1200, 455)
    area = catalog._area_trend(spark, SF_DIR)
    assert (area.count(), area.agg(F.max("sensorsReportingTrend")).first()[0]) == (128, 9)
    assert tr.too_high(catalog._trend(spark, SF_DIR)).count() == 1574


def test_production_windows(spark):
    """One-minute windows on sparse data: one row per window, nearly always."""
    result = sw.sensor_windows(readings(events(spark, SF_DIR)))
    assert (result.count(), result.filter("pm2tooHigh").count()) == (19985, 2)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def shuffles(frame):
    return len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition",
                          plan(frame)))


@pytest.mark.parametrize("name,expected", [
    ("decode_positional", 0), ("decode_json", 0), ("points_pollution", 0), ("points_time_range", 0),
    ("sensor_window_sliding", 1), ("trend_window", 1), ("trend_fold", 1),
])
def test_number_of_shuffles(spark, name, expected):
    assert shuffles(catalog.QUERIES[name](spark, SF_DIR)) == expected


@pytest.mark.parametrize("name", ["sensor_rise", "area_trend", "trend_points"])
def test_rows_are_shuffled_once(spark, name):
    """One exchange takes rows as they come; all others take sums or a row per pane or group."""
    frame = catalog.QUERIES[name](spark, SF_DIR)
    dealt = re.findall(r"Exchange hashpartitioning\([^)]*\), REPARTITION_BY_COL", plan(frame))
    assert len(dealt) == 1 and plan(frame).count("FileScan parquet") <= 3
    assert "partial_" in plan(frame)


def test_a_range_of_time_reaches_the_scan_below_a_decoder(spark):
    rows = observations(events(spark, SF_DIR))
    early = F.col("ts") < "2024-01-03"
    ranged = "ts >= timestamp'2024-01-08' and ts < timestamp'2024-01-10'"
    for wire, form in ((wire_a, decode.decode_positional), (wire_b, decode.decode_json)):
        for mode in (decode.SKIP, decode.FAILFAST):
            decoded = form(wire(rows), mode=mode).where(ranged)
            assert re.search(r"PushedFilters: \[[^]]*GreaterThanOrEqual\(ts", plan(decoded))
            assert plan(decoded).count("Generate") == 1
        # a bad message outside of the range stops nothing
        damaged = wire(rows).withColumn("value", F.when(early, "x").otherwise(F.col("value")))
        assert form(damaged).where(ranged).count() == rows.where(ranged).count() > 0
        with pytest.raises(Exception, match="bad record"):
            form(damaged).collect()


# Batch queries over the trend's state machine, the one place of the batch plans that runs Python.
FOLDED = {"trend_fold", "trend_too_high", "area_running_count", "alert_messages_updates", "encode_trend_json",
          "encode_trend_text", "encode_counts_text", "trend_points"}
STREAMED = ("_stream", "_closing", "_store", "_text_file")


def test_python_runs_in_the_fold_only_and_nothing_is_crossed(spark):
    for name, query in catalog.QUERIES.items():
        if not name.endswith(STREAMED):
            nodes = re.findall("MapInArrow|MapInPandas|ArrowEval|BatchEval|FlatMap|PythonUDF|CartesianProduct|NestedLoop",
                               plan(query(spark, SF_DIR)))
            assert nodes == (["MapInArrow"] if name in FOLDED else []), name


def test_scan_reads_what_is_needed(spark):
    text = plan(catalog.points_time_range(spark, SF_DIR))
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text and "event_type" not in text
    area = plan(areas.area_trend(sw.sensor_windows(readings(events(spark, SF_DIR)), catalog.DAYS), catalog.DAYS))
    assert "props" not in area
    fold = plan(tr.trend_fold(observations(events(spark, SF_DIR)), catalog.DAYS))
    assert "props" not in fold


def test_day_partitions_are_pruned(spark, tmp_path):
    rows = points.pollution(readings(events(spark, SF_DIR)), "ts").withColumn("date", F.to_date("ts"))
    rows.write.partitionBy("date").parquet(str(tmp_path / "Pollution"))
    table = spark.read.parquet(str(tmp_path / "Pollution"))
    ranged = points.in_time_range(table, "2024-01-08 00:00:00", "2024-01-10 12:00:00")
    expected = points.in_time_range(rows, "2024-01-08 00:00:00", "2024-01-10 12:00:00")
    assert ranged.count() == expected.count() > 0
    assert "date" in re.search(r"PartitionFilters: \[(.*?)\]", plan(ranged)).group(1)
