"""Names, hours and ranges."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from airhour.catalog import Catalog
from airhour.functions.naming import build_metric_columns, metric_name
from airhour.functions.time import (
    add_hours,
    ensure_utc,
    get_current_hour_start,
    get_previous_hour_start,
    iter_hours,
    truncate_to_hour,
)
from airhour.sources.ranges import backfill_range, incremental_range, specific_hour, time_range


def show(spark, column):
    return spark.range(1).select(F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]


def test_one_metric():
    assert build_metric_columns(["co_mean"]) == {"co_mean": "co"}


def test_many_metrics():
    assert build_metric_columns(["no_mean", "no2_mean", "nox_mean"]) == {
        "no_mean": "no",
        "no2_mean": "no2",
        "nox_mean": "nox",
    }


def test_no_metrics():
    assert build_metric_columns([]) == {}


def test_every_marker_is_removed(spark):
    assert build_metric_columns(["a_mean_b_mean"]) == {"a_mean_b_mean": "a_b"}
    row = spark.createDataFrame([("a_mean_b_mean",)], "c string").select(metric_name(F.col("c"))).first()
    assert row[0] == "a_b"


def test_catalog_has_six_tables_and_fifteen_metrics():
    tables = Catalog().select()
    assert [t.key for t in tables] == ["co", "nox", "pm10", "so2", "o3", "meteo"]
    assert sum(len(t.metrics) for t in tables) == 15


def test_unknown_table_names_the_known_ones():
    with pytest.raises(KeyError, match="meteo"):
        Catalog()["ozone"]


@pytest.mark.parametrize(
    "value, expected",
    [
        (datetime(2024, 1, 1, 10, 30), "2024-01-01 10:30:00.000000"),
        (datetime(2024, 1, 1, 10, 30, tzinfo=timezone.utc), "2024-01-01 10:30:00.000000"),
        (datetime(2024, 1, 1, 15, tzinfo=timezone(timedelta(hours=5))), "2024-01-01 10:00:00.000000"),
        ("2024-01-01T15:00:00+05:00", "2024-01-01 10:00:00.000000"),
        ("2024-01-01T10:00:00", "2024-01-01 10:00:00.000000"),
        (None, None),
    ],
)
def test_ensure_utc_of_values(spark, value, expected):
    assert show(spark, ensure_utc(value)) == expected


def test_ensure_utc_of_columns(spark):
    texts = spark.createDataFrame([("2024-01-01T15:00:00+05:00",), ("2024-01-01T10:00:00",), (None,)], "t string")
    got = texts.select(F.date_format(ensure_utc(F.col("t")), "HH:mm")).collect()
    assert [r[0] for r in got] == ["10:00", "10:00", None]
    naive = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 10:00:00' AS t").select(ensure_utc(F.col("t")).alias("t"))
    assert naive.dtypes == [("t", "timestamp")]
    assert show(spark, ensure_utc(naive.first()["t"].replace(tzinfo=None))) is not None


@pytest.mark.parametrize(
    "start, hours, expected",
    [
        ("2024-01-01T10:15:00", 3, "2024-01-01 13:15:00.000000"),
        ("2024-01-01T10:15:00", -3, "2024-01-01 07:15:00.000000"),
        ("2024-01-01T23:00:00", 2, "2024-01-02 01:00:00.000000"),
        ("2024-01-02T01:00:00", -3, "2024-01-01 22:00:00.000000"),
        ("2024-01-01T10:15:00", 0, "2024-01-01 10:15:00.000000"),
    ],
)
def test_add_hours(spark, start, hours, expected):
    assert show(spark, add_hours(start, hours)) == expected


def test_truncate(spark):
    assert show(spark, truncate_to_hour("2024-01-01T10:59:59.999999")) == "2024-01-01 10:00:00.000000"
    assert show(spark, truncate_to_hour("2024-01-01T10:00:00")) == "2024-01-01 10:00:00.000000"


def test_running_and_previous_hour(spark):
    as_of = "2024-01-01T00:30:00Z"
    assert show(spark, get_current_hour_start(as_of)) == "2024-01-01 00:00:00.000000"
    assert show(spark, get_previous_hour_start(as_of)) == "2023-12-31 23:00:00.000000"


def test_clock_hours_are_one_apart(spark):
    gap = F.unix_seconds(get_current_hour_start()) - F.unix_seconds(get_previous_hour_start())
    assert spark.range(1).select(gap).first()[0] == 3600


def test_hours_over_midnight(spark, utc):
    hours = iter_hours(spark, "2024-01-01T22:10:00", "2024-01-02T02:59:00")
    assert utc(hours, "hour") == ["2024-01-01 22:00", "2024-01-01 23:00", "2024-01-02 00:00", "2024-01-02 01:00"]


@pytest.mark.parametrize("end", ["2024-01-01T10:00:00", "2024-01-01T10:40:00", "2024-01-01T08:00:00"])
def test_no_hours(spark, end):
    assert iter_hours(spark, "2024-01-01T10:30:00", end).count() == 0


def within(spark, bounds, *times):
    rows = spark.createDataFrame([(t,) for t in times], "t string").select(ensure_utc(F.col("t")).alias("time"), "t")
    return [r["t"] for r in rows.where(bounds.predicate()).orderBy("t").collect()]


def test_explicit_range_is_half_open(spark):
    bounds = time_range("2024-01-01T10:00:00", "2024-01-01T11:00:00")
    times = ["2024-01-01T09:59:59.999999", "2024-01-01T10:00:00", "2024-01-01T10:59:59.999999", "2024-01-01T11:00:00"]
    assert within(spark, bounds, *times) == times[1:3]


def test_no_start_reads_from_the_epoch(spark):
    bounds = time_range(None, "2024-01-01T00:00:00")
    assert within(spark, bounds, "1969-12-31T23:59:59", "1970-01-01T00:00:00", "2024-01-01T00:00:00") == [
        "1970-01-01T00:00:00"
    ]


def test_no_end_reads_until_now(spark):
    bounds = time_range("2024-01-01T00:00:00", None, as_of="2024-01-01T05:30:00")
    times = ["2023-12-31T23:59:59", "2024-01-01T05:29:59", "2024-01-01T05:30:00"]
    assert within(spark, bounds, *times) == [times[1]]
    assert within(spark, time_range("2024-01-01T00:00:00"), "2024-06-01T00:00:00", "2999-01-01T00:00:00") == [
        "2024-06-01T00:00:00"
    ]


def test_no_bounds_read_the_previous_hour(spark):
    bounds = time_range(as_of="2024-01-15T11:30:00")
    times = ["2024-01-15T09:59:59", "2024-01-15T10:00:00", "2024-01-15T10:59:59", "2024-01-15T11:00:00"]
    assert within(spark, bounds, *times) == times[1:3]


def test_incremental_range(spark):
    times = ["2024-01-15T10:59:59", "2024-01-15T11:00:00", "2024-01-15T11:59:59", "2024-01-15T12:00:00"]
    bounds = incremental_range("2024-01-15T10:00:00", as_of="2024-01-15T12:30:00")
    assert within(spark, bounds, *times) == times[1:3]


def test_incremental_range_keeps_minutes_of_the_mark(spark):
    bounds = incremental_range("2024-01-15T10:20:00", as_of="2024-01-15T13:00:00")
    assert within(spark, bounds, "2024-01-15T11:19:59", "2024-01-15T11:20:00") == ["2024-01-15T11:20:00"]


def test_first_incremental_range(spark):
    bounds = incremental_range(None, as_of="2024-01-15T11:30:00")
    assert within(spark, bounds, "2024-01-15T09:59:59", "2024-01-15T10:00:00", "2024-01-15T11:00:00") == [
        "2024-01-15T10:00:00"
    ]


@pytest.mark.parametrize("last", ["2024-01-15T11:00:00", "2024-01-15T12:00:00", "2024-01-15T20:00:00"])
def test_up_to_date_range_is_empty_without_a_scan(spark, last):
    bounds = incremental_range(last, as_of="2024-01-15T12:30:00")
    readings = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn(
        "time", F.col("ts").cast("timestamp")
    )
    limited = readings.where(bounds.predicate())
    assert limited.count() == 0
    assert "FileScan" not in limited._jdf.queryExecution().executedPlan().toString()


def test_single_hour_and_backfill_ranges(spark):
    times = ["2024-01-01T10:00:00", "2024-01-01T10:30:00", "2024-01-01T11:00:00", "2024-01-01T11:30:00"]
    assert within(spark, specific_hour("2024-01-01T10:00:00"), *times) == times[:2]
    assert within(spark, backfill_range("2024-01-01T10:45:00", "2024-01-01T11:15:00"), *times) == times[:2]


def test_date_column_prunes_but_keeps_the_rows(spark, tmp_path):
    rows = spark.sql(
        "SELECT explode(sequence(TIMESTAMP'2024-01-01 00:30:00', TIMESTAMP'2024-01-05 00:00:00', INTERVAL 1 HOUR)) AS time"
    )
    rows.withColumn("date", F.to_date("time")).write.partitionBy("date").parquet(str(tmp_path / "r"))
    stored = spark.read.parquet(str(tmp_path / "r"))
    bounds = time_range("2024-01-02T22:00:00", "2024-01-03T02:00:00")
    limited = stored.where(bounds.predicate("time", "date"))
    assert limited.count() == stored.where(bounds.predicate()).count() == 4
    plan = limited._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert len(limited.inputFiles()) >= 1
