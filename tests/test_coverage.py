"""Missing hours and gaps."""

import pytest
from pyspark.sql import functions as F

from airhour.catalog import Catalog
from airhour.operators.coverage import (
    coverage_gaps,
    coverage_present,
    find_missing_hours,
    hours_with_data,
    missing_hours,
    preview,
)
from airhour.sources.readings import ReadingSource

DAY = "2024-01-01T%s:00Z"


def test_missing_hours(spark, utc):
    hours = find_missing_hours(spark, "2024-01-15T10:00:00", "2024-01-15T15:30:00")
    assert utc(hours, "hour") == [f"2024-01-15 {h}:00" for h in (11, 12, 13, 14)]


@pytest.mark.parametrize("last", ["2024-01-15T14:00:00", "2024-01-15T15:00:00", "2024-01-16T00:00:00"])
def test_nothing_missing(spark, last):
    assert find_missing_hours(spark, last, "2024-01-15T15:30:00").count() == 0


def test_missing_hours_cut_the_mark_to_its_hour(spark, utc):
    assert utc(find_missing_hours(spark, "2024-01-15T10:45:00", "2024-01-15T12:00:00"), "hour") == ["2024-01-15 11:00"]


def test_missing_hours_of_many_states(spark):
    states = spark.sql(
        "SELECT * FROM VALUES ('a', TIMESTAMP'2024-01-15 12:00:00'), ('b', NULL), ('c', TIMESTAMP'2024-01-15 14:00:00') "
        "AS t(pipeline, last_processed_hour)"
    )
    got = missing_hours(states, "2024-01-15T15:30:00").select("pipeline", F.hour("hour")).collect()
    assert sorted(map(tuple, got)) == [("a", 13), ("a", 14)]


def test_preview(spark):
    first, more = preview(find_missing_hours(spark, "2024-01-15T00:00:00", "2024-01-15T09:10:00"))
    assert len(first) == 5 and more == 3
    assert preview(find_missing_hours(spark, "2024-01-15T00:00:00", "2024-01-15T00:10:00")) == ([], 0)


@pytest.fixture
def source(frame):
    co = frame([(DAY % "10:05", "a", "v", 1.0), (DAY % "10:10", "b", "k", 1.0), (DAY % "12:00", "a", "k", 1.0)])
    o3 = frame([], "o3_mean double")
    catalog = Catalog({"co": ("co", ["co_mean"]), "o3": ("o3", ["o3_mean"])})
    return ReadingSource.from_frames({"co": co, "o3": o3}, catalog=catalog)


BOUNDS = ("2024-01-01T10:00:00", "2024-01-01T13:00:00")


def hours(df):
    keys = [c for c in df.columns if c != "hour"]
    return sorted((*[r[k] for k in keys], r["h"]) for r in df.withColumn("h", F.hour("hour")).collect())


def test_gaps_by_table(source):
    assert hours(coverage_gaps(source.readings(), *BOUNDS)) == [("co", 11), ("o3", 10), ("o3", 11), ("o3", 12)]


def test_present_hours_count_rows_of_any_status(source):
    assert hours(coverage_present(source.readings(), *BOUNDS)) == [("co", 10), ("co", 12)]
    rows = {(r["pollutant"], r["rows"]) for r in hours_with_data(source.readings()).collect()}
    assert rows == {("co", 2), ("co", 1)}


def test_gaps_by_location(source):
    assert hours(coverage_gaps(source.readings(), *BOUNDS, by_location=True)) == [
        ("co", "a", 11),
        ("co", "b", 11),
        ("co", "b", 12),
    ]


def test_gaps_of_a_station_list(spark, source):
    stations = spark.createDataFrame([("b",), ("c",)], "location string")
    got = hours(coverage_gaps(source.readings(["co"]), *BOUNDS, locations=stations))
    assert got == [("co", "b", 11), ("co", "b", 12), ("co", "c", 10), ("co", "c", 11), ("co", "c", 12)]


def test_empty_range_has_no_gaps(source):
    assert coverage_gaps(source.readings(), BOUNDS[1], BOUNDS[0]).count() == 0


def test_no_join_without_keys(source):
    for df in (coverage_gaps(source.readings(), *BOUNDS, by_location=True), coverage_gaps(source.readings(), *BOUNDS)):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in text and "NestedLoop" not in text
