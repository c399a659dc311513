"""The hourly aggregate: golden cases, brute force and plan shape."""

from collections import defaultdict
from datetime import datetime, timedelta
from math import isnan

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from airhour.operators.hourly import aggregate_to_long_format, hourly_long, naive_timestamps
from airhour.schema import OUTPUT_COLUMNS, OUTPUT_SCHEMA, create_empty_output_dataframe, validate_output_schema
from airhour.sources.events import event_source, separate_event_source
from airhour.sources.ranges import time_range
from airhour.sources.readings import ReadingSource

CO = {"co_mean": "co"}
TEN = "2024-01-01T10:%02d:00Z"


def types(df):
    return [kind for _, kind in df.dtypes]


FACT_TYPES = ["timestamp", "string", "string", "double", "bigint", "string"]


def test_basic_hour(frame, utc):
    rows = frame([(TEN % m, "loc1", "k", v) for m, v in [(0, 1.0), (10, 1.5), (20, 2.0), (30, 2.5)]])
    out = aggregate_to_long_format(rows, metric_columns=CO, version="test-v1.0")
    assert out.columns == OUTPUT_COLUMNS and types(out) == FACT_TYPES
    assert utc(out) == ["2024-01-01 10:00"]
    assert [tuple(r)[1:] for r in out.collect()] == [("loc1", "co", 1.75, 4, "test-v1.0")]


def test_only_valid_rows_count(frame):
    rows = frame([(TEN % 0, "loc1", "k", 1.0), (TEN % 10, "loc1", "v", 1.5), (TEN % 20, "loc1", "k", 2.0)])
    row = aggregate_to_long_format(rows, metric_columns=CO).first()
    assert (row["valor"], row["count_ok"], row["version"]) == (1.5, 2, None)


def test_status_is_case_sensitive_and_null_is_not_valid(frame):
    rows = frame([(TEN % 0, "a", "K", 1.0), (TEN % 1, "a", None, 2.0), (TEN % 2, "a", "k", 4.0)])
    row = aggregate_to_long_format(rows, metric_columns=CO).first()
    assert (row["valor"], row["count_ok"]) == (4.0, 1)


def test_two_metrics_in_one_table(frame):
    rows = frame([(TEN % 0, "l", "k", 1.0, 10.0), (TEN % 10, "l", "k", 1.5, 15.0)], "co_mean double, no_mean double")
    out = aggregate_to_long_format(rows, metric_columns={"co_mean": "co", "no_mean": "no"})
    assert sorted((r["metrica"], r["valor"], r["count_ok"]) for r in out.collect()) == [
        ("co", 1.25, 2),
        ("no", 12.5, 2),
    ]


def test_two_columns_may_share_a_metric_name(frame):
    rows = frame([(TEN % 0, "l", "k", 1.0, 10.0)], "co_mean double, co double")
    out = aggregate_to_long_format(rows, metric_columns={"co_mean": "co", "co": "co"})
    assert sorted(r["valor"] for r in out.collect()) == [1.0, 10.0]


def test_all_invalid_and_empty_inputs(spark, frame):
    for rows in (frame([(TEN % 0, "l", "v", 1.0)]), frame([]), spark.createDataFrame([], "")):
        out = aggregate_to_long_format(rows, metric_columns=CO)
        assert out.count() == 0 and out.columns == OUTPUT_COLUMNS and types(out) == FACT_TYPES


@pytest.mark.parametrize("names", [None, {}])
def test_metrics_are_required(frame, names):
    with pytest.raises(ValueError, match="metric_columns cannot be None or empty"):
        aggregate_to_long_format(frame([]), metric_columns=names)


def test_null_values_are_skipped_but_rows_kept(frame):
    rows = frame([(TEN % 0, "a", "k", None), (TEN % 1, "b", "k", None), (TEN % 2, "b", "k", 3.0)])
    out = {r["location"]: (r["valor"], r["count_ok"]) for r in aggregate_to_long_format(rows, metric_columns=CO).collect()}
    assert out == {"a": (None, 1), "b": (3.0, 2)}


def test_nan_propagates(frame):
    rows = frame([(TEN % 0, "a", "k", float("nan")), (TEN % 1, "a", "k", 1.0)])
    assert isnan(aggregate_to_long_format(rows, metric_columns=CO).first()["valor"])


def test_hour_edges(frame, utc):
    times = ["2024-01-01T10:00:00Z", "2024-01-01T10:59:59.999999Z", "2024-01-01T11:00:00Z"]
    out = aggregate_to_long_format(frame([(t, "a", "k", 1.0) for t in times]), metric_columns=CO).orderBy("time")
    assert utc(out) == ["2024-01-01 10:00", "2024-01-01 11:00"]
    assert [r["count_ok"] for r in out.collect()] == [2, 1]


def test_null_location_is_a_group(frame):
    out = aggregate_to_long_format(frame([(TEN % 0, None, "k", 1.0), (TEN % 1, "a", "k", 1.0)]), metric_columns=CO)
    assert {r["location"] for r in out.collect()} == {None, "a"}


def test_other_column_names(spark, frame):
    rows = frame([(TEN % 0, "a", "k", 2.0)]).withColumnsRenamed({"time": "at", "location": "site"})
    row = aggregate_to_long_format(rows, "at", "site", CO).first()
    assert (row["location"], row["valor"]) == ("a", 2.0)


def test_zone_free_input(spark):
    rows = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 10:30:00' AS time, 'a' AS location, 'k' AS status, 1D AS co_mean")
    source = ReadingSource.from_frames({"co": rows})
    out = hourly_long(source.readings(["co"]), "v")
    assert out.dtypes[0] == ("time", "timestamp")
    assert out.select(F.date_format("time", "HH:mm")).first()[0] == "10:00"


def test_no_tables_give_an_empty_result(spark):
    assert hourly_long([]).columns == OUTPUT_COLUMNS


def test_a_whole_hour_of_seven_metrics(frame):
    values = {
        "co_mean": [0.25, 0.75, 1.5, 2.5, 3.25, 0.125],
        "no_mean": [11.0, 17.5, 23.25, 31.0, 8.5, 4.75],
        "no2_mean": [9.5, 14.25, 6.0, 27.5, 33.0, 12.75],
        "nox_mean": [20.5, 31.75, 29.25, 58.5, 41.5, 17.5],
        "pm10_mean": [50.0, 41.5, 36.25, 28.0, 19.5, 11.75],
        "so2_mean": [2.5, 4.25, 6.75, 1.0, 3.5, 5.25],
        "o3_mean": [60.5, 72.25, 48.0, 35.75, 81.5, 66.0],
    }
    rows = [(TEN % (10 * i), "Centro", "k", *[v[i] for v in values.values()]) for i in range(6)]
    names = {c: c.replace("_mean", "") for c in values}
    out = aggregate_to_long_format(frame(rows, ", ".join(f"{c} double" for c in values)), metric_columns=names)
    got = {r["metrica"]: (r["valor"], r["count_ok"]) for r in out.collect()}
    assert got == {names[c]: (pytest.approx(sum(v) / 6), 6) for c, v in values.items()}


reading = st.tuples(
    st.integers(0, 60 * 5),
    st.sampled_from(["Centro", "Norte", None]),
    st.sampled_from(["k", "k", "v", "s", "m", "x", None]),
    st.one_of(st.none(), st.integers(-50, 50).map(float)),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(reading, max_size=60))
def test_brute_force(frame, rows):
    start = datetime(2024, 1, 1, 22)
    groups = defaultdict(list)
    for minute, location, status, value in rows:
        if status == "k":
            groups[((start + timedelta(minutes=minute)).replace(minute=0), location)].append(value)
    expected = {}
    for (hour, location), values in groups.items():
        known = [v for v in values if v is not None]
        expected[hour.strftime("%Y-%m-%d %H"), location] = (sum(known) / len(known) if known else None, len(values))
    made = [((start + timedelta(minutes=m)).isoformat() + "Z", loc, s, v) for m, loc, s, v in rows]
    out = aggregate_to_long_format(frame(made), metric_columns=CO)
    got = {
        (r["h"], r["location"]): (r["valor"], r["count_ok"])
        for r in out.withColumn("h", F.date_format("time", "yyyy-MM-dd HH")).collect()
    }
    assert got == expected


SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_shared_base_equals_separate_tables(spark):
    shared = hourly_long(event_source(spark, SF).readings(), "v")
    separate = hourly_long(separate_event_source(spark, SF).readings(), "v")
    assert shared.exceptAll(separate).count() == separate.exceptAll(shared).count() == 0
    assert shared.count() > 0


def test_shared_base_needs_one_scan_and_one_shuffle(spark):
    text = plan(hourly_long(event_source(spark, SF).readings(), "v"))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_one_table_prunes_columns_and_pushes_filters(spark, tmp_path):
    wide = event_source(spark, SF).fetch_table("nox")
    wide.withColumn("unused", F.lit(1)).write.parquet(str(tmp_path / "nox_minutales"))
    source = ReadingSource.from_path(spark, str(tmp_path))
    readings = source.readings(["nox"], time_range("2024-01-05T00:00:00", "2024-01-09T00:00:00"))
    text = plan(hourly_long(readings, "v"))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1
    assert "EqualTo(status,k)" in text and "GreaterThanOrEqual(time" in text and "LessThan(time" in text
    assert "unused" not in text.split("ReadSchema")[1]
    assert "Python" not in text


def test_schema_order_and_types():
    assert OUTPUT_COLUMNS == ["time", "location", "metrica", "valor", "count_ok", "version"]
    assert [f.dataType.simpleString() for f in OUTPUT_SCHEMA] == FACT_TYPES


def test_empty_fact_table(spark):
    empty = create_empty_output_dataframe(spark)
    assert empty.count() == 0 and types(empty) == FACT_TYPES


def test_conform_fills_missing_columns(spark):
    out = validate_output_schema(spark.sql("SELECT TIMESTAMP'2024-01-01 10:00:00' AS time, 'l' AS location, 'co' AS metrica"))
    row = out.first()
    assert out.columns == OUTPUT_COLUMNS and types(out) == FACT_TYPES
    assert (row["valor"], row["count_ok"], row["version"]) == (None, None, None)


def test_conform_casts_reorders_and_drops(spark):
    out = validate_output_schema(
        spark.sql("SELECT 'v' AS version, 5 AS count_ok, 1 AS valor, 'x' AS extra, 'co' AS metrica, 'l' AS location, "
                  "'2024-01-01T10:00:00Z' AS time")
    )
    assert out.columns == OUTPUT_COLUMNS and types(out) == FACT_TYPES
    assert tuple(out.first())[1:] == ("l", "co", 1.0, 5, "v")


def test_conform_of_nothing(spark):
    out = validate_output_schema(spark.createDataFrame([], ""))
    assert out.count() == 0 and types(out) == FACT_TYPES


def test_conform_fails_on_a_bad_cast(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        validate_output_schema(spark.sql("SELECT 'many' AS valor")).collect()


def test_naive_timestamps_keep_the_wall_clock(spark):
    out = naive_timestamps(spark.sql("SELECT TIMESTAMP'2024-01-01 10:00:00+00:00' AS time, 1 AS n"))
    assert out.dtypes == [("time", "timestamp_ntz"), ("n", "int")]
    assert out.first()["time"] == datetime(2024, 1, 1, 10)
