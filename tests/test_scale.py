"""Plans, jobs and files of the work that runs and streams do, and literal rows of the adapter."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from airhour.operators.coverage import coverage_gaps
from airhour.operators.hourly import hourly_long
from airhour.operators.quality import DataValidationError
from airhour.plans.registry import stored_event_source
from airhour.plans.runs import run_backfill, run_incremental
from airhour.plans.state import StateLog
from airhour.schema import OUTPUT_COLUMNS, STATE_SCHEMA
from airhour.sources.events import event_source, events, raw_event_source, wide_readings
from airhour.sources.ranges import backfill_range
from airhour.sources.readings import ReadingSource
from airhour.streaming.hourly import read_hours, start_hourly_stream

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_tables_prune_dates_and_push_the_status(spark):
    source = stored_event_source(spark, SF)
    within = backfill_range("2024-01-10T00:00:00Z", "2024-01-11T00:00:00Z")
    text = hourly_long(source.readings(["co"], within))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in text
    assert "EqualTo(status,k)" in text


def test_ranges_of_tables_on_one_base_share_a_scan(spark):
    source = event_source(spark, SF)
    ranges = {
        "co": backfill_range("2024-01-10T00:00:00Z", "2024-01-12T00:00:00Z"),
        "nox": backfill_range("2024-01-11T00:00:00Z", "2024-01-15T00:00:00Z"),
        "meteo": backfill_range("2024-01-20T00:00:00Z", "2024-01-19T00:00:00Z"),
    }
    together = hourly_long(source.readings_each(ranges))
    assert plan(together).count("FileScan") == 1 and plan(together).count("Exchange hashpartitioning") == 1
    apart = [row for key, within in ranges.items() for row in hourly_long(source.readings([key], within)).collect()]
    assert sorted(map(str, together.collect())) == sorted(map(str, apart)) and apart


def test_a_station_without_a_row_in_the_range_is_a_gap(spark, frame):
    rows = frame([("2024-01-01 10:05:00", "Norte", "k", 1.0), ("2024-01-01 12:05:00", "Sur", "k", 1.0)])
    source = ReadingSource.from_frames({"co": rows})
    start, end = "2024-01-01T10:00:00Z", "2024-01-01T11:00:00Z"
    gaps = coverage_gaps(source.readings(["co"], backfill_range(start, end)), start, end, by_location=True)
    assert [row["location"] for row in gaps.collect()] == ["Sur"]


def test_state_of_a_long_log(spark, tmp_path):
    path = str(tmp_path / "state")
    state = StateLog(spark, path)
    hours = spark.range(10_000).select(
        F.concat(F.lit("p"), F.col("id") % 5).alias("pipeline"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("updated_at"),
        F.timestamp_seconds(F.lit(1_600_000_000) + F.col("id") * 3600).alias("last_processed_hour"),
        F.lit("v").alias("version"),
        F.create_map(F.lit("n"), F.col("id").cast("string")).alias("metadata"),
    )
    hours.select(*STATE_SCHEMA.fieldNames()).write.mode("append").partitionBy("pipeline").parquet(path)
    names = [f"p{i}" for i in range(5)] + ["none"]
    before = state.load_all(names)
    assert before["p4"].metadata == {"n": "9999"} and before["none"].last_processed_hour is None
    state.compact()
    assert state.load_all(names) == before
    assert state.entries().count() == 5
    state.set_last_processed_hour("p4", "2024-01-01T00:00:00Z")
    assert state.get_last_processed_hour("p4") == datetime(2024, 1, 1, tzinfo=timezone.utc)


def test_jobs_of_a_run(spark, tmp_path):
    source = event_source(spark, SF)
    state = StateLog(spark, str(tmp_path / "state"))
    state.set_last_processed_hour("hourly", "2024-01-05T00:00:00Z")
    spark.sparkContext.setJobGroup("one-run", "")
    run_incremental(source, state, [], as_of=datetime(2024, 1, 6, tzinfo=timezone.utc))
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("one-run"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < jobs <= 8


def stream_of(spark, folder, rows):
    rows.write.parquet(folder)
    return spark.readStream.schema(rows.schema).parquet(folder)


def long_rows(spark, location):
    return spark.range(2_000).select(
        F.timestamp_seconds(F.lit(1_704_067_200) + (F.col("id") % 72) * 3600).alias("time"),
        location.alias("location"),
        F.lit("co").alias("metrica"),
        F.lit(1.0).alias("valor"),
        F.lit(1).cast("bigint").alias("count_ok"),
        F.lit("v").alias("version"),
    )


def test_files_of_a_stream(spark, tmp_path):
    rows = long_rows(spark, F.concat(F.lit("s"), F.col("id")))
    stream = stream_of(spark, str(tmp_path / "in"), rows)
    out = str(tmp_path / "out")
    start_hourly_stream(stream, out, str(tmp_path / "c"), files_per_day=2).awaitTermination()
    assert sorted(map(str, read_hours(spark, out).collect())) == sorted(map(str, rows.collect()))
    assert len(list((tmp_path / "out").glob("date=*/*.parquet"))) <= 3 * 2


def test_stream_names_missing_locations_when_told(spark, tmp_path):
    rows = long_rows(spark, F.lit(None).cast("string"))
    stream = stream_of(spark, str(tmp_path / "in"), rows)
    out = str(tmp_path / "out")
    start_hourly_stream(stream, out, str(tmp_path / "c"), missing_location="unknown").awaitTermination()
    assert [r[0] for r in read_hours(spark, out).select("location").distinct().collect()] == ["unknown"]
    with pytest.raises(Exception, match="null in required column"):
        start_hourly_stream(stream, str(tmp_path / "o2"), str(tmp_path / "c2")).awaitTermination()


def test_hours_of_an_empty_folder(spark, tmp_path):
    (tmp_path / "out").mkdir()
    hours = read_hours(spark, str(tmp_path / "out"))
    assert hours.columns == OUTPUT_COLUMNS and hours.count() == 0


def test_gate_of_a_run(spark, frame, tmp_path, caplog):
    rows = frame([("2024-01-01 10:05:00", "Norte", "?", 1.0), ("2024-01-01 10:06:00", "Norte", "k", 1.0)])
    source = ReadingSource.from_frames({"co": rows})
    run_backfill(source, "2024-01-01T10:00:00Z", "2024-01-01T11:00:00Z", [], ["co"], gate=True)
    assert "such as ['?']" in caplog.text
    with pytest.raises(DataValidationError, match="empty"):
        run_backfill(source, "2024-02-01T10:00:00Z", "2024-02-01T11:00:00Z", [], ["co"], gate=True)


def test_rows_of_the_adapter(spark):
    columns = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double"
    rows = [
        (1, datetime(2024, 1, 1, 10), 0, "signup", 8.01),
        (2, datetime(2024, 1, 1, 11), 3, "click", 301.5),
        (3, datetime(2024, 1, 1, 12), 4, "error", 0.5),
    ]
    frame = spark.createDataFrame(rows, columns)
    wide = wide_readings(spark, frame).orderBy("event_id")
    names = ["location", "co_status", "nox_status", "meteo_status", "co_mean", "no_mean", "o3_mean", "temp_mean"]
    assert [tuple(r) for r in wide.select(*names).collect()] == [
        ("Centro", "v", "k", "k", 8.0, 8.0, 6.0, -12.0),
        ("Este", "x", "x", "k", 301.5, 301.5, None, 281.5),
        ("Oeste", "m", "m", "m", None, 0.5, 0.375, -19.5),
    ]


def test_the_raw_adapter_keeps_values(spark):
    base = raw_event_source(spark, SF).readings(["nox"])[0].rows
    joined = base.join(events(spark, SF).select("event_id", "value"), "event_id")
    assert joined.where(F.col("no_mean") != F.col("value")).count() == 0


def test_marks_of_a_catch_up_start_at_whole_hours():
    from airhour.plans.runs import _missing

    last = datetime(2024, 1, 1, 9, 30, tzinfo=timezone.utc)
    assert _missing(last, last + timedelta(hours=3)) == (datetime(2024, 1, 1, 10, tzinfo=timezone.utc), 2)
    assert _missing(last, last)[1] <= 0
