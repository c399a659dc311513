"""The stream against the batch aggregate."""

import pytest
from pyspark.sql import functions as F

from airhour.operators.hourly import hourly_long
from airhour.schema import OUTPUT_COLUMNS
from airhour.session import prepare_streaming
from airhour.sources.events import STATUS_COLUMNS, events, wide_readings
from airhour.sources.readings import ReadingSource
from airhour.streaming.hourly import read_hours, read_stream, start_hourly_stream, stream_hourly_long

SF = "/root/testdata/sf0.001"


class Feed:
    """A folder of event files, a stream over it and a batch over the same rows."""

    def __init__(self, spark, folder):
        self.spark = prepare_streaming(spark)
        self.inbox, self.out, self.checkpoint = (str(folder / n) for n in ("inbox", "out", "checkpoint"))
        self.all = events(spark, SF).cache()

    def drop(self, condition):
        self.all.where(condition).coalesce(1).write.mode("append").parquet(self.inbox)

    def run(self, tables=None, delay="0 seconds"):
        stream = read_stream(self.spark, self.inbox, self.all.schema)
        source = ReadingSource.from_wide(wide_readings(self.spark, stream), status=STATUS_COLUMNS)
        long = stream_hourly_long(source, tables, "v", delay)
        start_hourly_stream(long, self.out, self.checkpoint).awaitTermination()
        return self.read()

    def read(self):
        return sorted(map(str, read_hours(self.spark, self.out).collect()))

    def batch(self, condition, until, tables=None):
        rows = wide_readings(self.spark, self.all.where(condition))
        source = ReadingSource.from_wide(rows, status=STATUS_COLUMNS)
        long = hourly_long(source.readings(tables), "v")
        return sorted(map(str, long.where(F.col("time") < F.lit(until)).collect()))


DAY1 = "ts < '2024-01-02'"
DAY2 = "ts >= '2024-01-02' AND ts < '2024-01-03'"
LAST_HOUR_1 = "2024-01-01 23:00:00"
LAST_HOUR_2 = "2024-01-02 23:00:00"


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def newest_valid_hour(feed, condition, tables):
    """Start of the hour that is still open after all rows of ``condition``."""
    rows = wide_readings(feed.spark, feed.all.where(condition))
    keys = tables or list(STATUS_COLUMNS)
    valid = " OR ".join(f"{STATUS_COLUMNS[k]} = 'k'" for k in keys)
    return rows.where(valid).agg(F.date_format(F.date_trunc("hour", F.max("time")), "yyyy-MM-dd HH:mm:ss")).first()[0]


@pytest.mark.parametrize("tables", [None, ["co"]])
def test_closed_hours_equal_the_batch(feed, tables):
    feed.drop(DAY1)
    open_hour = newest_valid_hour(feed, DAY1, tables)
    first = feed.run(tables)
    assert first and first == feed.batch(DAY1, open_hour, tables)

    feed.drop(DAY2)
    open_hour = newest_valid_hour(feed, DAY2, tables)
    second = feed.run(tables)
    assert len(second) > len(first)
    assert second == feed.batch(f"({DAY1}) OR ({DAY2})", open_hour, tables)

    assert feed.run(tables) == second


def test_late_rows_are_dropped(feed):
    feed.drop(f"({DAY1}) AND event_type = 'click'")
    feed.drop(DAY2)
    before = feed.run(["co"])
    feed.drop(f"({DAY1}) AND event_type = 'view'")
    assert feed.run(["co"]) == before


def test_delay_keeps_hours_open(feed):
    feed.drop(DAY1)
    assert len(feed.run(["co"], "6 hours")) < len(feed.batch(DAY1, LAST_HOUR_1, ["co"]))


def test_output_has_the_fact_columns(feed, spark):
    feed.drop(DAY1)
    feed.run(["meteo"])
    assert read_hours(spark, feed.out).columns == OUTPUT_COLUMNS
    assert "date" in spark.read.parquet(feed.out).columns


def test_files_per_trigger(feed, spark):
    feed.drop(DAY1)
    feed.drop(DAY2)
    stream = read_stream(spark, feed.inbox, feed.all.schema, files_per_trigger=1)
    source = ReadingSource.from_wide(wide_readings(spark, stream), status=STATUS_COLUMNS)
    query = start_hourly_stream(stream_hourly_long(source, ["co"], "v"), feed.out, feed.checkpoint)
    query.awaitTermination()
    assert feed.read() == feed.batch(
        f"({DAY1}) OR ({DAY2})", newest_valid_hour(feed, DAY2, ["co"]), ["co"]
    )
