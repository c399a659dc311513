"""Queries over the driver's tables, one function per capability.

Each takes a session and a data folder and gives a lazy DataFrame over whole
tables. Zone-free ``time`` columns match what other engines return.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import Catalog
from ..functions.naming import metric_name
from ..functions.time import (
    add_hours,
    ensure_utc,
    get_current_hour_start,
    get_previous_hour_start,
    iter_hours,
    truncate_to_hour,
)
from ..operators.coverage import coverage_gaps, coverage_present, missing_hours
from ..operators.hourly import hourly_long, hourly_long_fetched, hourly_wide, naive_timestamps
from ..operators.partials import finish, hourly_partials, merge_partials
from ..operators.presence import PresenceTable, gap_hours, gap_intervals, presence_days
from ..operators.quality import (
    null_profile,
    quality_score,
    table_quality,
    table_range_report,
    table_status_report,
    validation_profile,
)
from ..operators.sketches import (
    RANK_BOUND,
    SketchTable,
    daily_sketches,
    measured_ranks,
    merge_sketches,
    range_report_by,
    sketch_quantiles,
    status_report_by,
)
from ..schema import OUTPUT_COLUMNS, validate_output_schema
from ..session import prepare, prepare_streaming, scratch_path
from ..sinks.clustering import compact_clustered, folder_bytes, write_clustered
from ..sinks.tables import (
    AppendSink,
    HourPartitionSink,
    NarrowTableSink,
    ReportSink,
    RunAppendSink,
    Sink,
    TablePartitionSink,
    export,
    materialise,
)
from ..sources.events import (
    STATUS_COLUMNS,
    event_source,
    event_state_log,
    events,
    raw_event_source,
    separate_event_source,
    wide_readings,
)
from ..sources.ranges import backfill_range, incremental_range
from ..sources.readings import ReadingSource
from ..streaming.gate import GatedStream, gate_rules
from ..streaming.hourly import read_hours, read_stream, start_hourly_stream, stream_hourly_long
from ..streaming.late import LateHours
from .runs import backfill_from_state, run_backfill, run_incremental, run_tables_apart
from .state import StateLog, latest_entry, latest_state, merge_metadata, metadata_value, next_hour

# The version tag and the ranges that the queries use.
VERSION = "v1.0.0"
RANGE_START = "2024-01-05T10:30:00Z"
RANGE_END = "2024-01-19T08:15:00Z"
ONE_HOUR = "2024-01-12T18:00:00Z"
COVERAGE_START = "2024-01-01T00:00:00Z"
COVERAGE_END = "2024-02-01T00:00:00Z"
STREAM_DELAY = "3 hours"
RUN_START = "2023-12-31T22:00:00Z"
ONE_HOUR_END = "2024-01-12T19:00:00Z"
AGAIN_START = "2024-01-10T08:00:00Z"
AGAIN_END = "2024-01-10T18:00:00Z"
AGAIN_TABLES = ["co", "nox"]
EMPTIED_START = "2024-01-08T06:00:00Z"
EMPTIED_END = "2024-01-11T09:00:00Z"
UNREADABLE = "so2"
CLUSTERED_STATION = "Norte"
LATE_TYPES = ["error", "view"]
GATE_PARTS = [["click", "signup"], ["view"], ["purchase", "error"]]
AGAIN_VERSION = "v2.0.0"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return naive_timestamps(query(prepare(spark), sf_dir))

    run.__name__ = query.__name__
    run.__doc__ = query.__doc__
    QUERIES[query.__name__] = run
    return query


def moments_of(df: DataFrame, *aggregates: Column) -> list[datetime]:
    """Times aggregated from all rows: one row, read ahead, as bounds must be literals to reach the scan."""
    row = df.agg(*[F.unix_micros(aggregate) for aggregate in aggregates]).first()
    return [datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=micros) for micros in row]


def clock(spark: SparkSession, sf_dir: str) -> datetime:
    """The newest event time; it stands in for now, so results do not depend on the day."""
    return moments_of(events(spark, sf_dir), F.max(ensure_utc(F.col("ts"))))[0]


def last_processed(spark: SparkSession, sf_dir: str) -> datetime:
    """The oldest mark among the pipelines of the event state log."""
    return moments_of(latest_state(event_state_log(spark, sf_dir)), F.min("last_processed_hour"))[0]


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_long(event_source(spark, sf_dir).readings(), VERSION)


# Scans


@register
def table_scan_nox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole table, configured columns only."""
    return event_source(spark, sf_dir).fetch_table("nox")


@register
def wide_scan_all_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table configured with ``*``."""
    frames = {"base": wide_readings(spark, events(spark, sf_dir))}
    source = ReadingSource.from_frames(frames, catalog=Catalog({"base": ("base", ["*"])}))
    return source.fetch_table("base")


@register
def range_scan_co(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explicit half-open range."""
    return event_source(spark, sf_dir).fetch_data("co", RANGE_START, RANGE_END)


@register
def open_start_scan_so2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only an end is given."""
    return event_source(spark, sf_dir).fetch_data("so2", None, RANGE_END)


@register
def open_end_scan_o3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only a start is given: until the clock."""
    return event_source(spark, sf_dir).fetch_data("o3", RANGE_START, None, clock(spark, sf_dir))


@register
def previous_hour_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No bound is given: the last completed hour."""
    return event_source(spark, sf_dir).fetch_data("co", as_of=clock(spark, sf_dir))


@register
def single_hour_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_source(spark, sf_dir).fetch_specific_hour("pm10", ONE_HOUR)


@register
def incremental_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the state to the running hour."""
    source = event_source(spark, sf_dir)
    return source.fetch_incremental_data("co", last_processed(spark, sf_dir), clock(spark, sf_dir))


# Columns


@register
def metric_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir)
    column = F.concat_ws("_mean_", F.col("event_type"), F.col("user_id").cast("string"), F.lit("mean"))
    return rows.select("event_id", metric_name(column).alias("metrica"))


@register
def time_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO text with an offset, hour arithmetic and truncation on every event."""
    rows = events(spark, sf_dir).withColumn("time", ensure_utc(F.col("ts")))
    text = F.concat(F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:00"))
    return rows.select(
        "event_id",
        ensure_utc(text).alias("from_text"),
        add_hours(F.col("time"), 26).alias("later"),
        add_hours(F.col("time"), -3).alias("earlier"),
        truncate_to_hour(F.col("time")).alias("hour"),
        get_current_hour_start(F.col("time")).alias("current_hour"),
        get_previous_hour_start(F.col("time")).alias("previous_hour"),
    )


@register
def conform_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events, with some columns missing, some extra and some of another type."""
    raw = events(spark, sf_dir).select(
        F.col("props"), F.col("event_id").alias("valor"), F.col("event_type").alias("metrica"), F.col("ts").alias("time")
    )
    return validate_output_schema(raw)


# Aggregates


@register
def hourly_long_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six tables, long."""
    return hourly(spark, sf_dir)


@register
def hourly_long_separate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same when every table is stored by itself: one aggregate each and a union."""
    return hourly_long(separate_event_source(spark, sf_dir).readings(), VERSION)


@register
def hourly_wide_meteo(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = event_source(spark, sf_dir).readings(["meteo"])[0]
    return hourly_wide(item.frame(), list(item.table.metrics))


@register
def backfill_two_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All hours of a range, two tables."""
    source = event_source(spark, sf_dir)
    return hourly_long(source.readings(["co", "nox"], backfill_range(RANGE_START, RANGE_END)), VERSION)


@register
def incremental_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an incremental run computes."""
    within = incremental_range(last_processed(spark, sf_dir), clock(spark, sf_dir))
    return hourly_long(event_source(spark, sf_dir).readings(None, within), VERSION)


@register
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per metric: readings fetched, valid readings, and hourly rows."""
    counted = hourly_long_fetched(event_source(spark, sf_dir).readings(), VERSION)
    return counted.groupBy("metrica").agg(
        F.sum("fetched").alias("fetched"),
        F.sum("count_ok").alias("valid_readings"),
        F.count_if(F.col("count_ok") > 0).alias("hourly_rows"),
    )


# Hours and coverage


@register
def hour_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hour between the first and the newest event, with the readings in it."""
    rows = events(spark, sf_dir).select(ensure_utc(F.col("ts")).alias("time"))
    spine = iter_hours(spark, *moments_of(rows, F.min("time"), F.max("time")))
    counted = rows.groupBy(truncate_to_hour(F.col("time")).alias("hour")).agg(F.count(F.lit(1)).alias("rows"))
    return spine.join(counted, "hour", "left").select("hour", F.coalesce("rows", F.lit(0)).alias("rows"))


@register
def missing_hours_by_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = latest_state(event_state_log(spark, sf_dir)).select("pipeline", "last_processed_hour")
    return missing_hours(states, clock(spark, sf_dir)).select("pipeline", "hour")


@register
def missing_hours_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five missing hours of any pipeline, and how many pipelines miss each."""
    missing = missing_hours_by_pipeline(spark, sf_dir)
    return missing.groupBy("hour").agg(F.count(F.lit(1)).alias("pipelines")).orderBy("hour").limit(5)


@register
def coverage_gaps_by_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested hours without data, per table and location."""
    readings = event_source(spark, sf_dir).readings(None, backfill_range(COVERAGE_START, COVERAGE_END))
    return coverage_gaps(readings, COVERAGE_START, COVERAGE_END, by_location=True)


@register
def coverage_gaps_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = event_source(spark, sf_dir).readings(None, backfill_range(COVERAGE_START, COVERAGE_END))
    return coverage_gaps(readings, COVERAGE_START, COVERAGE_END)


@register
def coverage_present_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = event_source(spark, sf_dir).readings(None, backfill_range(COVERAGE_START, COVERAGE_END))
    return coverage_present(readings, COVERAGE_START, COVERAGE_END)


# Quality


@register
def status_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_status_report(event_source(spark, sf_dir).readings())


@register
def range_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_range_report(event_source(spark, sf_dir).readings())


@register
def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_profile(wide_readings(spark, events(spark, sf_dir)))


@register
def gate_profile_co(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the validation gate judges by."""
    return validation_profile(event_source(spark, sf_dir).fetch_table("co"), "co")


@register
def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One score per table."""
    return table_quality(event_source(spark, sf_dir).readings())


@register
def quality_scores_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One score per table, hour and location."""
    keys = {"hour": truncate_to_hour(F.col("time")), "location": F.col("location")}
    return table_quality(event_source(spark, sf_dir).readings(), keys)


@register
def quality_score_co(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of one frame."""
    return quality_score(event_source(spark, sf_dir).fetch_table("co"))


def whole_millionths(df: DataFrame, *columns: str) -> DataFrame:
    """Values cut to whole millionths. The offset keeps short decimals off the edges, where the last bit would decide."""
    return df.withColumns({c: F.floor(F.col(c) * 1e6 + 0.3712345).cast("double") / 1e6 for c in columns})


@register
def hourly_long_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly means of the values as they are."""
    return whole_millionths(hourly_long(raw_event_source(spark, sf_dir).readings(), VERSION), "valor")


@register
def hourly_wide_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table of the values as they are, a column per metric."""
    item = raw_event_source(spark, sf_dir).readings(["meteo"])[0]
    metrics = list(item.table.metrics)
    return whole_millionths(hourly_wide(item.frame(), metrics), *metrics)


@register
def ordered_scan_co(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range in the order of time."""
    return event_source(spark, sf_dir).fetch_data("co", RANGE_START, RANGE_END, ordered=True)


@register
def coverage_gaps_silent_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One hour, in which some stations have no row at all."""
    readings = event_source(spark, sf_dir).readings(None, backfill_range(ONE_HOUR, ONE_HOUR_END))
    return coverage_gaps(readings, ONE_HOUR, ONE_HOUR_END, by_location=True)


@register
def coverage_gaps_silent_station_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hour of the month in which the fewest stations have a row: the stations that are silent in it."""
    rows = events(spark, sf_dir).select(ensure_utc(F.col("ts")).alias("time"), (F.col("user_id") % 5).alias("station"))
    within = backfill_range(COVERAGE_START, COVERAGE_END)
    hours = rows.where(within.predicate()).groupBy(truncate_to_hour(F.col("time")).alias("hour")).agg(F.count_distinct("station").alias("n"))
    quiet = moments_of(hours, F.min_by("hour", F.struct("n", "hour")))[0]
    readings = event_source(spark, sf_dir).readings(None, backfill_range(quiet, quiet + timedelta(hours=1)))
    return coverage_gaps(readings, quiet, quiet + timedelta(hours=1), by_location=True)


@register
def presence_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bitmaps of two overlapping ranges, one of them added twice."""
    table = PresenceTable(spark, scratch_path(spark, "presence"))
    source = event_source(spark, sf_dir)
    for start, end in ((COVERAGE_START, RANGE_END), (RANGE_START, COVERAGE_END), (RANGE_START, COVERAGE_END)):
        table.add(presence_days(source.readings(None, backfill_range(start, end))))
    return table.read().select("pollutant", "location", "date", "hours")


@register
def gap_intervals_by_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of hours without data, per table and location, from bitmaps of whole tables."""
    days = presence_days(event_source(spark, sf_dir).readings())
    return gap_intervals(days, COVERAGE_START, COVERAGE_END)


@register
def gap_hours_by_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The single hours of a range within the month that begins and ends inside a day."""
    days = presence_days(event_source(spark, sf_dir).readings())
    return gap_hours(gap_intervals(days, RANGE_START, RANGE_END))


@register
def clustered_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings of all tables laid out by hour and station, compacted, then a narrow range of one station."""
    path = scratch_path(spark, "clustered")
    rows = wide_readings(spark, events(spark, sf_dir))
    write_clustered(rows, path, 16, group_bytes=64 << 10)
    compact_clustered(spark.read.parquet(path), path, folder_bytes(spark, path), file_bytes=1 << 20, group_bytes=64 << 10)
    source = ReadingSource.from_wide(spark.read.parquet(path), status=STATUS_COLUMNS)
    return source.fetch_data("meteo", ONE_HOUR, RANGE_END).where(F.col("location") == CLUSTERED_STATION)


# Checks by hour and station, sketches


@register
def range_checks_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values in and out of range per metric, hour and location."""
    return range_report_by(event_source(spark, sf_dir).readings())


@register
def status_checks_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid, null and unknown statuses per table, hour and location."""
    return status_report_by(event_source(spark, sf_dir).readings())


@register
def sketch_days_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that the stored sketches of each day and location have seen; the days of two weeks are written again."""
    table = SketchTable(spark, scratch_path(spark, "sketches"))
    source = event_source(spark, sf_dir)
    for within in (None, backfill_range("2024-01-05T00:00:00Z", "2024-01-19T00:00:00Z")):
        table.put(daily_sketches(source.readings(None, within)))
    seen = F.kll_sketch_get_n_double("sketch").alias("n")
    return table.read().select("pollutant", "metric", "location", "date", seen)


@register
def sketch_quantiles_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deciles of each metric from merged sketches of all days and locations; whether their measured ranks keep the bound."""
    readings = event_source(spark, sf_dir).readings()
    whole = merge_sketches(daily_sketches(readings), "pollutant", "metric")
    measured = measured_ranks(readings, sketch_quantiles(whole))
    close = (F.col("rank_below") - RANK_BOUND <= F.col("rank")) & (F.col("rank") <= F.col("rank_reached") + RANK_BOUND)
    return measured.select("pollutant", "metric", "rank", "n", close.alias("within_bound"))


@register
def hourly_from_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly means from partials of two deliveries of the rows, merged."""
    late = F.col("event_type").isin(LATE_TYPES)
    parts = []
    for condition in (~late, late):
        base = wide_readings(spark, events(spark, sf_dir).where(condition))
        parts.append(hourly_partials(ReadingSource.from_wide(base, status=STATUS_COLUMNS).readings()))
    return finish(merge_partials(parts[0].unionByName(parts[1])), VERSION)


# Sinks: each query writes to a new folder and reads it back


@register
def append_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends: every row is there twice."""
    sink = AppendSink(path=scratch_path(spark, "append"))
    kept, rows = materialise(hourly(spark, sf_dir))
    export(kept, [sink], rows)
    export(kept, [sink], rows)
    return spark.read.parquet(sink.path)


@register
def partition_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All hours written, then a range of them again: no row is there twice."""
    sink = HourPartitionSink(path=scratch_path(spark, "partitions"), unit="day")
    source = event_source(spark, sf_dir)
    export(hourly_long(source.readings(), VERSION), [sink])
    days = backfill_range("2024-01-05T00:00:00Z", "2024-01-07T00:00:00Z")
    export(hourly_long(source.readings(None, days), "v2.0.0"), [sink])
    return spark.read.parquet(sink.path).select(*OUTPUT_COLUMNS)


@register
def partition_subset_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables, then ten hours of two of them: the rows of the others stay."""
    sink = HourPartitionSink(path=scratch_path(spark, "partitions"), unit="day")
    source = event_source(spark, sf_dir)
    run_backfill(source, COVERAGE_START, COVERAGE_END, [sink], None, VERSION)
    run_backfill(source, AGAIN_START, AGAIN_END, [sink], AGAIN_TABLES, AGAIN_VERSION)
    return spark.read.parquet(sink.path).select(*OUTPUT_COLUMNS)


@register
def partition_one_hour_of_a_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days, then a single hour of one of them: its other hours stay."""
    sink = HourPartitionSink(path=scratch_path(spark, "partitions"), unit="day")
    source = event_source(spark, sf_dir)
    run_backfill(source, COVERAGE_START, COVERAGE_END, [sink], None, VERSION)
    run_backfill(source, ONE_HOUR, ONE_HOUR_END, [sink], None, AGAIN_VERSION)
    return spark.read.parquet(sink.path).select(*OUTPUT_COLUMNS)


@register
def partition_emptied_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All hours, then a range whose readings have gone in part: what is not there any more goes from the target."""
    sink = HourPartitionSink(path=scratch_path(spark, "partitions"))
    run_backfill(event_source(spark, sf_dir), COVERAGE_START, COVERAGE_END, [sink], None, VERSION)
    left = events(spark, sf_dir).where(F.hour("ts") != 12)
    source = ReadingSource.from_wide(wide_readings(spark, left), status=STATUS_COLUMNS)
    run_backfill(source, AGAIN_START, AGAIN_END, [sink], None, AGAIN_VERSION)
    return spark.read.parquet(sink.path).select(*OUTPUT_COLUMNS)


@register
def append_verified_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the target as the sink counts them, after each of two loads."""
    sink = AppendSink(path=scratch_path(spark, "append"))
    kept, rows = materialise(hourly(spark, sf_dir))
    loads = []
    for load in (1, 2):
        export(kept, [sink], rows)
        loads.append((load, sink.row_count(spark)))
    return spark.createDataFrame(loads, "load bigint, rows bigint")


@register
def narrow_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """32-bit values, widened again."""
    path = scratch_path(spark, "narrow")
    sink = NarrowTableSink(table=f"airhour_{path.rsplit('-', 1)[1]}", location=path)
    export(hourly(spark, sf_dir), [sink])
    spark.sql(f"DROP TABLE {sink.table}")
    return validate_output_schema(spark.read.parquet(path))


@register
def report_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = ReportSink(path=scratch_path(spark, "report"))
    export(hourly(spark, sf_dir), [sink])
    schema = "time timestamp_ntz, location string, metrica string, valor double, count_ok bigint, version string"
    return spark.read.schema(schema).csv(sink.written, header=True)


@register
def fan_out_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One result to two sinks; rows per location in each."""
    append = AppendSink(path=scratch_path(spark, "append"))
    hours = HourPartitionSink(path=scratch_path(spark, "partitions"), unit="day")
    export(hourly(spark, sf_dir), [append, hours, AppendSink(name="unconfigured")])

    def counted(path: str, name: str) -> DataFrame:
        rows = spark.read.parquet(path).groupBy("location").agg(F.count(F.lit(1)).alias("rows"))
        return rows.select(F.lit(name).alias("sink"), "location", "rows")

    return counted(append.path, append.name).unionByName(counted(hours.path, hours.name))


# State


@register
def state_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_state(event_state_log(spark, sf_dir))


@register
def state_next_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = latest_state(event_state_log(spark, sf_dir))
    return states.select("pipeline", next_hour(F.col("last_processed_hour"), clock(spark, sf_dir)).alias("next_hour"))


@register
def state_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A metadata update on every entry, then reads with and without a default."""
    log = event_state_log(spark, sf_dir)

    def entries(**items: Column) -> Column:
        return F.create_map(*[part for key, value in items.items() for part in (F.lit(key), value)])

    old = entries(pipeline_version=F.lit(VERSION), origin=F.col("version"))
    new = entries(pipeline_version=F.col("version"), last_execution=F.col("props"))
    metadata = merge_metadata(old, new)
    return log.select(
        "pipeline",
        "updated_at",
        metadata_value(metadata, "pipeline_version").alias("pipeline_version"),
        metadata_value(metadata, "origin").alias("origin"),
        metadata_value(metadata, "last_execution").alias("last_execution"),
        metadata_value(metadata, "last_backfill", "never").alias("last_backfill"),
        F.size(metadata).cast("bigint").alias("entries"),
    )


@register
def state_fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pipeline without an entry, and its next hour by the newest event."""
    state, _ = run_target(spark)
    fresh = state.load("hourly")
    following = state.get_next_hour_to_process("hourly", clock(spark, sf_dir))
    row = spark.createDataFrame(
        [(fresh.pipeline, fresh.version, len(fresh.metadata))], "pipeline string, version string, entries bigint"
    )
    return row.withColumns(
        {"last_processed_hour": F.lit(fresh.last_processed_hour).cast("timestamp"), "next_hour": ensure_utc(following)}
    )


# Runs: each query works on a state log and a target of its own


def run_target(spark: SparkSession) -> tuple[StateLog, HourPartitionSink]:
    path = scratch_path(spark, "run")
    return StateLog(spark, f"{path}/state"), HourPartitionSink(path=f"{path}/facts", unit="day")


@register
def incremental_runs_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs after one another, then a third without new hours: each hour is there once."""
    source = event_source(spark, sf_dir)
    state, _ = run_target(spark)
    sink = AppendSink(path=scratch_path(spark, "facts"))
    state.set_last_processed_hour("hourly", RUN_START)
    now = clock(spark, sf_dir)
    for as_of in (now - timedelta(days=2), now, now):
        run_incremental(source, state, [sink], version=VERSION, as_of=as_of)
    return spark.read.parquet(sink.path)


@register
def backfill_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping backfills of whole days, all tables; the second replaces the days they share."""
    source = event_source(spark, sf_dir)
    sink = TablePartitionSink(path=scratch_path(spark, "tables"))
    for start, end in ((COVERAGE_START, "2024-01-19T00:00:00Z"), ("2024-01-05T00:00:00Z", COVERAGE_END)):
        run_backfill(source, start, end, [sink], None, VERSION)
    return spark.read.parquet(sink.path).select(*OUTPUT_COLUMNS)


@register
def table_partition_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables by date and table, then ten hours of a day of two of them: all else stays."""
    sink = TablePartitionSink(path=scratch_path(spark, "tables"))
    source = event_source(spark, sf_dir)
    run_backfill(source, COVERAGE_START, COVERAGE_END, [sink], None, VERSION)
    run_backfill(source, AGAIN_START, AGAIN_END, [sink], AGAIN_TABLES, AGAIN_VERSION)
    return spark.read.parquet(sink.path).select(*OUTPUT_COLUMNS)


def emptied(spark: SparkSession, sf_dir: str, sink: HourPartitionSink | TablePartitionSink) -> DataFrame:
    """All hours, then a backfill of a range whose readings have all gone."""
    run_backfill(event_source(spark, sf_dir), COVERAGE_START, COVERAGE_END, [sink], None, VERSION)
    gone = ensure_utc(F.col("ts")).between(ensure_utc(EMPTIED_START), ensure_utc(EMPTIED_END))
    left = ReadingSource.from_wide(wide_readings(spark, events(spark, sf_dir).where(~gone)), status=STATUS_COLUMNS)
    run_backfill(left, EMPTIED_START, EMPTIED_END, [sink], None, VERSION)
    return spark.read.parquet(sink.path).select(*OUTPUT_COLUMNS)


@register
def table_partition_emptied_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backfill without any row removes what the target has of its range: whole days, and hours of a day."""
    return emptied(spark, sf_dir, TablePartitionSink(path=scratch_path(spark, "tables")))


@register
def partition_emptied_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in partitions by day alone."""
    return emptied(spark, sf_dir, HourPartitionSink(path=scratch_path(spark, "partitions"), unit="day"))


class _Failing(Sink):
    """Stands for what can stop a run after its rows are written and before its mark moves."""

    def write(self, df: DataFrame, rows: int, scope: object = None) -> None:
        raise RuntimeError("stopped")


@register
def append_runs_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that is stopped between sink and mark, an hour later again, and a further one: each hour is there once."""
    source = event_source(spark, sf_dir)
    state, _ = run_target(spark)
    sink = RunAppendSink(path=scratch_path(spark, "runs"))
    state.set_last_processed_hour("hourly", RUN_START)
    now = clock(spark, sf_dir)
    early = now - timedelta(days=2)
    for sinks, as_of in (([sink, _Failing()], early), ([sink], early + timedelta(hours=1)), ([sink], now)):
        try:
            run_incremental(source, state, sinks, version=VERSION, as_of=as_of)
        except RuntimeError:
            continue
    return sink.read(spark, state)


@register
def empty_run_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run without an hour to read writes nothing; the next one does. ``written`` counts the sinks of both."""
    source = event_source(spark, sf_dir)
    state, sink = run_target(spark)
    state.set_last_processed_hour("hourly", RUN_START)
    early = datetime.fromisoformat(RUN_START) + timedelta(hours=1)
    runs = [
        run_incremental(source, state, [sink], version=VERSION, as_of=as_of) for as_of in (early, clock(spark, sf_dir))
    ]
    written = F.lit(sum(len(run.written) for run in runs)).cast("bigint").alias("written")
    return spark.read.parquet(sink.path).select(*OUTPUT_COLUMNS, written)


@register
def stored_tables_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six tables stored by date; a run over them, then a backfill of two."""
    source = stored_event_source(spark, sf_dir)
    state, sink = run_target(spark)
    state.set_last_processed_hour("hourly", RUN_START)
    run_incremental(source, state, [sink], version=VERSION, as_of=clock(spark, sf_dir))
    run_backfill(source, AGAIN_START, AGAIN_END, [sink], AGAIN_TABLES, AGAIN_VERSION)
    return spark.read.parquet(sink.path).select(*OUTPUT_COLUMNS)


def stored_event_source(spark: SparkSession, sf_dir: str) -> ReadingSource:
    """The six tables written to the shared folder, each by date."""
    root = scratch_path(spark, "readings")
    for item in event_source(spark, sf_dir).readings():
        dated = item.frame().withColumn("date", F.to_date("time")).hint("rebalance", F.col("date"))
        dated.write.partitionBy("date").parquet(f"{root}/{item.table.table}")
    return ReadingSource.from_path(spark, root, date_col="date")


@register
def per_table_runs_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables with marks of their own: one is days ahead of the others, then all run up to the same hour."""
    source = event_source(spark, sf_dir)
    state, sink = run_target(spark)
    for key in source.catalog.keys:
        state.set_last_processed_hour(f"hourly-{key}", RUN_START)
    now = clock(spark, sf_dir)
    early = now - timedelta(days=2)
    run_incremental(source, state, [sink], ["co"], version=VERSION, as_of=early, per_table_state=True)
    run_incremental(source, state, [sink], version=VERSION, as_of=now, per_table_state=True)
    return spark.read.parquet(sink.path).select(*OUTPUT_COLUMNS)


@register
def tables_apart_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over six tables of which one cannot be read: the rows of the others, and the mark of each row's table."""
    shared = event_source(spark, sf_dir)
    frames = {key: shared.fetch_table(key) for key in shared.catalog.keys}
    frames[UNREADABLE] = frames[UNREADABLE].withColumn("location", F.raise_error(F.lit("unreadable")).cast("string"))
    state, sink = run_target(spark)
    for key in shared.catalog.keys:
        state.set_last_processed_hour(f"hourly-{key}", RUN_START)
    source = ReadingSource.from_frames(frames)
    outcomes = run_tables_apart(source, state, [sink], version=VERSION, as_of=clock(spark, sf_dir))
    failed = sorted(outcome.table for outcome in outcomes if outcome.error is not None)
    moved = latest_state(state.entries()).where(F.col("last_processed_hour") > ensure_utc(RUN_START)).count()
    facts = spark.read.parquet(sink.path).select(*OUTPUT_COLUMNS)
    return facts.withColumns({"failed": F.lit(",".join(failed)), "marks_moved": F.lit(moved).cast("bigint")})


@register
def catch_up_per_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The marks after a catch-up of tables with marks of their own."""
    source = event_source(spark, sf_dir)
    state, sink = run_target(spark)
    for key in source.catalog.keys:
        state.set_last_processed_hour(f"hourly-{key}", RUN_START)
    backfill_from_state(
        spark, source, state, [sink], version=VERSION, as_of=clock(spark, sf_dir), per_table_state=True
    )
    return latest_state(state.entries()).select("pipeline", "last_processed_hour")


@register
def catch_up_subset_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shared mark after a catch-up of some tables: unchanged. ``rows`` counts what was written."""
    state, sink = run_target(spark)
    state.set_last_processed_hour("hourly", RUN_START)
    source = event_source(spark, sf_dir)
    done = backfill_from_state(spark, source, state, [sink], AGAIN_TABLES, as_of=clock(spark, sf_dir))
    mark = latest_state(state.entries()).select("pipeline", "last_processed_hour")
    return mark.withColumn("rows", F.lit(done.rows).cast("bigint"))


def catch_up(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The state entry and the facts after a catch-up of all tables."""
    source = event_source(spark, sf_dir)
    state, sink = run_target(spark)
    state.set_last_processed_hour("hourly", RUN_START, VERSION)
    backfill_from_state(spark, source, state, [sink], None, "hourly", VERSION, clock(spark, sf_dir))
    return latest_entry(state.entries()), spark.read.parquet(sink.path).select(*OUTPUT_COLUMNS)


@register
def catch_up_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state after a catch-up; the metadata names the moment of it."""
    entry, _ = catch_up(spark, sf_dir)
    backfilled = ensure_utc(metadata_value(F.col("metadata"), "last_backfill"))
    return entry.select("pipeline", "last_processed_hour", "version", backfilled.alias("last_backfill"))


@register
def catch_up_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hours that a catch-up wrote."""
    return catch_up(spark, sf_dir)[1]


# Streaming


def streamed(spark: SparkSession, sf_dir: str, tables: list[str] | None, delay: str) -> DataFrame:
    prepare_streaming(spark)
    schema = events(spark, sf_dir).schema
    # As a pattern, the path may be one file as well as a folder of files.
    stream = read_stream(spark, f"{sf_dir}/[e]vents.parquet", schema)
    source = ReadingSource.from_wide(wide_readings(spark, stream), status=STATUS_COLUMNS)
    path = scratch_path(spark, "stream")
    long = stream_hourly_long(source, tables, VERSION, delay)
    start_hourly_stream(long, f"{path}/hours", f"{path}/checkpoint").awaitTermination()
    return read_hours(spark, f"{path}/hours")


@register
def stream_hourly_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All hours that the stream has closed, six tables in one query."""
    return streamed(spark, sf_dir, None, "0 seconds")


@register
def stream_hourly_delayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table, hours kept open for late rows."""
    return streamed(spark, sf_dir, ["co"], STREAM_DELAY)


@register
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of two kinds arrive after their hours were closed and written: all closed hours hold them."""
    prepare_streaming(spark)
    rows = events(spark, sf_dir)
    late = F.col("event_type").isin(LATE_TYPES)
    path = scratch_path(spark, "late")
    hours = LateHours(
        path, lambda batch: ReadingSource.from_wide(wide_readings(batch.sparkSession, batch), status=STATUS_COLUMNS),
        version=VERSION, unit="day",
    )
    for condition in (~late, late):
        rows.where(condition).write.mode("append").parquet(f"{path}/inbox")
        hours.start(read_stream(spark, f"{path}/inbox", rows.schema), f"{path}/checkpoint").awaitTermination()
    return hours.read(spark)


@register
def stream_gate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries of the rows, a batch each: read, valid and quarantined rows of a table under the strict gate."""
    prepare_streaming(spark)
    path = scratch_path(spark, "gate")
    gate = GatedStream(path, gate_rules("co", strict=True))
    rows = events(spark, sf_dir)
    for part in GATE_PARTS:
        rows.where(F.col("event_type").isin(part)).coalesce(1).write.mode("append").parquet(f"{path}/inbox")
        stream = wide_readings(spark, read_stream(spark, f"{path}/inbox", rows.schema))
        item = ReadingSource.from_wide(stream, status=STATUS_COLUMNS).readings(["co"])[0]
        gate.start(item.frame(), f"{path}/checkpoint").awaitTermination()
    return gate.counts(spark)
