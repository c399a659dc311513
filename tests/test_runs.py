"""State log, incremental runs and backfills."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from airhour.catalog import Catalog
from airhour.plans.runs import backfill_from_state, run_backfill, run_incremental
from airhour.plans.state import StateLog, latest_entry, latest_state, merge_metadata, metadata_value
from airhour.sinks.tables import AppendSink, HourPartitionSink, Sink
from airhour.sources.readings import ReadingSource


def at(hour, minute=0, day=15):
    return datetime(2024, 1, day, hour, minute, tzinfo=timezone.utc)


def iso(hour, minute=0, day=15):
    return at(hour, minute, day).isoformat()


@pytest.fixture
def state(spark, tmp_path):
    return StateLog(spark, str(tmp_path / "state"))


# State


def test_fresh_state(state):
    fresh = state.load("p")
    assert (fresh.last_processed_hour, fresh.version, fresh.metadata) == (None, "v1.0.0", {})
    assert state.get_last_processed_hour("p") is None
    assert state.get_next_hour_to_process("p", iso(11, 30)) == at(10)


def test_advance_and_next_hour(state):
    state.set_last_processed_hour("p", at(10))
    state.set_last_processed_hour("other", at(3))
    assert state.get_last_processed_hour("p") == at(10)
    assert state.get_next_hour_to_process("p", iso(20)) == at(11)
    state.set_last_processed_hour("p", "2024-01-15T13:00:00+02:00")
    assert state.get_last_processed_hour("p") == at(11)
    assert state.get_last_processed_hour("other") == at(3)


def test_reset_keeps_metadata(state):
    state.set_last_processed_hour("p", at(10), version="v2")
    state.update_metadata("p", "a", "1")
    state.reset_state("p")
    now = state.load("p")
    assert (now.last_processed_hour, now.version, now.metadata) == (None, "v2", {"a": "1"})
    assert latest_state(state.entries()).first()["last_processed_hour"] is None


def test_metadata(state):
    state.update_metadata("p", "a", "1")
    state.update_metadata("p", "b", "2")
    state.update_metadata("p", "a", "3")
    assert state.load("p").metadata == {"a": "3", "b": "2"}
    assert state.get_metadata("p", "a") == "3"
    assert state.get_metadata("p", "none", "default") == "default" and state.get_metadata("p", "none") is None
    assert state.entries().count() == 3


def test_entries_in_quick_succession_keep_their_order(state):
    for hour in range(6):
        state.set_last_processed_hour("p", at(hour))
    log = state.entries()
    assert log.select("updated_at").distinct().count() == 6
    assert state.get_last_processed_hour("p") == at(5)
    assert latest_entry(log).count() == 1


def test_pipeline_names_may_hold_odd_characters(state):
    for name in ("a/b", "x=1", "ñ o", "007"):
        state.set_last_processed_hour(name, at(10))
        assert state.get_last_processed_hour(name) == at(10)
    assert {r["pipeline"] for r in state.entries().collect()} == {"a/b", "x=1", "ñ o", "007"}


def test_metadata_columns(spark):
    rows = spark.sql(
        "SELECT map('a', '1', 'b', '2') AS old, map('b', '3', 'c', '4') AS new "
        "UNION ALL SELECT NULL, map('c', '4') UNION ALL SELECT map('a', '1'), NULL"
    )
    merged = rows.select(merge_metadata(F.col("old"), F.col("new")).alias("m"))
    assert [r["m"] for r in merged.collect()] == [{"a": "1", "b": "3", "c": "4"}, {"c": "4"}, {"a": "1"}]
    values = merged.select(metadata_value(F.col("m"), "a", "none"), metadata_value(F.col("m"), "a"))
    assert [tuple(r) for r in values.collect()] == [("1", "1"), ("none", None), ("1", "1")]


# Runs

CATALOG = Catalog({"co": ("co", ["co_mean"]), "o3": ("o3", ["o3_mean"])})


@pytest.fixture
def source(frame):
    """Two readings an hour of co from 8:00 to 17:00, o3 only before 12:00."""
    co = [(iso(h, m), "a", "k", float(h)) for h in range(8, 17) for m in (5, 35)]
    o3 = [(iso(h, 10), "b", "k", float(h)) for h in range(8, 12)]
    frames = {"co": frame(co), "o3": frame(o3, "o3_mean double")}
    return ReadingSource.from_frames(frames, catalog=CATALOG)


class Broken(Sink):
    name = "broken"

    def write(self, df, rows, scope=None):
        raise RuntimeError("target is down")


def hours(spark, path):
    rows = spark.read.parquet(path)
    return sorted((r["metrica"], r["h"]) for r in rows.withColumn("h", F.hour("time")).collect())


def test_first_run_reads_the_previous_hour(source, state):
    done = run_incremental(source, state, [], as_of=at(11, 30))
    assert (done.rows, done.rows_by_table, done.advanced) == (2, {"co": 1, "o3": 1}, ["hourly"])
    assert state.get_last_processed_hour("hourly") == at(10)
    meta = state.load("hourly").metadata
    assert meta["pipeline_version"] == "v1.0.0" and meta["last_execution"] == iso(11, 30)


def test_runs_split_the_hours_exactly(spark, source, state, tmp_path):
    sink = AppendSink(path=str(tmp_path / "facts"))
    for clock in (at(11, 30), at(12, 30), at(12, 59), at(15, 1)):
        run_incremental(source, state, [sink], as_of=clock, version="v3")
    assert hours(spark, sink.path) == [("co", h) for h in range(10, 15)] + [("o3", h) for h in (10, 11)]
    assert state.get_last_processed_hour("hourly") == at(14)
    assert state.load("hourly").version == "v3"


def test_no_rows_leave_the_state(source, state):
    state.set_last_processed_hour("hourly", at(20))
    done = run_incremental(source, state, [], as_of=at(22, 30))
    assert (done.rows, done.advanced, done.written) == (0, [], [])
    assert state.get_last_processed_hour("hourly") == at(20)


def test_up_to_date_run_does_nothing(source, state):
    state.set_last_processed_hour("hourly", at(10))
    assert run_incremental(source, state, [], as_of=at(11, 30)).rows == 0


def test_failing_sink_leaves_the_state_and_the_hour_is_read_again(spark, source, state, tmp_path):
    state.set_last_processed_hour("hourly", at(11))
    with pytest.raises(RuntimeError, match="target is down"):
        run_incremental(source, state, [Broken()], as_of=at(13, 30))
    assert state.get_last_processed_hour("hourly") == at(11)
    sink = AppendSink(path=str(tmp_path / "facts"))
    run_incremental(source, state, [sink], as_of=at(13, 45))
    assert hours(spark, sink.path) == [("co", 12)]
    assert state.get_last_processed_hour("hourly") == at(12)


def test_run_without_state(source, state):
    done = run_incremental(source, state, [], as_of=at(11, 30), incremental=False)
    assert done.rows == 2 and state.get_last_processed_hour("hourly") is None


def test_chosen_tables_and_fetched_counts(source, state):
    state.set_last_processed_hour("hourly", at(8))
    done = run_incremental(source, state, [], tables=["co"], as_of=at(11, 30), count_fetched=True)
    assert (done.rows, done.rows_by_table, done.fetched) == (2, {"co": 2}, {"co": 4})


@pytest.mark.parametrize("clock", [at(10, 30), at(11, 30)])
def test_counts_of_runs_without_valid_rows(frame, state, clock):
    """Nothing in range, and rows in range of which none is valid."""
    frames = {"co": frame([(iso(10, 5), "a", "v", 1.0)]), "o3": frame([], "o3_mean double")}
    source = ReadingSource.from_frames(frames, catalog=CATALOG)
    state.set_last_processed_hour("hourly", at(9))
    done = run_incremental(source, state, [], as_of=clock, count_fetched=True)
    assert (done.rows, done.advanced) == (0, [])
    assert done.fetched == {"co": 1 if clock.hour == 11 else 0, "o3": 0}


def test_own_mark_per_table(source, state):
    done = run_incremental(source, state, [], as_of=at(13, 30), per_table_state=True)
    assert done.advanced == ["hourly-co"]
    assert state.get_last_processed_hour("hourly-co") == at(12)
    assert state.get_last_processed_hour("hourly-o3") is None


def test_unknown_table(source, state):
    with pytest.raises(KeyError, match="available"):
        run_incremental(source, state, [], tables=["pm1"], as_of=at(11, 30))


def test_backfill_equals_single_hours(source, state):
    whole = run_backfill(source, at(9, 20), at(12, 40), []).result
    parts = None
    for hour in (9, 10, 11):
        part = run_backfill(source, at(hour), at(hour + 1), []).result
        parts = part if parts is None else parts.unionByName(part)
    assert whole.exceptAll(parts).count() == parts.exceptAll(whole).count() == 0
    assert whole.count() == 6
    assert state.entries().count() == 0


def test_backfill_reports_gaps(source):
    done = run_backfill(source, at(10), at(14), [], tables=["o3"])
    assert done.rows == 2
    assert sorted(r[0] for r in done.gaps.select(F.hour("hour")).collect()) == [12, 13]


def test_catch_up(spark, source, state, tmp_path):
    sink = AppendSink(path=str(tmp_path / "facts"))
    assert backfill_from_state(spark, source, state, [sink], as_of=at(15, 30)) is None
    state.set_last_processed_hour("hourly", at(10), version="v7")
    done = backfill_from_state(spark, source, state, [sink], tables=["co"], as_of=at(15, 30))
    assert hours(spark, sink.path) == [("co", h) for h in (11, 12, 13, 14)]
    assert done.advanced == [] and state.get_last_processed_hour("hourly") == at(10)
    done = backfill_from_state(spark, source, state, [], as_of=at(15, 30))
    assert done.advanced == ["hourly"]
    assert state.get_last_processed_hour("hourly") == at(14)
    assert state.get_metadata("hourly", "last_backfill") == iso(15, 30)
    assert backfill_from_state(spark, source, state, [sink], as_of=at(15, 45)) is None


def test_catch_up_per_table(spark, source, state):
    state.set_last_processed_hour("hourly-co", at(12))
    done = backfill_from_state(spark, source, state, [], as_of=at(15, 30), per_table_state=True)
    assert done.advanced == ["hourly-co"] and set(done.rows_by_table) == {"co"}
    assert state.get_last_processed_hour("hourly-co") == at(14)


def test_skipped_sink_leaves_the_state(source, state):
    done = run_incremental(source, state, [AppendSink()], as_of=at(11, 30))
    assert done.rows > 0 and done.written == [] and done.advanced == []


def test_backfill_of_some_tables_keeps_the_others(spark, source, state, tmp_path):
    sink = HourPartitionSink(path=str(tmp_path / "facts"))
    run_backfill(source, at(8), at(16), [sink], version="v1")
    before = spark.read.parquet(sink.path).drop("date", "hour").collect()
    run_backfill(source, at(9), at(12), [sink], tables=["co"], version="v2")
    after = spark.read.parquet(sink.path)
    assert sorted(r[:-1] for r in after.select(*before[0].__fields__).collect()) == sorted(r[:-1] for r in before)
    assert {r[0] for r in after.filter("version = 'v2'").select(F.hour("time")).collect()} <= {9, 10, 11}
    assert {r[0] for r in after.filter("version = 'v2'").select("metrica").collect()} == {"co"}


def test_failed_catch_up_leaves_the_state(spark, source, state):
    state.set_last_processed_hour("hourly", at(10))
    with pytest.raises(RuntimeError):
        backfill_from_state(spark, source, state, [Broken()], as_of=at(15, 30))
    assert state.get_last_processed_hour("hourly") == at(10)


def test_scans(source):
    assert source.fetch_data("co", iso(9), iso(10)).count() == 2
    assert source.fetch_data("co", as_of=iso(10, 20)).count() == 2
    assert source.fetch_incremental_data("co", iso(9), iso(12, 5)).count() == 4
    assert source.fetch_incremental_data("co", iso(12), iso(12, 5)).count() == 0
    assert source.fetch_incremental_data("co", iso(12), iso(12, 5)).columns == ["time", "location", "co_mean", "status"]
    assert source.fetch_specific_hour("co", iso(9)).count() == 2
    assert source.backfill_hours("co", iso(9, 30), iso(11, 30)).count() == 4
    times = [r["time"] for r in source.fetch_data("co", iso(8), iso(17), ordered=True).collect()]
    assert times == sorted(times) and len(times) == 18
    with pytest.raises(KeyError):
        source.fetch_data("pm1")


def test_sources_by_path_and_table(spark, frame, tmp_path):
    rows = frame([(iso(9), "a", "k", 1.0)]).withColumn("extra", F.lit(1))
    rows.write.parquet(str(tmp_path / "co_minutales"))
    rows.write.mode("overwrite").saveAsTable("co_minutales")
    by_path = ReadingSource.from_path(spark, str(tmp_path)).fetch_table("co")
    by_table = ReadingSource.from_tables(spark).fetch_table("co")
    assert by_path.columns == by_table.columns == ["time", "location", "co_mean", "status"]
    assert by_path.collect() == by_table.collect()
    everything = ReadingSource.from_tables(spark, catalog=Catalog({"co": ("co_minutales", ["*"])})).fetch_table("co")
    assert "extra" in everything.columns
