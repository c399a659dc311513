"""Sinks that survive repeats: runs listed by the state log, facts by date and table, ranges that became empty."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from airhour.catalog import Catalog
from airhour.plans.runs import backfill_from_state, run_backfill, run_incremental, run_tables_apart
from airhour.plans.state import StateLog
from airhour.sinks.tables import HourPartitionSink, RunAppendSink, Scope, Sink, TablePartitionSink, export
from airhour.sources.ranges import backfill_range
from airhour.sources.readings import ReadingSource

CATALOG = Catalog({"co": ("co", ["co_mean"]), "o3": ("o3", ["o3_mean"])})
START = datetime(2024, 1, 1, tzinfo=timezone.utc)
MARK = START - timedelta(hours=1)


def at(hours):
    return START + timedelta(hours=hours)


@pytest.fixture
def source(frame):
    def make(hours, tables=("co", "o3")):
        frames = {}
        for key in ("co", "o3"):
            rows = [(at(h + 0.5).isoformat(), "a", "k", float(h)) for h in hours if key in tables]
            frames[key] = frame(rows, f"{key}_mean double")
        return ReadingSource.from_frames(frames, catalog=CATALOG)

    return make


class Stops(Sink):
    def write(self, df, rows, scope=None):
        raise RuntimeError("stopped")


def held(df):
    hour = (F.unix_seconds("time") - F.lit(int(START.timestamp()))) / 3600
    return sorted((r.metrica, r.h, r.version) for r in df.select("metrica", hour.cast("int").alias("h"), "version").collect())


def rows_of(hours, version, metrics=("co", "o3")):
    return sorted((m, h, version) for m in metrics for h in hours)


@pytest.fixture
def runs(spark, tmp_path):
    state = StateLog(spark, str(tmp_path / "state"))
    state.set_last_processed_hour("hourly", MARK)
    return state, RunAppendSink(path=str(tmp_path / "facts"))


def test_a_stopped_run_is_not_seen(spark, source, runs):
    state, sink = runs
    assert sink.read(spark, state).count() == 0
    with pytest.raises(RuntimeError):
        run_incremental(source(range(9)), state, [sink, Stops()], version="v", as_of=at(5))
    assert sink.read(spark, state).count() == 0
    for as_of in (at(5), at(8), at(8)):
        run_incremental(source(range(9)), state, [sink], version="v", as_of=as_of)
    assert held(sink.read(spark, state)) == rows_of(range(8), "v")
    state.compact()
    assert held(sink.read(spark, state)) == rows_of(range(8), "v")


def test_a_repeat_before_its_mark_replaces_its_rows(spark, source, runs, tmp_path):
    state, sink = runs
    for _ in range(2):
        with pytest.raises(RuntimeError):
            run_incremental(source(range(9)), state, [sink, Stops()], version="v", as_of=at(5))
    assert len([f for f in (tmp_path / "facts").iterdir() if f.name.startswith("run=")]) == 1


def test_catch_up_lists_its_run(spark, source, runs):
    state, sink = runs
    backfill_from_state(spark, source(range(9)), state, [sink], version="v", as_of=at(4))
    assert held(sink.read(spark, state)) == rows_of(range(4), "v")


def test_runs_that_move_no_mark_are_refused(source, runs):
    state, sink = runs
    with pytest.raises(ValueError, match="mark"):
        run_backfill(source(range(9)), at(0), at(4), [sink])
    with pytest.raises(ValueError, match="mark"):
        run_incremental(source(range(9)), state, [sink], ["co"], as_of=at(4))
    with pytest.raises(ValueError, match="mark"):
        run_incremental(source(range(9)), state, [sink], as_of=at(4), incremental=False)


@pytest.fixture
def tables(tmp_path):
    return TablePartitionSink(path=str(tmp_path / "tables"), catalog=CATALOG)


def test_whole_days_are_replaced_without_a_scan(spark, source, tables, monkeypatch):
    run_backfill(source(range(72)), at(0), at(72), [tables], version="v1")
    reads = []
    monkeypatch.setattr(type(spark.read), "parquet", lambda *a, **k: reads.append(a))
    run_backfill(source(range(72)), at(24), at(48), [tables], version="v2")
    assert reads == []
    monkeypatch.undo()
    expected = rows_of([*range(24), *range(48, 72)], "v1") + rows_of(range(24, 48), "v2")
    assert held(spark.read.parquet(tables.path)) == sorted(expected)


@pytest.mark.parametrize(("low", "high"), [(20, 30), (3, 9), (10, 72), (0, 25), (47, 48)])
def test_part_days_keep_the_rest(spark, source, tables, low, high):
    run_backfill(source(range(72)), at(0), at(72), [tables], version="v1")
    for _ in range(2):
        run_backfill(source(range(72)), at(low), at(high), [tables], ["co"], version="v2")
    expected = rows_of(range(72), "v1", ["o3"]) + rows_of(range(low, high), "v2", ["co"])
    expected += rows_of([h for h in range(72) if not low <= h < high], "v1", ["co"])
    assert held(spark.read.parquet(tables.path)) == sorted(expected)


@pytest.mark.parametrize("kind", ["tables", "day", "hour"])
def test_a_range_that_became_empty_is_cleared(spark, source, tmp_path, kind):
    path = str(tmp_path / "facts")
    sink = TablePartitionSink(path=path, catalog=CATALOG) if kind == "tables" else HourPartitionSink(path=path, unit=kind)
    assert run_backfill(source([]), at(0), at(24), [sink]).written == []
    assert not (tmp_path / "facts").exists()
    run_backfill(source(range(72)), at(0), at(72), [sink], version="v1")
    done = run_backfill(source([]), at(20), at(50), [sink], ["o3"])
    assert done.rows == 0
    expected = rows_of(range(72), "v1", ["co"]) + rows_of([*range(20), *range(50, 72)], "v1", ["o3"])
    assert held(spark.read.parquet(path)) == sorted(expected)


def test_emptied_tables_of_whole_days_go(spark, source, tables, tmp_path):
    run_backfill(source(range(48)), at(0), at(48), [tables], version="v1")
    run_backfill(source(range(48), ["co"]), at(0), at(24), [tables], version="v2")
    assert held(spark.read.parquet(tables.path)) == sorted(rows_of(range(24), "v2", ["co"]) + rows_of(range(24, 48), "v1"))
    assert not (tmp_path / "tables" / "date=2024-01-01" / "table=o3").exists()


def test_unknown_metrics_fail(spark, tables):
    columns = "time timestamp, location string, metrica string, valor double, count_ok bigint, version string"
    facts = spark.createDataFrame([(at(0), "a", "unknown", 1.0, 1, "v")], columns)
    with pytest.raises(Exception, match="no table has metric unknown"):
        export(facts, [tables])


def test_a_scope_without_its_table(spark, source, tables):
    run_backfill(source(range(24)), at(0), at(24), [tables], version="v1")
    scope = [Scope(("o3",), backfill_range(at(0), at(24)))]
    export(spark.createDataFrame([], "time timestamp, location string, metrica string, valor double, count_ok bigint, version string"), [tables], 0, scope)
    assert held(spark.read.parquet(tables.path)) == rows_of(range(24), "v1", ["co"])


def test_a_table_that_fails_is_read_again(spark, source, frame, tmp_path):
    """The others are written and their marks move; the next run catches up."""
    state = StateLog(spark, str(tmp_path / "state"))
    for key in ("co", "o3"):
        state.set_last_processed_hour(f"hourly-{key}", MARK)
    sinks = [TablePartitionSink(path=str(tmp_path / "tables"), catalog=CATALOG), RunAppendSink(path=str(tmp_path / "runs"))]
    good = source(range(9))
    broken = good.fetch_table("o3").withColumn("location", F.raise_error(F.lit("unreadable")).cast("string"))
    source_of = ReadingSource.from_frames({"co": good.fetch_table("co"), "o3": broken}, catalog=CATALOG)
    co, o3 = run_tables_apart(source_of, state, sinks, version="v", as_of=at(5))
    assert co.error is None and co.result.rows == 5 and "unreadable" in str(o3.error)
    assert state.get_last_processed_hour("hourly-o3") == MARK and state.get_last_processed_hour("hourly-co") == at(4)
    assert held(spark.read.parquet(sinks[0].path)) == rows_of(range(5), "v", ["co"])
    outcomes = run_tables_apart(good, state, sinks, version="v", as_of=at(8))
    assert [o.result.rows for o in outcomes] == [3, 8]
    assert held(spark.read.parquet(sinks[0].path)) == rows_of(range(8), "v")
    assert held(sinks[1].read(spark, state)) == rows_of(range(8), "v")


def test_the_gate_stops_one_table(spark, source, frame, tmp_path):
    state = StateLog(spark, str(tmp_path / "state"))
    for key in ("co", "o3"):
        state.set_last_processed_hour(f"hourly-{key}", MARK)
    outcomes = run_tables_apart(source(range(4), ["co"]), state, [], version="v", as_of=at(3), gate=True)
    assert [o.error is None for o in outcomes] == [True, False]


def test_a_failing_sink_keeps_the_mark(spark, source, tmp_path):
    state = StateLog(spark, str(tmp_path / "state"))
    outcomes = run_tables_apart(source(range(4)), state, [Stops()], version="v", as_of=at(3))
    assert all("stopped" in str(o.error) for o in outcomes)
    assert state.entries().count() == 0
