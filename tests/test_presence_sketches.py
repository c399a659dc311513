"""Presence bitmaps with gap intervals; checks by group; sketches."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from airhour.catalog import Catalog
from airhour.operators.presence import PresenceTable, gap_hours, gap_intervals, merge_presence, presence_days
from airhour.operators.sketches import (
    RANK_BOUND,
    SketchTable,
    daily_sketches,
    merge_sketches,
    range_report_by,
    sketch_drift,
    sketch_quantiles,
    status_report_by,
)
from airhour.sources.ranges import backfill_range
from airhour.sources.readings import ReadingSource

CATALOG = Catalog({"co": ("co", ["co_mean"])})
START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def at(hours):
    return (START + timedelta(hours=hours)).isoformat()


@pytest.fixture
def source(frame):
    def make(held):
        rows = [(at(h + 0.5), name, "k", 1.0) for name, hours in held.items() for h in hours]
        return ReadingSource.from_frames({"co": frame(rows)}, catalog=CATALOG)

    return make


def brute(held, low, high):
    """Maximal stretches of missing hours of each station."""
    found = []
    for name, hours in held.items():
        run = None
        for h in range(low, high + 1):
            if h < high and h not in hours:
                run = h if run is None else run
            elif run is not None:
                found.append((name, run, h))
                run = None
    return sorted(found)


def intervals(df):
    hour = lambda c: (F.unix_seconds(c) - F.lit(int(START.timestamp()))) / 3600
    rows = df.select("location", hour("gap_start").cast("int"), hour("gap_end").cast("int"), "hours").collect()
    assert all(r[3] == r[2] - r[1] for r in rows)
    return sorted(tuple(r[:3]) for r in rows)


HELD = {
    "all": set(range(0, 100)),
    "none here": {200},
    "ends": {0, 99},
    "days apart": {23, 24, 71, 72},
    "odd": {1, 3, 5, 47, 49},
}


@pytest.mark.parametrize(("low", "high"), [(0, 100), (5, 60), (24, 48), (23, 25), (50, 50), (30, 20), (150, 250)])
def test_gap_intervals(source, low, high):
    days = presence_days(source(HELD).readings())
    assert intervals(gap_intervals(days, at(low), at(high))) == brute(HELD, low, high)


def test_gap_intervals_of_random_hours(source):
    rng = random.Random(2)
    held = {f"s{k}": {h for h in range(240) if rng.random() < k / 12} | {500} for k in range(12)}
    found = gap_intervals(presence_days(source(held).readings()), at(7), at(213))
    assert intervals(found) == brute(held, 7, 213)
    hours = gap_hours(found).groupBy("location").count().collect()
    assert {r[0]: r[1] for r in hours} == {n: 206 - len(h & set(range(7, 213))) for n, h in held.items() if not set(range(7, 213)) <= h}


def test_gaps_of_a_station_list(spark, source):
    days = presence_days(source(HELD).readings())
    listed = spark.createDataFrame([("odd",), ("unknown",)], "location string")
    found = gap_intervals(days, at(0), at(50), listed, ["co"])
    assert intervals(found) == brute({"odd": HELD["odd"], "unknown": set()}, 0, 50)
    with pytest.raises(ValueError, match="tables"):
        gap_intervals(days, at(0), at(50), listed)


def test_no_list_of_all_hours(source):
    days = presence_days(source(HELD).readings())
    plan = gap_intervals(days, at(0), at(100))._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(cast(" not in plan and "date_trunc(hour" not in plan.split("Aggregate")[0]
    assert plan.count("Generate") <= 4 and "INTERVAL" not in plan


def test_presence_table_takes_rows_again(spark, source, tmp_path):
    table = PresenceTable(spark, str(tmp_path / "presence"))
    assert table.read().count() == 0
    whole = source(HELD)
    for low, high in ((0, 30), (20, 60), (20, 60), (60, 300)):
        table.add(presence_days(whole.readings(None, backfill_range(at(low), at(high)))))
    rows = lambda df: sorted(map(str, df.select("pollutant", "location", "date", "hours").collect()))
    assert rows(table.read()) == rows(presence_days(whole.readings()))
    assert rows(merge_presence(table.read().unionByName(table.read()))) == rows(table.read())


def test_rows_without_time_or_station_count_nowhere(frame):
    table = frame([(None, "a", "k", 1.0), (at(1), None, "k", 1.0), (at(2), "b", None, None)])
    days = presence_days(ReadingSource.from_frames({"co": table}, catalog=CATALOG).readings()).collect()
    assert [(r.location, r.hours) for r in days] == [("b", 4)]


def test_checks_by_group(frame):
    nan = float("nan")
    rows = [(at(0.1), "a", "k", 5.0), (at(0.2), "a", "x", 101.0), (at(0.3), "a", None, nan), (at(1.1), "a", "v", -1.0), (at(0.1), "b", "k", None), (at(0.2), None, "k", 100.0)]
    readings = ReadingSource.from_frames({"co": frame(rows)}, catalog=CATALOG).readings()
    found = {(r.location, r.hour): (r.rows_checked, r.rows_outside, r.actual_min, r.actual_max) for r in range_report_by(readings).withColumn("hour", F.hour("hour")).collect()}
    assert found == {("a", 0): (2, 1, 5.0, 101.0), ("a", 1): (1, 1, -1.0, -1.0), (None, 0): (1, 0, 100.0, 100.0)}
    found = {(r.location, r.hour): (r.rows, r.valid_rows, r.null_rows, r.unknown_rows) for r in status_report_by(readings).withColumn("hour", F.hour("hour")).collect()}
    assert found == {("a", 0): (3, 1, 1, 1), ("a", 1): (1, 0, 0, 0), ("b", 0): (1, 1, 0, 0), (None, 0): (1, 1, 0, 0)}


def test_sketches_merge_within_the_bound(spark, frame, tmp_path):
    rng = random.Random(1)
    values = [rng.lognormvariate(2, 1) for _ in range(20_000)]
    rows = [(at(rng.randrange(72)), rng.choice("ab"), "k" if k % 5 else "s", v) for k, v in enumerate(values)]
    rows += [(at(1), "a", "k", float("nan")), (at(1), "a", "k", None)]
    source = ReadingSource.from_frames({"co": frame(rows)}, catalog=CATALOG)
    table = SketchTable(spark, str(tmp_path / "sketches"))
    table.put(daily_sketches(source.readings()))
    table.put(daily_sketches(source.readings(None, backfill_range(at(24), at(48)))))
    valid = sorted(v for k, v in enumerate(values) if k % 5)
    merged = merge_sketches(table.read(), "pollutant", "metric").collect()
    assert [r.n for r in merged] == [len(valid)]
    for row in sketch_quantiles(merge_sketches(table.read(), "metric"), [0.01, 0.5, 0.99]).collect():
        below = sum(v < row.quantile for v in valid) / len(valid)
        reached = sum(v <= row.quantile for v in valid) / len(valid)
        assert below - RANK_BOUND <= row["rank"] <= reached + RANK_BOUND


def test_drift(frame):
    rng = random.Random(5)

    def sketches(shift):
        rows = [(at(1), "a", "k", rng.gauss(50 + shift, 2)) for _ in range(3000)]
        # Kept, as a sketch that is computed again differs within its bound.
        return daily_sketches(ReadingSource.from_frames({"co": frame(rows)}, catalog=CATALOG).readings()).cache()

    before, same, moved = sketches(0), sketches(0), sketches(20)
    assert sketch_drift(before, before, ["metric"]).first().drift == 0
    assert sketch_drift(before, same, ["metric"]).first().drift < 0.15
    assert sketch_drift(before, moved, ["metric"]).first().drift > 0.6
