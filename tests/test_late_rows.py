"""Partials, and late rows that reach hours already written."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from airhour.operators.hourly import hourly_long
from airhour.operators.partials import finish, hourly_partials, merge_partials
from airhour.sources.events import STATUS_COLUMNS, events, wide_readings
from airhour.sources.readings import ReadingSource
from airhour.streaming.late import LateHours, PartialStore

SF = "/root/testdata/sf0.001"
DAYS = "ts < '2024-01-04'"


def source_of(rows):
    return ReadingSource.from_wide(wide_readings(rows.sparkSession, rows), status=STATUS_COLUMNS)


@pytest.fixture(scope="module")
def rows(spark):
    return events(spark, SF).where(DAYS).cache()


def texts(df):
    return sorted(map(str, df.collect()))


def closed(spark, rows, delay=timedelta(0)):
    """The batch over all rows, without hours that the newest valid row leaves open."""
    source = source_of(rows)
    newest = hourly_partials(source.readings()).agg(F.max("newest")).first()[0]
    long = hourly_long(source.readings(), "v")
    return texts(long.where(F.col("time") + F.expr("INTERVAL 1 HOUR") <= F.lit(newest - delay)))


@pytest.fixture(params=["hour", "day"])
def late(request, tmp_path):
    return LateHours(str(tmp_path / "late"), source_of, version="v", unit=request.param)


PARTS = ["event_type IN ('click', 'signup')", "event_type = 'view'", "event_type IN ('purchase', 'error')"]


def test_partials_add_up(spark, rows):
    whole = texts(hourly_long(source_of(rows).readings(), "v"))
    parts = [hourly_partials(source_of(rows.where(p)).readings()) for p in PARTS]
    merged = merge_partials(parts[0].unionByName(parts[2]).unionByName(parts[1]))
    assert texts(finish(merged, "v")) == whole


def test_partials_of_nulls_and_nan(frame):
    from airhour.catalog import Catalog

    day = "2024-01-01T10:%s:00Z"
    table = frame([(day % "01", "a", "k", None), (day % "02", "a", "k", 3.0), (day % "03", "a", "s", 9.0), (day % "04", "b", "k", None), (day % "05", "c", "k", float("nan"))])
    catalog = Catalog({"co": ("co", ["co_mean"])})
    parts = hourly_partials(ReadingSource.from_frames({"co": table}, catalog=catalog).readings())
    found = {r.location: (r.valor, r.count_ok) for r in finish(merge_partials(parts)).collect()}
    assert found["a"] == (3.0, 2) and found["b"] == (None, 1)
    assert found["c"][0] != found["c"][0]


def test_late_batches_equal_the_batch(spark, rows, late):
    seen = None
    for number, part in enumerate(PARTS):
        late.apply(rows.where(part), number)
        seen = rows.where(part) if seen is None else seen.unionByName(rows.where(part))
        assert texts(late.read(spark)) == closed(spark, seen)


def test_a_repeated_batch_changes_nothing(spark, rows, late):
    late.apply(rows.where(PARTS[0]), 0)
    late.apply(rows.where(PARTS[1]), 1)
    once = texts(late.read(spark))
    late.apply(rows.where(PARTS[1]), 1)
    assert texts(late.read(spark)) == once


def test_a_batch_that_stopped_half_way(spark, rows, late):
    """Partials are stored, facts are not: the repeat of the batch writes them."""
    late.apply(rows.where(PARTS[0]), 0)
    PartialStore(spark, f"{late.path}/partials").put(1, hourly_partials(source_of(rows.where(PARTS[1])).readings()))
    late.apply(rows.where(PARTS[1]), 1)
    assert texts(late.read(spark)) == closed(spark, rows.where(f"{PARTS[0]} OR {PARTS[1]}"))


def test_compaction(spark, rows, late):
    store = PartialStore(spark, f"{late.path}/partials")
    late.apply(rows.where(PARTS[0]), 0)
    late.apply(rows.where(PARTS[1]), 1)
    before = texts(finish(merge_partials(store.read())))
    store.compact()
    assert texts(finish(merge_partials(store.read()))) == before
    assert store._numbers("batches", "batch") == [] and store._numbers("compacted", "upto") == [1]
    late.apply(rows.where(PARTS[2]), 2)
    store.compact()
    assert store._numbers("compacted", "upto") == [2]
    assert texts(late.read(spark)) == closed(spark, rows)


def test_delay_keeps_hours_open(spark, rows, tmp_path):
    late = LateHours(str(tmp_path / "late"), source_of, version="v", delay=timedelta(hours=5))
    late.apply(rows.where(PARTS[0]), 0)
    assert texts(late.read(spark)) == closed(spark, rows.where(PARTS[0]), timedelta(hours=5))


def test_only_touched_hours_are_written(spark, rows, tmp_path):
    late = LateHours(str(tmp_path / "late"), source_of, version="v")
    first = "ts < '2024-01-03'"
    one = "ts >= '2024-01-01 10:00:00' AND ts < '2024-01-01 11:00:00'"
    late.apply(rows.where(f"{first} AND NOT ({one})"), 0)
    files = {f.name for f in (tmp_path / "late" / "facts").rglob("*.parquet")}
    late.apply(rows.where(one), 1)
    new = [f for f in (tmp_path / "late" / "facts").rglob("*.parquet") if f.name not in files]
    assert new and {f.parent.name for f in new} == {"hour=10"} and {f.parent.parent.name for f in new} == {"date=2024-01-01"}
    assert texts(late.read(spark)) == closed(spark, rows.where(first))


def test_an_empty_batch(spark, rows, late):
    late.apply(rows.limit(0), 0)
    late.apply(rows.where(PARTS[0]), 1)
    late.apply(rows.limit(0), 2)
    assert texts(late.read(spark)) == closed(spark, rows.where(PARTS[0]))
