"""Incremental runs and backfills: scan, aggregate, export, then advance the state."""

from __future__ import annotations

import hashlib
import logging
from concurrent.futures import ThreadPoolExecutor, as_completed
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from ..functions.time import TimeLike, get_current_hour_start, get_previous_hour_start
from ..operators.counts import counted_by_table
from ..operators.coverage import coverage_gaps
from ..operators.hourly import hourly_long, hourly_long_fetched
from ..operators.quality import validate_dataframe
from ..session import ensure_checkpoint_dir
from ..functions.naming import build_metric_columns
from ..schema import guard_not_null
from ..sinks.tables import RunAppendSink, Scope, Sink, export
from ..sources.ranges import TimeRange, backfill_range, incremental_range, time_range
from ..sources.readings import ReadingSource, Readings
from .state import DEFAULT_VERSION, RUN, StateLog

logger = logging.getLogger(__name__)


@dataclass
class RunResult:
    """What a run did. ``result`` is materialised; ``fetched`` is filled on request."""

    result: DataFrame
    rows: int
    rows_by_table: dict[str, int]
    fetched: dict[str, int] = field(default_factory=dict)
    written: list[str] = field(default_factory=list)
    advanced: list[str] = field(default_factory=list)
    gaps: DataFrame | None = None


def _compute(
    readings: list[Readings], version: str | None, count_fetched: bool = False
) -> tuple[DataFrame, dict[str, int]]:
    """One job computes the rows and all counts; what follows reads its output."""
    tables = [item.table for item in readings]
    hourly = hourly_long_fetched(readings, version) if count_fetched else hourly_long(readings, version)
    # The guard stands before the rows are kept: a null fails the run before any sink has begun.
    long, observation = counted_by_table(guard_not_null(hourly), tables)
    ensure_checkpoint_dir(long.sparkSession)
    result = long.checkpoint()
    return result, observation.get


def _deliver(
    result: DataFrame, counts: dict[str, int], readings: list[Readings], sinks: list[Sink], run: str | None
) -> RunResult:
    """The computed rows to all sinks."""
    tables = [item.table for item in readings]
    by_table = {table.key: counts[table.key] for table in tables}
    fetched = {table.key: counts[f"fetched.{table.key}"] for table in tables if f"fetched.{table.key}" in counts}
    scope = [
        Scope(tuple(build_metric_columns(item.table.metrics).values()), item.within, item.table.key) for item in readings
    ]
    written = export(result, sinks, counts["rows"], scope, run)
    logger.info("%d hourly rows, by table %s, written to %s", counts["rows"], by_table, written)
    return RunResult(result, counts["rows"], by_table, fetched, written)


def _execute(
    readings: list[Readings],
    version: str | None,
    sinks: list[Sink],
    count_fetched: bool = False,
    run: str | None = None,
) -> RunResult:
    return _deliver(*_compute(readings, version, count_fetched), readings, sinks, run)


def _readings(
    source: ReadingSource, marks: dict[str, list[str]], ranges: dict[str, TimeRange], apart: bool = False
) -> list[Readings]:
    """The tables of all marks. Fetched rows are counted for each base, so ``apart`` keeps the marks' scans apart."""
    if apart or len(marks) == 1:
        return [item for mark, keys in marks.items() for item in source.readings(keys, ranges[mark])]
    return source.readings_each({key: ranges[mark] for mark, keys in marks.items() for key in keys})


def run_id(marks: dict[str, list[str]], starts: dict[str, datetime | None], end: datetime) -> str:
    """The id of a run: its marks with their tables, what each had processed, and the hour it reaches."""
    parts = [f"{mark}:{','.join(sorted(keys))}:{starts.get(mark)}" for mark, keys in sorted(marks.items())]
    hour = (end if end.tzinfo else end.replace(tzinfo=timezone.utc)).astimezone(timezone.utc)
    digest = hashlib.sha256("|".join(parts).encode()).hexdigest()[:16]
    return f"{hour:%Y%m%dT%H}-{digest}"


def _require_mark(sinks: list[Sink], moves: bool) -> None:
    if not moves and any(isinstance(sink, RunAppendSink) for sink in sinks):
        raise ValueError("this run moves no mark that could list its rows; use a sink that replaces them")


def _validate(readings: list[Readings]) -> None:
    for item in readings:
        validate_dataframe(item.frame(), pollutant_type=item.table.key)


def _missing(last: datetime, as_of: datetime) -> tuple[datetime, int]:
    """The first whole hour after the mark, and how many are complete since."""

    def hour(moment: datetime) -> datetime:
        moment = moment.replace(tzinfo=timezone.utc) if moment.tzinfo is None else moment.astimezone(timezone.utc)
        return moment.replace(minute=0, second=0, microsecond=0)

    first = hour(last) + timedelta(hours=1)
    return first, (hour(as_of) - first) // timedelta(hours=1)


def run_incremental(
    source: ReadingSource,
    state: StateLog,
    sinks: list[Sink],
    tables: list[str] | None = None,
    pipeline: str = "hourly",
    version: str = DEFAULT_VERSION,
    as_of: datetime | None = None,
    incremental: bool = True,
    per_table_state: bool = False,
    count_fetched: bool = False,
    gate: bool = False,
) -> RunResult:
    """Process every completed hour after the state, then advance it.

    The clock is read once, so the hour recorded is the last hour read. A
    failing sink raises before the state moves and the hours are read again
    next time. Without rows, or when a sink was skipped, the state stays; a run of some tables never
    moves the mark that all of them share. With ``per_table_state`` each table
    has its own mark, moved only when that table had rows. ``incremental=False``
    reads the last completed hour and leaves the state alone. ``gate`` validates each
    table's rows first, and a table that fails stops the run before anything is written.
    """
    as_of = as_of or datetime.now(timezone.utc)
    keys = tables or source.catalog.keys
    marks = {f"{pipeline}-{key}": [key] for key in keys} if per_table_state else {pipeline: keys}
    _require_mark(sinks, incremental and (per_table_state or set(keys) == set(source.catalog.keys)))
    states = state.load_all(list(marks)) if incremental else {}
    ranges = {
        mark: incremental_range(states[mark].last_processed_hour, as_of) if incremental else time_range(as_of=as_of)
        for mark in marks
    }
    readings = _readings(source, marks, ranges, apart=count_fetched)
    if gate:
        _validate(readings)
    run = run_id(marks, {mark: states[mark].last_processed_hour for mark in states}, as_of)
    done = _execute(readings, version, sinks, count_fetched, run)
    if incremental and len(done.written) == len(sinks):
        for mark, marked in marks.items():
            if not per_table_state and set(marked) != set(source.catalog.keys):
                logger.warning("%s stays: only %s of its tables ran", mark, marked)
            elif any(done.rows_by_table[key] for key in marked):
                state.set_last_processed_hour(
                    mark,
                    get_previous_hour_start(as_of),
                    version,
                    {"pipeline_version": version, "last_execution": as_of.isoformat(), RUN: run},
                    states[mark],
                )
                done.advanced.append(mark)
    return done


@dataclass
class TableOutcome:
    """What became of one table: a result, or the error that stopped it."""

    table: str
    result: RunResult | None = None
    error: Exception | None = None


def run_tables_apart(
    source: ReadingSource,
    state: StateLog,
    sinks: list[Sink],
    tables: list[str] | None = None,
    pipeline: str = "hourly",
    version: str = DEFAULT_VERSION,
    as_of: datetime | None = None,
    gate: bool = False,
    at_once: int = 4,
) -> list[TableOutcome]:
    """An incremental run in which a table that fails does not stop the others.

    Each table has a mark and a job of its own, so tables on one base are scanned once each. Up to ``at_once`` tables are
    computed at the same time, each in a job group and a scheduler pool of its name (pools share the cluster evenly where
    ``spark.scheduler.mode`` is FAIR). Rows go to the sinks, and marks move, one table after another as they are ready; a
    table that fails anywhere keeps its mark and is read again by the next run.
    """
    as_of = as_of or datetime.now(timezone.utc)
    keys = tables or source.catalog.keys
    marks = {key: f"{pipeline}-{key}" for key in keys}
    states = state.load_all(list(marks.values()))
    context = state.spark.sparkContext

    def compute(key: str) -> tuple[list[Readings], DataFrame, dict[str, int]]:
        context.setJobGroup(marks[key], f"hourly rows of {key}")
        context.setLocalProperty("spark.scheduler.pool", marks[key])
        try:
            within = incremental_range(states[marks[key]].last_processed_hour, as_of)
            readings = source.readings([key], within)
            if gate:
                _validate(readings)
            return readings, *_compute(readings, version)
        finally:
            context.setLocalProperty("spark.scheduler.pool", None)

    outcomes = []
    with ThreadPoolExecutor(max_workers=at_once) as threads:
        waiting = {threads.submit(inheritable_thread_target(state.spark)(compute), key): key for key in keys}
        for ready in as_completed(waiting):
            key = waiting[ready]
            last = states[marks[key]]
            try:
                readings, result, counts = ready.result()
                run = run_id({marks[key]: [key]}, {marks[key]: last.last_processed_hour}, as_of)
                done = _deliver(result, counts, readings, sinks, run)
                if done.rows and len(done.written) == len(sinks):
                    metadata = {"pipeline_version": version, "last_execution": as_of.isoformat(), RUN: run}
                    state.set_last_processed_hour(marks[key], get_previous_hour_start(as_of), version, metadata, last)
                    done.advanced.append(marks[key])
                outcomes.append(TableOutcome(key, done))
            except Exception as error:  # any failure is this table's alone
                logger.exception("%s failed; its mark stays", key)
                outcomes.append(TableOutcome(key, error=error))
    return sorted(outcomes, key=lambda outcome: keys.index(outcome.table))


def run_backfill(
    source: ReadingSource,
    start: TimeLike,
    end: TimeLike,
    sinks: list[Sink],
    tables: list[str] | None = None,
    version: str = DEFAULT_VERSION,
    gate: bool = False,
) -> RunResult:
    """Process all hours in ``[start, end)`` as one range scan per table; no state is touched.

    ``gaps`` of the result lists, lazily, the requested hours without data. ``gate`` is as in run_incremental.
    """
    readings = source.readings(tables, backfill_range(start, end))
    if gate:
        _validate(readings)
    _require_mark(sinks, False)
    done = _execute(readings, version, sinks)
    done.gaps = coverage_gaps(readings, start, end)
    return done


def backfill_from_state(
    spark: SparkSession,
    source: ReadingSource,
    state: StateLog,
    sinks: list[Sink],
    tables: list[str] | None = None,
    pipeline: str = "hourly",
    version: str = DEFAULT_VERSION,
    as_of: datetime | None = None,
    per_table_state: bool = False,
) -> RunResult | None:
    """Process the hours between the state and the running hour, then advance the state.

    None when there is no state yet or nothing is missing. Tables without a mark of their own are left out with
    ``per_table_state``. A mark moves as in run_incremental, and also when there were no rows.
    """
    as_of = as_of or datetime.now(timezone.utc)
    keys = tables or source.catalog.keys
    marks = {f"{pipeline}-{key}": [key] for key in keys} if per_table_state else {pipeline: keys}
    _require_mark(sinks, per_table_state or set(keys) == set(source.catalog.keys))
    states = state.load_all(list(marks))
    ranges: dict[str, TimeRange] = {}
    starts: list[datetime] = []
    for mark in marks:
        last = states[mark].last_processed_hour
        if last is None:
            logger.info("no state for %s; run it first", mark)
            continue
        first, missing = _missing(last, as_of)
        if missing <= 0:
            logger.info("%s is up to date", mark)
            continue
        logger.info("%d missing hours of %s, first %s", missing, mark, first)
        ranges[mark] = backfill_range(first, get_current_hour_start(as_of))
        starts.append(first)
    if not ranges:
        return None
    readings = _readings(source, {mark: marks[mark] for mark in ranges}, ranges)
    run = run_id({mark: marks[mark] for mark in ranges}, {m: states[m].last_processed_hour for m in ranges}, as_of)
    done = _execute(readings, version, sinks, run=run)
    done.gaps = coverage_gaps(readings, min(starts), get_current_hour_start(as_of))
    skipped = done.rows > 0 and len(done.written) != len(sinks)
    for mark in ranges:
        if skipped or (not per_table_state and set(marks[mark]) != set(source.catalog.keys)):
            logger.warning("%s stays: not all of its tables and sinks took part", mark)
            continue
        state.set_last_processed_hour(
            mark,
            get_previous_hour_start(as_of),
            metadata={"last_backfill": as_of.isoformat(), RUN: run},
            previous=states[mark],
        )
        done.advanced.append(mark)
    return done
