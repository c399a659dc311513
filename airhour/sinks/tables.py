"""Where hourly rows go."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from datetime import date, datetime, time, timedelta, timezone
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..catalog import ALL_COLUMNS, Catalog
from ..functions.naming import build_metric_columns
from ..operators.hourly import naive_timestamps
from ..schema import (
    OUTPUT_COLUMNS,
    OUTPUT_SCHEMA,
    create_empty_output_dataframe,
    guard_not_null,
    require_output_columns,
)
from ..session import ensure_checkpoint_dir, prepare
from ..sources.ranges import TimeRange

if TYPE_CHECKING:
    from ..plans.state import StateLog

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class Scope:
    """What a result recomputes: the hours of these metrics that a range reaches, or all of them."""

    metrics: tuple[str, ...]
    within: TimeRange | None = None
    table: str | None = None  # the reading table that has the metrics

    def hours(self) -> Column:
        inside = F.col("metrica").isin(list(self.metrics))
        if self.within is None:
            return inside
        return inside & (F.col("time") >= F.date_trunc("hour", self.within.start)) & (F.col("time") < self.within.end)

    def dates(self) -> Column:
        if self.within is None:
            return F.lit(True)
        return F.col("date").between(F.to_date(self.within.start), F.to_date(self.within.end))


class Sink:
    """A target. ``configured`` is False when a needed setting is missing."""

    name = "sink"

    @property
    def configured(self) -> bool:
        return True

    def begin(self, run: str | None) -> None:
        """Called before ``write`` with the id of the run; runs over the same hours from the same marks share it."""

    def clear(self, spark: SparkSession, scope: Sequence[Scope]) -> None:
        """Called instead of ``write`` when a run has no rows: what the scope recomputes is empty now."""

    def write(self, df: DataFrame, rows: int, scope: Sequence[Scope] | None = None) -> None:
        raise NotImplementedError


def _facts(df: DataFrame) -> DataFrame:
    require_output_columns(df)
    return guard_not_null(df.select(*OUTPUT_COLUMNS))


@dataclass
class AppendSink(Sink):
    """Append to a warehouse table or a path, in any format Spark writes.

    A run that is repeated adds its rows again; RunAppendSink and the partition sinks do not.
    ``verify`` counts the target's rows after the load and logs the number.
    """

    path: str | None = None
    table: str | None = None
    fmt: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)
    verify: bool = False
    name: str = "append"

    @property
    def configured(self) -> bool:
        return bool(self.path or self.table)

    def write(self, df: DataFrame, rows: int, scope: Sequence[Scope] | None = None) -> None:
        if not self.configured:
            raise ValueError("path or table is required")
        writer = _facts(df).write.mode("append").format(self.fmt).options(**self.options)
        if self.table:
            writer.saveAsTable(self.table)
        else:
            writer.save(self.path)
        if self.verify:
            logger.info("%s holds %d rows now", self.table or self.path, self.row_count(df.sparkSession))

    def row_count(self, spark: SparkSession) -> int:
        """Rows the target holds now."""
        if self.table:
            return spark.table(self.table).count()
        return spark.read.format(self.fmt).options(**self.options).load(self.path).count()


@dataclass
class RunAppendSink(Sink):
    """Append rows under the id of their run, which a repeat of the run replaces.

    A run that was stopped after this sink, before its mark moved, leaves rows under an id that no mark names.
    ``read`` takes only the runs that the state log lists, so such rows are never seen, and the next
    run, which may reach further and so have another id, gives each hour once.
    """

    path: str | None = None
    run: str | None = None
    name: str = "runs"

    @property
    def configured(self) -> bool:
        return bool(self.path)

    def begin(self, run: str | None) -> None:
        self.run = run

    def write(self, df: DataFrame, rows: int, scope: Sequence[Scope] | None = None) -> None:
        if not self.configured:
            raise ValueError("path is required")
        if not self.run:
            raise ValueError("a run id is required; begin() takes it")
        _facts(df).write.mode("overwrite").parquet(f"{self.path}/run={self.run}")

    def read(self, spark: SparkSession, state: StateLog, pipelines: Sequence[str] | None = None) -> DataFrame:
        """The rows of the runs that the state log lists, of all pipelines or of some; none before the first."""
        whole = spark.createDataFrame([], OUTPUT_SCHEMA)
        root = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = root.getFileSystem(spark._jsc.hadoopConfiguration())
        if not files.exists(root):
            return whole
        # One folder per run: the listed ones are read, whatever else lies beside them.
        stored = {f.getPath().getName().removeprefix("run=") for f in files.listStatus(root)}
        folders = [f"{self.path}/run={run}" for run in sorted(stored & set(state.runs(pipelines)))]
        return spark.read.schema(OUTPUT_SCHEMA).parquet(*folders) if folders else whole


@dataclass
class NarrowTableSink(Sink):
    """Create the table when absent, then insert by position.

    ``valor`` is a 32-bit float and ``count_ok`` a 32-bit integer there; a count
    that does not fit fails the job.
    """

    table: str | None = None
    location: str | None = None
    name: str = "narrow"

    @property
    def configured(self) -> bool:
        return bool(self.table)

    def write(self, df: DataFrame, rows: int, scope: Sequence[Scope] | None = None) -> None:
        if not self.configured:
            raise ValueError("table is required")
        where = f" LOCATION '{self.location}'" if self.location else ""
        df.sparkSession.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (time TIMESTAMP NOT NULL, location STRING NOT NULL, "
            f"metrica STRING NOT NULL, valor FLOAT, count_ok INT NOT NULL, version STRING) USING parquet{where}"
        )
        _facts(df).write.insertInto(self.table)


@dataclass
class ReportSink(Sink):
    """CSV reports with zone-free timestamps, one folder for each run under ``path``; earlier ones stay.

    A report has as many files as the result has partitions, each with a header. ``single_file`` puts it
    into one, through one task, whatever its size.
    """

    path: str | None = None
    single_file: bool = False
    written: str | None = None  # the folder of the last report
    name: str = "report"

    @property
    def configured(self) -> bool:
        return bool(self.path)

    def write(self, df: DataFrame, rows: int, scope: Sequence[Scope] | None = None) -> None:
        if not self.configured:
            raise ValueError("path is required")
        report = naive_timestamps(df)
        if self.single_file:
            report = report.coalesce(1)
        folder = f"{self.path}/{datetime.now(timezone.utc):%Y%m%dT%H%M%S.%f}"
        report.write.csv(folder, header=True)
        self.written = folder


@dataclass
class HourPartitionSink(Sink):
    """Replace what a result recomputes, and keep all other rows, in partitions of hours or days.

    With a scope, stored rows of its metrics and hours go, also where the result has none. Without, stored rows
    of a metric and hour that the result holds go. The rest of the touched dates is read, and written again
    with the result. Repeating a run leaves the target unchanged.
    """

    path: str | None = None
    unit: str = "hour"
    name: str = "partitions"

    @property
    def configured(self) -> bool:
        return bool(self.path)

    def clear(self, spark: SparkSession, scope: Sequence[Scope]) -> None:
        if _exists(spark, self.path):
            self.write(create_empty_output_dataframe(spark), 0, scope)

    def write(self, df: DataFrame, rows: int, scope: Sequence[Scope] | None = None) -> None:
        if not self.configured:
            raise ValueError("path is required")
        if self.unit not in ("hour", "day"):
            raise ValueError("unit is 'hour' or 'day'")
        spark = df.sparkSession
        parts = {"date": F.to_date("time")}
        if self.unit == "hour":
            parts["hour"] = F.hour("time")
        laid_out = _facts(df).withColumns(parts)
        folder = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        emptied: list = []
        if files.exists(folder):
            stored = self._touched(spark.read.schema(laid_out.schema).parquet(self.path), laid_out, scope)
            if scope is None:
                kept = stored.join(laid_out.select("time", "metrica").distinct(), ["time", "metrica"], "left_anti")
            else:
                inside = reduce(Column.__or__, [s.hours() for s in scope], F.lit(False))
                kept = stored.filter(~F.coalesce(inside, F.lit(False)))
            # The partitions that are read are written over, so the rows are kept elsewhere in between.
            ensure_checkpoint_dir(spark)
            merged = laid_out.unionByName(kept.select(*laid_out.columns)).checkpoint()
            names = list(parts)  # a row for each touched partition
            emptied = stored.select(names).distinct().join(merged.select(names).distinct(), names, "left_anti").collect()
            laid_out = merged
        # Few files per partition, and large partitions cut into several tasks.
        balanced = laid_out.hint("rebalance", *[F.col(name) for name in parts])
        (
            balanced.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*parts)
            .parquet(self.path)
        )
        for row in emptied:
            gone = "/".join(f"{name}={row[name]}" for name in parts)
            files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{gone}"), True)

    def _touched(self, stored: DataFrame, new: DataFrame, scope: Sequence[Scope] | None) -> DataFrame:
        """The stored rows of the dates that the result or the scope reaches."""
        first, last = new.agg(F.min("date"), F.max("date")).first()
        dates = F.col("date").between(first, last) if first is not None else F.lit(False)
        return stored.filter(reduce(Column.__or__, [part.dates() for part in scope or ()], dates))


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


@dataclass(frozen=True)
class _Days:
    """The days of a scope: ``[first, end)`` wholly, and the part days at its edges."""

    table: str
    hours: Column
    first: date
    end: date
    parts: tuple[date, ...]


@dataclass
class TablePartitionSink(Sink):
    """Facts in partitions of date and reading table, so that what a run recomputes is a set of partitions.

    The days that a scope covers wholly are overwritten, and those without rows now removed, without reading
    the target. Of a day that it covers in part, the rows outside the scope are read and written again, and nothing
    else. Without a scope, the partitions that the result reaches are replaced whole. Repeating a run
    leaves the target unchanged.
    """

    path: str | None = None
    catalog: Catalog = field(default_factory=Catalog)
    name: str = "tables"

    @property
    def configured(self) -> bool:
        return bool(self.path)

    def clear(self, spark: SparkSession, scope: Sequence[Scope]) -> None:
        if _exists(spark, self.path):
            self.write(create_empty_output_dataframe(spark), 0, scope)

    def write(self, df: DataFrame, rows: int, scope: Sequence[Scope] | None = None) -> None:
        if not self.configured:
            raise ValueError("path is required")
        spark = df.sparkSession
        laid_out = self._laid_out(_facts(df))
        if scope is None or not _exists(spark, self.path):
            self._overwrite(laid_out)
            return
        days = self._days(spark, scope)
        partial = [d for d in days if d.parts]
        if partial:
            ensure_checkpoint_dir(spark)
            stored = spark.read.schema(laid_out.schema).parquet(self.path)
            touched = reduce(Column.__or__, [(F.col("table") == d.table) & F.col("date").isin(list(d.parts)) for d in partial])
            inside = reduce(Column.__or__, [(F.col("table") == d.table) & d.hours for d in partial])
            kept = stored.where(touched & ~F.coalesce(inside, F.lit(False))).select(*laid_out.columns)
            # The partitions that are read are written over, so the rows are kept elsewhere in between.
            laid_out = laid_out.unionByName(kept).checkpoint()
        emptied = self._stored(spark, days)
        if emptied:
            # A row for each partition that has rows.
            emptied -= {(r["date"], r["table"]) for r in laid_out.select("date", "table").distinct().collect()}
        self._overwrite(laid_out)
        for day, table in sorted(emptied):
            self._files(spark)[1].delete(spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/date={day}/table={table}"), True)

    def _laid_out(self, facts: DataFrame) -> DataFrame:
        names = F.create_map(*[F.lit(part) for pair in self._tables().items() for part in pair])
        table = F.coalesce(F.try_element_at(names, F.col("metrica")), F.raise_error(F.concat(F.lit("no table has metric "), "metrica")))
        return facts.withColumns({"date": F.to_date("time"), "table": table.cast("string")})

    def _tables(self) -> dict[str, str]:
        """The reading table of each metric."""
        known = [t for t in self.catalog.select() if t.metrics != ALL_COLUMNS]
        return {name: t.key for t in known for name in build_metric_columns(t.metrics).values()}

    def _overwrite(self, laid_out: DataFrame) -> None:
        balanced = laid_out.hint("rebalance", F.col("date"), F.col("table"))
        writer = balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("date", "table").parquet(self.path)

    def _files(self, spark: SparkSession):
        root = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return root, root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _stored(self, spark: SparkSession, days: list[_Days]) -> set[tuple[date, str]]:
        """The partitions of the scope that the target has; folders are listed, no row is read."""
        root, files = self._files(spark)
        found = set()
        for folder in files.listStatus(root):
            name = folder.getPath().getName()
            if not name.startswith("date="):
                continue
            day = date.fromisoformat(name.removeprefix("date="))
            tables = {d.table for d in days if d.first <= day < d.end or day in d.parts}
            if tables:
                inside = {f.getPath().getName().removeprefix("table=") for f in files.listStatus(folder.getPath())}
                found |= {(day, table) for table in tables & inside}
        return found

    def _days(self, spark: SparkSession, scope: Sequence[Scope]) -> list[_Days]:
        """The days of each scope; its bounds are literals, computed in one row."""
        of_metric = self._tables()
        scope = [replace(part, table=part.table or of_metric[part.metrics[0]]) for part in scope]
        ranges = [part for part in scope if part.within is not None]
        bounds = []
        for part in ranges:
            start, end = F.date_trunc("hour", part.within.start), part.within.end
            bounds += [F.unix_micros(start), F.unix_micros(end)]
        moments = spark.range(1).select(*[b.alias(str(i)) for i, b in enumerate(bounds)]).first() if bounds else ()
        found = []
        for i, part in enumerate(ranges):
            start, end = (datetime(1970, 1, 1) + timedelta(microseconds=m) for m in moments[2 * i : 2 * i + 2])
            if start >= end:
                continue
            first = start.date() + timedelta(days=start.time() != time.min)
            last = end.date()
            edges = {d for d, whole in ((start.date(), start.time() == time.min), (end.date(), end.time() == time.min)) if not whole}
            found.append(_Days(part.table, part.hours(), first, last, tuple(sorted(edges))))
        for part in scope:
            if part.within is None:
                found.append(_Days(part.table, part.hours(), date.min, date.max, ()))
        return found


def materialise(df: DataFrame) -> tuple[DataFrame, int]:
    """The rows, computed once and kept in the shared folder, and their number.

    All sinks then get the same values even when executors are lost in between.
    """
    ensure_checkpoint_dir(df.sparkSession)
    observation = Observation()
    prepare(df.sparkSession)
    kept = guard_not_null(df).observe(observation, F.count(F.lit(1)).alias("rows")).checkpoint()
    return kept, observation.get["rows"]


def export(
    df: DataFrame,
    sinks: list[Sink],
    rows: int | None = None,
    scope: Sequence[Scope] | None = None,
    run: str | None = None,
) -> list[str]:
    """Write one result to several sinks; gives the names of those written.

    Nothing is written for an empty result; a sink that replaces what a run recomputes then removes what the
    target has of the ``scope``. A sink without its settings is skipped with a warning; a failing one raises.
    ``rows`` is the row count of a result that is already materialised, ``run`` the id of the run.
    """
    if rows is None:
        df, rows = materialise(df)
    if rows == 0:
        logger.warning("no rows, nothing to export")
        for sink in sinks if scope is not None else ():
            if sink.configured:
                sink.begin(run)
                sink.clear(df.sparkSession, scope)
        return []
    written = []
    for sink in sinks:
        if not sink.configured:
            logger.warning("%s skipped: missing configuration", sink.name)
            continue
        sink.begin(run)
        sink.write(df, rows, scope)
        written.append(sink.name)
    return written
