"""Scans of the reading tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import ALL_COLUMNS, Catalog, ReadingTable
from ..functions.time import TimeLike, ensure_utc
from ..session import prepare
from .ranges import TimeRange, backfill_range, incremental_range, specific_hour, time_range


@dataclass(frozen=True)
class Readings:
    """The rows of one reading table, not yet read.

    ``rows`` may be wider than the table and shared: several tables can be kept
    as one wide base, each with its own metric and status columns. Operators
    over many tables handle such a base in one pass.
    """

    table: ReadingTable
    rows: DataFrame
    status: str = "status"
    within: TimeRange | None = None
    whole: DataFrame | None = None  # the rows without a range, where there is one
    only: Column | None = None  # the table's own range, where ``rows`` reach further

    def frame(self) -> DataFrame:
        """``time, location, <metrics>, status``, or every column for a ``*`` table."""
        rows = self.rows if self.only is None else self.rows.where(self.only)
        if self.table.metrics == ALL_COLUMNS:
            return rows
        return rows.select("time", "location", *self.table.metrics, F.col(self.status).alias("status"))


class ReadingSource:
    """Gives each catalog table as a lazy DataFrame.

    ``resolve`` maps a table to its rows; ``status`` gives the status column of
    a table by key where it is not ``status``; ``date_col`` is the date
    partition column of the stored tables, if they have one.
    """

    def __init__(
        self,
        resolve: Callable[[ReadingTable], DataFrame],
        catalog: Catalog | None = None,
        status: dict[str, str] | None = None,
        date_col: str | None = None,
    ):
        self.catalog = catalog or Catalog()
        self._resolve = resolve
        self._status = status or {}
        self._date_col = date_col

    @classmethod
    def from_tables(cls, spark: SparkSession, database: str | None = None, **kwargs) -> ReadingSource:
        """Tables of the session catalog."""
        prefix = f"{database}." if database else ""
        return cls(lambda table: spark.table(prefix + table.table), **kwargs)

    @classmethod
    def from_path(
        cls,
        spark: SparkSession,
        root: str,
        fmt: str = "parquet",
        options: dict[str, str] | None = None,
        **kwargs,
    ) -> ReadingSource:
        """One folder per table under ``root``, in any format Spark reads."""

        def resolve(table: ReadingTable) -> DataFrame:
            return spark.read.format(fmt).options(**(options or {})).load(f"{root.rstrip('/')}/{table.table}")

        return cls(resolve, **kwargs)

    @classmethod
    def from_jdbc(cls, spark: SparkSession, options: dict[str, str], **kwargs) -> ReadingSource:
        """Tables of a SQL database; the range predicate and the columns are pushed to it.

        Give ``partitionColumn``, ``lowerBound``, ``upperBound`` and
        ``numPartitions`` among the options to read in parallel. The driver jar
        has to be on the class path.
        """

        def resolve(table: ReadingTable) -> DataFrame:
            return spark.read.format("jdbc").options(**options).option("dbtable", table.table).load()

        return cls(resolve, **kwargs)

    @classmethod
    def from_frames(cls, frames: dict[str, DataFrame], **kwargs) -> ReadingSource:
        """Given DataFrames by table key."""
        return cls(lambda table: frames[table.key], **kwargs)

    @classmethod
    def from_wide(cls, base: DataFrame, status: dict[str, str], **kwargs) -> ReadingSource:
        """One wide base holding the columns of all tables, with a status column for each."""
        return cls(lambda table: base, status=status, **kwargs)

    def readings(self, keys: list[str] | None = None, within: TimeRange | None = None) -> list[Readings]:
        """The named tables (default: all), limited to a time range; no job runs."""
        ranged: dict[int, tuple[DataFrame, DataFrame]] = {}
        result = []
        for table in self.catalog.select(keys):
            base = self._resolve(table)
            prepare(base.sparkSession)
            if id(base) not in ranged:
                ranged[id(base)] = (base, self._limit(base, within))
            whole = None if within is None else base
            result.append(Readings(table, ranged[id(base)][1], self._status.get(table.key, "status"), within, whole))
        return result

    def readings_each(self, within: dict[str, TimeRange]) -> list[Readings]:
        """Tables with a range for each key.

        Tables on one base share one scan over all their ranges; each then takes the rows of its own range.
        """
        bases: dict[int, tuple[DataFrame, list[ReadingTable]]] = {}
        for table in self.catalog.select(list(within)):
            base = self._resolve(table)
            prepare(base.sparkSession)
            bases.setdefault(id(base), (base, []))[1].append(table)
        result = []
        for base, tables in bases.values():
            ranges = list({id(within[table.key]): within[table.key] for table in tables}.values())
            if len(ranges) == 1:
                rows = self._limit(base, ranges[0])
            else:
                reach = TimeRange(F.least(*[r.start for r in ranges]), F.greatest(*[r.end for r in ranges]))
                rows = self._limit(base, reach)
            for table in tables:
                own = within[table.key]
                only = own.predicate() if len(ranges) > 1 else None
                result.append(Readings(table, rows, self._status.get(table.key, "status"), own, base, only))
        return result

    def _limit(self, base: DataFrame, within: TimeRange | None) -> DataFrame:
        rows = base.withColumn("time", ensure_utc(F.col("time")))
        return rows if within is None else rows.where(within.predicate("time", self._date_col))

    def _scan(self, key: str, within: TimeRange | None) -> DataFrame:
        return self.readings([key], within)[0].frame()

    def fetch_table(self, key: str) -> DataFrame:
        """The whole table."""
        return self._scan(key, None)

    def fetch_data(
        self,
        key: str,
        start: TimeLike = None,
        end: TimeLike = None,
        as_of: TimeLike = None,
        ordered: bool = False,
    ) -> DataFrame:
        """Rows of ``[start, end)``, by default the last completed hour.

        ``ordered`` sorts by time; no operator here needs it.
        """
        scan = self._scan(key, time_range(start, end, as_of))
        return scan.orderBy("time") if ordered else scan

    def fetch_incremental_data(
        self, key: str, last_processed_hour: TimeLike = None, as_of: TimeLike = None
    ) -> DataFrame:
        """Rows after the last processed hour and before the running hour; may be none."""
        return self._scan(key, incremental_range(last_processed_hour, as_of))

    def fetch_specific_hour(self, key: str, hour: TimeLike) -> DataFrame:
        """Rows of one hour."""
        return self._scan(key, specific_hour(hour))

    def backfill_hours(self, key: str, start: TimeLike, end: TimeLike) -> DataFrame:
        """Rows of all hours in ``[start, end)`` as one scan."""
        return self._scan(key, backfill_range(start, end))


def by_base(readings: list[Readings]) -> list[list[Readings]]:
    """Tables grouped by the base they share, in first-seen order."""
    groups: dict[int, list[Readings]] = {}
    for item in readings:
        groups.setdefault(id(item.rows), []).append(item)
    return list(groups.values())
