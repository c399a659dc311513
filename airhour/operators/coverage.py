"""Which hours have data and which are missing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import TimeLike, add_hours, hour_array, truncate_to_hour
from ..sources.readings import Readings, by_base


def missing_hours(states: DataFrame, as_of: TimeLike = None, hour_col: str = "last_processed_hour") -> DataFrame:
    """Each state row once per hour after its processed hour and before the running hour, as ``hour``.

    A row without a processed hour has no missing hours.
    """
    now = F.current_timestamp() if as_of is None else as_of
    last = F.col(hour_col)
    hours = F.when(last.isNotNull(), hour_array(add_hours(last, 1), now))
    return states.select("*", F.explode(hours).alias("hour"))


def find_missing_hours(spark: SparkSession, last_processed_hour: TimeLike, current_time: TimeLike) -> DataFrame:
    """The same for one processed hour: rows ``hour``."""
    return spark.range(1).select(F.explode(hour_array(add_hours(last_processed_hour, 1), current_time)).alias("hour"))


def preview(hours: DataFrame, n: int = 5) -> tuple[list, int]:
    """The first ``n`` hours in order, and how many more there are."""
    first = [row["hour"] for row in hours.select("hour").orderBy("hour").limit(n).collect()]
    return first, hours.count() - len(first)


def hours_with_data(readings: list[Readings], by_location: bool = False) -> DataFrame:
    """``pollutant, [location,] hour, rows`` of the hours that hold any row, valid or not.

    Null keys are dropped here, as a join on them would; both uses in a gap
    report then share one scan.
    """
    hour = truncate_to_hour(F.col("time"))
    keys = ["location"] if by_location else []
    parts = []
    for group in by_base(readings):
        rows = group[0].rows.where(hour.isNotNull())
        for key in keys:
            rows = rows.where(F.col(key).isNotNull())
        counted = rows.groupBy(hour.alias("hour"), *keys).agg(F.count(F.lit(1)).alias("rows"))
        tables = F.array(*[F.lit(item.table.key) for item in group])
        parts.append(counted.select(F.explode(tables).alias("pollutant"), *keys, "hour", "rows"))
    return reduce(DataFrame.unionByName, parts)


def requested_hours(
    readings: list[Readings], start: TimeLike, end: TimeLike, locations: DataFrame | None = None
) -> DataFrame:
    """``pollutant, [location,] hour`` for every hour in ``[start, end)``.

    The hours are exploded per table (and per row of ``locations``, which has a
    ``location`` and may have a ``pollutant``), so no join is needed.
    """
    tables = F.array(*[F.lit(item.table.key) for item in readings])
    hours = F.explode(hour_array(start, end)).alias("hour")
    if locations is None:
        spine = readings[0].rows.sparkSession.range(1).select(F.explode(tables).alias("pollutant"))
        return spine.select("pollutant", hours)
    if "pollutant" not in locations.columns:
        locations = locations.select(F.explode(tables).alias("pollutant"), "location")
    return locations.select("pollutant", "location", hours)


def stations(readings: list[Readings]) -> DataFrame:
    """``pollutant, location`` of all rows of the tables, also outside the range of ``readings``."""
    parts = []
    for group in by_base(readings):
        rows = group[0].rows if group[0].whole is None else group[0].whole
        known = rows.where(F.col("location").isNotNull()).select("location").distinct()
        tables = F.array(*[F.lit(item.table.key) for item in group])
        parts.append(known.select(F.explode(tables).alias("pollutant"), "location"))
    return reduce(DataFrame.unionByName, parts)


def coverage_gaps(
    readings: list[Readings],
    start: TimeLike,
    end: TimeLike,
    by_location: bool = False,
    locations: DataFrame | None = None,
) -> DataFrame:
    """Requested hours without any row.

    With ``by_location`` the expected locations are ``locations`` (a station
    list), or else those that each table has at any time: a station that is silent
    for the whole range is a gap too. That reads one column of the whole tables;
    give a list to avoid it. The join is on whole hours after aggregation; its
    sides are sized at run time.
    """
    present = hours_with_data(readings, by_location or locations is not None)
    if by_location and locations is None:
        limited = any(item.whole is not None for item in readings)
        locations = stations(readings) if limited else present.select("pollutant", "location").distinct()
    spine = requested_hours(readings, start, end, locations)
    return spine.join(present, spine.columns, "left_anti")


def coverage_present(readings: list[Readings], start: TimeLike, end: TimeLike) -> DataFrame:
    """Requested hours that hold data."""
    spine = requested_hours(readings, start, end)
    return spine.join(hours_with_data(readings), spine.columns, "left_semi")
