"""Hour arithmetic on timestamp columns. All results are UTC under the required session zone."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TimeLike = Column | datetime | str | None


def _utc_text(value: datetime | str) -> str:
    moment = datetime.fromisoformat(value) if isinstance(value, str) else value
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return moment.astimezone(timezone.utc).isoformat()


def ensure_utc(value: TimeLike) -> Column:
    """A timestamp column from a column, a datetime, ISO text or None.

    Values without a zone are taken as UTC, others are converted. Columns may
    hold timestamps with or without zone, dates or ISO text. Python values
    become literals, so comparisons with them reach the file scan.
    """
    if isinstance(value, Column):
        return value.cast("timestamp")
    if value is None:
        return F.lit(None).cast("timestamp")
    return F.lit(_utc_text(value)).cast("timestamp")


def add_hours(value: TimeLike, hours: Column | int) -> Column:
    """``value`` moved by ``hours``, which may be negative."""
    return ensure_utc(value) + F.make_dt_interval(hours=hours if isinstance(hours, Column) else F.lit(hours))


def truncate_to_hour(value: TimeLike) -> Column:
    """Start of the hour that holds ``value``."""
    return F.date_trunc("hour", ensure_utc(value))


def get_current_hour_start(as_of: TimeLike = None) -> Column:
    """Start of the running hour, by the query's clock unless ``as_of`` is given."""
    return truncate_to_hour(F.current_timestamp() if as_of is None else as_of)


def get_previous_hour_start(as_of: TimeLike = None) -> Column:
    """Start of the last completed hour."""
    return add_hours(get_current_hour_start(as_of), -1)


def hour_array(start: TimeLike, end: TimeLike) -> Column:
    """Array of the hours in ``[start, end)``, both cut to the hour; empty when there are none."""
    first = truncate_to_hour(start)
    stop = truncate_to_hour(end)
    hours = F.sequence(first, add_hours(stop, -1), F.make_dt_interval(hours=F.lit(1)))
    return F.when(first < stop, hours).otherwise(F.array().cast("array<timestamp>"))


def iter_hours(spark: SparkSession, start: TimeLike, end: TimeLike) -> DataFrame:
    """One row ``hour`` per hour in ``[start, end)``."""
    return spark.range(1).select(F.explode(hour_array(start, end)).alias("hour"))
