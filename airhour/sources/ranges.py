"""Half-open time ranges as predicates that the file scan can use."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.time import (
    TimeLike,
    add_hours,
    ensure_utc,
    get_current_hour_start,
    get_previous_hour_start,
    truncate_to_hour,
)

# Fixed value: the lower bound when only an end is given.
EPOCH = "1970-01-01T00:00:00Z"


@dataclass(frozen=True)
class TimeRange:
    """``[start, end)``; a range whose start is not before its end selects nothing."""

    start: Column
    end: Column

    def predicate(self, time_col: str = "time", date_col: str | None = None) -> Column:
        """Rows inside the range.

        ``date_col`` names a partition column holding the date of ``time_col``.
        The extra bounds on it select no fewer rows, they let Spark skip the
        directories of other days. The comparison of the bounds is constant
        for literals, so an empty range is planned without a scan.
        """
        time = F.col(time_col)
        inside = (self.start < self.end) & (time >= self.start) & (time < self.end)
        if date_col is None:
            return inside
        date = F.col(date_col)
        return inside & (date >= F.to_date(self.start)) & (date <= F.to_date(self.end))


def time_range(start: TimeLike = None, end: TimeLike = None, as_of: TimeLike = None) -> TimeRange:
    """Explicit bounds.

    Neither bound: the last completed hour. No start: from the epoch. No end:
    until ``as_of``, by default the query's clock.
    """
    if start is None and end is None:
        return TimeRange(get_previous_hour_start(as_of), get_current_hour_start(as_of))
    if end is None:
        end = F.current_timestamp() if as_of is None else as_of
    return TimeRange(ensure_utc(EPOCH if start is None else start), ensure_utc(end))


def incremental_range(last_processed_hour: TimeLike = None, as_of: TimeLike = None) -> TimeRange:
    """Everything after the last processed hour, up to the running hour.

    Without a processed hour (None, or a null in a column) only the last
    completed hour is read. The processed hour is not truncated.
    """
    following = F.coalesce(add_hours(last_processed_hour, 1), get_previous_hour_start(as_of))
    return TimeRange(following, get_current_hour_start(as_of))


def specific_hour(hour: TimeLike) -> TimeRange:
    """One hour from the given moment on."""
    return TimeRange(ensure_utc(hour), add_hours(hour, 1))


def backfill_range(start: TimeLike, end: TimeLike) -> TimeRange:
    """All whole hours from ``start``'s hour up to, but without, ``end``'s hour."""
    return TimeRange(truncate_to_hour(start), truncate_to_hour(end))
