"""Hourly means and valid-row counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import VALID_STATUS
from ..functions.naming import build_metric_columns
from ..functions.time import truncate_to_hour
from ..schema import create_empty_output_dataframe, validate_output_schema
from ..sources.readings import Readings, by_base


def is_valid(status: str = "status") -> Column:
    return F.col(status) == VALID_STATUS


def valid_rows(df: DataFrame, status: str = "status") -> DataFrame:
    """Rows marked valid; a null status is not."""
    return df.where(is_valid(status))


def _by_hour(df: DataFrame, time_col: str, location_col: str, watermark_delay: str | None):
    """Grouping by hour and location; for a stream, by windows that a watermark closes."""
    location = F.col(location_col).alias("location")
    if watermark_delay is None:
        return df.groupBy(truncate_to_hour(F.col(time_col)).alias("time"), location)
    return df.withWatermark(time_col, watermark_delay).groupBy(F.window(time_col, "1 hour").alias("hour"), location)


def _start_of_hour(watermark_delay: str | None) -> Column:
    return (F.col("time") if watermark_delay is None else F.col("hour.start")).alias("time")


def hourly_wide(
    df: DataFrame,
    metrics: list[str],
    time_col: str = "time",
    location_col: str = "location",
    watermark_delay: str | None = None,
) -> DataFrame:
    """One row per hour and location of the valid rows: a mean per metric, and ``count_ok``.

    ``count_ok`` counts valid rows, whether or not a metric is null in them.
    Means are partial sums before the shuffle, so an hour or location that
    holds much of the data still sends one small row per map task.
    """
    grouped = _by_hour(valid_rows(df), time_col, location_col, watermark_delay)
    wide = grouped.agg(F.count(F.lit(1)).alias("count_ok"), *[F.avg(m).alias(m) for m in metrics])
    return wide.select(_start_of_hour(watermark_delay), "location", *metrics, "count_ok")


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _name(column: str) -> str:
    escaped = column.replace("`", "``")
    return f"`{escaped}`"


def _cells(cells: list[tuple[str, str, str]]) -> Column:
    """One (metrica, valor, count_ok) row per cell of (name, value column, count column); null values stay."""
    rows = [f"{_text(name)}, double({_name(value)}), {_name(count)}" for name, value, count in cells]
    return F.expr(f"stack({len(rows)}, {', '.join(rows)})").alias("metrica", "valor", "count_ok")


def wide_to_long(wide: DataFrame, metric_columns: dict[str, str], version: str | None = None) -> DataFrame:
    """Reshape the hourly rows; this is after the aggregate, so it touches little data."""
    cells = [(name, column, "count_ok") for column, name in metric_columns.items()]
    return validate_output_schema(
        wide.select("time", "location", _cells(cells), F.lit(version).cast("string").alias("version"))
    )


def aggregate_to_long_format(
    df: DataFrame,
    time_col: str = "time",
    location_col: str = "location",
    metric_columns: dict[str, str] | None = None,
    version: str | None = None,
) -> DataFrame:
    """Wide minute rows to long hourly rows, in one scan and one shuffle.

    ``metric_columns`` maps reading columns to metric names. An input without
    rows or columns gives the empty fact table.
    """
    if not metric_columns:
        raise ValueError("metric_columns cannot be None or empty")
    if not df.columns:
        return create_empty_output_dataframe(df.sparkSession)
    wide = hourly_wide(df, list(metric_columns), time_col, location_col)
    return wide_to_long(wide, metric_columns, version)


def hourly_long(
    readings: list[Readings], version: str | None = None, watermark_delay: str | None = None
) -> DataFrame:
    """Hourly long rows of many tables.

    Tables stored on their own give one aggregate each and a union. Tables that
    share a wide base are aggregated together: one scan and one shuffle for all.
    Streams need a ``watermark_delay``.
    """
    if not readings:
        return create_empty_output_dataframe(SparkSession.active())
    parts = [
        _own_table(group[0], version, watermark_delay)
        if len(group) == 1
        else _shared_base(group, version, watermark_delay)
        for group in by_base(readings)
    ]
    return reduce(DataFrame.unionByName, parts)


def _own_table(item: Readings, version: str | None, watermark_delay: str | None) -> DataFrame:
    names = build_metric_columns(item.table.metrics)
    return wide_to_long(hourly_wide(item.frame(), list(names), watermark_delay=watermark_delay), names, version)


def _shared_base(
    group: list[Readings], version: str | None, watermark_delay: str | None = None, fetched: bool = False
) -> DataFrame:
    flags = {}
    aggregates = []
    cells = []
    for item in group:
        key = item.table.key
        valid = f"{key}.valid"
        # A flag per row, so that the status text is compared once and not once per metric.
        marked = is_valid(item.status) if item.only is None else is_valid(item.status) & item.only
        flags[valid] = F.coalesce(marked, F.lit(False))
        aggregates.append(F.expr(f"count_if({_name(valid)})").alias(f"{key}.count_ok"))
        for column, name in build_metric_columns(item.table.metrics).items():
            aggregates.append(F.expr(f"avg({_name(column)}) FILTER (WHERE {_name(valid)})").alias(f"{key}.{column}"))
            cells.append((name, f"{key}.{column}", f"{key}.count_ok"))
    metrics = dict.fromkeys(metric for item in group for metric in item.table.metrics)
    rows = group[0].rows.select("time", "location", *metrics, *[flag.alias(name) for name, flag in flags.items()])
    if fetched:
        aggregates.append(F.count(F.lit(1)).alias("fetched"))
    if watermark_delay is not None:
        # Only valid rows move the watermark. A batch needs no such filter: few rows are
        # invalid for every table, and testing all flags beforehand costs more than it saves.
        rows = rows.where(" OR ".join(_name(flag) for flag in flags))
    hourly = _by_hour(rows, "time", "location", watermark_delay).agg(*aggregates)
    long = hourly.select(
        _start_of_hour(watermark_delay),
        "location",
        _cells(cells),
        F.lit(version).cast("string").alias("version"),
        *(["fetched"] if fetched else []),
    )
    return long if fetched else validate_output_schema(long.where(F.col("count_ok") > 0))


def hourly_long_fetched(readings: list[Readings], version: str | None = None) -> DataFrame:
    """Like ``hourly_long``, with the column ``fetched``: rows of any status in the hour and location.

    Hours without valid rows are kept, with ``count_ok`` 0, so the counts add up
    to what was read. The status filter cannot reach the scan here.
    """
    return reduce(DataFrame.unionByName, [_shared_base(group, version, fetched=True) for group in by_base(readings)])


def naive_timestamps(df: DataFrame) -> DataFrame:
    """Timestamps without zone, showing the UTC wall clock, for files that know no zones."""
    return df.select(
        *[
            F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(name)
            for name, kind in df.dtypes
        ]
    )
