"""Data-quality checks; every function makes one aggregate over its input."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog import METRIC_RANGES, STATUS_DOMAIN, VALID_STATUS
from ..schema import REQUIRED_INPUT_COLUMNS
from ..sources.readings import Readings, by_base

logger = logging.getLogger(__name__)

TEMPORAL_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType, T.DayTimeIntervalType, T.TimeType)


class DataValidationError(Exception):
    """The readings break a rule that later steps rely on."""


def _null_count(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def _share(part: Column, total: Column) -> Column:
    return F.try_divide(part.cast("double"), total.cast("double"))


def _score(columns: list[str], status: str | None, total: Column) -> Column:
    """Mean of completeness over ``columns`` and the share of valid rows; 0 for no rows."""
    if columns:
        complete = reduce(Column.__add__, [_share(F.count(F.col(c)), total) for c in columns]) / F.lit(
            float(len(columns))
        )
    else:
        complete = F.lit(1.0)
    valid = F.lit(1.0) if status is None else _share(F.count_if(F.col(status) == VALID_STATUS), total)
    return F.when(total > 0, (complete + valid) / F.lit(2.0)).otherwise(F.lit(0.0))


def quality_score(df: DataFrame, keys: list[Column | str] | None = None) -> DataFrame:
    """Column ``quality_score`` in one row, or in one row per group of ``keys``.

    Completeness covers every column but ``time``.
    """
    columns = [c for c in df.columns if c != "time"]
    status = "status" if "status" in df.columns else None
    rows = F.count(F.lit(1))
    return df.groupBy(*(keys or [])).agg(rows.alias("rows"), _score(columns, status, rows).alias("quality_score"))


def validate_data_quality_score(df: DataFrame) -> float:
    """The score of a whole frame as a number."""
    if not df.columns:
        return 0.0
    return quality_score(df).first()["quality_score"]


def table_quality(readings: list[Readings], keys: dict[str, Column] | None = None) -> DataFrame:
    """One score per table, and per group of ``keys`` when given; tables on a shared base in one pass."""
    keys = keys or {}
    parts = []
    for group in by_base(readings):
        rows = F.count(F.lit(1))
        scored = (
            group[0]
            .rows.groupBy(*[column.alias(name) for name, column in keys.items()])
            .agg(
                rows.alias("rows"),
                *[
                    _score(["location", *item.table.metrics, item.status], item.status, rows).alias(item.table.key)
                    for item in group
                ],
            )
        )
        parts.append(scored.unpivot([*keys, "rows"], [i.table.key for i in group], "pollutant", "quality_score"))
    return reduce(DataFrame.unionByName, parts)


def null_profile(df: DataFrame) -> DataFrame:
    """``column_name, null_count, total_rows`` for every column."""
    counts = df.agg(F.count(F.lit(1)).alias("total_rows"), *[_null_count(f"`{c}`").alias(c) for c in df.columns])
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("null_count")) for c in df.columns]
    return counts.select(F.inline(F.array(*cells)), "total_rows")


def status_domain_report(df: DataFrame, status: str = "status") -> DataFrame:
    """Status codes outside the domain, with their row counts."""
    return df.where(~F.col(status).isin(STATUS_DOMAIN)).groupBy(F.col(status).alias("status")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def table_status_report(readings: list[Readings]) -> DataFrame:
    """The same for many tables, as ``pollutant, status, rows``.

    A shared base is read once: its rows are first counted per combination of
    status codes, and only those few combinations are split by table.
    """
    parts = []
    for group in by_base(readings):
        combinations = group[0].rows.groupBy(*dict.fromkeys(i.status for i in group)).agg(F.count(F.lit(1)).alias("n"))
        codes = F.array(
            *[F.struct(F.lit(i.table.key).alias("pollutant"), F.col(i.status).alias("status")) for i in group]
        )
        parts.append(combinations.select(F.inline(codes), "n"))
    return (
        reduce(DataFrame.unionByName, parts)
        .where(~F.col("status").isin(STATUS_DOMAIN))
        .groupBy("pollutant", "status")
        .agg(F.sum("n").alias("rows"))
    )


def _range_rows(df: DataFrame, checks: list[tuple[str, str, float, float]]) -> DataFrame:
    """Min, max and outliers of (pollutant, metric, low, high) checks, one aggregate for all."""
    aggregates, cells = [], []
    for pollutant, metric, low, high in checks:
        number = F.when(~F.isnan(metric), F.col(metric))
        aggregates += [
            F.min(number).alias(f"{metric}.min"),
            F.max(number).alias(f"{metric}.max"),
            F.count_if((number < low) | (number > high)).alias(f"{metric}.outside"),
            F.count(F.col(metric)).alias(f"{metric}.count"),
        ]
        cells.append(
            F.struct(
                F.lit(pollutant).alias("pollutant"),
                F.lit(metric).alias("metric"),
                F.lit(float(low)).alias("min_allowed"),
                F.lit(float(high)).alias("max_allowed"),
                F.col(f"`{metric}.min`").cast("double").alias("actual_min"),
                F.col(f"`{metric}.max`").cast("double").alias("actual_max"),
                F.col(f"`{metric}.outside`").alias("rows_outside"),
                F.col(f"`{metric}.count`").alias("rows_checked"),
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*cells))).where(F.col("rows_checked") > 0)


# How many unknown codes a warning names.
NAMED_CODES = 20


def _checks(pollutant: str | None, columns: list[str]) -> list[tuple[str, str, float, float]]:
    ranges = METRIC_RANGES.get(pollutant, {})
    return [(pollutant, metric, low, high) for metric, (low, high) in ranges.items() if metric in columns]


def range_check_report(df: DataFrame, pollutant: str) -> DataFrame | None:
    """Bounds are inclusive. Absent and all-null metrics give no row; NaN counts as neither in nor out.

    None when the table has no bounds for any column of ``df``.
    """
    checks = _checks(pollutant, df.columns)
    return _range_rows(df, checks) if checks else None


def table_range_report(readings: list[Readings]) -> DataFrame:
    """The range check of many tables."""
    parts = []
    for group in by_base(readings):
        checks = [c for item in group for c in _checks(item.table.key, list(item.table.metrics))]
        if checks:
            parts.append(_range_rows(group[0].rows, checks))
    return reduce(DataFrame.unionByName, parts)


def validation_profile(df: DataFrame, pollutant: str | None = None) -> DataFrame:
    """The numbers that the gate judges by, in one row: counts, and least and greatest value per bounded metric."""
    aggregates = [F.count(F.lit(1)).alias("total_rows")]
    if "time" in df.columns:
        aggregates.append(_null_count("time").alias("time_nulls"))
    if "status" in df.columns:
        aggregates.append(_null_count("status").alias("status_nulls"))
        aggregates.append(F.count_if(~F.col("status").isin(STATUS_DOMAIN)).alias("status_unknown"))
    for _, metric, _, _ in _checks(pollutant, df.columns):
        number = F.when(~F.isnan(metric), F.col(metric))
        aggregates.append(F.min(number).alias(f"{metric}_min"))
        aggregates.append(F.max(number).alias(f"{metric}_max"))
    return df.agg(*aggregates)


def validate_dataframe(
    df: DataFrame,
    required_columns: list[str] | None = None,
    pollutant_type: str | None = None,
) -> bool:
    """Gate before the transform: raises DataValidationError, or returns True.

    Checked in order: no rows, missing columns, null times, a time column that
    is not temporal, null statuses. Unknown statuses and values out of range
    are logged as warnings. All counts come from a single job.
    """
    if not df.columns:
        raise DataValidationError("DataFrame is empty")
    profile = validation_profile(df, pollutant_type).first()
    if profile["total_rows"] == 0:
        raise DataValidationError("DataFrame is empty")
    missing = [c for c in (required_columns or REQUIRED_INPUT_COLUMNS) if c not in df.columns]
    if missing:
        raise DataValidationError(f"Missing required columns: {missing}")
    if "time" in df.columns:
        if profile["time_nulls"]:
            raise DataValidationError(f"Time column contains {profile['time_nulls']} null values")
        kind = df.schema["time"].dataType
        if not isinstance(kind, TEMPORAL_TYPES):
            raise DataValidationError(f"Time column has invalid type: {kind.simpleString()}")
    if "status" in df.columns:
        if profile["status_nulls"]:
            raise DataValidationError(f"Status column contains {profile['status_nulls']} null values")
        if profile["status_unknown"]:
            codes = df.where(~F.col("status").isin(STATUS_DOMAIN)).select("status").distinct().orderBy("status")
            named = [row["status"] for row in codes.limit(NAMED_CODES).collect()]
            logger.warning(
                "%d rows have a status outside %s, such as %s; status_domain_report lists all codes",
                profile["status_unknown"],
                STATUS_DOMAIN,
                named,
            )
    for pollutant, metric, low, high in _checks(pollutant_type, df.columns):
        least, most = profile[f"{metric}_min"], profile[f"{metric}_max"]
        if least is not None and (least < low or most > high):
            logger.warning("%s.%s lies in [%s, %s], expected [%s, %s]", pollutant, metric, least, most, low, high)
    return True
