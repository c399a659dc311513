"""Metric names from reading column names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the marker that reading columns carry.
MEAN_MARKER = "_mean"


def metric_name(column: Column) -> Column:
    """The text without any occurrence of the marker, not only a trailing one."""
    return F.replace(column, F.lit(MEAN_MARKER), F.lit(""))


def build_metric_columns(metrics: Iterable[str]) -> dict[str, str]:
    """Reading column to metric name, by the same rule, at plan time."""
    return {column: column.replace(MEAN_MARKER, "") for column in metrics}
