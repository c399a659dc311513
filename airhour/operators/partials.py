"""Hourly sums and counts that add up.

A mean cannot be corrected when a late row arrives, its sum and counts can. Partials of any two sets of
rows are merged by adding them, in any order; ``finish`` gives the hourly rows that all of the rows together have.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.naming import build_metric_columns
from ..functions.time import truncate_to_hour
from ..schema import validate_output_schema
from ..sources.readings import Readings, by_base
from .hourly import is_valid

PARTIALS = (
    "time timestamp, location string, metrica string, total double, n_values bigint, count_ok bigint, newest timestamp"
)
KEYS = ["time", "location", "metrica"]


def _partials_of(group: list[Readings]) -> DataFrame:
    """One scan and one shuffle for all tables on a base, as for the hourly means."""
    flags, aggregates, cells = {}, [], []
    for item in group:
        valid = is_valid(item.status) if item.only is None else is_valid(item.status) & item.only
        flags[f"{item.table.key}.valid"] = F.coalesce(valid, F.lit(False))
        marked = F.col(f"`{item.table.key}.valid`")
        aggregates.append(F.count_if(marked).alias(f"{item.table.key}.rows"))
        for column, name in build_metric_columns(item.table.metrics).items():
            value = F.when(marked, F.col(f"`{column}`").cast("double"))
            aggregates.append(F.struct(F.sum(value).alias("total"), F.count(value).alias("n")).alias(f"{item.table.key}.{column}"))
            own = F.col(f"`{item.table.key}.{column}`")
            cells.append(
                F.struct(
                    F.lit(name).alias("metrica"),
                    own["total"].alias("total"),
                    own["n"].alias("n_values"),
                    F.col(f"`{item.table.key}.rows`").alias("count_ok"),
                )
            )
    metrics = dict.fromkeys(metric for item in group for metric in item.table.metrics)
    rows = group[0].rows.select("time", "location", *metrics, *[flag.alias(name) for name, flag in flags.items()])
    some = reduce(Column.__or__, [F.col(f"`{name}`") for name in flags])
    hourly = rows.groupBy(truncate_to_hour(F.col("time")).alias("hour"), "location").agg(
        *aggregates, F.max(F.when(some, F.col("time"))).alias("newest")
    )
    long = hourly.select(F.col("hour").alias("time"), "location", F.inline(F.array(*cells)), "newest")
    return long.where("count_ok > 0").select(*KEYS, "total", "n_values", "count_ok", "newest")


def hourly_partials(readings: list[Readings]) -> DataFrame:
    """``time, location, metrica, total, n_values, count_ok, newest`` of the valid rows.

    ``total`` is null without values; ``newest`` is the time of the newest row of the hour and location that is valid
    for any table of its base.
    """
    return reduce(DataFrame.unionByName, [_partials_of(group) for group in by_base(readings)])


def merge_partials(partials: DataFrame) -> DataFrame:
    """One row per hour, location and metric."""
    return partials.groupBy(*KEYS).agg(
        F.sum("total").alias("total"),
        F.sum("n_values").alias("n_values"),
        F.sum("count_ok").alias("count_ok"),
        F.max("newest").alias("newest"),
    )


def finish(partials: DataFrame, version: str | None = None) -> DataFrame:
    """The hourly rows of merged partials."""
    return validate_output_schema(
        partials.select(
            *KEYS,
            F.try_divide("total", "n_values").alias("valor"),
            "count_ok",
            F.lit(version).cast("string").alias("version"),
        )
    )
