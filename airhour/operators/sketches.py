"""Checks by group, and quantile sketches that add up over days and stations.

Exact counts per hour and station say where values left their range or statuses were unknown. A quantile sketch
(KLL) per table, metric, day and station is a few kilobytes however many rows it saw; sketches merge into those of
any longer time or wider area, so distributions are compared without reading the rows again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import METRIC_RANGES, STATUS_DOMAIN, VALID_STATUS
from ..functions.time import truncate_to_hour
from ..sources.readings import Readings, by_base

# Rows that a sketch level holds: ranks are off by less than RANK_BOUND with a chance far above 99 per cent.
SKETCH_K = 800
RANK_BOUND = 0.015
DECILES = [i / 10 for i in range(1, 10)]
SKETCHES = "pollutant string, metric string, location string, n bigint, sketch binary, date date"
SERIES = ["pollutant", "metric"]


def by_hour_and_station() -> dict[str, Column]:
    return {"hour": truncate_to_hour(F.col("time")), "location": F.col("location")}


def _number(column: str) -> Column:
    """A value that counts: neither null nor NaN."""
    value = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(value), value)


def range_report_by(readings: list[Readings], keys: dict[str, Column] | None = None) -> DataFrame:
    """The range check in one row per table, metric and group of ``keys`` (by default hour and station).

    ``rows_checked, rows_outside, actual_min, actual_max``; groups without any value give no row. One scan
    and one shuffle per base.
    """
    keys = by_hour_and_station() if keys is None else keys
    parts = []
    for group in by_base(readings):
        aggregates, cells = [], []
        for item in group:
            for metric, (low, high) in METRIC_RANGES.get(item.table.key, {}).items():
                if metric not in item.table.metrics:
                    continue
                value = _number(metric) if item.only is None else F.when(item.only, _number(metric))
                figures = F.struct(
                    F.count(value).alias("rows_checked"),
                    F.count_if((value < float(low)) | (value > float(high))).alias("rows_outside"),
                    F.min(value).alias("actual_min"),
                    F.max(value).alias("actual_max"),
                )
                aggregates.append(figures.alias(f"{item.table.key}.{metric}"))
                own = F.col(f"`{item.table.key}.{metric}`")
                names = ("rows_checked", "rows_outside", "actual_min", "actual_max")
                cells.append(
                    F.struct(
                        F.lit(item.table.key).alias("pollutant"), F.lit(metric).alias("metric"), *[own[n].alias(n) for n in names]
                    )
                )
        if cells:
            found = group[0].rows.groupBy(*[column.alias(name) for name, column in keys.items()]).agg(*aggregates)
            parts.append(found.select(*keys, F.inline(F.array(*cells))).where("rows_checked > 0"))
    return reduce(DataFrame.unionByName, parts)


def status_report_by(readings: list[Readings], keys: dict[str, Column] | None = None) -> DataFrame:
    """``rows, valid_rows, null_rows, unknown_rows`` per table and group of ``keys`` (by default hour and station)."""
    keys = by_hour_and_station() if keys is None else keys
    parts = []
    for group in by_base(readings):
        aggregates, cells = [], []
        for item in group:
            status = F.col(f"`{item.status}`")
            own = F.lit(True) if item.only is None else item.only
            figures = F.struct(
                F.count_if(own).alias("rows"),
                F.count_if(own & (status == VALID_STATUS)).alias("valid_rows"),
                F.count_if(own & status.isNull()).alias("null_rows"),
                F.count_if(own & ~status.isin(STATUS_DOMAIN)).alias("unknown_rows"),
            )
            aggregates.append(figures.alias(item.table.key))
            names = ("rows", "valid_rows", "null_rows", "unknown_rows")
            column = F.col(f"`{item.table.key}`")
            cells.append(F.struct(F.lit(item.table.key).alias("pollutant"), *[column[n].alias(n) for n in names]))
        found = group[0].rows.groupBy(*[column.alias(name) for name, column in keys.items()]).agg(*aggregates)
        parts.append(found.select(*keys, F.inline(F.array(*cells))).where("rows > 0"))
    return reduce(DataFrame.unionByName, parts)


def daily_sketches(readings: list[Readings], k: int = SKETCH_K) -> DataFrame:
    """``pollutant, metric, location, date, n, sketch`` of the valid values of each metric; none without values.

    Sketches are aggregated before the shuffle, so a day or station that holds much of the data sends one
    sketch per map task.
    """
    parts = []
    for group in by_base(readings):
        aggregates, cells = [], []
        for item in group:
            valid = F.col(f"`{item.status}`") == VALID_STATUS
            if item.only is not None:
                valid = valid & item.only
            for metric in item.table.metrics:
                value = F.when(valid, _number(metric))
                name = f"{item.table.key}.{metric}"
                aggregates.append(
                    F.struct(F.count(value).alias("n"), F.kll_sketch_agg_double(value, F.lit(k)).alias("sketch")).alias(name)
                )
                own = F.col(f"`{name}`")
                cells.append(
                    F.struct(
                        F.lit(item.table.key).alias("pollutant"),
                        F.lit(metric).alias("metric"),
                        own["n"].alias("n"),
                        own["sketch"].alias("sketch"),
                    )
                )
        days = group[0].rows.groupBy("location", F.to_date("time").alias("date")).agg(*aggregates)
        parts.append(days.select(F.inline(F.array(*cells)), "location", "date").where("n > 0"))
    return reduce(DataFrame.unionByName, parts).select(*SERIES, "location", "n", "sketch", "date")


def merge_sketches(sketches: DataFrame, *keys: str) -> DataFrame:
    """One sketch per group of ``keys``."""
    return sketches.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_quantiles(sketches: DataFrame, ranks: list[float] | None = None) -> DataFrame:
    """The rows of ``sketches`` once per rank, with ``rank`` and the ``quantile`` there."""
    at = F.array(*[F.lit(float(r)) for r in (DECILES if ranks is None else ranks)])
    others = [c for c in sketches.columns if c != "sketch"]
    found = F.arrays_zip(at.alias("rank"), F.kll_sketch_get_quantile_double("sketch", at).alias("quantile"))
    return sketches.select(*others, F.inline(found).alias("rank", "quantile"))


def sketch_drift(before: DataFrame, after: DataFrame, keys: list[str], ranks: list[float] | None = None) -> DataFrame:
    """How far two distributions are apart: per group the greatest difference of quantiles, over their common spread.

    0 for equal quantiles; 1 if some quantile moved by the whole distance between the lowest and highest of both.
    Groups that only one side has give no row.
    """
    left = sketch_quantiles(before, ranks).select(*keys, "rank", F.col("quantile").alias("low"))
    right = sketch_quantiles(after, ranks).select(*keys, "rank", F.col("quantile").alias("high"))
    both = left.join(right, [*keys, "rank"])
    spread = F.max(F.greatest("low", "high")) - F.min(F.least("low", "high"))
    moved = F.max(F.abs(F.col("high") - F.col("low")))
    return both.groupBy(*keys).agg(F.coalesce(F.try_divide(moved, spread), F.lit(0.0)).alias("drift"))


class SketchTable:
    """Sketches in a shared folder, by date. Writing the days of a range again replaces them."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def put(self, sketches: DataFrame) -> None:
        """Replace the dates that ``sketches`` has; they have to hold these dates whole."""
        writer = sketches.hint("rebalance", F.col("date")).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(SKETCHES).parquet(self.path)


def measured_ranks(readings: list[Readings], quantiles: DataFrame) -> DataFrame:
    """``quantiles`` (``pollutant, metric, rank, quantile``) with ``n`` and the share of valid values at or below each.

    One pass over the rows; the quantiles, a few for each metric, become literals of it.
    """
    wanted: dict[tuple[str, str], list[tuple[float, float]]] = {}
    for row in quantiles.select(*SERIES, "rank", "quantile").collect():
        wanted.setdefault((row.pollutant, row.metric), []).append((row["rank"], row.quantile))
    parts = []
    for group in by_base(readings):
        aggregates, cells = [], []
        for item in group:
            valid = F.col(f"`{item.status}`") == VALID_STATUS
            for metric in item.table.metrics:
                value = F.when(valid, _number(metric))
                count = f"{item.table.key}.{metric}"
                aggregates.append(F.count(value).alias(count))
                for i, (rank, quantile) in enumerate(wanted.get((item.table.key, metric), [])):
                    aggregates.append(F.count_if(value <= quantile).alias(f"{count}.{i}"))
                    aggregates.append(F.count_if(value < quantile).alias(f"{count}.{i}.below"))
                    cells.append(
                        F.struct(
                            F.lit(item.table.key).alias("pollutant"),
                            F.lit(metric).alias("metric"),
                            F.lit(rank).alias("rank"),
                            F.col(f"`{count}`").alias("n"),
                            (F.col(f"`{count}.{i}.below`") / F.col(f"`{count}`")).alias("rank_below"),
                            (F.col(f"`{count}.{i}`") / F.col(f"`{count}`")).alias("rank_reached"),
                        )
                    )
        parts.append(group[0].rows.agg(*aggregates).select(F.inline(F.array(*cells))))
    return reduce(DataFrame.unionByName, parts)
