"""Presence as bitmaps: which hours of a day a station has rows in, as 24 bits.

A bitmap is one number per table, station and day, so bitmaps of a year are small, and those of two sets of
rows are merged by a bitwise or: adding rows again changes nothing. Gaps are found between set bits of a day and
from one day with data to the next, so no list of all requested hours is made; only gaps become rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.time import TimeLike, hour_array, truncate_to_hour
from ..session import ensure_checkpoint_dir
from ..sources.readings import Readings, by_base

PRESENCE = "pollutant string, location string, hours bigint, date date"
KEYS = ["pollutant", "location"]


def presence_days(readings: list[Readings]) -> DataFrame:
    """``pollutant, location, date, hours``: bit h of ``hours`` is set if hour h of the day holds any row, valid or not.

    One aggregate with fixed-width buffers per base; rows without time or location count nowhere.
    """
    bit = F.expr("shiftleft(1L, hour(time))")
    parts = []
    for group in by_base(readings):
        rows = group[0].rows.where(F.col("time").isNotNull() & F.col("location").isNotNull())
        days = rows.groupBy("location", F.to_date("time").alias("date"))
        if all(item.only is None for item in group):
            tables = F.array(*[F.lit(item.table.key) for item in group])
            found = days.agg(F.bit_or(bit).alias("hours"))
            parts.append(found.select(F.explode(tables).alias("pollutant"), "location", "date", "hours"))
        else:
            own = [F.bit_or(bit if i.only is None else F.when(i.only, bit)).alias(i.table.key) for i in group]
            found = days.agg(*own).unpivot(["location", "date"], [i.table.key for i in group], "pollutant", "hours")
            parts.append(found.where("hours is not null").select("pollutant", "location", "date", "hours"))
    return reduce(DataFrame.unionByName, parts)


def merge_presence(days: DataFrame) -> DataFrame:
    """One bitmap per table, station and day."""
    return days.groupBy(*KEYS, "date").agg(F.bit_or("hours").alias("hours"))


class PresenceTable:
    """Bitmaps in a shared folder, by date. ``add`` can be repeated."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def read(self) -> DataFrame:
        """The stored bitmaps; none before the first ``add``."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return self.spark.createDataFrame([], PRESENCE)
        return self.spark.read.schema(PRESENCE).parquet(self.path)

    def add(self, days: DataFrame) -> None:
        """Merge bitmaps into the table; only the dates that they touch are read and written."""
        ensure_checkpoint_dir(self.spark)
        new = merge_presence(days).checkpoint()
        dates = [row["date"] for row in new.select("date").distinct().collect()]  # a row per date
        stored = self.read().where(F.col("date").isin(dates)).select(*new.columns)
        merged = merge_presence(new.unionByName(stored)).checkpoint()
        writer = merged.hint("rebalance", F.col("date")).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(self.path)


def _hour_number(moment: Column) -> Column:
    """Hours since 1970."""
    return F.floor(F.unix_seconds(moment) / 3600).cast("long")


def gap_intervals(
    days: DataFrame,
    start: TimeLike,
    end: TimeLike,
    locations: DataFrame | None = None,
    tables: list[str] | None = None,
) -> DataFrame:
    """``pollutant, location, gap_start, gap_end, hours``: the maximal stretches of ``[start, end)`` without any row.

    ``days`` are merged bitmaps. Stations are those of ``locations`` (with ``location``, and with ``pollutant`` unless
    they belong to each of ``tables``), or else all that ``days`` has at any time, also outside the range; one
    without rows in the range is a gap of the whole range.
    """
    first, stop = _hour_number(truncate_to_hour(start)), _hour_number(truncate_to_hour(end))
    within = F.col("date").between(F.to_date(truncate_to_hour(start)), F.to_date(truncate_to_hour(end)))
    numbered = F.transform(F.sequence(F.lit(0), F.lit(23)), lambda i: F.struct(i.alias("h"), (F.unix_date("date").cast("long") * 24 + i).alias("n")))
    inside = F.filter(numbered, lambda x: (F.getbit("hours", x["h"]) == 1) & (x["n"] >= first) & (x["n"] < stop))
    # One row per station and day: at most 24 numbers.
    present = days.where(within).select(*KEYS, "date", F.transform(inside, lambda x: x["n"]).alias("held"))
    present = present.where(F.size("held") > 0)

    def gap(low: Column, high: Column) -> Column:
        return F.struct(low.cast("long").alias("low"), high.cast("long").alias("high"))

    by_day = Window.partitionBy(*KEYS).orderBy("date")
    held = F.col("held")
    following = F.lead(F.element_at(held, 1)).over(by_day)
    marked = present.select(
        *KEYS, "held", F.coalesce(following, stop).alias("next"), F.lag(F.element_at(held, 1)).over(by_day).isNull().alias("opens")
    )
    between = F.zip_with(held, F.slice(held, F.lit(2), F.size(held)), lambda a, b: gap(a + 1, b))
    after = F.array(gap(F.element_at(held, -1) + 1, F.col("next")))
    before = F.when(F.col("opens"), F.array(gap(first, F.element_at(held, 1)))).otherwise(F.array().cast("array<struct<low:bigint,high:bigint>>"))
    empty = F.filter(F.concat(before, between, after), lambda g: g["high"] > g["low"])
    gaps = marked.select(*KEYS, F.inline(empty))

    if locations is None:
        known = days.select(*KEYS).distinct()
    elif "pollutant" in locations.columns:
        known = locations.select(*KEYS).distinct()
    else:
        if not tables:
            raise ValueError("tables is needed for locations without pollutant")
        known = locations.select(F.explode(F.array(*[F.lit(t) for t in tables])).alias("pollutant"), "location").distinct()
    if locations is not None:
        gaps = gaps.join(known, KEYS, "left_semi")
    silent = known.join(present.select(*KEYS).distinct(), KEYS, "left_anti").where(first < stop)
    gaps = gaps.unionByName(silent.select(*KEYS, first.cast("long").alias("low"), stop.cast("long").alias("high")))
    return gaps.select(
        *KEYS,
        F.timestamp_seconds(F.col("low") * 3600).alias("gap_start"),
        F.timestamp_seconds(F.col("high") * 3600).alias("gap_end"),
        (F.col("high") - F.col("low")).alias("hours"),
    )


def gap_hours(intervals: DataFrame) -> DataFrame:
    """The single hours of gaps: ``pollutant, location, hour``."""
    return intervals.select(*KEYS, F.explode(hour_array(F.col("gap_start"), F.col("gap_end"))).alias("hour"))
