"""The hourly aggregate as a stream.

A batch run closes an hour by the wall clock, a stream by event time: an hour is
written once the watermark has passed its end, and rows later than that are
dropped. Open state is one row per open hour and location, so the delay bounds it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.hourly import hourly_long
from ..schema import OUTPUT_COLUMNS, OUTPUT_SCHEMA, guard_not_null
from ..sources.readings import ReadingSource


def read_stream(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", files_per_trigger: int | None = None
) -> DataFrame:
    """A folder whose new files are the stream."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def stream_hourly_long(
    source: ReadingSource,
    tables: list[str] | None = None,
    version: str | None = None,
    delay: str = "0 seconds",
) -> DataFrame:
    """Closed hours of the given tables, for an append sink.

    Tables in one query share one watermark: that of their common base, or the
    slowest of their own.
    """
    return hourly_long(source.readings(tables), version, watermark_delay=delay)


def start_hourly_stream(
    long: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = True,
    files_per_day: int = 4,
    missing_location: str | None = None,
) -> StreamingQuery:
    """Append closed hours to a Parquet folder with one sub-folder per day.

    The checkpoint holds what has been read and the open hours; both folders
    belong on storage the cluster shares. ``available_now`` processes what is
    there and stops. A batch writes at most ``files_per_day`` files for a day; the
    rows of a day are dealt by location.

    A null location fails the stream, again at each restart. With
    ``missing_location``, a name that no station has, such rows are written under it.
    """
    if missing_location is not None:
        long = long.withColumn("location", F.coalesce("location", F.lit(missing_location)))
    dated = guard_not_null(long).withColumn("date", F.to_date("time"))
    dated = dated.repartition(F.col("date"), F.pmod(F.xxhash64("location"), F.lit(files_per_day)))
    writer = (
        dated.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("date")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_hours(spark: SparkSession, path: str) -> DataFrame:
    """The hours a stream has written so far; none before the first is closed."""
    return spark.read.schema(OUTPUT_SCHEMA).parquet(path).select(*OUTPUT_COLUMNS)
