"""Readings laid out so that a narrow range on time and station reads few row groups.

The bits of the hour and of a hash of the station are interleaved into one number; rows are dealt to files by ranges of
it and sorted by it. A row group then holds a short time of a few stations, and the least and greatest values
that Parquet keeps for it let a scan skip it for a filter on time, on station, or on both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

BITS = 16  # of each of the two
GROUP_BYTES = 8 << 20
FILE_BYTES = 256 << 20


def spread_bits(value: Column) -> Column:
    """The 16 low bits of a number, each followed by a free bit."""
    spread = value.cast("long").bitwiseAND(F.lit((1 << BITS) - 1))
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        spread = spread.bitwiseOR(F.shiftleft(spread, shift)).bitwiseAND(F.lit(mask))
    return spread


def interleaved(first: Column, second: Column) -> Column:
    """One number of the bits of two, the higher ones first."""
    return F.shiftleft(spread_bits(first), 1).bitwiseOR(spread_bits(second))


def cluster_key(low: int, span: int, time_col: str = "time", location_col: str = "location") -> Column:
    """The key of a row: its hour's place in the ``span`` hours from hour number ``low``, and the station's hash.

    Both use all their bits, so that neither alone decides the high bits of the key.
    """
    hour = F.floor(F.unix_seconds(F.col(time_col).cast("timestamp")) / 3600)
    place = F.floor((hour - low) * F.lit(1 << BITS) / span)
    place = F.least(F.greatest(place, F.lit(0)), F.lit((1 << BITS) - 1))
    return interleaved(F.coalesce(place, F.lit(0)), F.pmod(F.xxhash64(location_col), F.lit(1 << BITS)))


def clustered(df: DataFrame, files: int, time_col: str = "time", location_col: str = "location") -> DataFrame:
    """The rows in ``files`` ranges of the key, sorted. Its span of time takes one small job.

    A station or hour that holds much of the data is cut by the other half of the key and by the sort order below it.
    """
    hour = F.floor(F.unix_seconds(F.col(time_col).cast("timestamp")) / 3600)
    low, high = df.agg(F.min(hour), F.max(hour)).first()
    low, high = (0, 0) if low is None else (low, high)
    key = cluster_key(low, high - low + 1, time_col, location_col)
    order = ["cluster_key", time_col, location_col]
    keyed = df.withColumn("cluster_key", key)
    return keyed.repartitionByRange(files, *order).sortWithinPartitions(*order).drop("cluster_key")


def write_clustered(
    df: DataFrame,
    path: str,
    files: int,
    group_bytes: int = GROUP_BYTES,
    time_col: str = "time",
    location_col: str = "location",
) -> None:
    """Write the rows clustered, in row groups of about ``group_bytes``.

    Timestamps are stored as microseconds: the older format that is Spark's default keeps no least and greatest values.
    """
    laid_out = clustered(df, files, time_col, location_col)
    settings, key = df.sparkSession.conf, "spark.sql.parquet.outputTimestampType"
    before = settings.get(key)
    settings.set(key, "TIMESTAMP_MICROS")
    try:
        laid_out.write.mode("overwrite").option("parquet.block.size", group_bytes).parquet(path)
    finally:
        settings.set(key, before)


def compact_clustered(
    df: DataFrame, path: str, n_bytes: int, file_bytes: int = FILE_BYTES, group_bytes: int = GROUP_BYTES
) -> int:
    """Many small files as few clustered ones, as many as ``n_bytes`` of them need; their number.

    ``df`` may read from ``path``: rows are kept in the shared folder in between.
    """
    files = max(1, -(-n_bytes // file_bytes))
    ensure_checkpoint_dir(df.sparkSession)
    write_clustered(df.checkpoint(), path, files, group_bytes)
    return files


def folder_bytes(spark, path: str) -> int:
    """The size of the files under a folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
