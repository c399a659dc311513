"""Late rows reach hours that are closed already.

Each micro-batch is kept as partials of its own, and the hours it touches are added up again from the partials
of all batches, so a row that arrives after its hour was written corrects that hour. An hour is written
once the newest valid row seen is past its end (by ``delay``), and again whenever rows for it arrive. Nothing
is dropped, and there is no state besides the stored partials.

A batch that is repeated, as after a failure, writes its partials over the ones it wrote before and the
same hours again, so nothing counts twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.partials import PARTIALS, finish, hourly_partials, merge_partials
from ..schema import OUTPUT_COLUMNS, OUTPUT_SCHEMA, guard_not_null
from ..session import prepare
from ..sources.readings import ReadingSource

STORED = f"{PARTIALS}, date date"
MARKS = "newest timestamp, batch bigint"


class PartialStore:
    """Partials in a shared folder: one folder per batch, and the merged ones of batches that were compacted.

    ``compacted/upto=N`` holds batches up to N once it is complete; only folders of later batches are read beside it.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _numbers(self, folder: str, name: str) -> list[int]:
        """The numbers of the sub-folders that are complete, ascending."""
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}/{name}=*/_SUCCESS")
        found = root.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(root) or []
        return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)

    def _delete(self, folder: str) -> None:
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        root.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(root, True)

    def put(self, batch: int, partials: DataFrame) -> DataFrame:
        """Keep the partials of a batch, in place of earlier ones of the same batch; what was stored."""
        folder = f"{self.path}/batches/batch={batch}"
        dated = guard_not_null(partials).withColumn("date", F.to_date("time")).hint("rebalance", F.col("date"))
        dated.write.mode("overwrite").partitionBy("date").parquet(folder)
        return self.spark.read.schema(STORED).parquet(folder)

    def mark(self, batch: int, stored: DataFrame) -> None:
        """Keep the time of the newest row of a batch."""
        stored.agg(F.max("newest").alias("newest")).write.mode("overwrite").parquet(f"{self.path}/marks/batch={batch}")

    def newest(self, before: int | None = None) -> int | None:
        """The time of the newest row of all batches, or of those before one, in microseconds."""
        if not self._numbers("marks", "batch"):
            return None
        marks = self.spark.read.schema(MARKS).parquet(f"{self.path}/marks")
        if before is not None:
            marks = marks.where(F.col("batch") < before)
        return marks.agg(F.unix_micros(F.max("newest"))).first()[0]

    def read(self) -> DataFrame:
        """All partials, by date; several rows for an hour, location and metric."""
        upto = max(self._numbers("compacted", "upto"), default=-1)
        folders = [f"{self.path}/batches/batch={n}" for n in self._numbers("batches", "batch") if n > upto]
        if upto >= 0:
            folders.append(f"{self.path}/compacted/upto={upto}")
        parts = [self.spark.read.schema(STORED).parquet(folder) for folder in folders]
        whole = self.spark.createDataFrame([], STORED)
        for part in parts:
            whole = whole.unionByName(part)
        return whole

    def compact(self) -> None:
        """Merge all batches into one folder and remove theirs. Not to be run beside a batch.

        A merge that was cut short is not read, and removing folders that a complete merge holds changes nothing.
        """
        batches = self._numbers("batches", "batch")
        if not batches:
            return
        merged = merge_partials(self.read()).withColumn("date", F.to_date("time")).hint("rebalance", F.col("date"))
        merged.write.mode("overwrite").partitionBy("date").parquet(f"{self.path}/compacted/upto={batches[-1]}")
        for upto in self._numbers("compacted", "upto")[:-1]:
            self._delete(f"compacted/upto={upto}")
        for batch in batches:
            self._delete(f"batches/batch={batch}")


@dataclass
class LateHours:
    """Adds batches of rows to stored partials and writes the hours that they change or close.

    ``source_of`` makes the readings of a batch from its rows. Facts are partitioned by date and hour (``unit='hour'``),
    so that just the touched hours are written, or by date, with fewer folders: then the closed hours of touched dates are.
    """

    path: str
    source_of: Callable[[DataFrame], ReadingSource]
    tables: list[str] | None = None
    version: str | None = None
    delay: timedelta = timedelta(0)
    unit: str = "hour"

    @property
    def facts(self) -> str:
        return f"{self.path}/facts"

    def apply(self, rows: DataFrame, batch: int) -> None:
        """What a stream does with each batch; repeating it changes nothing."""
        if self.unit not in ("hour", "day"):
            raise ValueError("unit is 'hour' or 'day'")
        spark = prepare(rows.sparkSession)
        store = PartialStore(spark, f"{self.path}/partials")
        own = store.put(batch, hourly_partials(self.source_of(rows).readings(self.tables)))
        before = store.newest(batch)
        store.mark(batch, own)
        newest = store.newest(batch + 1)
        if newest is None:
            return

        def closing(micros: int | None):
            return F.timestamp_micros(F.lit((micros or 0) - self.delay // timedelta(microseconds=1)))

        # Literal bounds and dates, a row for each date of the batch, so that only their folders are read.
        dates = [row["date"] for row in own.select("date").distinct().collect()]
        end = F.col("time") + F.expr("INTERVAL 1 HOUR")
        closed = end <= closing(newest)
        reached = F.col("date") <= F.to_date(closing(newest))
        fresh = F.lit(True) if before is None else end > closing(before)
        if before is not None:
            again = F.date_sub(F.to_date(closing(before)), 1)
            reached = reached & (F.col("date").isin(dates) | (F.col("date") >= again))
        parts = store.read().where(reached & closed)
        unit = ["time"] if self.unit == "hour" else ["date"]
        touched = own.select(*unit).distinct().withColumn("touched", F.lit(True))
        new = F.coalesce(F.col("touched"), F.lit(False)) | fresh
        if self.unit == "day":
            opened = parts.where(fresh).select("date").distinct().withColumn("touched", F.lit(True))
            touched, new = touched.unionByName(opened).distinct(), F.col("touched")
        changed = parts.join(touched, unit, "left").where(new).select(*parts.columns)
        facts = finish(merge_partials(changed), self.version).withColumn("date", F.to_date("time"))
        if self.unit == "hour":
            facts = facts.withColumn("hour", F.hour("time"))
        folders = ["date", *(["hour"] if self.unit == "hour" else [])]
        (
            facts.hint("rebalance", *[F.col(name) for name in folders])
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*folders)
            .parquet(self.facts)
        )

    def start(self, stream: DataFrame, checkpoint: str, available_now: bool = True) -> StreamingQuery:
        """Apply every batch of a stream. ``available_now`` processes what is there and stops."""
        writer = stream.writeStream.foreachBatch(self.apply).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer).start()

    def read(self, spark: SparkSession) -> DataFrame:
        """The hours written so far."""
        return spark.read.schema(OUTPUT_SCHEMA).parquet(self.facts).select(*OUTPUT_COLUMNS)
