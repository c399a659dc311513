"""Processing state as an append-only log; the newest entry of a pipeline counts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import TimeLike, add_hours, ensure_utc, get_previous_hour_start
from ..schema import STATE_SCHEMA
from ..session import ensure_checkpoint_dir

# Fixed value: version of a pipeline that has not recorded one.
DEFAULT_VERSION = "v1.0.0"
# Metadata of an entry that a run wrote: the id under which sinks may have kept its rows.
RUN = "run"


def latest_state(log: DataFrame) -> DataFrame:
    """``pipeline, updated_at, last_processed_hour``, newest entry per pipeline; a reset stays null.

    Only fixed-width values are aggregated, so this is a hash aggregate with
    partial results and one long log does no harm.
    """
    return log.groupBy("pipeline").agg(
        F.max("updated_at").alias("updated_at"),
        F.max_by("last_processed_hour", "updated_at").alias("last_processed_hour"),
    )


def latest_entry(log: DataFrame) -> DataFrame:
    """The newest entry per pipeline with all its columns."""
    rest = [c for c in log.columns if c not in ("pipeline", "updated_at")]
    newest = log.groupBy("pipeline").agg(
        F.max("updated_at").alias("updated_at"), F.max_by(F.struct(*rest), "updated_at").alias("entry")
    )
    return newest.select("pipeline", "updated_at", *[F.col(f"entry.{c}").alias(c) for c in rest])


def next_hour(last_processed_hour: Column, as_of: TimeLike = None) -> Column:
    """The hour after the processed one; the last completed hour when there is none."""
    return F.coalesce(add_hours(last_processed_hour, 1), get_previous_hour_start(as_of))


def merge_metadata(old: Column, new: Column) -> Column:
    """``old`` with the entries of ``new`` added or replaced."""
    kept = F.map_filter(old, lambda key, _: ~F.map_contains_key(new, key))
    return F.when(old.isNull(), new).when(new.isNull(), old).otherwise(F.map_concat(kept, new))


def metadata_value(metadata: Column, key: str, default: str | None = None) -> Column:
    return F.coalesce(F.try_element_at(metadata, F.lit(key)), F.lit(default).cast("string"))


@dataclass
class State:
    """One pipeline's state; a fresh one has no processed hour."""

    pipeline: str
    last_processed_hour: datetime | None = None
    version: str = DEFAULT_VERSION
    metadata: dict[str, str] = field(default_factory=dict)
    updated_at: datetime | None = None


def _moment(micros: int | None) -> datetime | None:
    if micros is None:
        return None
    return datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=micros)


class StateLog:
    """State log in a folder that the cluster shares, one sub-folder per pipeline; created when absent."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            empty = spark.createDataFrame([], STATE_SCHEMA)
            empty.write.mode("ignore").partitionBy("pipeline").parquet(path)

    def entries(self) -> DataFrame:
        """The whole log; empty before the first entry."""
        return self.spark.read.schema(STATE_SCHEMA).parquet(self.path).select(*STATE_SCHEMA.fieldNames())

    def load(self, pipeline: str) -> State:
        """The current state, fresh when the pipeline has no entry."""
        return self.load_all([pipeline])[pipeline]

    def load_all(self, pipelines: list[str]) -> dict[str, State]:
        """The current states of the named pipelines, by one job."""
        newest = latest_entry(self.entries().where(F.col("pipeline").isin(pipelines)))
        rows = newest.select(
            "pipeline",
            F.unix_micros("last_processed_hour").alias("hour"),
            F.unix_micros("updated_at").alias("updated"),
            "version",
            "metadata",
        ).collect()  # a row for each named pipeline
        found = {
            row["pipeline"]: State(
                row["pipeline"],
                _moment(row["hour"]),
                row["version"] or DEFAULT_VERSION,
                dict(row["metadata"] or {}),
                _moment(row["updated"]),
            )
            for row in rows
        }
        return {pipeline: found.get(pipeline, State(pipeline)) for pipeline in pipelines}

    def runs(self, pipelines: Sequence[str] | None = None) -> list[str]:
        """The ids of all runs that moved a mark; an id for each run, from one column of the log."""
        log = self.entries()
        if pipelines is not None:
            log = log.where(F.col("pipeline").isin(list(pipelines)))
        run = metadata_value(F.col("metadata"), RUN)
        return [row["run"] for row in log.where(run.isNotNull()).select(run.alias("run")).distinct().collect()]

    def compact(self) -> None:
        """Keep the newest entry of each pipeline, and those that list runs, in one file; other entries go.

        Not to be run beside a run that advances the state. Pipelines are replaced one folder at a time,
        and a folder that has not been replaced yet gives the same state as before.
        """
        ensure_checkpoint_dir(self.spark)
        newest = latest_entry(self.entries()).select(*STATE_SCHEMA.fieldNames())
        listing = self.entries().where(metadata_value(F.col("metadata"), RUN).isNotNull())
        older = listing.join(newest.select("pipeline", "updated_at"), ["pipeline", "updated_at"], "left_anti")
        newest = newest.unionByName(older.select(*newest.columns)).checkpoint()
        writer = newest.repartition("pipeline").write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy("pipeline").parquet(self.path)

    def get_last_processed_hour(self, pipeline: str) -> datetime | None:
        return self.load(pipeline).last_processed_hour

    def get_next_hour_to_process(self, pipeline: str, as_of: TimeLike = None) -> datetime:
        last = ensure_utc(self.load(pipeline).last_processed_hour)
        return _moment(self.spark.range(1).select(F.unix_micros(next_hour(last, as_of))).first()[0])

    def get_metadata(self, pipeline: str, key: str, default: str | None = None) -> str | None:
        return self.load(pipeline).metadata.get(key, default)

    def set_last_processed_hour(
        self,
        pipeline: str,
        hour: TimeLike,
        version: str | None = None,
        metadata: dict[str, str] | None = None,
        previous: State | None = None,
    ) -> None:
        """Advance the state, with metadata in the same entry. ``previous`` is the state, if it has been loaded."""
        state = previous or self.load(pipeline)
        self._append(state, hour, version or state.version, {**state.metadata, **(metadata or {})})

    def update_metadata(self, pipeline: str, key: str, value: str) -> None:
        state = self.load(pipeline)
        self._append(state, state.last_processed_hour, state.version, {**state.metadata, key: value})

    def reset_state(self, pipeline: str) -> None:
        """Forget the processed hour; version and metadata stay."""
        state = self.load(pipeline)
        self._append(state, None, state.version, state.metadata)

    def _append(self, previous: State, hour: TimeLike, version: str, metadata: dict[str, str]) -> None:
        now = datetime.now(timezone.utc)
        if previous.updated_at is not None:
            now = max(now, previous.updated_at + timedelta(microseconds=1))
        entry = self.spark.createDataFrame(
            [(previous.pipeline, version, metadata)], "pipeline string, version string, metadata map<string,string>"
        ).withColumns({"updated_at": ensure_utc(now), "last_processed_hour": ensure_utc(hour)})
        entry.select(*STATE_SCHEMA.fieldNames()).write.mode("append").partitionBy("pipeline").parquet(self.path)
