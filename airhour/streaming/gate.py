"""The quality gate on a stream: rows that break a rule go to quarantine, and each micro-batch is counted.

A batch run stops at a table that breaks a rule. A stream cannot stop for each bad row: it keeps valid rows and
quarantined ones apart, with the rules that they break, and counts both in the pass that writes them. For every
batch, valid and quarantined rows add up to the rows read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..catalog import METRIC_RANGES, STATUS_DOMAIN
from ..session import prepare

COUNTS = "rows_read bigint, rows_valid bigint, rows_quarantined bigint, batch bigint"
OBSERVED = "airhour_gate"


def gate_rules(table: str | None = None, strict: bool = False) -> dict[str, Column]:
    """Conditions by name that break the gate: null time, location or status.

    ``strict`` adds what a batch run only warns of: unknown statuses, and values out of the table's ranges.
    """
    rules = {f"null {name}": F.col(name).isNull() for name in ("time", "location", "status")}
    if strict:
        rules["unknown status"] = ~F.col("status").isin(STATUS_DOMAIN)
        for metric, (low, high) in METRIC_RANGES.get(table, {}).items():
            rules[f"{metric} out of range"] = (F.col(metric) < float(low)) | (F.col(metric) > float(high))
    return rules


def broken(rules: dict[str, Column]) -> Column:
    """The names of the rules that a row breaks; a rule that is null for a row is kept."""
    named = [F.when(F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    return F.array_compact(F.array(*named)) if named else F.array().cast("array<string>")


class GateListener(StreamingQueryListener):
    """Hands the counts of each batch to a function as the stream reports them."""

    def __init__(self, notify: Callable[[int, dict[str, int]], None]):
        self.notify = notify

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        found = event.progress.observedMetrics.get(OBSERVED)
        if found is not None:
            self.notify(event.progress.batchId, found.asDict())

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


@dataclass
class GatedStream:
    """Writes each batch once, to ``valid`` and ``quarantined`` folders of its own, so that a repeat replaces it."""

    path: str
    rules: dict[str, Column] = field(default_factory=gate_rules)

    def marked(self, rows: DataFrame) -> DataFrame:
        """Rows with ``broken`` and, in the same pass, the counts that the listener gets."""
        marked = rows.withColumn("broken", broken(self.rules))
        bad = F.size("broken") > 0
        return marked.observe(
            OBSERVED,
            F.count(F.lit(1)).alias("rows_read"),
            F.count_if(~bad).alias("rows_valid"),
            F.count_if(bad).alias("rows_quarantined"),
        )

    def apply(self, marked: DataFrame, batch: int) -> None:
        """What the stream does with each batch of marked rows."""
        spark = prepare(marked.sparkSession)
        folder = f"{self.path}/rows/batch={batch}"
        kind = F.when(F.size("broken") > 0, F.lit("quarantined")).otherwise(F.lit("valid"))
        marked.withColumn("kind", kind).write.mode("overwrite").partitionBy("kind").parquet(folder)
        stored = spark.read.schema("broken array<string>, kind string").parquet(folder)
        counts = stored.agg(
            F.count(F.lit(1)).alias("rows_read"),
            F.count_if(F.col("kind") == "valid").alias("rows_valid"),
            F.count_if(F.col("kind") == "quarantined").alias("rows_quarantined"),
        )
        counts.write.mode("overwrite").parquet(f"{self.path}/counts/batch={batch}")

    def start(self, stream: DataFrame, checkpoint: str, available_now: bool = True) -> StreamingQuery:
        writer = self.marked(stream).writeStream.foreachBatch(self.apply).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer).start()

    def valid(self, spark: SparkSession) -> DataFrame:
        """The valid rows of all batches."""
        return self._rows(spark).where("kind = 'valid'").drop("broken", "kind", "batch")

    def quarantined(self, spark: SparkSession) -> DataFrame:
        """The other rows, with ``broken`` and ``batch``."""
        return self._rows(spark).where("kind = 'quarantined'").drop("kind")

    def counts(self, spark: SparkSession) -> DataFrame:
        """``batch, rows_read, rows_valid, rows_quarantined``."""
        found = spark.read.schema(COUNTS).parquet(f"{self.path}/counts")
        return found.select("batch", "rows_read", "rows_valid", "rows_quarantined")

    def _rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.option("basePath", f"{self.path}/rows").parquet(f"{self.path}/rows/batch=*")
