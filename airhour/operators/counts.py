"""Row counts taken by the job that moves the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..catalog import ReadingTable
from ..functions.naming import build_metric_columns
from ..schema import validate_output_schema


def counted_by_table(
    long: DataFrame, tables: list[ReadingTable], name: str = "hourly"
) -> tuple[DataFrame, Observation]:
    """Hourly long rows; the action that runs them also counts all ``rows`` and the rows of each table.

    The counts sit after the last shuffle, where no recomputed task counts
    twice. A ``fetched`` column is summed up per table and dropped, with the
    hours that had no valid row.
    """
    observation = Observation(name)
    kept = F.col("count_ok") > 0
    aggregates = [F.count_if(kept).alias("rows")]
    for table in tables:
        metrics = list(build_metric_columns(table.metrics).values())
        aggregates.append(F.count_if(kept & F.col("metrica").isin(metrics)).alias(table.key))
        if "fetched" in long.columns:
            once = F.when(F.col("metrica") == metrics[0], F.col("fetched"))
            aggregates.append(F.coalesce(F.sum(once), F.lit(0)).alias(f"fetched.{table.key}"))
    observed = long.observe(observation, *aggregates)
    if "fetched" in long.columns:
        observed = validate_output_schema(observed.where(kept))
    return observed, observation
