"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and then three times; its number is the median.
Results are consumed in full by a sink that stores nothing. Queries whose name
starts with ``alt_`` are other shapes of the same work, for comparison; they are
not part of the total.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from airhour.functions.naming import build_metric_columns
from airhour.operators.hourly import aggregate_to_long_format, hourly_long
from airhour.plans.registry import QUERIES, VERSION
from airhour.session import create_session
from airhour.sources.events import event_source, separate_event_source
from airhour.sources.ranges import backfill_range, specific_hour

WARM_UPS = 1
RUNS = 3
DAY = datetime(2024, 1, 10, tzinfo=timezone.utc)
HEADLINE = [
    "hourly_long_all",
    "hourly_long_separate",
    "hourly_wide_meteo",
    "range_scan_co",
    "incremental_hourly",
    "backfill_two_weeks",
    "missing_hours_by_pipeline",
    "coverage_gaps_by_location",
    "status_domain",
    "range_checks",
    "null_counts",
    "quality_scores",
    "quality_scores_by_hour",
    "state_latest",
    "append_readback",
    "partition_readback",
    "incremental_runs_readback",
    "backfill_readback",
    "stream_hourly_closed",
]


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def per_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One aggregate per metric."""
    parts = []
    for item in separate_event_source(spark, sf_dir).readings():
        for column, name in build_metric_columns(item.table.metrics).items():
            parts.append(aggregate_to_long_format(item.frame(), metric_columns={column: name}, version=VERSION))
    return reduce(DataFrame.unionByName, parts)


def one_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day as one range scan."""
    source = event_source(spark, sf_dir)
    return hourly_long(source.readings(None, backfill_range(DAY, DAY + timedelta(days=1))), VERSION)


def day_by_hours(spark: SparkSession, sf_dir: str) -> None:
    """The same day as 24 jobs."""
    source = event_source(spark, sf_dir)
    for hour in range(24):
        consume(hourly_long(source.readings(None, specific_hour(DAY + timedelta(hours=hour))), VERSION))


def timed(work: Callable[[], None]) -> float:
    for _ in range(WARM_UPS):
        work()
    taken = []
    for _ in range(RUNS):
        start = time.perf_counter()
        work()
        taken.append(time.perf_counter() - start)
    return round(statistics.median(taken), 4)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = create_session(
        "airhour-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {name: timed(lambda q=QUERIES[name]: consume(q(spark, sf_dir))) for name in HEADLINE}
    seconds["backfill_day"] = timed(lambda: consume(one_day(spark, sf_dir)))
    total = sum(seconds.values())
    seconds["alt_hourly_long_per_metric"] = timed(lambda: consume(per_metric(spark, sf_dir)))
    seconds["alt_backfill_day_by_hours"] = timed(lambda: day_by_hours(spark, sf_dir))
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_median_seconds",
                "value": round(total, 4),
                "unit": "sec",
                "queries": seconds,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": int(cpus),
                "runs": RUNS,
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
