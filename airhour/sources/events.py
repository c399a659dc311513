"""The driver's ``events`` table seen as minute readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .readings import ReadingSource

# One wide base for all six tables, as text that Spark and DuckDB both run. Every
# event is a reading of every table; each table has its own status column. Readings
# are in steps of 1/64: their sums are exact, so means do not depend on the order
# in which tasks add up, and results of any two engines can be compared bit by bit.
READINGS_SQL = """
SELECT event_id, ts AS time,
 CASE user_id % 5 WHEN 0 THEN 'Centro' WHEN 1 THEN 'Norte' WHEN 2 THEN 'Sur'
                  WHEN 3 THEN 'Este' ELSE 'Oeste' END AS location,
 CASE WHEN reading > 300 THEN 'x' WHEN reading < 1 THEN 'm' WHEN event_type = 'signup' THEN 'v'
      WHEN event_type = 'error' THEN 's' ELSE 'k' END AS co_status,
 CASE WHEN reading > 300 THEN 'x' WHEN reading < 1 THEN 'm' WHEN event_type = 'view' THEN 'v'
      WHEN event_type = 'error' THEN 's' ELSE 'k' END AS nox_status,
 CASE WHEN reading > 300 THEN 'x' WHEN reading < 1 THEN 'm' WHEN event_type = 'click' THEN 'v'
      WHEN event_type = 'error' THEN 's' ELSE 'k' END AS pm10_status,
 CASE WHEN reading > 300 THEN 'x' WHEN reading < 1 THEN 'm' WHEN event_type = 'purchase' THEN 'v'
      WHEN event_type = 'error' THEN 's' ELSE 'k' END AS so2_status,
 CASE WHEN reading > 300 THEN 'x' WHEN reading < 1 THEN 'm' WHEN event_type = 'signup' THEN 'v'
      WHEN event_type = 'view' THEN 's' ELSE 'k' END AS o3_status,
 CASE WHEN reading < 1 THEN 'm' WHEN event_type = 'error' THEN 's' ELSE 'k' END AS meteo_status,
 CASE WHEN reading >= 4 THEN reading END AS co_mean,
 reading AS no_mean, reading * 0.5 AS no2_mean, reading * 1.5 AS nox_mean,
 reading * 2.0 AS pm10_mean, reading * 0.25 AS so2_mean,
 CASE WHEN event_type <> 'click' THEN reading * 0.75 END AS o3_mean,
 reading * 0.125 AS dv_mean, reading * 0.0625 AS vv_mean, reading - 20.0 AS temp_mean,
 reading * 0.375 AS hr_mean, reading + 700.0 AS pa_mean, reading * 0.03125 AS uv_mean,
 reading * 0.015625 AS lluvia_mean, reading * 4.0 AS rs_mean
FROM (SELECT *, floor(value * 64) / 64 AS reading FROM {events})
"""

# The same with the values as they are; their means depend on the order of the sums in the last digits.
RAW_READINGS_SQL = READINGS_SQL.replace("floor(value * 64) / 64 AS reading", "value AS reading")

STATUS_COLUMNS = {
    key: f"{key}_status" for key in ("co", "nox", "pm10", "so2", "o3", "meteo")
}

# Every event as an entry of a state log: one pipeline per user, an error resets it.
STATE_LOG_SQL = """
SELECT concat('station-', CAST(user_id AS STRING)) AS pipeline, ts AS updated_at,
 CASE WHEN event_type <> 'error' THEN date_trunc('hour', ts) END AS last_processed_hour,
 event_type AS version, props
FROM {events}
"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def wide_readings(spark: SparkSession, frame: DataFrame) -> DataFrame:
    """The wide base over any frame shaped like ``events``, batch or streaming."""
    return spark.sql(READINGS_SQL, events=frame)


def event_source(spark: SparkSession, sf_dir: str) -> ReadingSource:
    """All six tables on one shared base."""
    return ReadingSource.from_wide(wide_readings(spark, events(spark, sf_dir)), status=STATUS_COLUMNS)


def raw_event_source(spark: SparkSession, sf_dir: str) -> ReadingSource:
    """All six tables on one shared base, with the values as they are."""
    base = spark.sql(RAW_READINGS_SQL, events=events(spark, sf_dir))
    return ReadingSource.from_wide(base, status=STATUS_COLUMNS)


def separate_event_source(spark: SparkSession, sf_dir: str) -> ReadingSource:
    """The six tables as frames of their own, as when each is stored by itself."""
    shared = event_source(spark, sf_dir)
    return ReadingSource.from_frames({key: shared.fetch_table(key) for key in shared.catalog.keys})


def event_state_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = spark.sql(STATE_LOG_SQL, events=events(spark, sf_dir))
    return log.withColumns(
        {name: log[name].cast("timestamp") for name in ("updated_at", "last_processed_hour")}
    )
