"""The registered queries in plain SQL, for checking results with another engine."""

from __future__ import annotations

from ..catalog import METRIC_RANGES, TABLES
from ..functions.naming import build_metric_columns
from ..sources.events import RAW_READINGS_SQL, READINGS_SQL, STATE_LOG_SQL, STATUS_COLUMNS
from .registry import (
    AGAIN_END,
    AGAIN_START,
    AGAIN_TABLES,
    AGAIN_VERSION,
    CLUSTERED_STATION,
    COVERAGE_END,
    COVERAGE_START,
    EMPTIED_END,
    EMPTIED_START,
    GATE_PARTS,
    ONE_HOUR,
    ONE_HOUR_END,
    RANGE_END,
    RANGE_START,
    RUN_START,
    STREAM_DELAY,
    UNREADABLE,
    VERSION,
)

DOMAIN = "('k', 'v', 's', 'm')"
CLOCK = "(SELECT max(ts) FROM events)"
RUNNING_HOUR = f"date_trunc('hour', {CLOCK})"


def moment(text: str) -> str:
    return f"TIMESTAMP '{text[:10]} {text[11:19]}'"


def hour_of(text: str) -> str:
    return f"date_trunc('hour', {moment(text)})"


def readings(query: str) -> str:
    return f"WITH readings AS ({READINGS_SQL.format(events='events')}) {query}"


def raw_readings(query: str) -> str:
    return f"WITH readings AS ({RAW_READINGS_SQL.format(events='events')}) {query}"


def millionths(column: str) -> str:
    return f"floor({column} * 1e6 + 0.3712345::DOUBLE) / 1e6"


def anew(where: str) -> str:
    """The rows of ``where`` with the second version."""
    return f"* REPLACE (CASE WHEN {where} THEN '{AGAIN_VERSION}' ELSE version END AS version)"


def states(query: str) -> str:
    """``latest``: the newest entry per pipeline; arg_max alone would skip a null hour."""
    return f"""
    WITH log AS ({STATE_LOG_SQL.format(events='events')}),
    latest AS (
      SELECT pipeline, max(updated_at) AS updated_at,
             arg_max_null(last_processed_hour, updated_at) AS last_processed_hour
      FROM log GROUP BY pipeline)
    {query}"""


def columns(key: str) -> str:
    return ", ".join(["time", "location", *TABLES[key][1], f"{STATUS_COLUMNS[key]} AS status"])


def hourly(where: str = "true", keys: list[str] | None = None) -> str:
    return " UNION ALL ".join(
        f"""SELECT date_trunc('hour', time) AS time, location, '{name}' AS metrica, avg({column}) AS valor,
            count(*) AS count_ok, '{VERSION}' AS version
            FROM readings WHERE {STATUS_COLUMNS[key]} = 'k' AND {where} GROUP BY 1, 2"""
        for key in (keys or TABLES)
        for column, name in build_metric_columns(TABLES[key][1]).items()
    )


def score(key: str) -> str:
    parts = " + ".join(
        f"count({c})::DOUBLE / count(*)" for c in ["location", *TABLES[key][1], STATUS_COLUMNS[key]]
    )
    size = len(TABLES[key][1]) + 2
    valid = f"count(*) FILTER (WHERE {STATUS_COLUMNS[key]} = 'k')::DOUBLE / count(*)"
    return f"(({parts}) / {size}.0::DOUBLE + {valid}) / 2.0::DOUBLE"


def scan(key: str, where: str) -> str:
    return readings(f"SELECT {columns(key)} FROM readings WHERE {where}")


TABLE_KEYS = "(VALUES " + ", ".join(f"('{key}')" for key in TABLES) + ") AS tables(pollutant)"
COVERAGE_HOURS = (
    f"(SELECT unnest(generate_series({moment(COVERAGE_START)}, "
    f"{moment(COVERAGE_END)} - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS hour)"
)
RANGE_HOURS = (
    f"(SELECT unnest(generate_series({hour_of(RANGE_START)}, "
    f"{hour_of(RANGE_END)} - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS hour)"
)
IN_COVERAGE = f"ts >= {moment(COVERAGE_START)} AND ts < {moment(COVERAGE_END)}"
HAS_DATA = f"EXISTS (SELECT 1 FROM events WHERE {IN_COVERAGE} AND date_trunc('hour', ts) = h.hour)"
LAST_PROCESSED = "(SELECT min(last_processed_hour) FROM latest)"
MISSING = f"""
    SELECT pipeline, unnest(generate_series(last_processed_hour + INTERVAL 1 HOUR,
      {RUNNING_HOUR} - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS hour
    FROM latest WHERE last_processed_hour IS NOT NULL"""
ANY_VALID = " OR ".join(f"{status} = 'k'" for status in STATUS_COLUMNS.values())


def null_counts() -> str:
    names = ["event_id", "time", "location", *STATUS_COLUMNS.values(), *[m for _, ms in TABLES.values() for m in ms]]
    return " UNION ALL ".join(
        f"SELECT '{n}' AS column_name, count(*) FILTER (WHERE {n} IS NULL) AS null_count, count(*) AS total_rows "
        "FROM readings"
        for n in names
    )


def range_checks() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{key}' AS pollutant, '{metric}' AS metric, {low}.0::DOUBLE AS min_allowed,
            {high}.0::DOUBLE AS max_allowed, min({metric}) AS actual_min, max({metric}) AS actual_max,
            count(*) FILTER (WHERE {metric} < {low} OR {metric} > {high}) AS rows_outside,
            count({metric}) AS rows_checked FROM readings"""
        for key, ranges in METRIC_RANGES.items()
        for metric, (low, high) in ranges.items()
    )


def range_checks_by_hour() -> str:
    return " UNION ALL ".join(
        f"""SELECT date_trunc('hour', time) AS hour, location, '{key}' AS pollutant, '{metric}' AS metric,
            count({metric}) AS rows_checked, count(*) FILTER (WHERE {metric} < {low} OR {metric} > {high}) AS rows_outside,
            min({metric}) AS actual_min, max({metric}) AS actual_max FROM readings GROUP BY 1, 2 HAVING count({metric}) > 0"""
        for key, ranges in METRIC_RANGES.items()
        for metric, (low, high) in ranges.items()
    )


def gate_counts() -> str:
    low, high = METRIC_RANGES["co"]["co_mean"]
    bad = f"co_status NOT IN {DOMAIN} OR co_mean < {low} OR co_mean > {high}"
    return " UNION ALL ".join(
        f"""SELECT CAST({batch} AS BIGINT) AS batch, count(*) AS rows_read,
            count(*) - count(*) FILTER (WHERE {bad}) AS rows_valid, count(*) FILTER (WHERE {bad}) AS rows_quarantined
            FROM readings WHERE event_id IN (SELECT event_id FROM events WHERE event_type IN ({", ".join(f"'{t}'" for t in part)}))"""
        for batch, part in enumerate(GATE_PARTS)
    )


def missing_stations(hours: str) -> str:
    """Hours without data of every table and station."""
    return f"""SELECT pollutant, l.location, h.hour
        FROM {TABLE_KEYS}, (SELECT DISTINCT location FROM readings) l, {hours} h
        WHERE NOT EXISTS (SELECT 1 FROM readings r WHERE r.location = l.location AND date_trunc('hour', r.time) = h.hour)"""


def closed_hours(keys: list[str] | None, watched: str, delay: str) -> str:
    closing = f"(SELECT max(time) FROM readings WHERE {watched}) - INTERVAL {delay}"
    return f"SELECT * FROM ({hourly(keys=keys)}) WHERE time + INTERVAL 1 HOUR <= {closing}"


def incremental(query: str) -> str:
    """``query`` with the state log and the readings at hand."""
    return states(f", readings AS ({READINGS_SQL.format(events='events')}) {query}")


IN_INCREMENT = f"time >= {LAST_PROCESSED} + INTERVAL 1 HOUR AND time < {RUNNING_HOUR}"
# Bounds on whole hours are put on the hourly rows: in a filter below the means, a
# subquery lets threads add up readings in varying order.
SINCE_START = f"time >= {moment(RUN_START)} + INTERVAL 1 HOUR AND time < {RUNNING_HOUR}"
AGAIN = f"time >= {moment(AGAIN_START)} AND time < {moment(AGAIN_END)}"
AGAIN_METRICS = ", ".join(f"'{name}'" for key in AGAIN_TABLES for name in build_metric_columns(TABLES[key][1]).values())
IN_MONTH = f"time >= {moment(COVERAGE_START)} AND time < {moment(COVERAGE_END)}"
IN_ONE_HOUR = f"time >= {moment(ONE_HOUR)} AND time < {moment(ONE_HOUR_END)}"
EMPTIED = f"time >= {moment(EMPTIED_START)} AND time < {moment(EMPTIED_END)}"
REPLACED_DAYS = "time >= TIMESTAMP '2024-01-05' AND time < TIMESTAMP '2024-01-07'"

ORACLES: dict[str, str] = {
    "table_scan_nox": scan("nox", "true"),
    "wide_scan_all_columns": readings("SELECT * FROM readings"),
    "range_scan_co": scan("co", f"time >= {moment(RANGE_START)} AND time < {moment(RANGE_END)}"),
    "open_start_scan_so2": scan("so2", f"time >= TIMESTAMP '1970-01-01' AND time < {moment(RANGE_END)}"),
    "open_end_scan_o3": scan("o3", f"time >= {moment(RANGE_START)} AND time < {CLOCK}"),
    "previous_hour_scan": scan("co", f"time >= {RUNNING_HOUR} - INTERVAL 1 HOUR AND time < {RUNNING_HOUR}"),
    "single_hour_scan": scan("pm10", f"time >= {moment(ONE_HOUR)} AND time < {moment(ONE_HOUR)} + INTERVAL 1 HOUR"),
    "incremental_scan": incremental(f"SELECT {columns('co')} FROM readings WHERE {IN_INCREMENT}"),
    "metric_naming": """
        SELECT event_id,
          replace(event_type || '_mean_' || CAST(user_id AS VARCHAR) || '_mean_mean', '_mean', '') AS metrica
        FROM events""",
    "time_functions": """
        SELECT event_id, date_trunc('second', ts) - INTERVAL 5 HOUR AS from_text,
          ts + INTERVAL 26 HOUR AS later, ts - INTERVAL 3 HOUR AS earlier, date_trunc('hour', ts) AS hour,
          date_trunc('hour', ts) AS current_hour, date_trunc('hour', ts) - INTERVAL 1 HOUR AS previous_hour
        FROM events""",
    "conform_schema": """
        SELECT ts AS time, CAST(NULL AS VARCHAR) AS location, event_type AS metrica,
          CAST(event_id AS DOUBLE) AS valor, CAST(NULL AS BIGINT) AS count_ok, CAST(NULL AS VARCHAR) AS version
        FROM events""",
    "hourly_long_all": readings(hourly()),
    "hourly_long_separate": readings(hourly()),
    "hourly_wide_meteo": readings(
        "SELECT date_trunc('hour', time) AS time, location, "
        + ", ".join(f"avg({m}) AS {m}" for m in TABLES["meteo"][1])
        + ", count(*) AS count_ok FROM readings WHERE meteo_status = 'k' GROUP BY 1, 2"
    ),
    "backfill_two_weeks": readings(
        hourly(f"time >= {hour_of(RANGE_START)} AND time < {hour_of(RANGE_END)}", ["co", "nox"])
    ),
    "incremental_hourly": incremental(f"SELECT * FROM ({hourly()}) WHERE {IN_INCREMENT}"),
    "row_counts": readings(
        "SELECT metrica, (SELECT count(*) FROM readings) AS fetched, count(*) AS hourly_rows, "
        f"CAST(sum(count_ok) AS BIGINT) AS valid_readings FROM ({hourly()}) GROUP BY metrica"
    ),
    "hour_spine": f"""
        SELECT h.hour, count(ts) AS rows
        FROM (SELECT unnest(generate_series(date_trunc('hour', (SELECT min(ts) FROM events)),
                {RUNNING_HOUR} - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS hour) h
        LEFT JOIN events ON date_trunc('hour', ts) = h.hour GROUP BY h.hour""",
    "missing_hours_by_pipeline": states(MISSING),
    "missing_hours_preview": states(
        f"SELECT hour, count(*) AS pipelines FROM ({MISSING}) GROUP BY hour ORDER BY hour LIMIT 5"
    ),
    "coverage_gaps_by_location": readings(f"""
        , seen AS (SELECT location, date_trunc('hour', time) AS hour FROM readings
                   WHERE time >= {moment(COVERAGE_START)} AND time < {moment(COVERAGE_END)})
        SELECT pollutant, l.location, h.hour
        FROM {TABLE_KEYS}, (SELECT DISTINCT location FROM seen) l, {COVERAGE_HOURS} h
        WHERE NOT EXISTS (SELECT 1 FROM seen WHERE seen.location = l.location AND seen.hour = h.hour)"""),
    "coverage_gaps_by_table": f"SELECT pollutant, h.hour FROM {TABLE_KEYS}, {COVERAGE_HOURS} h WHERE NOT {HAS_DATA}",
    "coverage_present_by_table": f"SELECT pollutant, h.hour FROM {TABLE_KEYS}, {COVERAGE_HOURS} h WHERE {HAS_DATA}",
    "status_domain": readings(
        " UNION ALL ".join(
            f"SELECT '{key}' AS pollutant, {status} AS status, count(*) AS rows FROM readings "
            f"WHERE {status} NOT IN {DOMAIN} GROUP BY {status}"
            for key, status in STATUS_COLUMNS.items()
        )
    ),
    "range_checks": readings(range_checks()),
    "null_counts": readings(null_counts()),
    "gate_profile_co": readings(
        "SELECT count(*) AS total_rows, count(*) FILTER (WHERE time IS NULL) AS time_nulls, "
        "count(*) FILTER (WHERE co_status IS NULL) AS status_nulls, "
        f"count(*) FILTER (WHERE co_status NOT IN {DOMAIN}) AS status_unknown, "
        "min(co_mean) AS co_mean_min, max(co_mean) AS co_mean_max FROM readings"
    ),
    "quality_scores": readings(
        " UNION ALL ".join(
            f"SELECT count(*) AS rows, '{key}' AS pollutant, {score(key)} AS quality_score FROM readings"
            for key in TABLES
        )
    ),
    "quality_scores_by_hour": readings(
        " UNION ALL ".join(
            f"SELECT date_trunc('hour', time) AS hour, location, count(*) AS rows, '{key}' AS pollutant, "
            f"{score(key)} AS quality_score FROM readings GROUP BY 1, 2"
            for key in TABLES
        )
    ),
    "quality_score_co": readings(f"SELECT count(*) AS rows, {score('co')} AS quality_score FROM readings"),
    "hourly_long_raw": raw_readings(f"SELECT * REPLACE ({millionths('valor')} AS valor) FROM ({hourly()})"),
    "hourly_wide_raw": raw_readings(
        "SELECT date_trunc('hour', time) AS time, location, "
        + ", ".join(f"{millionths(f'avg({m})')} AS {m}" for m in TABLES["meteo"][1])
        + ", count(*) AS count_ok FROM readings WHERE meteo_status = 'k' GROUP BY 1, 2"
    ),
    "ordered_scan_co": scan("co", f"time >= {moment(RANGE_START)} AND time < {moment(RANGE_END)} ORDER BY time"),
    "coverage_gaps_silent_stations": readings(f"""
        SELECT pollutant, l.location, {moment(ONE_HOUR)} AS hour
        FROM {TABLE_KEYS}, (SELECT DISTINCT location FROM readings) l
        WHERE l.location NOT IN (SELECT location FROM readings WHERE {IN_ONE_HOUR})"""),
    "partition_subset_backfill": readings(
        f"SELECT {anew(f'{AGAIN} AND metrica IN ({AGAIN_METRICS})')} FROM ({hourly()}) WHERE {IN_MONTH}"
    ),
    "partition_one_hour_of_a_day": readings(f"SELECT {anew(IN_ONE_HOUR)} FROM ({hourly()}) WHERE {IN_MONTH}"),
    "partition_emptied_hours": readings(
        f"SELECT {anew(AGAIN)} FROM ({hourly()}) WHERE {IN_MONTH} AND NOT ({AGAIN} AND hour(time) = 12)"
    ),
    "append_verified_count": readings(
        f"SELECT CAST(load AS BIGINT) AS load, CAST(load * count(*) AS BIGINT) AS rows FROM ({hourly()}), "
        "(VALUES (1), (2)) AS loads(load) GROUP BY load"
    ),
    "append_readback": readings(f"SELECT * FROM ({hourly()}) UNION ALL SELECT * FROM ({hourly()})"),
    "partition_readback": readings(
        f"SELECT * REPLACE (CASE WHEN {REPLACED_DAYS} THEN 'v2.0.0' ELSE version END AS version) FROM ({hourly()})"
    ),
    "narrow_readback": readings(
        f"SELECT * REPLACE (CAST(CAST(valor AS REAL) AS DOUBLE) AS valor) FROM ({hourly()})"
    ),
    "report_readback": readings(hourly()),
    "fan_out_counts": readings(
        f"SELECT sink, location, count(*) AS rows FROM ({hourly()}), "
        "(VALUES ('append'), ('partitions')) AS sinks(sink) GROUP BY sink, location"
    ),
    "state_latest": states("SELECT pipeline, updated_at, last_processed_hour FROM latest"),
    "state_next_hour": states(
        "SELECT pipeline, coalesce(last_processed_hour + INTERVAL 1 HOUR, "
        f"{RUNNING_HOUR} - INTERVAL 1 HOUR) AS next_hour FROM latest"
    ),
    "state_metadata": states("""
        SELECT pipeline, updated_at, version AS pipeline_version, version AS origin, props AS last_execution,
          'never' AS last_backfill, CAST(3 AS BIGINT) AS entries FROM log"""),
    "state_fresh": f"""
        SELECT 'hourly' AS pipeline, '{VERSION}' AS version, CAST(0 AS BIGINT) AS entries,
          CAST(NULL AS TIMESTAMP) AS last_processed_hour, {RUNNING_HOUR} - INTERVAL 1 HOUR AS next_hour""",
    "empty_run_readback": readings(
        f"SELECT *, CAST(1 AS BIGINT) AS written FROM ({hourly()}) WHERE {SINCE_START}"
    ),
    "stored_tables_readback": readings(
        f"SELECT {anew(f'{AGAIN} AND metrica IN ({AGAIN_METRICS})')} FROM ({hourly()}) WHERE {SINCE_START}"
    ),
    "per_table_runs_readback": readings(f"SELECT * FROM ({hourly()}) WHERE {SINCE_START}"),
    "tables_apart_readback": readings(
        f"SELECT *, '{UNREADABLE}' AS failed, CAST({len(TABLES) - 1} AS BIGINT) AS marks_moved "
        f"FROM ({hourly(keys=[key for key in TABLES if key != UNREADABLE])}) WHERE {SINCE_START}"
    ),
    "catch_up_per_table": f"SELECT 'hourly-' || pollutant AS pipeline, "
    f"{RUNNING_HOUR} - INTERVAL 1 HOUR AS last_processed_hour FROM {TABLE_KEYS}",
    "catch_up_subset_state": readings(
        f"SELECT 'hourly' AS pipeline, {moment(RUN_START)} AS last_processed_hour, count(*) AS rows "
        f"FROM ({hourly(keys=AGAIN_TABLES)}) WHERE {SINCE_START}"
    ),
    "incremental_runs_readback": readings(f"SELECT * FROM ({hourly()}) WHERE {SINCE_START}"),
    "backfill_readback": readings(hourly(IN_MONTH)),
    "table_partition_backfill": readings(
        f"SELECT {anew(f'{AGAIN} AND metrica IN ({AGAIN_METRICS})')} FROM ({hourly()}) WHERE {IN_MONTH}"
    ),
    "table_partition_emptied_range": readings(f"SELECT * FROM ({hourly()}) WHERE {IN_MONTH} AND NOT ({EMPTIED})"),
    "partition_emptied_range": readings(f"SELECT * FROM ({hourly()}) WHERE {IN_MONTH} AND NOT ({EMPTIED})"),
    "append_runs_readback": readings(f"SELECT * FROM ({hourly()}) WHERE {SINCE_START}"),
    "hourly_from_partials": readings(hourly()),
    "stream_late_rows": readings(closed_hours(None, ANY_VALID, "0 HOUR")),
    "coverage_gaps_silent_station_hours": readings(f"""
        , quiet AS (SELECT hour FROM (SELECT date_trunc('hour', time) AS hour, count(DISTINCT location) AS n
                    FROM readings WHERE {IN_MONTH} GROUP BY 1) ORDER BY n, hour LIMIT 1)
        SELECT pollutant, l.location, q.hour
        FROM {TABLE_KEYS}, (SELECT DISTINCT location FROM readings) l, quiet q
        WHERE NOT EXISTS (SELECT 1 FROM readings r WHERE r.location = l.location AND date_trunc('hour', r.time) = q.hour)"""),
    "presence_readback": readings(f"""
        SELECT pollutant, location, CAST(time AS DATE) AS date, bit_or(CAST(1 AS BIGINT) << CAST(hour(time) AS INTEGER)) AS hours
        FROM {TABLE_KEYS}, readings WHERE {IN_MONTH} GROUP BY ALL"""),
    "gap_intervals_by_location": readings(f"""
        , missing AS ({missing_stations(COVERAGE_HOURS)})
        SELECT pollutant, location, min(hour) AS gap_start, max(hour) + INTERVAL 1 HOUR AS gap_end, count(*) AS hours
        FROM (SELECT *, hour - to_hours(CAST(row_number() OVER (PARTITION BY pollutant, location ORDER BY hour) AS INTEGER)) AS island
              FROM missing) GROUP BY pollutant, location, island"""),
    "gap_hours_by_location": readings(missing_stations(RANGE_HOURS)),
    "clustered_range_scan": scan(
        "meteo", f"time >= {moment(ONE_HOUR)} AND time < {moment(RANGE_END)} AND location = '{CLUSTERED_STATION}'"
    ),
    "stream_gate_counts": readings(gate_counts()),
    "range_checks_by_hour": readings(range_checks_by_hour()),
    "status_checks_by_hour": readings(
        " UNION ALL ".join(
            f"""SELECT date_trunc('hour', time) AS hour, location, '{key}' AS pollutant, count(*) AS rows,
                count(*) FILTER (WHERE {status} = 'k') AS valid_rows, count(*) FILTER (WHERE {status} IS NULL) AS null_rows,
                count(*) FILTER (WHERE {status} NOT IN {DOMAIN}) AS unknown_rows FROM readings GROUP BY 1, 2"""
            for key, status in STATUS_COLUMNS.items()
        )
    ),
    "sketch_days_readback": readings(
        " UNION ALL ".join(
            f"""SELECT '{key}' AS pollutant, '{metric}' AS metric, location, CAST(time AS DATE) AS date, count({metric}) AS n
                FROM readings WHERE {STATUS_COLUMNS[key]} = 'k' GROUP BY location, CAST(time AS DATE) HAVING count({metric}) > 0"""
            for key, (_, metrics) in TABLES.items()
            for metric in metrics
        )
    ),
    "sketch_quantiles_checked": readings(
        "SELECT pollutant, metric, CAST(decile AS DOUBLE) / 10 AS rank, n, true AS within_bound FROM ("
        + " UNION ALL ".join(
            f"SELECT '{key}' AS pollutant, '{metric}' AS metric, count({metric}) AS n FROM readings WHERE {STATUS_COLUMNS[key]} = 'k'"
            for key, (_, metrics) in TABLES.items()
            for metric in metrics
        )
        + "), (SELECT unnest(range(1, 10)) AS decile) WHERE n > 0"
    ),
    "catch_up_state": f"""
        SELECT 'hourly' AS pipeline, {RUNNING_HOUR} - INTERVAL 1 HOUR AS last_processed_hour,
          '{VERSION}' AS version, {CLOCK} AS last_backfill""",
    "catch_up_readback": readings(f"SELECT * FROM ({hourly()}) WHERE {SINCE_START}"),
    "stream_hourly_closed": readings(closed_hours(None, ANY_VALID, "0 HOUR")),
    "stream_hourly_delayed": readings(closed_hours(["co"], "co_status = 'k'", STREAM_DELAY.replace("hours", "HOUR"))),
}
