"""Compare a registered query with its SQL on the same files."""

from __future__ import annotations

from datetime import datetime
from pathlib import Path

import duckdb


def plain(value):
    """Comparable form; nulls sort with everything and NaN equals itself."""
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, repr(value))
    if isinstance(value, datetime):
        return (1, value.isoformat())
    return (1, str(value))


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(plain(row[i]) for i in order) for row in rows)


def sql_rows(sf_dir: str, sql: str):
    with duckdb.connect() as connection:
        for file in Path(sf_dir).glob("*.parquet"):
            connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
        result = connection.execute(sql)
        names = [column[0] for column in result.description]
        return rows_of(names, result.fetchall())


def spark_rows(df):
    return rows_of(df.columns, [tuple(row) for row in df.collect()])
