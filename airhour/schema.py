"""Schemas of the hourly fact table and the state log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

OUTPUT_SCHEMA = T.StructType(
    [
        T.StructField("time", T.TimestampType(), False),
        T.StructField("location", T.StringType(), False),
        T.StructField("metrica", T.StringType(), False),
        T.StructField("valor", T.DoubleType(), True),
        T.StructField("count_ok", T.LongType(), False),
        T.StructField("version", T.StringType(), True),
    ]
)
OUTPUT_COLUMNS = OUTPUT_SCHEMA.fieldNames()
REQUIRED_OUTPUT_COLUMNS = [field.name for field in OUTPUT_SCHEMA if not field.nullable]

REQUIRED_INPUT_COLUMNS = ["time", "location", "status"]

STATE_SCHEMA = T.StructType(
    [
        T.StructField("pipeline", T.StringType(), False),
        T.StructField("updated_at", T.TimestampType(), False),
        T.StructField("last_processed_hour", T.TimestampType(), True),
        T.StructField("version", T.StringType(), True),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType()), True),
    ]
)


def create_empty_output_dataframe(spark: SparkSession) -> DataFrame:
    """The fact table's columns with no rows."""
    return spark.createDataFrame([], OUTPUT_SCHEMA)


def validate_output_schema(df: DataFrame) -> DataFrame:
    """Conform ``df`` to the fact table: typed nulls for missing columns, casts, order, no extras.

    One projection and no job. A value that cannot be cast fails the job that
    evaluates it (ANSI mode), so nothing is silently nulled.
    """
    present = set(df.columns)
    return df.select(
        *[
            (F.col(field.name) if field.name in present else F.lit(None)).cast(field.dataType).alias(field.name)
            for field in OUTPUT_SCHEMA
        ]
    )


def require_output_columns(df: DataFrame) -> None:
    """Raise ValueError when a fact-table column is absent."""
    missing = [name for name in OUTPUT_COLUMNS if name not in df.columns]
    if missing:
        raise ValueError(f"missing fact-table columns: {missing}")


def guard_not_null(df: DataFrame) -> DataFrame:
    """Fail the job that writes a null into a required column.

    Parquet tables do not enforce NOT NULL, and an all-null group key survives
    the hourly aggregate, so the check travels inside the write's own projection.
    """

    def checked(name: str):
        failure = F.raise_error(F.lit(f"null in required column {name}"))
        return F.when(F.col(name).isNull(), failure).otherwise(F.col(name)).alias(name)

    return df.select(*[checked(c) if c in REQUIRED_OUTPUT_COLUMNS else F.col(c) for c in df.columns])
