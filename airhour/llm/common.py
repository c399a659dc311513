"""Pieces the text operators share: input columns, batches, ranges of a key, folds."""

from __future__ import annotations

import ctypes
import functools
import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airhour.session import prepare

ROOT = str(Path(__file__).resolve().parents[2])
# Rows of one Arrow batch. Texts are long, so the default of 10,000 would be too many.
ARROW_ROWS = 512
# Bytes of text that a task works on at a time, when the work is vectorised.
CHUNK_BYTES = 1 << 21


def prepare_text(spark: SparkSession) -> SparkSession:
    """Session settings the text operators rely on.

    Python workers look for this package where the driver found it; a cluster that keeps it elsewhere
    ships it as usual (``--py-files`` or an installed package).
    """
    prepare(spark)
    places = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in places:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*filter(None, places), ROOT])
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") != str(ARROW_ROWS):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare_text(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, so that other columns can have any name."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def fold(column: str, modulus: int) -> Column:
    """crc32 of an id as text, modulo."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(modulus)


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``limit`` bytes; a longer text stands alone."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def laid_out(texts: list[bytes], gap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One byte array of all texts, each followed by ``gap`` zero bytes; their starts and lengths."""
    lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    starts = np.zeros(len(texts), dtype=np.int64)
    if len(texts) > 1:
        np.cumsum(lengths[:-1] + gap, out=starts[1:])
    between = bytes(gap)
    return np.frombuffer(between.join(texts) + between, dtype=np.uint8), starts, lengths


@functools.lru_cache(maxsize=1)
def _trim():
    """What gives freed memory back to the system, where the C library can."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Hand the memory that a task has freed back: workers live on between tasks, and so would its peak."""
    pa.default_memory_pool().release_unused()
    trim = _trim()
    if trim is not None:
        trim(0)


def column_list(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def key_bounds(df: DataFrame, key: str, n: int) -> list[int]:
    """At most ``n - 1`` ascending values that cut the key into ranges with about as many rows each.

    Only these numbers reach the driver.
    """
    if n <= 1:
        return []
    cuts = [i / n for i in range(1, n)]
    found = df.agg(F.percentile_approx(F.col(key), cuts, max(1000, 10 * n)).alias("cuts")).first()["cuts"]
    return sorted(set(found or []))


def range_of(key: str, bounds: list[int]) -> Column:
    """The number of the range that a key falls in; null goes with the first."""
    if not bounds:
        return F.lit(0)
    below = F.size(F.filter(F.from_json(F.lit(str(bounds)), "array<long>"), lambda b: b <= F.col(key)))
    return F.when(F.col(key).isNull(), F.lit(0)).otherwise(below)
