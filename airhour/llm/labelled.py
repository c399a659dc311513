"""Bounded samples of labelled rows, and per-token features, for the classifiers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airhour.session import scratch_path

# Labelled rows that a classifier learns from at most; a bound on what is broadcast, and what reaches the driver.
SAMPLE_ROWS = 20_000


def sample(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, text, label, pick``: at most ``rows`` labelled ids that are allowed, those with the smallest hashes.

    The ids and labels (two numbers a row) are broadcast to a scan of the documents; the texts found are
    written to the shared folder. A doc_id with several labels has the largest.
    """
    spark = docs.sparkSession
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    ids = ids.filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & allowed)
    ids = ids.groupBy("doc_id").agg(F.max("label").alias("label"))
    ids = ids.withColumn("pick", F.xxhash64("doc_id")).orderBy("pick").limit(rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Of several texts with one id the least counts, however the rows are dealt.
    found = texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "label", "pick").agg(F.min("text").alias("text"))
    found = found.select("doc_id", "text", "label", "pick")
    path = scratch_path(spark, "labelled")
    found.write.parquet(path)
    return spark.read.schema(found.schema).parquet(path)


class TokenTable:
    """What each token contributes to the features of its text, described once and then remembered."""

    def __init__(self, describe: Callable[[str], tuple[float, ...]], limit: int = 400_000) -> None:
        self.describe, self.limit = describe, limit
        self._forget()

    def _forget(self) -> None:
        self.codes: dict[str, int] = {}
        self.rows: dict[tuple[float, ...], int] = {}
        self.table = np.zeros((0, 0))

    def of(self, tokens: Sequence[str]) -> np.ndarray:
        """A row of features for each token."""
        codes = self.codes
        if len(codes) > self.limit:
            self._forget()
            codes = self.codes
        for token in set(tokens).difference(codes):
            codes[token] = self.rows.setdefault(self.describe(token), len(self.rows))
        if len(self.table) != len(self.rows):
            self.table = np.array(list(self.rows))
        found = np.fromiter(map(codes.__getitem__, tokens), dtype=np.int64, count=len(tokens))
        return self.table[found]


def quantile_edges(values: np.ndarray, bins: int) -> np.ndarray:
    """At most ``bins - 1`` values that cut a feature into bins; a value goes right of the edges below it."""
    cuts = np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1], method="nearest") if len(values) else np.zeros(0)
    return np.unique(cuts)


def binned(x: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1).astype(np.int64)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))
