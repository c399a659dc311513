"""Approximate nearest neighbours by randomly rotated one-bit codes.

The index holds, for each distinct vector, its residual to the nearest of a few centroids, turned by a
random rotation and cut to signs, one bit a dimension; and two numbers that correct for the cut: the residual's
length, and its inner product with its own code. From code and numbers follow an estimate of the inner
product with any query, and how far the truth can be from it, but for a chance that ``BOUND`` sets. A block
of the index reranks, on the original vectors, every candidate that these bounds do not exclude from the
nearest; the blocks' nearest meet in a last ranking.

Vectors that are equal share an entry, with as many of their ids as can be among the nearest, the
smallest. Blocks of queries meet blocks of the index; nothing that grows is broadcast.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, neither as
queries nor as candidates; nor do null ids. Vectors are near only to those with as many dimensions: each number
of dimensions that a query has is searched apart. Rows that repeat both id and vector count once; one id on several vectors is as many rows. A query finds no row with
its own id. A query has fewer neighbours if there are fewer candidates. An empty table gives no rows. Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airhour.llm.common import prepare_text
from airhour.session import scratch_path

NEAREST = 10
SAMPLE_ROWS = 4096  # vectors that the centroids are fitted on; a bound on what reaches the driver
CENTROIDS = 16
BOUND = 5.0  # standard deviations of the estimate
BLOCK_ROWS = 16_384
QUERY_ROWS = 16_384  # of a block of queries
TILE = 256  # queries scored together


@dataclass(frozen=True)
class Coding:
    rotation: np.ndarray
    centroids: np.ndarray


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, vector`` of the rows that take part."""
    cast = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")
    ).filter("vec_id is not null")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return cast.filter(F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0))


def fit(good: DataFrame, seed: int = 11) -> Coding:
    """A random rotation, and centroids by a few rounds of k-means over a bounded sample."""
    rows = good.select("vector", F.xxhash64("vec_id").alias("pick")).orderBy("pick").limit(SAMPLE_ROWS).toArrow()
    x = np.array(rows.column("vector").to_pylist())
    rng = np.random.default_rng(seed)
    q, r = np.linalg.qr(rng.normal(size=(x.shape[1], x.shape[1])))
    centroids = x[rng.permutation(len(x))[:CENTROIDS]]
    for _ in range(8):
        own = _closest(x, centroids)
        for k in np.unique(own):
            centroids[k] = x[own == k].mean(axis=0)
    return Coding(q * np.sign(np.diag(r)), centroids)


def _closest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return ((centroids**2).sum(axis=1) - 2 * x @ centroids.T).argmin(axis=1)


INDEX = "ids array<long>, vector array<double>, centroid int, code binary, length double, own double"


def build(good: DataFrame, coding: Coding, nearest: int = NEAREST) -> DataFrame:
    """An entry for each distinct vector."""
    spread = good.sparkSession.sparkContext.broadcast(coding)
    # A ranking up to a limit is cut before the shuffle too, so copies by the million do not travel.
    by_id = Window.partitionBy("vector").orderBy("vec_id")
    few = good.distinct().withColumn("copy", F.row_number().over(by_id)).filter(F.col("copy") <= nearest + 1)
    entries = few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = spread.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array(batch.column(1).to_pylist())
            centroid = _closest(x, known.centroids)
            rest = (x - known.centroids[centroid]) @ known.rotation
            length = np.linalg.norm(rest, axis=1)
            own = np.abs(rest).sum(axis=1) / np.sqrt(x.shape[1]) / np.where(length > 0, length, 1)
            codes = [row.tobytes() for row in np.packbits(rest > 0, axis=1)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(centroid.astype(np.int32)),
                    pa.array(codes, pa.binary()),
                    pa.array(length),
                    pa.array(np.where(length > 0, own, 1.0)),
                ],
                names=["ids", "vector", "centroid", "code", "length", "own"],
            )

    return entries.select("ids", "vector").mapInArrow(coded, INDEX)


def squared_bounds(coding: Coding, code: np.ndarray, centroid: np.ndarray, length: np.ndarray, own: np.ndarray, queries: np.ndarray, bound: float = BOUND) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the squared distance of each entry (rows) to each query (columns)."""
    dims = queries.shape[1]
    signs = (np.unpackbits(code, axis=1, count=dims).astype(np.float32) * 2 - 1) / np.float32(np.sqrt(dims))
    low, high = np.empty((2, len(code), len(queries)), dtype=np.float32)
    spread = bound * np.sqrt(np.maximum(0.0, 1 - own**2) / max(1, dims - 1)) / own
    for k in np.unique(centroid):
        rows = np.flatnonzero(centroid == k)
        rest = (queries - coding.centroids[k]) @ coding.rotation
        away = np.linalg.norm(rest, axis=1)
        unit = (rest / np.where(away > 0, away, 1)[:, None]).astype(np.float32)
        inner = signs[rows] @ unit.T / own[rows, None]
        error = spread[rows, None] + 1e-5
        both, sums = 2 * length[rows, None] * away, length[rows, None] ** 2 + away**2
        slack = 1e-5 * sums
        low[rows] = np.maximum(0, sums - both * np.minimum(1, inner + error)) - slack
        high[rows] = sums - both * np.maximum(-1, inner - error) + slack
    return low, high


FOUND = "query_id long, vec_id long, score double"


def _search(spread, nearest: int):
    def work(entries: pa.Table, queries: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if entries.num_rows and queries.num_rows:
            ids = entries.column("ids").to_pylist()
            x = np.array(entries.column("vector").to_pylist())
            code = np.frombuffer(b"".join(entries.column("code").to_pylist()), dtype=np.uint8).reshape(len(x), -1)
            centroid, length, own = (entries.column(c).to_numpy() for c in ("centroid", "length", "own"))
            only: dict[int, list[int]] = {}  # entries that are of no use to a query, as they have no other id
            for row, own_ids in enumerate(ids):
                if len(own_ids) == 1:
                    only.setdefault(own_ids[0], []).append(row)
            q, q_ids = np.array(queries.column("vector").to_pylist()), queries.column("vec_id").to_pylist()
            for at in range(0, len(q), TILE):
                low, high = squared_bounds(spread.value, code, centroid, length, own, q[at : at + TILE])
                for j, query in enumerate(q_ids[at : at + TILE]):
                    high[only.get(query, []), j] = np.inf
                reach = np.partition(high, nearest - 1, axis=0)[nearest - 1] if len(x) >= nearest else np.full(low.shape[1], np.inf)
                for j, query in enumerate(q_ids[at : at + TILE]):
                    some = np.setdiff1d(np.flatnonzero(low[:, j] <= reach[j]), only.get(query, []))
                    exact = np.sqrt(np.cumsum((x[some] - q[at + j]) ** 2, axis=1)[:, -1])
                    if len(exact) > nearest:
                        near = exact <= np.partition(exact, nearest - 1)[nearest - 1]
                        some, exact = some[near], exact[near]
                    pairs = [(s, i) for row, s in zip(some.tolist(), exact.tolist(), strict=True) for i in ids[row] if i != query]
                    for s, i in sorted(pairs)[:nearest]:
                        out[0].append(query)
                        out[1].append(i)
                        out[2].append(s)
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})

    return work


def _blocks(rows: DataFrame, size: int, *key: str) -> tuple[DataFrame, int]:
    """Each row in a block of about ``size``; the key has to differ from row to row, or one block gets too many."""
    n = max(1, -(-rows.count() // size))
    return rows.withColumn("block", F.pmod(F.xxhash64(*key), F.lit(n)).cast("int")), n


def search(vectors: DataFrame, is_query: Column, nearest: int = NEAREST) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest rows by Euclidean distance, ties to the smaller id."""
    spark = prepare_text(vectors.sparkSession)
    good = usable(vectors)
    found = spark.createDataFrame([], FOUND)
    for row in good.filter(is_query).select(F.size("vector").alias("dims")).distinct().orderBy("dims").collect():
        found = found.unionByName(_found(good.filter(F.size("vector") == row.dims), is_query, nearest))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")


def _found(good: DataFrame, is_query: Column, nearest: int) -> DataFrame:
    """``query_id, vec_id, score`` of each block's nearest; all vectors have the same number of dimensions."""
    spark = good.sparkSession
    coding = fit(good)
    path = scratch_path(spark, "index")
    build(good, coding, nearest).write.parquet(path)
    index, n_index = _blocks(spark.read.schema(INDEX).parquet(path), BLOCK_ROWS, "vector")
    queries, n_queries = _blocks(good.filter(is_query).distinct(), QUERY_ROWS, "vec_id", "vector")
    index = index.withColumn("queries", F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))))
    queries = queries.withColumnRenamed("block", "queries")
    queries = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_index - 1))))
    spread = spark.sparkContext.broadcast(coding)
    return (
        index.groupBy("block", "queries")
        .cogroup(queries.groupBy("block", "queries"))
        .applyInArrow(_search(spread, nearest), FOUND)
    )


def op5(embeddings: DataFrame) -> DataFrame:
    return search(embeddings, F.pmod("vec_id", F.lit(100)) == 0)


OP5_SQL = """
WITH good AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS vector FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND list_bool_or(list_transform(embedding, lambda x: x <> 0))
    AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))
), pairs AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         sqrt(list_sum(list_transform(list_zip(v.vector, q.vector), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS score
  FROM good q JOIN good v ON q.vec_id <> v.vec_id
  WHERE q.vec_id % 100 = 0
)
SELECT query_id, rank, vec_id, score
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank FROM pairs)
WHERE rank <= 10
"""
