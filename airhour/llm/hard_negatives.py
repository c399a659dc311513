"""Hard negatives of anchors, by a secondary sort.

Anchors meet all rows in blocks: of each pair of blocks one task computes the integer inner products. It keeps
of them what can count, which is little and loses nothing: in a first pass the best rows of the anchor's label, of
which the first ``POSITIVES`` of all blocks are the anchor's positives; in a second one, with the positives
known, the best ``NEGATIVES`` rows of other labels in the window of each positive.

What is kept is packed into keys of anchor, descending score, kind and id, dealt by anchor and sorted within
partitions. An iterator reads it in that order: each positive opens its window, each negative is emitted for
the open windows that it lies in. It holds the windows of one anchor, never its rows.

Defined results: a row without a label, an id or a vector, or with a null or non-finite component, takes no part,
nor does one with a component of 2**30 or more when scaled; scores end at 2**62. Only vectors of as many dimensions are compared. Rows that
repeat id, label and vector count once; other rows that repeat an id stand for themselves, also as anchors
whose results then come under one ``anchor_id``. A row with the anchor's own id is not another row. An
empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airhour.llm.common import prepare_text
from airhour.session import scratch_path

POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95  # per cent of the positive's score
SCALE = 256
LARGEST = 1 << 30
BLOCK_ROWS = 8192
ANCHOR_ROWS = 4096
TILE = 64  # anchors whose products are held together
LONG = (1 << 62) - 1
EXACT = 1 << 53  # integers below are exact as doubles


def usable(vectors: DataFrame, label: Column) -> DataFrame:
    """``vec_id, label, vector`` of the rows that take part."""
    vector = F.col("embedding").cast("array<double>")
    # Not so for null, infinity and NaN, which is greater than all numbers.
    whole = F.forall(vector, lambda x: F.coalesce(F.abs(x) * SCALE < LARGEST, F.lit(False)))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(whole, F.lit(False)))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), vector.alias("vector"))


class Rows:
    """Distinct rows of a block by ascending id, their components as whole numbers."""

    def __init__(self, rows: pa.Table) -> None:
        ids, labels = (rows.column(c).to_numpy() for c in ("vec_id", "label"))
        flat = rows.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        exact = flat.reshape(len(ids), rows.column("dims")[0].as_py())
        order = np.lexsort((*exact.T[:1], labels, ids))
        if len(order) > 1:  # only rows that repeat an id can be the same
            one, two = order[:-1], order[1:]
            if (ids[one] == ids[two]).any():
                order = np.lexsort((*exact.T[::-1], labels, ids))
                one, two = order[:-1], order[1:]
                again = (ids[one] == ids[two]) & (labels[one] == labels[two])
                again[again] = (exact[one[again]] == exact[two[again]]).all(axis=1)
                order = order[np.append(True, ~again)]
        self.ids, self.labels = ids[order], labels[order]
        whole = np.floor(exact[order] * SCALE)
        largest = float(np.abs(whole).max(initial=0))
        self.largest, self.dims = largest, whole.shape[1]
        self.whole = whole

    def times(self, other: Rows) -> np.ndarray:
        """All inner products, exact as far as they fit in 64 bits."""
        reach = self.largest * other.largest * max(1, self.dims)
        if reach < EXACT:
            return (self.whole @ other.whole.T).astype(np.int64)
        left, right = self.whole.astype(np.int64), other.whole.astype(np.int64).T
        if reach < 2 * LONG:
            return left @ right
        return np.clip(left.astype(object) @ right.astype(object), -LONG, LONG).astype(np.int64)

    def some(self, rows: slice | np.ndarray) -> Rows:
        part = object.__new__(Rows)
        part.ids, part.labels, part.whole = self.ids[rows], self.labels[rows], self.whole[rows]
        part.largest, part.dims = self.largest, self.dims
        return part


def best(score: np.ndarray, allowed: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``score`` its ``n`` largest allowed columns, ties to the lesser column, as (row, column)."""
    if score.shape[1] > n:
        masked = np.where(allowed, score, np.iinfo(np.int64).min)
        bar = np.partition(masked, -n, axis=1)[:, -n]
        row, column = np.nonzero(allowed & (masked >= bar[:, None]))
    else:
        row, column = np.nonzero(allowed)
    order = np.lexsort((column, -score[row, column], row))
    row, column = row[order], column[order]
    first = np.searchsorted(row, row)
    keep = np.arange(len(row)) - first < n
    return row[keep], column[keep]


KEY = "anchor binary, anchor_id long, falling long, kind int, id long"


def _keys(out: list[tuple[np.ndarray, ...]], anchors: list[bytes], ids: np.ndarray) -> pa.Table:
    """Packed keys; ``out`` has anchor rows, scores, kinds and ids."""
    anchor, score, kind, other = (
        np.concatenate(part) if part else np.zeros(0, dtype=np.int64) for part in (zip(*out, strict=True) if out else ((),) * 4)
    )
    return pa.table(
        {
            "anchor": pa.array([anchors[i] for i in anchor.tolist()], pa.binary()),
            "anchor_id": pa.array(ids[anchor.astype(np.int64)], pa.int64()),
            "falling": pa.array(-score, pa.int64()),
            "kind": pa.array(kind, pa.int32()),
            "id": pa.array(other, pa.int64()),
        }
    )


def _positives(positives: int):
    def work(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list = []
        names = anchors.column("anchor").to_pylist()
        numbers = anchors.column("vec_id").to_numpy()
        if rows.num_rows and anchors.num_rows:
            block = Rows(rows)
            asked = _as_they_stand(anchors)
            for label in np.unique(asked.labels).tolist():
                own, mine = np.flatnonzero(block.labels == label), np.flatnonzero(asked.labels == label)
                part = block.some(own)
                for at in range(0, len(mine) if len(own) else 0, TILE):
                    some = mine[at : at + TILE]
                    score = asked.some(some).times(part)
                    row, column = best(score, part.ids[None, :] != numbers[some, None], positives)
                    out.append((some[row], score[row, column], np.zeros(len(row), dtype=np.int32), part.ids[column]))
        return _keys(out, names, numbers)

    return work


def _as_they_stand(rows: pa.Table) -> Rows:
    """The rows in the order given."""
    found = object.__new__(Rows)
    found.ids, found.labels = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy()
    flat = rows.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    found.whole = np.floor(flat.reshape(rows.num_rows, rows.column("dims")[0].as_py()) * SCALE)
    found.largest, found.dims = float(np.abs(found.whole).max(initial=0)), found.whole.shape[1]
    return found


def _negatives(negatives: int, low: int, high: int):
    def work(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list = []
        names = anchors.column("anchor").to_pylist()
        numbers = anchors.column("vec_id").to_numpy()
        if rows.num_rows and anchors.num_rows:
            block, asked = Rows(rows), _as_they_stand(anchors)
            lists = anchors.column("scores").to_pylist()
            for at in range(0, len(numbers), TILE):
                some = np.arange(at, min(at + TILE, len(numbers)))
                score = asked.some(some).times(block)
                other = block.labels[None, :] != asked.labels[some, None]
                for rank in range(max(len(lists[i]) for i in some.tolist())):
                    # Without a positive of this rank the window is empty.
                    bar = [lists[i][rank] if rank < len(lists[i]) else None for i in some.tolist()]
                    lo = np.array([0 if b is None else -(-low * b // 100) for b in bar], dtype=np.int64)
                    hi = np.array([-1 if b is None else high * b // 100 for b in bar], dtype=np.int64)
                    inside = other & (score >= lo[:, None]) & (score <= hi[:, None])
                    row, column = best(score, inside, negatives)
                    out.append((some[row], score[row, column], np.ones(len(row), dtype=np.int32), block.ids[column]))
        return _keys(out, names, numbers)

    return work


def _sorted_by_anchor(keys: DataFrame) -> DataFrame:
    """The secondary sort: dealt by anchor, in the order of the whole key within each partition."""
    dealt = keys.repartition("anchor")
    return dealt.sortWithinPartitions("anchor", "falling", "kind", "id")


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    last = None
    for batch in batches:
        for key in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if key != last:  # rows of two blocks or windows may meet in one key
                yield key
            last = key


def _first(positives: int):
    """The first positives of each anchor, from keys in order."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, scores, ids, done = None, [], [], ([], [], [])

        def close() -> None:
            done[0].append(anchor)
            done[1].append(scores)
            done[2].append(ids)

        def batch_of() -> pa.RecordBatch:
            kinds = (pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(d, k) for d, k in zip(done, kinds, strict=True)], names=["anchor", "scores", "positives"])

        for key, _, falling, _, other in _lists(batches):
            if key != anchor:
                if anchor is not None:
                    close()
                anchor, scores, ids = key, [], []
                if len(done[0]) >= ANCHOR_ROWS:
                    yield batch_of()
                    done = ([], [], [])
            if len(ids) < positives:
                scores.append(-falling)
                ids.append(other)
        if anchor is not None:
            close()
        yield batch_of()

    return work


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _mined(positives: int, negatives: int, low: int, high: int):
    """Opens a window for each of the first positives, emits each negative for the open windows it lies in."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, opened = None, []
        out: list[tuple] = []

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = [part.split()[0] for part in RESULT.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for key, anchor_id, falling, kind, other in _lists(batches):
            if key != anchor:
                anchor, opened = key, []
            score = -falling
            if kind == 0:
                if len(opened) < positives:
                    opened.append([other, score, 0])
                continue
            for window in opened:
                positive, bar, emitted = window
                if emitted < negatives and low * bar <= 100 * score <= high * bar:
                    window[2] += 1
                    out.append((anchor_id, positive, window[2], other, bar, score))
            if len(out) >= ANCHOR_ROWS:
                yield batch_of()
                out = []
        yield batch_of()

    return work


def _blocks(rows: DataFrame, n: int, name: str) -> DataFrame:
    return rows.withColumn(name, F.pmod(F.xxhash64("vec_id", "label", "vector"), F.lit(n)).cast("int"))


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    block_rows: int = BLOCK_ROWS,
    anchor_rows: int = ANCHOR_ROWS,
) -> DataFrame:
    """The first ``negatives`` rows of other labels for each of an anchor's first ``positives`` rows of its own.

    ``is_anchor`` is a condition on ``vec_id``; ``label`` what counts as the label.
    """
    spark = prepare_text(vectors.sparkSession)
    rows = usable(vectors, F.col("label") if label is None else label)
    counts = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(is_anchor).alias("anchors")).first()
    n_blocks, n_asked = max(1, -(-counts.rows // block_rows)), max(1, -(-counts.anchors // anchor_rows))

    def everywhere(n: int, name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)

    dealt = _blocks(rows, n_blocks, "block").select("*", F.size("vector").alias("dims"), everywhere(n_asked, "asked"))
    anchors = _blocks(rows.filter(is_anchor).distinct(), n_asked, "asked").select("*", F.size("vector").alias("dims"))
    anchors = anchors.withColumn("anchor", F.unhex(F.md5(F.to_json(F.struct("vec_id", "label", "vector")).cast("binary"))))
    keys = ["dims", "block", "asked"]

    found = (
        dealt.groupBy(*keys)
        .cogroup(anchors.select("*", everywhere(n_blocks, "block")).groupBy(*keys))
        .applyInArrow(_positives(positives), KEY)
    )
    path = scratch_path(spark, "positives")
    found.write.parquet(path)
    close = spark.read.schema(KEY).parquet(path)

    first = _sorted_by_anchor(close).mapInArrow(_first(positives), "anchor binary, scores array<long>, positives array<long>")
    known = anchors.join(first.select("anchor", "scores"), "anchor")
    known = known.select(*[F.col(c).alias(c) for c in known.columns])  # columns of their own, beside those of the rows
    far = (
        dealt.groupBy(*keys)
        .cogroup(known.select("*", everywhere(n_blocks, "block")).groupBy(*keys))
        .applyInArrow(_negatives(negatives, low, high), KEY)
    )
    return _sorted_by_anchor(close.unionByName(far)).mapInArrow(_mined(positives, negatives, low, high), RESULT)


def op13(embeddings: DataFrame) -> DataFrame:
    label = F.col("label").cast("long")
    shifted = F.when(F.pmod("vec_id", F.lit(7)) == 0, (label + 1) % 10).otherwise(label)
    return mine(embeddings, F.pmod("vec_id", F.lit(50)) == 0, shifted)


OP13_SQL = """
WITH good AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE CAST(label AS BIGINT) END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND coalesce(list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false))), true)
), pairs AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
         CAST(list_sum(list_transform(list_zip(a.v, r.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM good a JOIN good r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS place FROM pairs WHERE same)
  WHERE place <= 5
), ranked AS (
  SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank
  FROM positives p JOIN pairs n ON p.anchor_id = n.anchor_id AND NOT n.same
    AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
)
SELECT * FROM ranked WHERE rank <= 3
"""
