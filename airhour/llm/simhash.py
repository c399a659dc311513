"""SimHash near-duplicates: a grid range join over segment counts, then exact comparison.

A fingerprint of 64 bits is embedded as the numbers of set bits in 32 segments of two bits.
The Manhattan distance of two such vectors is never above the Hamming distance of the
fingerprints, so pairs beyond the distance there need no comparison. The vectors lie on a
grid whose axes are dealt to ``distance + AGREEING`` faces: within the distance, at least ``AGREEING``
faces agree exactly. Each choice of faces is a grid of its own in which a point has one cell, and
two points within the distance share a cell in at least one of them. In a cell, the
Manhattan bound and then the bits decide.

Documents with the same fingerprint are one point from the start. A task reports its links as a
spanning forest, never as all pairs. A cell of more than ``CROWDED`` points is not compared whole:
its points are dealt to finer cells, over the next partitions, as often as its faces can be cut.

Defined results: a text without words (null, empty, white space) has fingerprint 0 and
links like others. Rows with a null ``doc_id`` get a fingerprint, take no part in links, and have
a null component. Repeated rows share their component. An empty table gives no rows. Extra columns are
ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airhour.llm.common import chunks, column_list, id_and_text, prepare_text
from airhour.llm.components import components
from airhour.session import scratch_path

SHINGLE_WORDS = 4
DISTANCE = 4
SEED = 42
AGREEING = 3
CROWDED = 4096
LOW_BITS = 0x5555555555555555  # the lower bit of every segment


def text_fingerprints(texts: list[bytes], words: int = SHINGLE_WORDS) -> np.ndarray:
    """The fingerprint of each text: the majority of each bit over the hashes of its shingles."""
    found = np.zeros(len(texts), dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    for row, text in enumerate(texts):
        tokens = text.lower().split()
        if not tokens:
            continue
        line, n = b" ".join(tokens), min(words, len(tokens))
        ends = list(itertools.accumulate(len(t) + 1 for t in tokens))
        starts = [0, *ends[: len(tokens) - n]]
        hashes = [digest(line[a : b - 1], SEED) for a, b in zip(starts, ends[n - 1 :], strict=True)]
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        most = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
        found[row] = np.packbits(most, bitorder="little").view("<u8")[0]
    return found


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, bits`` (the fingerprint as a signed long) of every row."""
    prepare_text(docs.sparkSession)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode("utf-8", "replace") for t in column_list(batch, "text")]
            parts = [text_fingerprints(texts[lo:hi], words) for lo, hi in chunks(texts)]
            bits = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits.view(np.int64))], names=["doc_id", "bits"])

    return id_and_text(docs).mapInArrow(marked, "doc_id long, bits long")


def _faces(segments: list[int], n: int) -> list[int]:
    """The segments dealt to ``n`` faces of near equal size, each as a mask of bits."""
    edges = [round(i * len(segments) / n) for i in range(n + 1)]
    return [sum(3 << (2 * s) for s in segments[a:b]) for a, b in itertools.pairwise(edges)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def embedded(bits: np.ndarray) -> np.ndarray:
    """The count of each segment in unary (0, 1, 3), so that Manhattan distances are differing bits."""
    low = np.uint64(LOW_BITS)
    one, two = bits & low, (bits >> np.uint64(1)) & low
    return (one | two) | ((one & two) << np.uint64(1))


def _embedded(bits: Column) -> Column:
    one, two = bits.bitwiseAND(F.lit(LOW_BITS)), F.shiftrightunsigned(bits, 1).bitwiseAND(F.lit(LOW_BITS))
    return one.bitwiseOR(two).bitwiseOR(F.shiftleft(one.bitwiseAND(two), 1))


def _cells(points: DataFrame, distance: int) -> DataFrame:
    """``cell, bits``: each point in its cell of each grid."""
    faces = _faces(list(range(32)), distance + AGREEING)
    grids = [_signed(sum(chosen)) for chosen in itertools.combinations(faces, AGREEING)]
    place = [F.xxhash64(F.lit(i), _embedded(F.col("bits")).bitwiseAND(F.lit(g))) for i, g in enumerate(grids)]
    return points.select(F.explode(F.array(*place)).alias("cell"), "bits")


def _finer(cell: np.ndarray, points: np.ndarray, distance: int, level: int) -> tuple[np.ndarray, np.ndarray]:
    """The points of crowded cells, each in its finer cells.

    Segments are dealt to faces in another order at each level, so that finer cells cut across coarser ones.
    """
    order = sorted(range(32), key=lambda s: (s * (2 * level + 5)) % 32)
    faces = _faces(order, distance + AGREEING)
    places, unary = [], embedded(points)
    for i, chosen in enumerate(itertools.combinations(faces, AGREEING)):
        key = (unary & np.uint64(sum(chosen))) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(i + 64 * level)
        key = (key ^ (key >> np.uint64(29)) ^ cell.view(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
        places.append((key ^ (key >> np.uint64(32))).view(np.int64))
    return np.concatenate(places), np.tile(points, len(places))


class Forest:
    """Keeps only links that join two trees."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = parent[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def near(cell: np.ndarray, points: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs within the distance whose cells are equal; rows are sorted by cell."""
    unary = embedded(points)
    at = np.arange(len(points))
    for step in range(1, len(points)):
        at = at[: np.searchsorted(at, len(points) - step)]
        at = at[cell[at] == cell[at + step]]
        if not len(at):
            return
        some = at[np.bitwise_count(unary[at] ^ unary[at + step]) <= distance]
        some = some[np.bitwise_count(points[some] ^ points[some + step]) <= distance]
        if len(some):
            yield points[some], points[some + step]


LINKS = "a long, b long, cell long"


def _linked(distance: int, level: int, crowded: int):
    """Links of the cells of a partition sorted by cell (``cell`` null), and points for finer cells (``b`` null)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        rest_cell, rest = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        crowd: int | None = None  # the crowded cell that is passing by

        def emit(a, b, cell) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, cell)], names=["a", "b", "cell"])

        def pass_on(cell: np.ndarray, points: np.ndarray) -> pa.RecordBatch:
            key, again = _finer(cell, points, distance, level)
            return emit(again.view(np.int64), [None] * len(key), key)

        def settle(cell: np.ndarray, points: np.ndarray) -> Iterator[pa.RecordBatch]:
            a, b = [], []
            for left, right in near(cell, points, distance):
                for x, y in zip(left.view(np.int64).tolist(), right.view(np.int64).tolist(), strict=True):
                    if forest.join(x, y):
                        a.append(x)
                        b.append(y)
            if a:
                yield emit(a, b, [None] * len(a))

        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                cell = np.concatenate([rest_cell, batch.column(0).to_numpy()])
                points = np.concatenate([rest, batch.column(1).to_numpy().view(np.uint64)])
                whole = int(np.searchsorted(cell, cell[-1])) if len(cell) else 0
            else:
                cell, points = rest_cell, rest
                whole = len(cell)
            rest_cell, rest = cell[whole:], points[whole:]
            cell, points = cell[:whole], points[:whole]
            if crowd is not None and len(cell):
                own = cell == crowd
                if own.any():
                    yield pass_on(cell[own], points[own])
                cell, points = cell[~own], points[~own]
            if len(cell):
                _, first, counts = np.unique(cell, return_index=True, return_counts=True)
                for i, n in zip(first[counts > crowded].tolist(), counts[counts > crowded].tolist(), strict=True):
                    yield pass_on(cell[i : i + n], points[i : i + n])
                few = np.repeat((counts > 1) & (counts <= crowded), counts)
                yield from settle(cell[few], points[few])
            if len(rest) > crowded or (crowd is not None and len(rest) and rest_cell[0] == crowd):
                crowd = int(rest_cell[0])
                yield pass_on(rest_cell, rest)
                rest_cell, rest = rest_cell[:0], rest[:0]

    return work


LEVELS = 3


def links(points: DataFrame, distance: int = DISTANCE, crowded: int = CROWDED) -> DataFrame:
    """``a, b``: links that connect the same points as all pairs of ``bits`` within the distance do."""
    spark = points.sparkSession
    found, cells = [], _cells(points, distance)
    for level in range(LEVELS + 1):
        # At the last level cells are compared whole, step by step, however many points they have.
        limit = crowded if level < LEVELS else 1 << 62
        path = scratch_path(spark, "links")
        dealt = cells.repartition("cell").sortWithinPartitions("cell")
        dealt.mapInArrow(_linked(distance, level, limit), LINKS).write.parquet(path)
        out = spark.read.schema(LINKS).parquet(path)
        found.append(out.filter("cell is null").select("a", "b"))
        cells = out.filter("cell is not null").select("cell", F.col("a").alias("bits"))
        if not cells.take(1):
            break
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """``doc_id, bits, component_id`` of every row; the component is the least ``doc_id`` that links reach."""
    spark = prepare_text(docs.sparkSession)
    path = scratch_path(spark, "fingerprints")
    fingerprints(docs, words).write.parquet(path)
    marked = spark.read.schema("doc_id long, bits long").parquet(path)
    points = marked.filter("doc_id is not null").groupBy("bits").agg(F.min("doc_id").alias("least"))
    roots = components(links(points.select("bits"), distance), "a", "b")
    rooted = points.join(roots, points["bits"] == roots["node"], "left").select(
        "bits", "least", F.coalesce("root", "bits").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_bits = rooted.join(named, "root").select("bits", "component_id")
    return marked.join(by_bits, "bits", "left").select(
        "doc_id", "bits", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    )


def op7(documents: DataFrame) -> DataFrame:
    return near_duplicates(documents).select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )
