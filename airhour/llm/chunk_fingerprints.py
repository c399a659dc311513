"""Document fingerprints by content-defined chunking.

A rolling gear hash over the bytes of a text marks where chunks end: seldom before the normal
size, often after it, so sizes stay near it (normalised chunking), never under a least or over a greatest
size. The hash sees only the bytes before a place, so an edit moves no boundary beyond its surroundings.
A fingerprint is the set of the chunks' digests with their lengths; how much of one text stands in another
is the length of the chunks they share, over the length of its own.

A fingerprint is written as its entries in order, separated by commas: 12 hexadecimal digits of a chunk's
XXH64, and 2 of its length.

Defined results: a null text is empty; an empty text has an empty fingerprint, which is contained wholly in
an empty one and not at all in another. Order is by ``doc_id``, null first, repeated ones by text; the last
row is followed by the first, and a single row by itself. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airhour.llm.common import chunks, column_list, id_and_text, key_bounds, laid_out, prepare_text, range_of

LEAST, NORMAL, GREATEST = 16, 48, 192
# Of so many places, one ends a chunk before and after the normal size.
SELDOM, OFTEN = 128, 16
WINDOW = 32  # bytes that a 32-bit gear hash sees


def _gear() -> np.ndarray:
    """A random-looking number for each byte, by a rule."""
    x = (np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(27))) >> np.uint64(16)).astype(np.uint32)


GEAR = _gear()


def gear_hashes(data: np.ndarray, outside: np.ndarray) -> np.ndarray:
    """At each byte, the sum of the gear numbers of it and the bytes before, each doubled once a byte."""
    found = GEAR[data]
    found[outside] = 0
    size = 1
    while size < WINDOW:
        found[size:] += found[:-size] << np.uint32(size)
        size *= 2
    return found


def _next(marks: np.ndarray) -> np.ndarray:
    """For each place, the first mark at or after it."""
    n = len(marks)
    at = np.where(marks, np.arange(n), n)
    return np.append(np.minimum.accumulate(at[::-1])[::-1], n)


def boundaries(texts: list[bytes]) -> tuple[bytes, list[list[int]]]:
    """All texts laid out, and the places in them where each text's chunks begin and end."""
    data, starts, lengths = laid_out(texts, WINDOW)
    outside = np.ones(len(data), dtype=bool)
    outside[np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))] = False
    hashes = gear_hashes(data, outside)
    seldom, often = _next(hashes < np.uint32((1 << 32) // SELDOM)), _next(hashes < np.uint32((1 << 32) // OFTEN))
    ends = starts + lengths
    rows, at = np.arange(len(texts)), starts.copy()
    found_rows, found_at = [rows], [starts]
    while True:
        open_ = at < ends[rows]
        rows, at = rows[open_], at[open_]
        if not len(rows):
            break
        limit = len(seldom) - 1
        early = seldom[np.minimum(at + LEAST - 1, limit)] + 1  # a chunk ends after its marked byte
        late = often[np.minimum(at + NORMAL - 1, limit)] + 1
        cut = np.where(early < at + NORMAL, early, late)
        at = np.minimum(np.minimum(cut, at + GREATEST), ends[rows])
        found_rows.append(rows)
        found_at.append(at)
    every_row, every_at = np.concatenate(found_rows), np.concatenate(found_at)
    order = np.argsort(every_row, kind="stable")
    edges = np.cumsum(np.bincount(every_row, minlength=len(texts)))[:-1]
    return data.tobytes(), [part.tolist() for part in np.split(every_at[order], edges)]


def fingerprints_of(texts: list[bytes]) -> list[dict[str, int]]:
    """The entries of each text's fingerprint, and their lengths."""
    digest, out = xxhash.xxh64_hexdigest, []
    for lo, hi in chunks(texts):
        data, places = boundaries(texts[lo:hi])
        for own in places:
            out.append({f"{digest(data[a:b])[:12]}{b - a:02x}": b - a for a, b in itertools.pairwise(own)})
    return out


def written(fingerprint: dict[str, int]) -> str:
    return ",".join(sorted(fingerprint))


def containment(a: dict[str, int], b: dict[str, int]) -> float:
    """The part of ``a`` that is in ``b``, by length."""
    if not a:
        return 0.0 if b else 1.0
    return sum(a[e] for e in a.keys() & b.keys()) / sum(a.values())


def edited(text: str, following: str) -> str:
    """The last quarter replaced by as much of the start of the following text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def with_following(docs: DataFrame) -> DataFrame:
    """``doc_id, text, part, extra``, dealt by ranges of ``doc_id`` and sorted in each: the first rows of the next
    range stand at the end of each, with ``extra`` true.

    A number for each range reaches the driver and is broadcast again.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = id_and_text(docs)
    keyed = keyed.withColumn("part", range_of("doc_id", key_bounds(keyed, "doc_id", n)))
    firsts = keyed.groupBy("part").agg(F.min("doc_id").alias("first"), F.max(F.col("doc_id").isNull()).alias("nulls"))
    firsts = sorted(firsts.collect(), key=lambda r: r["part"])
    before = [(r["part"], r["first"], r["nulls"], firsts[i - 1]["part"]) for i, r in enumerate(firsts)]
    heads = spark.createDataFrame(before, "part int, first long, nulls boolean, before int")
    is_first = F.when(F.col("nulls"), F.col("doc_id").isNull()).otherwise(F.col("doc_id") == F.col("first"))
    own = F.struct(F.col("part"), F.lit(False).alias("extra"))
    also = F.struct(F.col("before").alias("part"), F.lit(True).alias("extra"))
    places = F.explode(F.when(is_first, F.array(own, also)).otherwise(F.array(own)))
    rows = keyed.join(F.broadcast(heads), "part").select("doc_id", "text", places.alias("place"))
    rows = rows.select("doc_id", "text", "place.part", "place.extra")
    return rows.repartitionByRange(n, "part").sortWithinPartitions("part", "extra", "doc_id", "text")


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting: list[tuple] = []  # (doc_id, text, part, extra, fingerprint); the last row waits for its follower
    for batch in batches:
        texts = [t or "" for t in column_list(batch, "text")]
        prints = fingerprints_of([t.encode("utf-8", "replace") for t in texts])
        rows = list(zip(*[column_list(batch, c) for c in ("doc_id",)], texts, column_list(batch, "part"), column_list(batch, "extra"), prints, strict=True))
        rows = waiting + rows
        pairs = [(a, b) for a, b in itertools.pairwise(rows) if not a[3] and a[2] == b[2]]
        waiting = rows[-1:]
        changed = [edited(a[1], b[1]) for a, b in pairs]
        data = [c.encode("utf-8", "replace") for c in changed]
        edited_prints = fingerprints_of(data)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([a[0] for a, _ in pairs], pa.int64()),
                pa.array([len(a[1]) for a, _ in pairs], pa.int64()),
                pa.array([hashlib.sha256(d).hexdigest() for d in data], pa.string()),
                pa.array([written(a[4]) for a, _ in pairs], pa.string()),
                pa.array([written(e) for e in edited_prints], pa.string()),
                pa.array([containment(a[4], e) for (a, _), e in zip(pairs, edited_prints, strict=True)], pa.float64()),
                pa.array([containment(a[4], b[4]) for a, b in pairs], pa.float64()),
            ],
            names=[c.split()[0] for c in SCHEMA.split(", ")],
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` of every row."""
    prepare_text(docs.sparkSession)

    @F.arrow_udf("string")
    def fingerprint(texts: pa.Array) -> pa.Array:
        found = fingerprints_of([(t or "").encode("utf-8", "replace") for t in texts.to_pylist()])
        return pa.array([written(f) for f in found], pa.string())

    return id_and_text(docs).select("doc_id", fingerprint("text").alias("fingerprint"))


def op3(documents: DataFrame) -> DataFrame:
    prepare_text(documents.sparkSession)
    return with_following(documents).mapInArrow(_described, SCHEMA)
