"""Token ids in ORC files, in ascending order of documents.

One pass cuts the documents into ranges of ``doc_id``, sorts each range, encodes it with
the tokenizers library and writes it as one file. ORC packs the ids with its integer
run-length encoding, keeps row indexes, and has Bloom filters on ``doc_id``, so a range of
documents or a single one is found from metadata, and the stripes of a file are read in parallel.

Columns of the files: ``block`` (the range, from 0, ascending), ``row`` (from 0 in the
block), ``doc_id``, ``n_tokens``, ``ids`` (the end id last). Blocks and rows in order are the
documents in order: null ``doc_id`` first, repeated ones by their texts.

Defined results: a null text is empty and has the end id alone. An empty table gives a folder
without rows, which reads as an empty table. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from airhour.llm.bpe import VOCABULARY, byte_letters, with_special
from airhour.llm.common import chunks, column_list, id_and_text, prepare_text
from airhour.llm.pieces import Units
from airhour.session import scratch_path

END_ID = 0
SCHEMA = "block int, row int, doc_id long, n_tokens int, ids array<int>"
ORC_OPTIONS = {
    "compression": "zstd",
    "orc.stripe.size": str(64 << 20),
    "orc.row.index.stride": "2000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}


class LibraryEncoder:
    """The tokenizers library over pre-tokens, each encoded once as long as it is remembered."""

    def __init__(self, path: str) -> None:
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.model = tokenizer.model
        self.letters = {byte: letter for letter, byte in byte_letters().items()}
        with open(path, encoding="utf-8") as file:
            self.special = {t["content"].encode(): t["id"] for t in json.load(file)["added_tokens"]}
        self.units = Units(self._pieces)

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        as_letters = [p.encode().decode("latin-1").translate(self.letters) for p in pieces]
        return [np.array([t.id for t in self.model.tokenize(p)], dtype="<i4").tobytes() for p in as_letters]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return with_special(self.units, self.special, texts)


@functools.lru_cache(maxsize=2)
def library_encoder(path: str) -> LibraryEncoder:
    """One for each Python worker."""
    return LibraryEncoder(path)


def _with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> pa.ListArray:
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts + 1, out=offsets[1:])
    values = np.full(int(offsets[-1]), end_id, dtype=np.int32)
    inside = np.ones(len(values), dtype=bool)
    inside[offsets[1:] - 1] = False
    values[inside] = ids
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def write_tokens(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID) -> None:
    """Encode every row of ``docs`` into ORC files. ``path`` is that of a tokenizer file on the workers."""
    spark = prepare_text(docs.sparkSession)
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(path or public_tokenizers.path(VOCABULARY))
        block, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = [(t or "").encode("utf-8", "replace") for t in column_list(batch, "text")]
            for lo, hi in chunks(texts):
                ids, counts = encoder.encode(texts[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(hi - lo, block, dtype=np.int32)),
                        pa.array(np.arange(row, row + hi - lo, dtype=np.int32)),
                        batch.column(0)[lo:hi],
                        pa.array((counts + 1).astype(np.int32)),
                        _with_end(ids, counts, end_id),
                    ],
                    names=["block", "row", "doc_id", "n_tokens", "ids"],
                )
                row += hi - lo

    ordered = id_and_text(docs).repartitionByRange(ranges, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(encoded, SCHEMA).write.options(**ORC_OPTIONS).mode("overwrite").orc(folder)


def read_tokens(spark: SparkSession, folder: str, doc_ids: Sequence[int] | None = None) -> DataFrame:
    """The rows of all documents, or of some: stripes without them are skipped by Bloom filter and index."""
    rows = spark.read.schema(SCHEMA).orc(folder)
    return rows if doc_ids is None else rows.filter(F.col("doc_id").isin([int(i) for i in doc_ids]))


def with_starts(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """``rows`` with ``start``: the ids of all documents before each. ``blocks``: the same files' ``block, n_tokens``."""
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    totals = blocks.groupBy("block").agg(F.sum("n_tokens").alias("total"))
    totals = totals.select("block", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("block_start"))
    inside = Window.partitionBy("block").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return rows.join(totals, "block").withColumn("start", F.col("block_start") + F.col("inside"))


def checksums(rows: DataFrame) -> DataFrame:
    """``block, row, doc_id, n_tokens, ids_crc32`` from the ids that were read."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            counts = lists.value_lengths().to_numpy().astype(np.int64)
            data = memoryview(lists.flatten().to_numpy().astype("<u4").tobytes())
            ends = np.cumsum(counts) * 4
            crc = [zlib.crc32(data[e - 4 * n : e]) for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(counts), pa.array(crc, pa.int64())],
                names=["block", "row", "doc_id", "n_tokens", "ids_crc32"],
            )

    return rows.select("block", "row", "doc_id", "ids").mapInArrow(
        summed, "block int, row int, doc_id long, n_tokens long, ids_crc32 long"
    )


def op1(documents: DataFrame, path: str | None = None) -> DataFrame:
    spark = documents.sparkSession
    folder = scratch_path(spark, "token-files")
    write_tokens(documents, folder, path)
    rows = read_tokens(spark, folder)
    return with_starts(checksums(rows), rows.select("block", "n_tokens")).select(
        "doc_id", F.col("start").cast("long").alias("start"), "n_tokens", "ids_crc32"
    )
