"""Benchmark decontamination: Wu-Manber search of documents for word windows of test items.

A window is ``WINDOW`` consecutive words of an item, or all words of a shorter one. Texts are brought to
one form first: their words, lower-cased, with one space before, between and after them, so that a window
occurs where its form does. Windows of the same number of words are searched together:

1. Shift tables. Each block of up to eight bytes in the first ``m`` bytes of a window (``m``: the bytes of
   the shortest) sets how far a cursor on such a block may move on; any other block moves it by the most there is.
   Cursors of many stretches of the documents move in step.
2. Where the shift is zero, the string of that many words from there on is hashed, and the hash chooses a
   bucket of windows.
3. The window and the text are compared directly; only that counts.

The windows of a shard (about ``SHARD_BYTES`` of item text, counted beforehand) are broadcast; more text makes
more shards, each searched by a pass of its own, and spans and items of a document are united.

Defined results: null and empty texts have no words. A row with a null ``item_id`` has windows like
any other, but no id to count or list. Rows that repeat an ``item_id`` are one item with the windows of
each. Repeated documents, also with a null ``doc_id``, each give their row. Empty tables give no rows, or
no hits. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airhour.llm.common import chunks, column_list, id_and_text, prepare_text
from airhour.session import scratch_path

WINDOW = 10
SHARD_BYTES = 16 << 20
PIECE_WORDS = 1 << 14  # words of a long item that are sent as one row
BLOCK = 8
STRETCH = 1024  # bytes that one cursor passes over
# Words are runs of [0-9a-z] and of everything beyond ASCII; bytes of all else become spaces.
_FORM = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_TIMES = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_FORM).split()


def in_form(words: list[bytes]) -> bytes:
    return b" " + b" ".join(words) + b" " if words else b""


class Bytes:
    """Texts in one array, zeros between them, read up to eight bytes at a time from any position."""

    def __init__(self, forms: list[bytes]) -> None:
        data = (b"\0" * 8).join([*forms, b"", b""])
        self.flat = np.frombuffer(data, dtype=np.uint8)
        self.eight = np.lib.stride_tricks.as_strided(
            np.frombuffer(data, dtype="<u8", count=1), shape=(len(data) - 7,), strides=(1,)
        )
        lengths = np.fromiter((len(f) for f in forms), dtype=np.int64, count=len(forms))
        self.starts = np.cumsum(lengths + 8) - lengths - 8
        self.spaces = np.flatnonzero(self.flat == 32)

    def at(self, position: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        """The bytes from each position on, as a number; of ``size`` below eight only so many."""
        found = self.eight[position]
        short = np.clip(8 - np.asarray(size), 0, 8).astype(np.uint64) * np.uint64(8)
        return found & (np.uint64(0xFFFFFFFFFFFFFFFF) >> short)

    def hashes(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """A hash of each string."""
        out, open_, step = length.astype(np.uint64), np.arange(len(start)), 0
        while len(open_):
            part = self.at(start[open_] + step, length[open_] - step)
            mixed = (out[open_] ^ part) * _TIMES
            out[open_] = mixed ^ (mixed >> np.uint64(29))
            step += 8
            open_ = open_[length[open_] > step]
        return out


def same(left: Bytes, a: np.ndarray, right: Bytes, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Which of the pairs of strings are equal, byte by byte."""
    good, open_, step = np.ones(len(a), dtype=bool), np.arange(len(a)), 0
    while len(open_):
        size = length[open_] - step
        good[open_] = left.at(a[open_] + step, size) == right.at(b[open_] + step, size)
        step += 8
        open_ = open_[good[open_] & (length[open_] > step)]
    return good


class WordWindows:
    """Wu-Manber tables over all windows of ``words`` words; ``number`` is each window's own."""

    def __init__(self, text: Bytes, start: np.ndarray, length: np.ndarray, number: np.ndarray, words: int) -> None:
        self.words, self.text = words, text
        self.reach = int(length.min())  # the bytes at the front of each window that the shifts look at
        self.block = min(BLOCK, self.reach)
        self.last = self.reach - self.block  # where in a window the block stands that has shift zero
        bits = min(24, max(12, int(len(start) * (self.last + 1)).bit_length() + 3))
        self.bits = np.uint64(64 - bits)
        self.shift = np.full(1 << bits, self.last + 1, dtype=np.int32)
        for offset in range(self.last + 1):
            np.minimum.at(self.shift, self._slot(text.at(start + offset, self.block)), self.last - offset)
        key = text.hashes(start, length)
        order = np.argsort(key, kind="stable")
        self.key, self.start, self.length, self.number = key[order], start[order], length[order], number[order]

    def _slot(self, block: np.ndarray) -> np.ndarray:
        return ((block * _TIMES) >> self.bits).astype(np.int64)

    def candidates(self, text: Bytes) -> np.ndarray:
        """Where windows may start."""
        end = len(text.flat) - 8
        cursor = np.arange(self.last, end, STRETCH)
        stop = np.minimum(cursor + STRETCH, end)
        found = []
        while len(cursor):
            step = self.shift[self._slot(text.at(cursor, self.block))]
            hit = step == 0
            if hit.any():
                found.append(cursor[hit] - self.last)
            cursor = cursor + np.maximum(step, 1)
            ahead = cursor < stop
            if not ahead.all():
                cursor, stop = cursor[ahead], stop[ahead]
        return np.sort(np.concatenate(found)) if found else np.zeros(0, dtype=np.int64)

    def occurrences(self, text: Bytes) -> tuple[np.ndarray, np.ndarray]:
        """The place among the spaces where each occurrence starts, and the number of its window."""
        start = self.candidates(text)
        start = start[text.flat[start] == 32]
        space = np.searchsorted(text.spaces, start)
        whole = space + self.words < len(text.spaces)
        start, space = start[whole], space[whole]
        length = text.spaces[space + self.words] + 1 - start
        key = text.hashes(start, length)
        low, high = np.searchsorted(self.key, key), np.searchsorted(self.key, key, side="right")
        many = high - low
        row = np.repeat(np.arange(len(start)), many)
        window = np.repeat(low - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
        alike = self.length[window] == length[row]
        row, window = row[alike], window[alike]
        good = same(text, start[row], self.text, self.start[window], length[row])
        return space[row[good]], self.number[window[good]]


@dataclass
class Shard:
    """What is broadcast: texts of items in form, with the item that each belongs to."""

    forms: list[bytes]
    items: list[str | None]


class Searcher:
    """The windows of a shard, and the items that have each distinct one."""

    def __init__(self, shard: Shard, window: int = WINDOW) -> None:
        text = Bytes(shard.forms)
        self.names = sorted({i for i in shard.items if i is not None})
        of_name = {name: k for k, name in enumerate(self.names)}
        classes: dict[int, tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]] = {}
        for i, form in enumerate(shard.forms):
            lo = int(np.searchsorted(text.spaces, text.starts[i]))
            n = int(np.searchsorted(text.spaces, text.starts[i] + len(form))) - lo - 1
            if n < 1:
                continue
            words = min(window, n)
            first = lo + np.arange(n - words + 1)
            starts, lengths, owners = classes.setdefault(words, ([], [], []))
            starts.append(text.spaces[first])
            lengths.append(text.spaces[first + words] + 1 - text.spaces[first])
            owners.append(np.full(len(first), of_name.get(shard.items[i], -1)))
        self.classes: list[WordWindows] = []
        pairs, numbers = [np.zeros((0, 2), dtype=np.int64)], 0
        for words, parts in sorted(classes.items()):
            start, length, owner = (np.concatenate(p) for p in parts)
            key = text.hashes(start, length)
            # Equal windows stand together, as far as the hash goes; different ones that share it stay apart.
            order = np.lexsort((start, length, key))
            start, length, owner, key = start[order], length[order], owner[order], key[order]
            head = np.ones(len(start), dtype=bool)
            if len(start) > 1:
                alike = (key[1:] == key[:-1]) & (length[1:] == length[:-1])
                row = np.flatnonzero(alike)
                head[1:][row] = ~same(text, start[row], text, start[row + 1], length[row])
            number = numbers + np.cumsum(head) - 1
            heads = np.flatnonzero(head)
            self.classes.append(WordWindows(text, start[heads], length[heads], number[heads], words))
            pairs.append(np.stack([number, owner], axis=1)[owner >= 0])
            numbers = int(number[-1]) + 1
        pairs = np.unique(np.concatenate(pairs), axis=0)
        self.item = pairs[:, 1]
        self.item_edges = np.searchsorted(pairs[:, 0], np.arange(numbers + 1))

    def search(self, forms: list[bytes], counts: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each text with hits: its place, the numbers of its words that are hit, and the items, ascending.

        ``counts``: the words of each text.
        """
        text = Bytes(forms)
        # A text of n words has n + 1 spaces, one without words none.
        edges = np.concatenate([[0], np.cumsum(np.where(counts > 0, counts + 1, 0))])
        change = np.zeros(len(text.spaces) + 1, dtype=np.int64)
        docs, items = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for windows in self.classes:
            space, number = windows.occurrences(text)
            np.add.at(change, space, 1)
            np.add.at(change, space + windows.words, -1)
            both = np.unique((np.searchsorted(edges, space, side="right") - 1) * np.int64(len(self.item_edges)) + number)
            doc, number = both // len(self.item_edges), both % len(self.item_edges)
            low = self.item_edges[number]
            many = self.item_edges[number + 1] - low
            docs.append(np.repeat(doc, many))
            items.append(self.item[np.repeat(low - np.cumsum(many) + many, many) + np.arange(int(many.sum()))])
        hit = np.flatnonzero(np.cumsum(change) > 0)
        owner = np.searchsorted(edges, hit, side="right") - 1
        pairs = np.unique(np.concatenate(docs) * np.int64(max(1, len(self.names))) + np.concatenate(items))
        doc, item = pairs // max(1, len(self.names)), pairs % max(1, len(self.names))
        for i in np.unique(owner).tolist():
            a, b = np.searchsorted(owner, [i, i + 1])
            c, d = np.searchsorted(doc, [i, i + 1])
            yield i, hit[a:b] - edges[i], item[c:d]


def _pieces(items: DataFrame, window: int) -> DataFrame:
    """``item string, form binary``: items in form, long ones in pieces that share ``window - 1`` words."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                parts = [in_form(words[at : at + PIECE_WORDS]) for at in range(0, max(1, len(words) - window + 1), PIECE_WORDS - window + 1)]
                parts = [p for p in parts if p]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(parts), pa.string()), pa.array(parts, pa.binary())], names=["item", "form"]
                )

    rows = items.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(cut, "item string, form binary").distinct()


def shards(items: DataFrame, window: int = WINDOW, shard_bytes: int = SHARD_BYTES) -> Iterator[Shard]:
    """The items in shards of about ``shard_bytes``, one at a time on the driver."""
    spark = items.sparkSession
    path = scratch_path(spark, "windows")
    _pieces(items, window).write.parquet(path)
    pieces = spark.read.schema("item string, form binary").parquet(path)
    size = pieces.agg(F.sum(F.octet_length("form") + F.coalesce(F.octet_length("item"), F.lit(0)))).first()[0] or 0
    n = -(-size // shard_bytes)
    for shard in range(n):
        rows = pieces.filter(F.pmod(F.xxhash64("item", "form"), F.lit(n)) == shard).orderBy("item", "form").collect()
        yield Shard([bytes(r.form) for r in rows], [r.item for r in rows])


RESULT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def _digest(names: list[str]) -> str:
    return hashlib.sha256(",".join(names).encode()).hexdigest()


def _runs(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending numbers as runs, each from its first to beyond its last."""
    cut = np.flatnonzero(np.diff(places) > 1)
    return places[np.append(0, cut + 1)], places[np.append(cut, len(places) - 1)] + 1


HITS_COLUMNS = ("row", "starts", "ends", "items")
HITS = "row long, starts array<long>, ends array<long>, items array<string>"


def _searched(shard, window: int, key: str):
    """``key, n_words, starts, ends, items`` of every row: runs of words that are hit, and the items hit."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = None
        for batch in batches:
            searcher = searcher or (Searcher(shard.value, window) if shard is not None else None)
            forms, counts = [], np.zeros(batch.num_rows, dtype=np.int64)
            for i, text in enumerate(column_list(batch, "text")):
                words = words_of(text)
                counts[i] = len(words)
                forms.append(in_form(words))
            runs: list = [[] for _ in forms], [[] for _ in forms], [[] for _ in forms]
            for lo, hi in chunks(forms) if searcher else ():
                for i, places, items in searcher.search(forms[lo:hi], counts[lo:hi]):
                    runs[0][lo + i], runs[1][lo + i] = _runs(places)
                    runs[2][lo + i] = [searcher.names[k] for k in items.tolist()]
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts),
                    pa.array(runs[0], longs),
                    pa.array(runs[1], longs),
                    pa.array(runs[2], pa.list_(pa.string())),
                ],
                names=[key, "n_words", "starts", "ends", "items"],
            )

    return work


def find(docs: DataFrame, items: DataFrame, window: int = WINDOW, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``doc_id, n_words, starts, ends, items`` of every row: runs of words inside windows, from a word's number
    to beyond the last one's, and the items that have them, sorted as strings."""
    spark = prepare_text(docs.sparkSession)
    found = "n_words long, starts array<long>, ends array<long>, items array<string>"
    rows, tables = id_and_text(docs), shards(items, window, shard_bytes)
    first, second = next(tables, None), next(tables, None)
    if second is None:
        shard = spark.sparkContext.broadcast(first) if first is not None else None
        return rows.mapInArrow(_searched(shard, window, "doc_id"), f"doc_id long, {found}")
    path = scratch_path(spark, "documents")
    rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").write.parquet(path)
    stored = spark.read.schema("row long, doc_id long, text string").parquet(path)
    path = scratch_path(spark, "hits")
    for table in itertools.chain([first, second], tables):
        spread = spark.sparkContext.broadcast(table)
        hits = stored.select("row", "text").mapInArrow(_searched(spread, window, "row"), f"row long, {found}")
        hits.filter(F.size("starts") > 0).select(*HITS_COLUMNS).write.mode("append").parquet(path)
        spread.destroy()
    runs = spark.read.schema(HITS).parquet(path)
    per_row = runs.groupBy("row").agg(
        F.array_sort(F.flatten(F.collect_list(F.arrays_zip("starts", "ends")))).alias("runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    counted = stored.mapInArrow(_counted, "row long, doc_id long, n_words long")
    none = F.array().cast("array<long>")
    return counted.join(per_row, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce(F.col("runs.starts"), none).alias("starts"),
        F.coalesce(F.col("runs.ends"), none).alias("ends"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = pa.array([len(words_of(t)) for t in column_list(batch, "text")], pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], counts], names=["row", "doc_id", "n_words"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        starts, ends, items = (column_list(batch, c) for c in ("starts", "ends", "items"))
        hits = []
        for s, e in zip(starts, ends, strict=True):
            total, reach = 0, 0
            for a, b in zip(s, e, strict=True):
                total += max(0, b - max(a, reach))
                reach = max(reach, b)
            hits.append(total)
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns[:2],
                pa.array(hits, pa.int64()),
                pa.array([len(i) for i in items], pa.int64()),
                pa.array([_digest(i) for i in items], pa.string()),
                pa.array([h > 0 for h in hits], pa.bool_()),
            ],
            names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        )


def summarise(found: DataFrame) -> DataFrame:
    """The result of ``find`` as counts and digests."""
    return found.mapInArrow(_summed, RESULT)


def op12(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    return summarise(find(documents, benchmark))


OP12_SQL = """
WITH doc_words AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents
), item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark
), windows AS (
  SELECT DISTINCT item, least(10, len(words)) AS size, array_to_string(words[i:i + least(10, len(words)) - 1], ' ') AS piece
  FROM (SELECT *, unnest(generate_series(1, len(words) - least(10, len(words)) + 1)) AS i FROM item_words WHERE len(words) > 0)
), strings AS (
  SELECT r, i, size, array_to_string(words[i:i + size - 1], ' ') AS piece
  FROM (SELECT r, words, s.size, unnest(generate_series(1, len(words) - s.size + 1)) AS i
        FROM doc_words, (SELECT DISTINCT size FROM windows) s WHERE len(words) >= s.size)
), found AS (
  SELECT s.r, s.i, s.size, w.item FROM strings s JOIN windows w ON s.size = w.size AND s.piece = w.piece
), hits AS (
  SELECT r, count(DISTINCT word) AS n_hit
  FROM (SELECT r, unnest(generate_series(i, i + size - 1)) AS word FROM (SELECT DISTINCT r, i, size FROM found)) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT r, item FROM found WHERE item IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hits USING (r) LEFT JOIN items USING (r)
"""
