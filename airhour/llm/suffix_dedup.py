"""Removing bytes of strings that also start in an earlier document, by suffix order.

Whole documents are dealt to units of some megabytes. Every string of ``length`` bytes has one
anchor, the least hash of the shorter strings in it, so equal strings have equal anchors:

1. Units send the distinct anchors of their documents to buckets of anchors, which
   send back those that more than one document has. All other text is out: it cannot repeat.
2. Of runs of strings around such an anchor, units send each distinct one, with its least document, to
   the suffix bucket of the anchor. Strings at an anchor that very many documents share go by
   themselves, to the bucket of their own hash, so no bucket grows with the documents of one anchor.
3. A suffix bucket puts its suffixes in order (``suffix_order``), in which equal strings stand
   together, and gives back the runs that an earlier document has as well.
4. Units unite the runs of each document and cut them out.

A unit or bucket is what one call holds in memory; their numbers grow with the text. A document longer than
a slice is worked on in slices, so its length costs no memory beyond its own bytes.

Defined results: a null text is empty. Rows with a null ``doc_id`` are neither earlier nor
later than others and stay whole. Rows that repeat a ``doc_id`` are not earlier than each other. A
text shorter than ``length`` stays whole. Extra columns are ignored.
"""

from __future__ import annotations

import inspect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airhour.llm.common import give_back, prepare_text
from airhour.llm.suffix_order import PERIOD, Ordered

LENGTH = 50
GRAM = 24  # bytes of the strings whose hashes are compared
UNIT_BYTES = 6 << 20
SLICE = 1 << 20  # strings that are looked at together
BUCKET_BYTES = 3 << 20  # text of the corpus for each suffix bucket
ANCHOR_BYTES = 32 << 20  # text of the corpus for each bucket of anchors
CROWDED = 1000  # documents that share an anchor from which on its strings go by themselves
_BASE = 0x9E3779B97F4A7C15


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash of the ``gram`` bytes from each position on."""
    power = lambda n: np.uint64(pow(_BASE, n, 1 << 64))
    doubled, size = data.astype(np.uint64) + np.uint64(1), 1
    whole, done = None, 0
    while size <= gram:
        if gram & size:
            if whole is None:
                whole = doubled
            else:
                n = len(data) - done - size + 1
                whole = whole[:n] * power(size) + doubled[done : done + n]
            done += size
        doubled = doubled[: len(doubled) - size] * power(size) + doubled[size:]
        size *= 2
    whole ^= whole >> np.uint64(32)
    whole *= np.uint64(0xD6E8FEB86659FD93)
    return whole ^ (whole >> np.uint64(29))


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def anchor_runs(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of strings with the same anchor: the anchors, first strings, numbers of strings, and where
    in the first string its anchor stands."""
    if len(data) < length:
        empty = np.zeros(0, dtype=np.int64)
        return empty.astype(np.uint64), empty, empty, empty
    hashes = gram_hashes(data, gram)
    width = length - gram + 1
    least = least_of(hashes, width)
    starts = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    anchors = least[starts]
    offset = np.full(len(starts), -1, dtype=np.int64)
    open_ = np.arange(len(starts))
    for step in range(width):
        hit = hashes[starts[open_] + step] == anchors[open_]
        offset[open_[hit]] = step
        open_ = open_[~hit]
    return anchors, starts, np.diff(np.append(starts, len(least))), offset


def slices(data: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """Parts of a text, each with ``SLICE`` strings of its own."""
    for at in range(0, max(1, len(data) - length + 1), SLICE):
        yield at, data[at : at + SLICE + length - 1]


class Unit:
    """The distinct documents of a unit in ascending order, and the table row of each."""

    def __init__(self, docs: pa.Table) -> None:
        rows: dict[tuple[int, bytes], list[int]] = {}
        self.texts = [(t or "").encode("utf-8", "replace") for t in docs.column("text").to_pylist()]
        self.ids = docs.column("doc_id").to_pylist()
        for i, (doc, text) in enumerate(zip(self.ids, self.texts, strict=True)):
            if doc is not None:
                rows.setdefault((doc, text), []).append(i)
        self.distinct = sorted(rows)
        self.rows = rows


def _bucket_and_rest(anchors: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each anchor, and the 40 bits by which it is told apart there."""
    return (anchors & np.uint64(0xFFFFFF)).astype(np.int64) % buckets, anchors >> np.uint64(24)


def _packed(rest: np.ndarray) -> bytes:
    """Numbers of 40 bits in five bytes each."""
    return rest.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), dtype=np.uint8)
    out[:, :5] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


ANCHORS = "unit int, bucket int, anchors binary, counts binary"


def _sent_anchors(length: int, buckets: int):
    def work(docs: pa.Table) -> pa.Table:
        unit, own = Unit(docs), []
        for _, text in unit.distinct:
            parts = [anchor_runs(part, length)[0] for _, part in slices(np.frombuffer(text, dtype=np.uint8), length)]
            own.append(np.unique(np.concatenate(parts)))
        found, counts = np.unique(np.concatenate(own) if own else np.zeros(0, dtype=np.uint64), return_counts=True)
        bucket, rest = _bucket_and_rest(found, buckets)
        order = np.argsort(bucket, kind="stable")
        bucket, rest, counts = bucket[order], rest[order], np.minimum(counts[order], 255).astype(np.uint8)
        edges = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket)) if len(bucket) else [0]
        spans = list(zip(edges[:-1], edges[1:], strict=True))
        return pa.table(
            {
                "unit": pa.array([docs.column("unit")[0].as_py()] * len(spans), pa.int32()),
                "bucket": pa.array([bucket[a] for a, _ in spans], pa.int32()),
                "anchors": pa.array([_packed(rest[a:b]) for a, b in spans], pa.binary()),
                "counts": pa.array([counts[a:b].tobytes() for a, b in spans], pa.binary()),
            }
        )

    return work


def _repeated_anchors(crowded: int):
    def work(rows: pa.Table) -> pa.Table:
        """For each unit its anchors that several documents have; ``counts`` is 1 where very many have it."""
        own = [_unpacked(a) for a in rows.column("anchors").to_pylist()]
        counts = [np.frombuffer(c, dtype=np.uint8) for c in rows.column("counts").to_pylist()]
        every = np.concatenate(own)
        found, where = np.unique(every, return_inverse=True)
        total = np.bincount(where, weights=np.concatenate(counts), minlength=len(found))[where]
        edges = np.concatenate([[0], np.cumsum([len(o) for o in own])])
        keep = [np.flatnonzero(total[a:b] > 1) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        hot = [(total[a:b][k] >= crowded).astype(np.uint8) for a, b, k in zip(edges[:-1], edges[1:], keep, strict=True)]
        return pa.table(
            {
                "unit": rows.column("unit"),
                "bucket": rows.column("bucket"),
                "anchors": pa.array([_packed(o[k]) for o, k in zip(own, keep, strict=True)], pa.binary()),
                "counts": pa.array([h.tobytes() for h in hot], pa.binary()),
            }
        )

    return work


RUNS = "bucket int, unit int, packed binary"
_PART = [("doc", "<i8"), ("strings", "<i4"), ("anchor", "<i4"), ("many", "<i4"), ("place", "<i4"), ("start", "<i4")]


class Sent:
    """What a unit sends to one suffix bucket: runs of strings (bytes, least document, number of strings, where
    the anchor stands), and the places (run, document of the unit, position) that have them.

    Places of a run without bytes are removed already; ``run`` then is the number of their strings.
    """

    def __init__(self) -> None:
        self.data: list[bytes] = []
        self.doc: list[int] = []
        self.strings: list[int] = []
        self.anchor: list[int] = []
        self.run: list[int] = []
        self.place: list[int] = []
        self.start: list[int] = []

    def packed(self) -> bytes:
        """All of it, compressed; documents and places stand as steps, which are small."""
        run = np.array(self.run, dtype=np.int64)
        order = np.argsort(run, kind="stable") if self.data else np.arange(len(run))
        parts = {
            "doc": np.diff(self.doc, prepend=0) if self.doc else [],
            "strings": self.strings,
            "anchor": self.anchor,
            "many": np.bincount(run, minlength=len(self.data)) if self.data else run,
            "place": np.diff(np.array(self.place)[order], prepend=0),
            "start": np.array(self.start)[order],
        }
        arrays = [np.asarray(parts[name]).astype(kind).tobytes() for name, kind in _PART]
        sizes = np.array([len(a) for a in arrays], dtype="<i8").tobytes()
        return zstandard.ZstdCompressor(level=3).compress(b"".join([sizes, *arrays, *self.data]))


def _opened(packed: bytes) -> tuple[dict[str, np.ndarray], bytes]:
    data = zstandard.ZstdDecompressor().decompress(packed)
    at, out = 8 * len(_PART), {}
    for (name, kind), size in zip(_PART, np.frombuffer(data[:at], dtype="<i8").tolist(), strict=True):
        out[name] = np.frombuffer(data[at : at + size], dtype=kind).astype(np.int64)
        at += size
    out["doc"], out["place"] = np.cumsum(out["doc"]), np.cumsum(out["place"])
    return out, data[at:]


def _sent_runs(length: int, anchor_buckets: int, buckets: int):
    def work(docs: pa.Table, repeated: pa.Table) -> pa.Table:
        unit = Unit(docs)
        known, hot = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.uint8)]
        for b, a, c in zip(*(repeated.column(n).to_pylist() for n in ("bucket", "anchors", "counts")), strict=True):
            known.append(_unpacked(a) | (np.uint64(b) << np.uint64(40)))
            hot.append(np.frombuffer(c, dtype=np.uint8))
        known, hot = np.concatenate(known), np.concatenate(hot)
        order = np.argsort(known)
        known, hot = known[order], hot[order]
        out: dict[int, Sent] = {}
        seen: dict[bytes, tuple[int, Sent, int]] = {}
        gone = Sent()  # places of strings that an earlier document of this unit has

        def send(piece: bytes, key: int, doc: int, place: int, start: int, strings: int, anchor: int) -> None:
            first = seen.get(piece)
            if first is None:
                bucket = out.setdefault(key % buckets, Sent())
                first = seen[piece] = (doc, bucket, len(bucket.data))
                bucket.data.append(piece)
                bucket.doc.append(doc)
                bucket.strings.append(strings)
                bucket.anchor.append(anchor)
            to = first[1] if doc == first[0] else gone
            to.run.append(first[2] if doc == first[0] else strings)
            to.place.append(place)
            to.start.append(start)

        for place, (doc, text) in enumerate(unit.distinct if len(known) else []):
            for at, part in slices(np.frombuffer(text, dtype=np.uint8), length):
                anchors, starts, strings, offset = anchor_runs(part, length)
                bucket, rest = _bucket_and_rest(anchors, anchor_buckets)
                wanted = rest | (bucket.astype(np.uint64) << np.uint64(40))
                where = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
                some = np.flatnonzero(known[where] == wanted)
                crowded = hot[where[some]].tolist()
                lows, counts, offsets = (at + starts[some]).tolist(), strings[some].tolist(), offset[some].tolist()
                for start, n, key, begin, many in zip(lows, counts, (anchors[some] >> np.uint64(24)).tolist(), offsets, crowded, strict=True):
                    if many:
                        for k in range(start, start + n):
                            piece = text[k : k + length]
                            send(piece, xxhash.xxh64_intdigest(piece) >> 8, doc, place, k, 1, 0)
                    else:
                        send(text[start : start + n - 1 + length], key, doc, place, start, n, begin)
        number = docs.column("unit")[0].as_py()
        sent = [(b, s) for b, s in out.items()] + ([(buckets + number, gone)] if gone.run else [])
        return pa.table(
            {
                "bucket": pa.array([b for b, _ in sent], pa.int32()),
                "unit": pa.array([number] * len(sent), pa.int32()),
                "packed": pa.array([s.packed() for _, s in sent], pa.binary()),
            }
        )

    return work


SPANS = "unit int, place array<int>, start array<long>, end array<long>"


def _spans_table(unit: list[int], rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.Table:
    return pa.table(
        {
            "unit": pa.array(unit, pa.int32()),
            "place": pa.array([r[0] for r in rows], pa.list_(pa.int32())),
            "start": pa.array([r[1] for r in rows], pa.list_(pa.int64())),
            "end": pa.array([r[2] for r in rows], pa.list_(pa.int64())),
        }
    )


def _flat(rows: pa.Table, name: str) -> np.ndarray:
    return rows.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)


def earlier(data: list[bytes], doc: np.ndarray, strings: np.ndarray, anchor: np.ndarray, length: int) -> np.ndarray:
    """For each string of each run, in turn: whether a run of a smaller document has it too.

    Equal runs, which several units send, are put in order once, for the least of their documents; those of other
    documents have all their strings there.
    """
    flat = memoryview(b"".join(data))
    ends = np.cumsum(strings + (length - 1))
    number: dict[bytes, int] = {}
    run = np.fromiter(
        (number.setdefault(bytes(flat[a:b]), len(number)) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)),
        dtype=np.int64,
        count=len(strings),
    )
    if len(number) == len(strings):
        return _earlier(list(number), doc, strings, anchor, length)
    least = np.full(len(number), np.iinfo(np.int64).max)
    np.minimum.at(least, run, doc)
    head = np.zeros(len(number), dtype=np.int64)
    head[run[::-1]] = np.arange(len(run))[::-1]  # the first of each
    found = _earlier(list(number), least, strings[head], anchor[head], length)
    many = strings[head]
    first = np.cumsum(many) - many
    inside = np.arange(int(strings.sum())) - np.repeat(np.cumsum(strings) - strings, strings)
    return found[np.repeat(first[run], strings) + inside] | np.repeat(doc > least[run], strings)


def _earlier(data: list[bytes], doc: np.ndarray, strings: np.ndarray, anchor: np.ndarray, length: int) -> np.ndarray:
    # Runs lie so that their anchors stand at residue 0: equal strings then mostly tie within one residue.
    size = strings + (length - 1)
    room = (anchor + size + 2 * PERIOD) // PERIOD * PERIOD
    starts = np.cumsum(room) - room + (-anchor) % PERIOD
    text = np.zeros(int(room.sum()) + PERIOD, dtype=np.uint8)
    flat = np.frombuffer(b"".join(data), dtype=np.uint8)
    before = np.cumsum(size) - size
    inside = np.repeat(starts - before, size) + np.arange(len(flat))
    text[inside] = flat
    first = np.cumsum(strings) - strings
    at = np.repeat(starts - first, strings) + np.arange(int(strings.sum()))
    owner = np.zeros(len(text), dtype=np.int32)  # the string that starts at each position
    owner[at] = np.arange(len(at), dtype=np.int32)
    docs = np.repeat(doc, strings)
    out = np.zeros(len(at), dtype=bool)
    ordered = Ordered(text, length, inside)
    for bucket in ordered.buckets(at):
        bucket = ordered.sort(bucket)
        heads = np.flatnonzero(ordered.equal_runs(bucket))
        own = owner[bucket]
        least = np.minimum.reduceat(docs[own], heads)
        out[own] = docs[own] > np.repeat(least, np.diff(np.append(heads, len(own))))
    return out


def _found_spans(length: int, buckets: int):
    def work(rows: pa.Table) -> pa.Table:
        number = rows.column("unit").to_pylist()
        opened = [_opened(p) for p in rows.column("packed").to_pylist()]
        if rows.column("bucket")[0].as_py() >= buckets:
            gone = [(o["place"], o["start"], o["start"] + o["many"] + (length - 1)) for o, _ in opened]
            return _spans_table(number, gone)
        doc, strings, anchor, many_places, place, start = (
            np.concatenate([o[name] for o, _ in opened]) for name, _ in _PART
        )
        run = np.repeat(np.arange(len(strings)), many_places)
        runs_in = np.array([len(o["place"]) for o, _ in opened])
        out = earlier([data for _, data in opened], doc, strings, anchor, length)
        # Stretches of removed strings within each run.
        owner = np.repeat(np.arange(len(strings)), strings)
        inside = np.arange(len(out)) - (np.cumsum(strings) - strings)[owner]
        head = out & np.append(True, ~out[:-1] | (owner[1:] != owner[:-1]))
        tail = out & np.append(~out[1:] | (owner[1:] != owner[:-1]), True)
        heads, tails = np.flatnonzero(head), np.flatnonzero(tail)
        stretch_of = owner[heads]
        many = np.bincount(stretch_of, minlength=len(strings))
        first = np.cumsum(many) - many
        n = many[run]
        which = np.repeat(first[run] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        spot = np.repeat(np.arange(len(run)), n)
        row = np.repeat(np.arange(len(number)), runs_in)[spot]
        begin = start[spot] + inside[heads[which]]
        end = start[spot] + inside[tails[which]] + length
        edges = np.searchsorted(row, np.arange(len(number) + 1))
        parts = [(place[spot[a:b]], begin[a:b], end[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        return _spans_table(number, parts)

    return work


CLEANED = (
    T.StructType()
    .add("doc_id", T.LongType())
    .add("kept", T.BinaryType())
    .add("n_bytes", T.LongType())
    .add("starts", T.ArrayType(T.LongType()))
    .add("ends", T.ArrayType(T.LongType()))
)


def to_characters(text: bytes, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans without the characters that they cut in part."""
    lead = (np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80
    edges = np.append(np.flatnonzero(lead), len(text))
    start = edges[np.searchsorted(edges, start)]
    end = edges[np.searchsorted(edges, end, side="right") - 1]
    return start[start < end], end[start < end]


def united(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans that overlap or touch as one."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    heads = np.append(True, start[1:] > end[:-1])
    return start[heads], end[np.append(heads[1:], True)]


def _cut_out(whole_characters: bool):
    def work(docs: pa.Table, spans: pa.Table) -> pa.Table:
        unit = Unit(docs)
        place, start, end = _flat(spans, "place"), _flat(spans, "start"), _flat(spans, "end")
        order = np.argsort(place, kind="stable")
        place, start, end = place[order], start[order], end[order]
        kept: list[bytes] = list(unit.texts)
        starts: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * len(unit.texts)
        ends = list(starts)
        edges = np.searchsorted(place, np.arange(len(unit.distinct) + 1)).tolist()
        for key, a, b in zip(unit.distinct, edges[:-1], edges[1:], strict=True):
            if a == b:
                continue
            text, pieces, last = key[1], [], 0
            s, e = united(start[a:b], end[a:b])
            if whole_characters:
                s, e = to_characters(text, s, e)
            for x, y in zip(s.tolist(), e.tolist(), strict=True):
                pieces.append(text[last:x])
                last = y
            rest = b"".join([*pieces, text[last:]])
            for i in unit.rows[key]:
                kept[i], starts[i], ends[i] = rest, s, e
        return pa.table(
            {
                "doc_id": docs.column("doc_id"),
                "kept": pa.array(kept, pa.binary()),
                "n_bytes": pa.array([len(t) for t in unit.texts], pa.int64()),
                "starts": pa.array(starts, pa.list_(pa.int64())),
                "ends": pa.array(ends, pa.list_(pa.int64())),
                "carried": docs.column("carried"),
            }
        )

    return work


def _tidy(work):
    """The same work, after which the worker gives back what it has freed."""
    if len(inspect.signature(work).parameters) == 2:

        def pair(left: pa.Table, right: pa.Table) -> pa.Table:
            try:
                return work(left, right)
            finally:
                give_back()

        return pair

    def single(rows: pa.Table) -> pa.Table:
        try:
            return work(rows)
        finally:
            give_back()

    return single


def _nullable(kind: T.DataType) -> T.DataType:
    """The type with nulls allowed everywhere but in keys of maps."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType), True) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType), True)
    if isinstance(kind, T.MapType):
        return T.MapType(_nullable(kind.keyType), _nullable(kind.valueType), True)
    return kind


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, crowded: int = CROWDED, whole_characters: bool = False
) -> DataFrame:
    """``doc_id, kept, n_bytes, starts, ends, carried`` of every row: the bytes that stay, and the spans cut out.

    A byte goes if a string of ``length`` bytes over it also starts in a document with a smaller ``doc_id``;
    with ``whole_characters``, a character goes if all its bytes do. ``carried`` has the other columns of ``docs``.
    """
    spark = prepare_text(docs.sparkSession)
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    carried = F.struct(*others) if others else F.lit(None).cast("string")
    # Results of Arrow functions may be null, and so may be all that they carry.
    kind = _nullable(docs.select(carried.alias("carried")).schema["carried"].dataType)
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), carried.cast(kind).alias("carried")
    )
    cleaned = T.StructType([*CLEANED.fields, T.StructField("carried", kind)])
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    units = max(partitions, -(-n_bytes // UNIT_BYTES))
    buckets = max(partitions, -(-n_bytes // BUCKET_BYTES))
    anchor_buckets = min(1 << 24, max(partitions, -(-n_bytes // ANCHOR_BYTES)))
    dealt = texts.withColumn("unit", F.pmod(F.xxhash64("doc_id", "text"), F.lit(units)).cast("int"))
    sent = dealt.groupBy("unit").applyInArrow(_tidy(_sent_anchors(length, anchor_buckets)), ANCHORS)
    repeated = sent.groupBy("bucket").applyInArrow(_tidy(_repeated_anchors(crowded)), ANCHORS)
    runs = (
        dealt.groupBy("unit")
        .cogroup(repeated.groupBy("unit"))
        .applyInArrow(_tidy(_sent_runs(length, anchor_buckets, buckets)), RUNS)
    )
    spans = runs.groupBy("bucket").applyInArrow(_tidy(_found_spans(length, buckets)), SPANS)
    return dealt.groupBy("unit").cogroup(spans.groupBy("unit")).applyInArrow(_tidy(_cut_out(whole_characters)), cleaned)


def op6(documents: DataFrame) -> DataFrame:
    removed = F.aggregate(F.zip_with("ends", "starts", lambda e, s: e - s), F.lit(0).cast("long"), lambda a, x: a + x)
    return remove_repeats(documents.select("doc_id", "text")).select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
