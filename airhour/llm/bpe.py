"""Byte-level BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a pre-token there is just one token that can end its encoding. An automaton
over the vocabulary gives, at each byte, all tokens that end there. Of those, the one is kept
whose left neighbour, the last token of the prefix before it, is compatible with it: merging
the bytes of both must give those two tokens again. Following the kept tokens back from the
end gives exactly the ids that merging by rank gives, in time linear in the length, also
for a pre-token of a million bytes.

Defined results: a null text is empty and has no ids. Rows with a null ``doc_id`` and repeated
rows are encoded like others. Extra columns are ignored. Unknown or null ids decode to nothing;
bytes that are not UTF-8 decode to the replacement character.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airhour.llm.common import chunks, column_list, give_back, id_and_text, prepare_text
from airhour.llm.pieces import Units, gather

VOCABULARY = "byte_bpe_50k.json"
NEVER = float("inf")
ENCODED_BYTES = 1 << 19  # of text encoded together; the arrays beside it take about 100 times as much
# Places for remembered pairs of tokens in a Python worker, 9 bytes each.
PAIR_PLACES = 1 << 21
# Pre-tokens up to this many bytes are encoded side by side, longer ones one by one.
SIDE_BY_SIDE = 64


def vocabulary_path(name: str = VOCABULARY) -> str:
    return public_tokenizers.path(name)


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in a vocabulary file, and its byte.

    Printable bytes stand for themselves; the rest take the characters from 256 on, in order.
    """
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Pairs:
    """Remembers which pairs of tokens are compatible, in a table of fixed size."""

    def __init__(self, decide: Callable[[int, int], bool], places: int = PAIR_PLACES) -> None:
        self.decide, self.places = decide, places
        self._empty()

    def _empty(self) -> None:
        self.keys = np.full(self.places, -1, dtype=np.int64)
        self.values = np.zeros(self.places, dtype=bool)
        self.count = 0

    def _place(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each key is, or the free place where it would go; and whether it is there."""
        bits = self.places.bit_length() - 1
        place = ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)
        seen = self.keys[place]
        moving = np.flatnonzero((seen != keys) & (seen >= 0))
        while len(moving):
            place[moving] = (place[moving] + 1) % self.places
            seen[moving] = now = self.keys[place[moving]]
            moving = moving[(now != keys[moving]) & (now >= 0)]
        return place, seen == keys

    def test(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 32) | right
        place, there = self._place(keys)
        if there.all():
            return self.values[place]
        new = np.unique(keys[~there])
        if self.count + len(new) > self.places // 2:
            self._empty()
            new = np.unique(keys)
        answers = {k: self.decide(k >> 32, k & 0xFFFFFFFF) for k in new.tolist()}
        if len(new) > self.places // 2:
            return np.fromiter((answers[k] for k in keys.tolist()), dtype=bool, count=len(keys))
        self._insert(new, np.fromiter(answers.values(), dtype=bool, count=len(new)))
        return self.values[self._place(keys)[0]]

    def _insert(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Several keys at once: of those that want the same place, the first gets it and the rest try again."""
        self.count += len(keys)
        while len(keys):
            place, _ = self._place(keys)
            _, first = np.unique(place, return_index=True)
            self.keys[place[first]], self.values[place[first]] = keys[first], values[first]
            rest = np.ones(len(keys), dtype=bool)
            rest[first] = False
            keys, values = keys[rest], values[rest]


class Vocabulary:
    """Tokens, their merges, and the encoder over them."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        self.bytes_of = {i: bytes(letters[c] for c in token) for token, i in spec["model"]["vocab"].items()}
        ids = {token: i for i, token in self.bytes_of.items()}
        self.byte_ids = [ids[bytes([b])] for b in range(256)]
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, float] = {}
        self.merged: dict[tuple[int, int], float] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair = ids[bytes(letters[c] for c in left)], ids[bytes(letters[c] for c in right)]
            whole = ids[self.bytes_of[pair[0]] + self.bytes_of[pair[1]]]
            self.merged.setdefault(pair, rank)
            if whole not in self.rank:
                self.rank[whole], self.parts[whole] = rank, pair
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: token for token, i in self.special.items()}
        self.tokens = [i for i, token in self.bytes_of.items() if i in self.rank or len(token) == 1]
        self._build_automaton()
        self.automaton = ahocorasick.Automaton()
        for i in self.tokens:
            self.automaton.add_word(self.bytes_of[i].decode("latin-1"), (len(self.bytes_of[i]), i))
        self.automaton.make_automaton()
        self.pairs = Pairs(self._compatible)
        self.compatible = functools.lru_cache(maxsize=1 << 16)(self._compatible)
        self.units = Units(self._pieces)

    def _build_automaton(self) -> None:
        """States are the prefixes of tokens. From a state and a byte to the longest prefix of a token that
        is a suffix of what was read; at each state, the longest token that ends there, and the next."""
        at = {b"": 0}
        levels: list[list[tuple[int, int, int]]] = []
        for i in self.tokens:
            token = self.bytes_of[i]
            for n in range(1, len(token) + 1):
                if token[:n] not in at:
                    at[token[:n]] = len(at)
                    while len(levels) < n:
                        levels.append([])
                    levels[n - 1].append((at[token[: n - 1]], token[n - 1], at[token[:n]]))
        parent = np.concatenate([[e[0] for e in edges] for edges in levels])
        inner = np.unique(parent)  # a state without longer prefixes steps as the state of its longest suffix does
        row = np.zeros(len(at), dtype=np.int32)
        row[inner] = np.arange(len(inner))
        is_inner = np.zeros(len(at), dtype=bool)
        is_inner[inner] = True
        step = np.zeros((len(inner), 256), dtype=np.int32)
        back = np.zeros(len(at), dtype=np.int32)
        self.token_at = np.full(len(at), -1, dtype=np.int32)
        for i in self.tokens:
            self.token_at[at[self.bytes_of[i]]] = i
        self.longest = np.zeros(len(at), dtype=np.int32)  # the state of the longest token that ends here
        self.shorter = np.zeros(len(at), dtype=np.int32)  # the state of the next one
        for level, edges in enumerate(levels):
            parents, letters, children = np.array(edges).T
            if level:
                back[children] = step[row[back[parents]], letters]
            step[row[parents], letters] = children
            self.shorter[children] = self.longest[back[children]]
            self.longest[children] = np.where(self.token_at[children] >= 0, children, self.shorter[children])
            own = is_inner[children]
            row[children[~own]] = row[back[children[~own]]]
            step[row[children[own]]] = step[row[back[children[own]]]]
        self.step, self.row = step, row

        self.length = np.zeros(max(self.bytes_of) + 1, dtype=np.int32)
        for i, token in self.bytes_of.items():
            self.length[i] = len(token)
        self.letters = np.frombuffer(b"".join(self.bytes_of.get(i, b"") for i in range(len(self.length))), dtype=np.uint8)
        self.letters_at = np.cumsum(self.length, dtype=np.int64) - self.length

    def _compatible(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens gives both again.

        Merges happen by rank. Only the last part of ``left`` and the first part of ``right`` can merge
        across the border, so it is enough to see these parts grow, and whether a merge across comes
        first. Of equal ranks the leftmost merge comes first.
        """
        last, first = [left], [right]
        while last[-1] in self.parts:
            last.append(self.parts[last[-1]][1])
        while first[-1] in self.parts:
            first.append(self.parts[first[-1]][0])
        i, j = len(last) - 1, len(first) - 1
        while True:
            across = self.merged.get((last[i], first[j]), NEVER)
            grow_left = self.rank[last[i - 1]] if i else NEVER
            grow_right = self.rank[first[j - 1]] if j else NEVER
            if across < grow_left and across <= grow_right and across < NEVER:
                return False
            if not i and not j:
                return True
            if grow_left <= grow_right:
                i -= 1
            else:
                j -= 1

    def _long_piece(self, piece: bytes) -> bytes:
        """The ids of one pre-token, as 32-bit integers."""
        size = len(piece)
        ending: list[int] = [-1] * (size + 1)
        starts = [0] * (size + 1)
        for last, (length, token) in self.automaton.iter(piece.decode("latin-1")):
            end, start = last + 1, last + 1 - length
            if ending[end] < 0 and (start == 0 or (ending[start] >= 0 and self.compatible(ending[start], token))):
                ending[end], starts[end] = token, start
        ids = []
        while size:
            ids.append(ending[size])
            size = starts[size]
        return np.array(ids[::-1], dtype="<i4").tobytes()

    def _short_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """The same for many short pre-tokens, the longest first: all of them take each step together."""
        sizes = np.fromiter(map(len, pieces), dtype=np.int32, count=len(pieces))
        most = int(sizes[0])
        data = np.frombuffer(b"".join([p.ljust(most, b"\0") for p in pieces]), dtype=np.uint8).reshape(-1, most)
        ending = np.full((most + 1, len(pieces)), -1, dtype=np.int32)
        state = np.zeros(len(pieces), dtype=np.int32)
        for end in range(1, most + 1):
            n = int(np.searchsorted(-sizes, -end, side="right"))
            state = self.step[self.row[state[:n]], data[:n, end - 1]]
            rows, match = np.arange(n), self.longest[state]
            while len(rows):
                token = self.token_at[match]
                start = end - self.length[token]
                before = ending[start, rows]
                fits = (start == 0) | (before >= 0)
                test = np.flatnonzero(fits & (start > 0))
                fits[test] = self.pairs.test(before[test], token[test])
                ending[end, rows[fits]] = token[fits]
                rows, match = rows[~fits], self.shorter[match[~fits]]
                alive = match > 0
                rows, match = rows[alive], match[alive]
        back, left = [], sizes.copy()
        while left.any():
            token = np.where(left > 0, ending[left, np.arange(len(pieces))], -1)
            back.append(token)
            left = left - np.where(token >= 0, self.length[token], 0)
        ids = np.array(back[::-1]).T
        counts = (ids >= 0).sum(axis=1)
        flat = ids[ids >= 0].astype("<i4").tobytes()
        ends = np.cumsum(counts) * 4
        return [flat[a:b] for a, b in zip((ends - counts * 4).tolist(), ends.tolist(), strict=True)]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        data = [p.encode("utf-8", "replace") for p in pieces]
        found: list[bytes] = [self._long_piece(p) if len(p) > SIDE_BY_SIDE else b"" for p in data]
        short = sorted((i for i, p in enumerate(data) if 0 < len(p) <= SIDE_BY_SIDE), key=lambda i: -len(data[i]))
        for at in range(0, len(short), 1 << 16):
            some = short[at : at + (1 << 16)]
            for i, ids in zip(some, self._short_pieces([data[i] for i in some]), strict=True):
                found[i] = ids
        return found

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in turn, and how many each has; special tokens in a text are their own ids."""
        return with_special(self.units, self.special, texts)

    def decode(self, lists: pa.ListArray) -> list[str]:
        """The text of each list of ids."""
        counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ids = pc.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        ids = np.where((ids >= 0) & (ids < len(self.length)), ids, len(self.length))
        sizes = np.append(self.length, 0)[ids].astype(np.int64)
        data = gather(self.letters, np.append(self.letters_at, 0)[ids], sizes).tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:], strict=True)]


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One for each Python worker."""
    return Vocabulary(path)


def with_special(units: Units, special: dict[bytes, int], texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Encodes texts in which some strings are special tokens."""
    if not any(token in text for token in special for text in texts):
        return units.of(texts)
    split = re.compile(b"(" + b"|".join(map(re.escape, sorted(special, key=len, reverse=True))) + b")").split
    parts = [split(text) for text in texts]
    plain, sizes = units.of([p for own in parts for p in own if p not in special])
    pieces = iter(np.split(plain, np.cumsum(sizes)[:-1]))
    ids = [
        np.concatenate([np.array([special[p]], dtype=np.int32) if p in special else next(pieces) for p in own])
        for own in parts
    ]
    return np.concatenate(ids), np.array([len(i) for i in ids])


def id_lists(ids: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids`` of every row. ``path`` is that of a vocabulary file on the workers."""
    prepare_text(docs.sparkSession)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path or vocabulary_path())
        for batch in batches:
            texts = [(t or "").encode("utf-8", "replace") for t in column_list(batch, "text")]
            for lo, hi in chunks(texts, ENCODED_BYTES):
                ids = id_lists(*known.encode(texts[lo:hi]))
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], ids], names=["doc_id", "ids"])
            give_back()

    return id_and_text(docs).mapInArrow(encoded, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids, text`` of rows with ids."""
    prepare_text(encoded.sparkSession)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path or vocabulary_path())
        for batch in batches:
            texts = pa.array(known.decode(batch.column(1)), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", F.col("ids").cast("array<int>").alias("ids")).mapInArrow(
        decoded, "doc_id long, ids array<int>, text string"
    )


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids, text`` of every row, the text decoded from the ids; both in one pass over the workers."""
    prepare_text(docs.sparkSession)

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path or vocabulary_path())
        for batch in batches:
            texts = [(t or "").encode("utf-8", "replace") for t in column_list(batch, "text")]
            for lo, hi in chunks(texts, ENCODED_BYTES):
                ids = id_lists(*known.encode(texts[lo:hi]))
                text = pa.array(known.decode(ids), pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], ids, text], names=["doc_id", "ids", "text"])
            give_back()

    return id_and_text(docs).mapInArrow(both, "doc_id long, ids array<int>, text string")


def ids_digest(ids: str) -> F.Column:
    """sha256 of decimal ids joined by commas."""
    return F.sha2(F.concat_ws(",", F.col(ids).cast("array<string>")), 256)


def op9(documents: DataFrame, path: str | None = None) -> DataFrame:
    return round_trip(documents, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        ids_digest("ids").alias("ids_sha256"),
        F.sha2(F.col("text"), 256).alias("decoded_sha256"),
    )
