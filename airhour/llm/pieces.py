"""Splitting text where byte-level BPE is bound to split it, and remembering what units encode to.

A byte-level tokenizer encodes each pre-token by itself. A space that is followed by
something other than white space always starts a pre-token, so a text can be cut there
and its units encoded one by one. A task meets most units many times, so it remembers them, in flat
arrays that take a fraction of the memory of Python objects and are searched side by side.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import regex

from airhour.llm.common import laid_out

# White space by the Unicode property, and the pre-token pattern of the vocabulary.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
PRE_TOKEN = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
)
# Bytes after a space at which no unit is cut: white space, the first bytes of longer white space, zero.
_NO_CUT = np.zeros(256, dtype=bool)
_NO_CUT[[0, *{c.encode()[0] for c in WHITE}]] = True

# Units longer than this many bytes are not remembered.
LONGEST_UNIT = 64
# Units remembered in a Python worker; about 60 bytes each. When there are more, all are forgotten, and of the units
# of one call that are more by themselves, those after the first so many are encoded without being remembered.
REMEMBERED = 1_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)


def pre_tokens(unit: bytes) -> list[str]:
    text = unit.decode("utf-8", "replace")
    return [text] if text[0] == " " and text[1:].isalpha() else PRE_TOKEN.findall(text)


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


class Pool:
    """Rows of different lengths in one array that grows."""

    def __init__(self, dtype: type) -> None:
        self.data, self.used = np.zeros(1 << 16, dtype=dtype), 0

    def add(self, more: np.ndarray) -> None:
        while self.used + len(more) > len(self.data):
            self.data = np.concatenate([self.data, np.zeros_like(self.data)])
        self.data[self.used : self.used + len(more)] = more
        self.used += len(more)


def gather(pool: np.ndarray, offsets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The rows at these offsets, one after the other."""
    before = np.cumsum(counts) - counts
    index = np.repeat(offsets - before, counts) + np.arange(int(counts.sum()), dtype=np.int64)
    return np.take(pool, index, mode="clip")


class Units:
    """Encodes texts by their units. ``encode`` takes pre-tokens and gives the bytes of the ids of each."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], limit: int = REMEMBERED) -> None:
        self.encode, self.limit = encode, limit
        self.bits = (2 * limit).bit_length()
        self.powers = _powers(int(_BASE), 1 << 16)
        self.inverse = _powers(pow(int(_BASE), -1, 1 << 64), 1 << 16)
        self._forget()

    def _forget(self) -> None:
        self.slots = np.full(1 << self.bits, -1, dtype=np.int32)
        self.hashes = Pool(np.uint64)
        self.letters, self.letters_at = Pool(np.uint8), Pool(np.int64)
        self.ids, self.ids_at, self.ids_count = Pool(np.int32), Pool(np.int64), Pool(np.int32)

    def _hash(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        while len(self.powers) < len(data):
            n = 2 * len(self.powers)
            self.powers = _powers(int(_BASE), n)
            self.inverse = _powers(pow(int(_BASE), -1, 1 << 64), n)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[: len(data)], out=sums[1:])
        found = (sums[ends] - sums[starts]) * self.inverse[starts]
        found ^= found >> np.uint64(31)
        return found * np.uint64(0xD6E8FEB86659FD93)

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of the unit with each hash, or -1; and its slot, or the free one where it would go."""
        slot = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        number = self.slots[slot]
        moving = np.flatnonzero((number >= 0) & (self.hashes.data[number] != hashes))
        while len(moving):
            slot[moving] = (slot[moving] + 1) & ((1 << self.bits) - 1)
            number[moving] = now = self.slots[slot[moving]]
            moving = moving[(now >= 0) & (self.hashes.data[now] != hashes[moving])]
        return number, slot

    def _learn(self, units: list[bytes]) -> list[bytes]:
        pieces = [pre_tokens(unit) for unit in units]
        distinct = list({p for own in pieces for p in own})
        ids = dict(zip(distinct, self.encode(distinct), strict=True))
        return [ids[own[0]] if len(own) == 1 else b"".join([ids[p] for p in own]) for own in pieces]

    def _remember(self, hashes: np.ndarray, units: list[bytes]) -> None:
        ids = self._learn(units)
        if self.hashes.used + len(units) > self.limit:
            self._forget()
        number = np.arange(self.hashes.used, self.hashes.used + len(units), dtype=np.int32)
        for pool, at, rows, size, dtype in (
            (self.letters, self.letters_at, units, 1, np.uint8),
            (self.ids, self.ids_at, ids, 4, "<i4"),
        ):
            counts = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows)) // size
            at.add(pool.used + np.cumsum(counts) - counts)
            pool.add(np.frombuffer(b"".join(rows), dtype=dtype))
        self.ids_count.add(counts)
        self.hashes.add(hashes)
        while len(hashes):  # of those that want the same slot, the first gets it and the rest try again
            _, slot = self._find(hashes)
            _, first = np.unique(slot, return_index=True)
            self.slots[slot[first]] = number[first]
            rest = np.ones(len(hashes), dtype=bool)
            rest[first] = False
            hashes, number = hashes[rest], number[rest]

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each text has."""
        counts = np.zeros(len(texts), dtype=np.int64)
        data, text_starts, lengths = laid_out(texts, 1)
        full = np.flatnonzero(lengths)
        if not len(full):
            return np.zeros(0, dtype=np.int32), counts
        cuts = np.zeros(len(data), dtype=bool)
        cuts[:-1] = (data[:-1] == 32) & ~_NO_CUT[data[1:]]
        cuts[text_starts[full]] = True
        starts = np.flatnonzero(cuts)
        first = np.searchsorted(starts, text_starts[full])
        ends = np.append(starts[1:], 0)
        ends[np.append(first[1:], len(starts)) - 1] = (text_starts + lengths)[full]
        sizes = ends - starts

        hashes = self._hash(data, starts, ends)
        number = self._find(hashes)[0]
        long = sizes > LONGEST_UNIT
        new = np.flatnonzero((number < 0) & ~long)
        if len(new):
            _, own = np.unique(hashes[new], return_index=True)
            own = new[own]
            if self.hashes.used + len(own) > self.limit:  # forgetting would take the known ones away
                self._forget()
                own = np.flatnonzero(~long)
                own = own[np.unique(hashes[own], return_index=True)[1]]
                own = np.sort(own)[: self.limit]  # by place: the least hashes would crowd the first slots
            view = data.tobytes()
            some = [view[a:b] for a, b in zip(starts[own].tolist(), ends[own].tolist(), strict=True)]
            self._remember(hashes[own], some)
            number = self._find(hashes)[0]
        number[long] = -1

        # A unit counts as known only if its letters are those that were remembered.
        known = np.flatnonzero(number >= 0)
        same = gather(self.letters.data, self.letters_at.data[number[known]], sizes[known])
        mine = gather(data, starts[known], sizes[known])
        if not np.array_equal(same, mine):
            differ = np.add.reduceat(same != mine, np.cumsum(sizes[known]) - sizes[known]) > 0
            number[known[differ]] = -1
        alone = np.flatnonzero(number < 0)
        learned = self._learn([data[starts[i] : ends[i]].tobytes() for i in alone.tolist()])

        n = np.where(number >= 0, self.ids_count.data[number], 0).astype(np.int64)
        n[alone] = [len(ids) // 4 for ids in learned]
        flat = gather(self.ids.data, np.where(number >= 0, self.ids_at.data[number], 0), n)
        at = np.cumsum(n) - n
        for i, ids in zip(alone.tolist(), learned, strict=True):
            flat[at[i] : at[i] + n[i]] = np.frombuffer(ids, dtype="<i4")
        counts[full] = np.add.reduceat(n, first)
        return flat, counts
