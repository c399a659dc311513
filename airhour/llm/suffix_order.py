"""Suffixes in order, one suffix bucket at a time, with ties resolved by cover-sample ranks.

A difference cover modulo ``PERIOD`` is a set of residues such that for any two positions
some shift below ``PERIOD`` takes both onto the cover. The suffixes at covered positions, a
sample of 4 in 13, are ranked first. All others are then sorted bucket by bucket: by their first
``PERIOD`` bytes, and where these tie, by the ranks of the covered positions that one
shift reaches from both. So only one bucket at a time needs memory beyond the sample's ranks, and a
tie costs one look-up however long it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# A perfect difference cover.
PERIOD = 13
COVER = (0, 1, 3, 9)
# Suffixes that are sorted at a time; a bucket of one leading pair of bytes is not cut.
BUCKET = 1 << 19

COVERED = np.isin(np.arange(PERIOD), COVER)
SHIFT = np.array(
    [[next(s for s in range(PERIOD) if COVERED[(a + s) % PERIOD] and COVERED[(b + s) % PERIOD]) for b in range(PERIOD)] for a in range(PERIOD)]
)


def _numbered(changes: np.ndarray) -> np.ndarray:
    """Numbers from 1 that rise where a sorted row differs from the one before."""
    return np.cumsum(changes, dtype=np.int32)


def _changes(*keys: np.ndarray) -> np.ndarray:
    out = np.ones(len(keys[0]), dtype=bool)
    if len(out):
        out[1:] = False
        for key in keys:
            out[1:] |= key[1:] != key[:-1]
    return out


class Ordered:
    """A text and the order of its suffixes up to ``depth`` bytes; beyond its end are zeros."""

    def __init__(self, text: np.ndarray, depth: int, inside: np.ndarray | None = None) -> None:
        """``inside``: the positions that matter, in ascending order; all if not given."""
        self.depth = depth
        padded = np.zeros(len(text) + depth + 4 * PERIOD + 16, dtype=np.uint8)
        padded[: len(text)] = text
        pairs = (padded[:-1].astype(np.uint64) << np.uint64(8)) | padded[1:]
        fours = (pairs[:-2] << np.uint64(16)) | pairs[2:]
        self.eight = (fours[:-4] << np.uint64(32)) | fours[4:]  # the eight bytes from each position on
        del pairs, fours
        self._rank(np.arange(len(text)) if inside is None else inside)

    def _first(self, at: np.ndarray) -> np.ndarray:
        """Numbers that order positions by their first PERIOD bytes."""
        return (self.rank_eight[at].astype(np.int64) << 32) | self.rank_eight[at + (PERIOD - 8)]

    def _rank(self, inside: np.ndarray) -> None:
        self.rank_eight = np.zeros(len(self.eight), dtype=np.int32)
        order = inside[np.argsort(self.eight[inside])]
        self.rank_eight[order] = _numbered(_changes(self.eight[order]))
        sample = inside[COVERED[inside % PERIOD]]
        self.rank = np.zeros(len(self.eight), dtype=np.int32)
        key, known = self._first(sample), PERIOD
        while True:
            order = np.argsort(key)
            self.rank[sample[order]] = _numbered(_changes(key[order]))
            if known >= self.depth:
                return
            # A covered position and the one ``known`` further on, which is covered as well.
            key = (self.rank[sample].astype(np.int64) << 32) | self.rank[sample + known]
            known *= 2

    def buckets(self, at: np.ndarray) -> Iterator[np.ndarray]:
        """The positions dealt to buckets by their leading two bytes, in ascending order of these."""
        lead = (self.eight[at] >> np.uint64(48)).astype(np.uint16)
        ends = np.cumsum(np.bincount(lead, minlength=1 << 16))
        by_lead = at[np.argsort(lead, kind="stable")]
        start = 0
        while start < len(at):
            cut = int(np.searchsorted(ends, start + BUCKET, side="right"))
            end = int(ends[cut - 1]) if cut and ends[cut - 1] > start else int(ends[np.searchsorted(ends, start, side="right")])
            yield by_lead[start:end]
            start = end

    def sort(self, at: np.ndarray) -> np.ndarray:
        """The positions of one bucket in the order of their suffixes."""
        key = self._first(at)
        order = np.argsort(key)
        at, group = at[order], _numbered(_changes(key[order]))
        tied = np.zeros(len(at), dtype=bool)
        same = group[1:] == group[:-1]
        tied[1:] = same
        tied[:-1] |= same
        rows = np.flatnonzero(tied)
        if len(rows):
            at[rows] = self._resolve(at[rows], group[rows])
        return at

    def _resolve(self, at: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Positions in tied groups in their order; the groups are in order already."""
        residue = at % PERIOD
        own = self.rank[at + SHIFT[residue, residue]]
        key = ((group.astype(np.int64) * PERIOD + residue) << 32) | own
        order = np.argsort(key)
        at, group, residue = at[order], group[order], residue[order]
        first = _changes(key[order])
        one = np.cumsum(first) - 1  # which distinct suffix of a residue a row belongs to
        heads = np.flatnonzero(first)
        place = self._places(at[heads], group[heads], residue[heads])
        return at[np.argsort((group.astype(np.int64) << 32) | place[one])]

    def _places(self, at: np.ndarray, group: np.ndarray, residue: np.ndarray) -> np.ndarray:
        """How many distinct suffixes of its group, of each residue, are less than each.

        Rows are sorted within a residue; two residues are compared by the shift that suits both. Ranks see
        ``depth`` bytes from each shift at least, so only suffixes equal up to there may count differently.
        """
        runs = _changes(group, residue)
        index = np.arange(len(at))
        place = index - np.maximum.accumulate(np.where(runs, index, 0))
        several = np.isin(group, np.unique(group[runs])[np.unique(group[runs], return_counts=True)[1] > 1])
        by_residue = [np.flatnonzero(several & (residue == r)) for r in range(PERIOD)]
        for a in range(PERIOD):
            for b in range(PERIOD):
                x, y = by_residue[a], by_residue[b]
                if a == b or not len(x) or not len(y):
                    continue
                shift = int(SHIFT[a, b])
                base = group[x].astype(np.int64) << 32
                others = np.sort((group[y].astype(np.int64) << 32) | self.rank[at[y] + shift])
                place[x] += np.searchsorted(others, base | self.rank[at[x] + shift]) - np.searchsorted(others, base)
        return place

    def equal_runs(self, at: np.ndarray) -> np.ndarray:
        """Where sorted positions begin another string of ``depth`` bytes."""
        steps = [*range(0, self.depth - 7, 8), self.depth - 8]
        return _changes(*[self.eight[at + s] for s in steps])


def suffix_array(text: bytes, depth: int) -> np.ndarray:
    """All positions of a text ordered by their first ``depth`` bytes at least."""
    ordered = Ordered(np.frombuffer(text, dtype=np.uint8), depth)
    parts = [ordered.sort(bucket) for bucket in ordered.buckets(np.arange(len(text)))]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
