"""Quality: a generalised additive model with pairwise interactions.

Boosting visits the features in cycles and adds to each a shallow tree over its bins, so that every
feature ends with one look-up table; then the pairs of features that explain most of what is left
are boosted the same way, with tables over two features. A score is the sum of one bin of each
table, through the logistic function. It learns from a bounded sample of labelled rows.

Defined results: a null or empty text has the features of no words, and the score that goes with them.
Without labels of both kinds to learn from, every score is 0. Repeated rows have the same score, rows with
a null ``doc_id`` are scored like others, and extra columns are ignored.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airhour.llm.common import fold, prepare_text
from airhour.llm.labelled import SAMPLE_ROWS, TokenTable, binned, quantile_edges, sample, sigmoid

THRESHOLD = 0.7
BINS, PAIR_BINS = 32, 8
CYCLES, PAIR_CYCLES, PAIRS = 60, 30, 6
RATE, LEAST_LEAF = 0.2, 8

FEATURES = [
    "log words",
    "letters in a word",
    "words without a letter",
    "words with symbols at their end",
    "words with symbols inside",
    "words in capitals",
    "words ending a sentence",
    "words ending with !",
    "words with a digit",
    "distinct words",
    "most frequent word",
    "word equal to the one before",
    "distinct pairs of words",
    "distinct lines",
    "words in a line",
    "capitals",
    "marks",
    "white space",
]


def _describe(token: str) -> tuple[float, ...]:
    core = token.rstrip(".,;:!?")
    letters = sum(c.isalpha() for c in token)
    inner = core.strip("\"'()[]-")
    odd_end = bool(core) and not core[-1].isalnum() and core[-1] not in "\"')]-"
    odd_inside = any(not c.isalnum() and c not in "'-" for c in inner.rstrip("*#$%&|~^_=+<>@/\\"))
    return (
        float(min(letters, 40)),
        float(letters == 0),
        float(odd_end and letters > 0),
        float(odd_inside),
        float(letters > 1 and token.isupper()),
        float(token[-1] in ".?"),
        float(token[-1] == "!"),
        float(any(c.isdigit() for c in token)),
    )


class Features:
    def __init__(self) -> None:
        self.tokens = TokenTable(_describe)

    def of(self, texts: list[str]) -> np.ndarray:
        return np.array([self._one(t) for t in texts]).reshape(len(texts), len(FEATURES))

    def _one(self, text: str) -> list[float]:
        words = text.split()
        n = max(1, len(words))
        means = self.tokens.of(words).mean(axis=0) if words else np.zeros(8)
        counts = Counter(words)
        pairs = len(set(itertools.pairwise(words)))
        again = sum(map(str.__eq__, words[1:], words))
        lines = [line for line in text.split("\n") if line]
        data = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
        size = max(1, len(data))
        kinds = np.bincount(data, minlength=128)
        marks = int(kinds[33:48].sum() + kinds[58:65].sum() + kinds[91:97].sum() + kinds[123:127].sum())
        return [
            np.log1p(len(words)),
            *means.tolist(),
            len(counts) / n,
            max(counts.values(), default=0) / n,
            again / n,
            pairs / max(1, len(words) - 1),
            len(set(lines)) / max(1, len(lines)),
            n / max(1, len(lines)),
            float(kinds[65:91].sum()) / size,
            marks / size,
            float(kinds[[9, 10, 13, 32]].sum()) / size,
        ]


@dataclass
class QualityModel:
    edges: list[np.ndarray]
    tables: np.ndarray  # features x BINS
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)
    base: float = 0.0


def _sums(key: np.ndarray, gradient: np.ndarray, weight: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (
        np.bincount(key, gradient, size),
        np.bincount(key, weight, size),
        np.bincount(key, minlength=size).astype(np.float64),
    )


def _gain(g: np.ndarray, w: np.ndarray) -> np.ndarray:
    return g**2 / (w + 1.0)


def _best_cut(g: np.ndarray, w: np.ndarray, n: np.ndarray) -> tuple[float, int]:
    """The gain and place of the best cut of a row of bins, after that bin."""
    a, b, c = g.cumsum()[:-1], w.cumsum()[:-1], n.cumsum()[:-1]
    gain = _gain(a, b) + _gain(g.sum() - a, w.sum() - b) - _gain(g.sum(), w.sum())
    gain = np.where((c >= LEAST_LEAF) & (n.sum() - c >= LEAST_LEAF), gain, -np.inf)
    at = int(gain.argmax())
    return float(gain[at]), at


def _shallow_tree(g: np.ndarray, w: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The leaf values, bin by bin, of a tree with two levels of cuts."""
    ranges, values = [(0, len(g))], np.zeros(len(g))
    for _ in range(2):
        cut = []
        for a, b in ranges:
            gain, at = _best_cut(g[a:b], w[a:b], n[a:b]) if b - a > 1 else (-np.inf, 0)
            cut += [(a, a + at + 1), (a + at + 1, b)] if gain > 0 else [(a, b)]
        ranges = cut
    for a, b in ranges:
        values[a:b] = RATE * g[a:b].sum() / (w[a:b].sum() + 1.0)
    return values


def _pair_tree(g: np.ndarray, w: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """The gain and leaf values of the best tree that cuts two features once each."""
    corner = [np.pad(v.reshape(PAIR_BINS, PAIR_BINS).cumsum(0).cumsum(1), ((1, 0), (1, 0))) for v in (g, w, n)]
    best, leaves = 0.0, np.zeros((PAIR_BINS, PAIR_BINS))
    whole = float(_gain(g.sum(), w.sum()))
    for i, j in itertools.product(range(1, PAIR_BINS), repeat=2):
        parts = []
        for v in corner:
            a, b, c, d = v[i, j], v[i, -1], v[-1, j], v[-1, -1]
            parts.append(np.array([a, b - a, c - a, d - b - c + a]))
        if (parts[2] < LEAST_LEAF).sum() > 1:
            continue
        gain = float(_gain(parts[0], parts[1]).sum()) - whole
        if gain > best:
            best = gain
            value = RATE * parts[0] / (parts[1] + 1.0)
            leaves = np.empty((PAIR_BINS, PAIR_BINS))
            leaves[:i, :j], leaves[:i, j:], leaves[i:, :j], leaves[i:, j:] = value
    return best, leaves


def _pair_key(bins: np.ndarray, pair: tuple[int, int]) -> np.ndarray:
    return bins[:, pair[0]] * PAIR_BINS + bins[:, pair[1]]


def boosted(x: np.ndarray, y: np.ndarray) -> QualityModel:
    model = QualityModel([quantile_edges(x[:, j], BINS) for j in range(x.shape[1])], np.zeros((x.shape[1], BINS)))
    model.pair_edges = [quantile_edges(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    model.base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    bins, coarse = binned(x, model.edges), binned(x, model.pair_edges)
    z = np.full(len(y), model.base)

    def pull() -> tuple[np.ndarray, np.ndarray]:
        p = sigmoid(z)
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(CYCLES):
        for j in range(x.shape[1]):
            tree = _shallow_tree(*_sums(bins[:, j], *pull(), BINS))
            model.tables[j] += tree
            z += tree[bins[:, j]]
    gradient, weight = pull()
    every = list(itertools.combinations(range(x.shape[1]), 2))
    gains = [_pair_tree(*_sums(_pair_key(coarse, p), gradient, weight, PAIR_BINS**2))[0] for p in every]
    model.pairs = [every[i] for i in np.argsort(gains, kind="stable")[::-1][:PAIRS].tolist() if gains[i] > 0]
    model.pair_tables = [np.zeros((PAIR_BINS, PAIR_BINS)) for _ in model.pairs]
    for _ in range(PAIR_CYCLES):
        for pair, table in zip(model.pairs, model.pair_tables, strict=True):
            key = _pair_key(coarse, pair)
            tree = _pair_tree(*_sums(key, *pull(), PAIR_BINS**2))[1]
            table += tree
            z += tree.ravel()[key]
    return model


def raw_scores(model: QualityModel, x: np.ndarray) -> np.ndarray:
    """Sums of one bin of each table."""
    z = np.full(len(x), model.base)
    bins, coarse = binned(x, model.edges), binned(x, model.pair_edges)
    for j, table in enumerate(model.tables):
        z += table[bins[:, j]]
    for pair, table in zip(model.pairs, model.pair_tables, strict=True):
        z += table.ravel()[_pair_key(coarse, pair)]
    return z


def train(rows: DataFrame) -> QualityModel | None:
    """From ``text, label, pick`` of a bounded sample."""

    @F.arrow_udf("array<double>")
    def described(texts: pa.Array) -> pa.Array:
        return pa.array(list(Features().of([t or "" for t in texts.to_pylist()])), pa.list_(pa.float64()))

    found = rows.select("label", "pick", described("text").alias("x")).toArrow().sort_by("pick")
    y = found.column("label").to_numpy().astype(np.int64)
    if len(np.unique(y)) < 2:
        return None
    return boosted(np.array(found.column("x").to_pylist()), y)


def score_of(docs: DataFrame, model: QualityModel | None) -> Callable[[Column], Column]:
    """A function from a text column to a score from 0 to 1."""
    spread = docs.sparkSession.sparkContext.broadcast(model)  # tables of fixed size
    ready: dict[str, Features] = {}

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        known = spread.value
        if known is None or not len(texts):
            return pa.array(np.zeros(len(texts)))
        x = ready.setdefault("one", Features()).of([t or "" for t in texts.to_pylist()])
        return pa.array(sigmoid(raw_scores(known, x)))

    return score


def held_out() -> Column:
    return F.coalesce(fold("doc_id", 4) == 2, F.lit(False))


def op4(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    prepare_text(documents.sparkSession)
    score = score_of(documents, train(sample(documents, labels, "quality", ~held_out(), sample_rows)))
    scored = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), score(F.col("text").cast("string")).alias("score")
    )
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted)
