"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities of a fixed and of a learned lexicon, how near second-person
words its hits stand, and rates of capitals, punctuation and obfuscation. The learned lexicon has
words, and beginnings of words, that stand in toxic training texts far more often than in
others. A bounded sample of labelled rows is dealt in two: each half is described with a lexicon learned from the
other, and so gives the trees and the calibration.

Defined results: a null or empty text has the features of no words, and the score that goes with them.
Without labels of both kinds to learn from, every score is 0. Repeated rows have the same score, rows with
a null ``doc_id`` are scored like others, and extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airhour.llm.common import fold, prepare_text
from airhour.llm.labelled import SAMPLE_ROWS, TokenTable, binned, quantile_edges, sample, sigmoid

# Insults, and words for the person spoken to, in the languages of the corpus.
INSULTS = frozenset(
    """idiot idiots moron morons stupid loser losers trash scum clown pathetic worthless disgusting dumb fool jerk
    imbecile vermin idioten dumm abschaum versager widerlich trottel imbécile crétin nul débile ordure minable
    idiota estúpido imbécil basura payaso patético asqueroso""".split()
)
SECOND_PERSON = frozenset(
    """you your yours u ur yourself du dich dir dein deine euch ihr tu te toi ton ta vous votre tú ti
    usted ustedes vosotros""".split()
)
# What stands for a letter in obfuscated words.
DISGUISES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": None})

NEAR = 5  # words between a hit and a second-person word
PREFIX = 5  # letters of the beginnings of words
LEXICON = 400  # entries of the learned lexicon at most
LEAST_ODDS = 2.0  # lower bound of the log odds of an entry
LEAST_TEXTS = 3  # toxic texts it stands in
TREES, DEPTH, RATE, BINS, LEAST_LEAF = 80, 3, 0.15, 32, 4
FOLDS = 3  # of the rows for calibration, each scored by trees that have not seen it

_WORD = regex.compile(r"[\p{L}\p{N}@$*!']+")
_EDGE = "!*'$@"


@dataclass
class ToxicityModel:
    lexicon: dict[str, float]
    edges: list[np.ndarray] = field(default_factory=list)
    base: float = 0.0
    trees: list = field(default_factory=list)
    calibrated_at: np.ndarray = field(default_factory=lambda: np.zeros(0))
    calibrated: np.ndarray = field(default_factory=lambda: np.zeros(0))


def entries_of(word: str) -> list[str]:
    """The lexicon entries that a word may be: itself, and its beginning with a mark."""
    return [word, word[:PREFIX] + "~"] if len(word) > PREFIX else [word]


def learned_lexicon(rows: DataFrame) -> dict[str, float]:
    """Entries with the largest lower bounds of their log odds; only these reach the driver."""
    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}  # 0 and 1
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return {}
    words = F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{N}]+"))
    starts = F.transform(
        F.filter(words, lambda w: F.length(w) > PREFIX), lambda w: F.concat(F.substring(w, 1, PREFIX), F.lit("~"))
    )
    entries = rows.select("label", F.explode(F.array_union(words, starts)).alias("entry")).filter("entry != ''")
    counts = entries.groupBy("entry").agg(
        F.sum("label").alias("a"), F.sum(F.lit(1) - F.col("label")).alias("b")
    )
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.log(a / (toxic + 1 - a)) - F.log(b / (clean + 1 - b))
    spread = F.sqrt(1 / a + 1 / (toxic + 1 - a) + 1 / b + 1 / (clean + 1 - b))
    counts = counts.filter(F.col("a") >= LEAST_TEXTS).filter((F.col("a") < toxic + 0.5) & (F.col("b") < clean + 0.5))
    best = counts.select("entry", F.round(odds - 1.5 * spread, 6).alias("odds")).filter(F.col("odds") >= LEAST_ODDS)
    return {r["entry"]: r["odds"] for r in best.orderBy(F.desc("odds"), "entry").limit(LEXICON).collect()}


class Features:
    """Features of texts, given a lexicon."""

    def __init__(self, lexicon: dict[str, float]) -> None:
        self.lexicon = lexicon
        self.tokens = TokenTable(self._describe)

    def _odds(self, word: str) -> float:
        return max((self.lexicon.get(e, 0.0) for e in entries_of(word)), default=0.0)

    def _describe(self, token: str) -> tuple[float, ...]:
        word = token.lower().strip(_EDGE)
        plain = word.isalpha()
        odds, insult = self._odds(word), word in INSULTS
        hidden = False
        if not plain and word:
            clear = word.translate(DISGUISES)
            hidden = clear in INSULTS or self._odds(clear) > 0
            odds, insult = max(odds, self._odds(clear)), insult or clear in INSULTS
        caps = len(token) > 1 and token.isupper()
        mixed = not plain and any(c.isalpha() for c in word) and "'" not in word
        stretched = any(a == b == c for a, b, c in zip(word, word[1:], word[2:], strict=False))
        return (odds, float(insult), float(word in SECOND_PERSON), float(caps), float(mixed), float(stretched), float(hidden))

    def of(self, texts: list[str]) -> np.ndarray:
        return np.array([self._one(t) for t in texts]).reshape(len(texts), -1)

    def _one(self, text: str) -> list[float]:
        tokens = _WORD.findall(text)
        n = max(1, len(tokens))
        rows = self.tokens.of(tokens) if tokens else np.zeros((1, 7))
        odds, insult, person, caps, mixed, stretched, hidden = rows.T
        hit = (odds > 0) | (insult > 0)
        hits = np.flatnonzero(hit)
        persons = np.flatnonzero(person)
        near = 0
        if len(hits) and len(persons):
            after = np.searchsorted(persons, hits)
            gap = np.minimum(
                np.abs(persons[np.minimum(after, len(persons) - 1)] - hits), np.abs(persons[np.maximum(after - 1, 0)] - hits)
            )
            near = int((gap <= NEAR).sum())
        letters = np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")
        size = max(1, len(letters))
        capitals = ((letters >= 65) & (letters <= 90)).sum()
        marks = ((letters > 32) & (letters < 48)) | ((letters > 57) & (letters < 65)) | ((letters > 90) & (letters < 97))
        loud = (letters == 33) | (letters == 63)
        return [
            np.log1p(len(tokens)),
            100 * len(hits) / n,
            np.log1p(len(hits)),
            float(odds.max()),
            float(odds.sum()) / n,
            float(len(set(tokens[i].lower() for i in hits.tolist()) if tokens else ())),
            100 * insult.sum() / n,
            float(insult.sum()),
            near / max(1, len(hits)),
            capitals / size,
            caps.sum() / n,
            marks.sum() / size,
            loud.sum() / size,
            mixed.sum() / n,
            stretched.sum() / n,
            float(hidden.sum()),
        ]


def _split(x: np.ndarray, gradient: np.ndarray, weight: np.ndarray, node: np.ndarray, nodes: int, bins: int):
    """The best feature and bin for each node of a level."""
    gains = np.full((nodes, x.shape[1], bins), -np.inf)
    for j in range(x.shape[1]):
        key = node * bins + x[:, j]
        g, w, n = (
            np.bincount(key, weights=v, minlength=nodes * bins).reshape(nodes, bins).cumsum(axis=1)
            for v in (gradient, weight, np.ones(len(x)))
        )
        left = g**2 / (w + 1.0)
        right = (g[:, -1:] - g) ** 2 / (w[:, -1:] - w + 1.0)
        ok = (n >= LEAST_LEAF) & (n[:, -1:] - n >= LEAST_LEAF)
        gains[:, j] = np.where(ok, left + right - g[:, -1:] ** 2 / (w[:, -1:] + 1.0), -np.inf)
    best = gains.reshape(nodes, -1).argmax(axis=1)
    return best // bins, np.where(np.isfinite(gains.reshape(nodes, -1).max(axis=1)), best % bins, bins)


def boosted(x: np.ndarray, y: np.ndarray) -> tuple[float, list]:
    """Trees for the log odds of a label; each level has a feature and a bin for each of its nodes."""
    base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    z, trees = np.full(len(y), base), []
    for _ in range(TREES):
        p = sigmoid(z)
        gradient, weight = y - p, np.maximum(p * (1 - p), 1e-6)
        node, levels = np.zeros(len(y), dtype=np.int64), []
        for level in range(DEPTH):
            feature, cut = _split(x, gradient, weight, node, 1 << level, BINS)
            levels.append((feature, cut))
            node = 2 * node + (x[np.arange(len(x)), feature[node]] > cut[node])
        leaves = 1 << DEPTH
        g, w = np.bincount(node, gradient, leaves), np.bincount(node, weight, leaves)
        values = RATE * g / (w + 1.0)
        z += values[node]
        trees.append((levels, values))
    return base, trees


def raw_scores(model: ToxicityModel, x: np.ndarray) -> np.ndarray:
    bins = binned(x, model.edges)
    z = np.full(len(x), model.base)
    rows = np.arange(len(x))
    for levels, values in model.trees:
        node = np.zeros(len(x), dtype=np.int64)
        for feature, cut in levels:
            node = 2 * node + (bins[rows, feature[node]] > cut[node])
        z += values[node]
    return z


def isotonic(z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rising step function nearest to the labels, by pooling neighbours that fall; middles and values of its steps."""
    order = np.argsort(z, kind="stable")
    at, start = np.unique(z[order], return_index=True)
    sums = np.add.reduceat(y[order].astype(float), start)
    sizes = np.diff(np.append(start, len(z)))
    steps: list[list[float]] = []
    for middle, s, n in zip(at.tolist(), sums.tolist(), sizes.tolist(), strict=True):
        steps.append([middle * n, s, n])
        while len(steps) > 1 and steps[-2][1] * steps[-1][2] >= steps[-1][1] * steps[-2][2]:
            middle, s, n = steps.pop()
            steps[-1] = [steps[-1][0] + middle, steps[-1][1] + s, steps[-1][2] + n]
    return np.array([s[0] / s[2] for s in steps]), np.array([(s[1] + 0.02) / (s[2] + 0.04) for s in steps])


def calibrate(model: ToxicityModel, z: np.ndarray) -> np.ndarray:
    """Between the middles of steps the score rises in line, beyond the last ones ever less: no order is lost."""
    if not len(model.calibrated):
        return sigmoid(z)
    at, values = model.calibrated_at, model.calibrated
    low, high = np.minimum(z - at[0], 0), np.maximum(z - at[-1], 0)
    return np.interp(z, at, values) * np.exp(low) + (1 - values[-1]) * -np.expm1(-high)


def train(rows: DataFrame) -> ToxicityModel | None:
    """From ``text, label, pick`` of a bounded sample.

    The features of each half use the lexicon of the other, so trees and calibration learn from all rows and no row
    meets a lexicon that has seen it. Scores use the lexicon of the whole sample.
    """
    half = F.pmod(F.shiftright("pick", 7), F.lit(2))
    halves = [learned_lexicon(rows.filter(half == k)) for k in (0, 1)]
    lexicon = learned_lexicon(rows)
    spread = rows.sparkSession.sparkContext.broadcast(halves)

    @F.arrow_udf("array<double>")
    def described(texts: pa.Array, own: pa.Array) -> pa.Array:
        found: list = [None] * len(texts)
        sides, words = np.array(own.to_pylist()), texts.to_pylist()
        for k in (0, 1):
            rows_of = np.flatnonzero(sides == k).tolist()
            if rows_of:
                for i, x in zip(rows_of, Features(spread.value[1 - k]).of([words[i] or "" for i in rows_of]), strict=True):
                    found[i] = x
        return pa.array(found, pa.list_(pa.float64()))

    found = rows.select("label", "pick", described("text", half.cast("int")).alias("x")).toArrow().sort_by("pick")
    y = found.column("label").to_numpy().astype(np.int64)
    if len(np.unique(y)) < 2:
        return None
    x = np.array(found.column("x").to_pylist())
    edges = [quantile_edges(x[:, j], BINS) for j in range(x.shape[1])]
    bins = binned(x, edges)
    unseen, part = np.zeros(len(y)), np.arange(len(y)) % FOLDS  # rows are in order of a hash
    for k in range(FOLDS):
        rest = ToxicityModel(lexicon, edges, *boosted(bins[part != k], y[part != k]))
        unseen[part == k] = raw_scores(rest, x[part == k])
    model = ToxicityModel(lexicon, edges, *boosted(bins, y))
    model.calibrated_at, model.calibrated = isotonic(unseen, y)
    return model


def score_of(docs: DataFrame, model: ToxicityModel | None) -> Callable[[Column], Column]:
    """A function from a text column to a score from 0 to 1."""
    spread = docs.sparkSession.sparkContext.broadcast(model)  # a lexicon and trees of fixed size
    ready: dict[str, Features] = {}

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        known = spread.value
        if known is None:
            return pa.array(np.zeros(len(texts)))
        features = ready.setdefault("one", Features(known.lexicon))
        x = features.of([t or "" for t in texts.to_pylist()])
        return pa.array(np.clip(calibrate(known, raw_scores(known, x)), 0.0, 1.0)) if len(x) else pa.array([], pa.float64())

    return score


def held_out() -> Column:
    return F.coalesce(fold("doc_id", 5) == 0, F.lit(False))


def op2(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    prepare_text(documents.sparkSession)
    score = score_of(documents, train(sample(documents, labels, "toxic", ~held_out(), sample_rows)))
    scored = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), score(F.col("text").cast("string")).alias("score")
    )
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
