"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text is the mean of the embeddings of its subwords (2 to 4 bytes of the lower-cased
text, which may begin or end at a word's edge but never cross it), hashed into
``BUCKETS`` rows. Embeddings and the softmax are trained together by stochastic gradient
descent in numpy, on hashed counts of a bounded sample of labelled rows. Probabilities
are tempered on rows kept out of the descent, and the score below which a
text is rejected comes from the same rows.

Defined results: a null text, or one without any letter, is ``und`` with score 0 and
rejected; without a single labelled row to learn from, so is every text. Rows with a null
``doc_id`` are scored like others. Repeated rows give repeated results. Ties between
languages go to the first by name. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airhour.llm.common import chunks, column_list, fold, give_back, id_and_text, laid_out, prepare_text

BUCKETS = 1 << 12
DIMENSIONS = 16
SUBWORDS = (2, 3, 4)
UNKNOWN = "und"
# Rows of the training sample; a bound on what reaches the driver (BUCKETS counts a row at most).
SAMPLE_ROWS = 4000
# Part of the kept-out rows, classified rightly, that may fall below the rejection score.
REJECTED_PART = 0.001
HIGHEST_REJECTION = 0.5

# ASCII letters to lower case, other ASCII to a space; bytes of other letters stay.
_FOLDED = np.full(256, 32, dtype=np.uint8)
_FOLDED[128:] = np.arange(128, 256)
_FOLDED[ord("a") : ord("z") + 1] = _FOLDED[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # BUCKETS x languages: embeddings times softmax weights
    bias: np.ndarray
    temperature: float
    rejection: float


def subword_buckets(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length of subwords: the bucket of each subword, text by text, and how many each text has."""
    data, starts, lengths = laid_out([b" " + t + b" " for t in texts], max(SUBWORDS))
    data = _FOLDED[data]
    space = data == 32
    values = data.astype(np.uint32)
    ends = starts + lengths
    row = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(np.append(starts, len(data))))
    found = []
    for n in SUBWORDS:
        size = len(data) - n + 1
        code = np.full(size, n, dtype=np.uint32)
        for k in range(n):
            code = code * np.uint32(0x01000193) + values[k : k + size]
        keep = ~(space[:size] & space[1 : 1 + size])
        for k in range(1, n - 1):
            keep &= ~space[k : k + size]
        keep = np.flatnonzero(keep)
        keep = keep[keep + n <= ends[row[keep]]]
        code = code[keep]
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x85EBCA6B)
        buckets = (code >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int32)
        found.append((buckets, np.bincount(row[keep], minlength=len(texts))))
    return found


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def _lowered(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "replace")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [_lowered(t) for t in column_list(batch, "text")]
        for lo, hi in chunks(texts):
            parts = [np.split(b, np.cumsum(c)[:-1]) for b, c in subword_buckets(texts[lo:hi])]
            rows = [np.unique(np.concatenate(own), return_counts=True) for own in zip(*parts, strict=True)]
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": batch.column(batch.schema.get_field_index("lang"))[lo:hi],
                    "bucket": pa.array([r[0] for r in rows], pa.list_(pa.int32())),
                    "n": pa.array([r[1].astype(np.int32) for r in rows], pa.list_(pa.int32())),
                }
            )


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> LanguageModel | None:
    """A model from at most ``sample_rows`` rows of ``docs`` that have a text and a language.

    The sample is the rows with the smallest hashes of id and text, so it is the same each time.
    """
    prepare_text(docs.sparkSession)
    labelled = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "lang"
    ).filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    picks = (
        labelled.select("doc_id", "lang", F.xxhash64("doc_id", "text").alias("pick"))
        .orderBy("pick", "lang")
        .limit(sample_rows)
        .agg(F.max("pick").alias("last"))
    )
    last = picks.first()["last"]
    if last is None:
        return None
    sample = labelled.filter(F.xxhash64("doc_id", "text") <= F.lit(last))
    rows = sample.mapInArrow(_counted, "lang string, bucket array<int>, n array<int>").limit(sample_rows).toArrow()
    languages = sorted(set(rows.column("lang").to_pylist()))
    target = np.searchsorted(languages, rows.column("lang").to_pylist())
    x = _parts(rows)
    # Rows come in any order; the descent must not depend on it.
    order = np.lexsort((x[:, 0], x @ np.arange(BUCKETS, dtype=np.float32), target))
    x, target = x[order], target[order]
    del rows
    give_back()
    return _descend(x, target, languages, seed)


def _parts(rows: pa.Table) -> np.ndarray:
    """What part of a row's subwords falls in each bucket; the lists are read where they lie, as numbers."""
    x, at = np.zeros((rows.num_rows, BUCKETS), dtype=np.float32), 0
    for batch in rows.to_batches():
        for bucket, n in zip(batch.column("bucket"), batch.column("n"), strict=True):
            if len(n):
                counts = n.values.to_numpy()
                x[at, bucket.values.to_numpy()] = counts.astype(np.float32) / counts.sum()
            at += 1
    return x


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _descend(x: np.ndarray, y: np.ndarray, languages: list[str], seed: int) -> LanguageModel:
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    kept_out = order[: max(1, len(x) // 5)] if len(x) > 4 else order
    learned = order[len(kept_out) :] if len(x) > 4 else order
    labels = len(languages)
    emb = rng.normal(0, 1.0, (BUCKETS, DIMENSIONS)).astype(np.float32)
    out = np.zeros((DIMENSIONS, labels), dtype=np.float32)
    bias = np.zeros(labels, dtype=np.float32)
    batch, epochs = 32, max(10, min(200, 60_000 // max(1, len(learned))))
    for epoch in range(epochs):
        rate = 4.0 * (1 - epoch / epochs)
        rng.shuffle(learned)
        for at in range(0, len(learned), batch):
            rows = learned[at : at + batch]
            hidden = x[rows] @ emb
            wrong = _softmax(hidden @ out + bias)
            wrong[np.arange(len(rows)), y[rows]] -= 1
            wrong /= len(rows)
            back = wrong @ out.T
            out -= rate * (hidden.T @ wrong)
            bias -= rate * 0.1 * wrong.sum(axis=0)
            emb -= rate * (x[rows].T @ back)
    table = emb @ out
    logits = x[kept_out] @ table + bias
    truth = y[kept_out]

    def loss(t: float) -> float:
        return float(-np.log(_softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean())

    temperature = min(np.geomspace(0.25, 8, 41), key=loss)
    p = _softmax(logits / temperature)
    right = p.max(axis=1)[p.argmax(axis=1) == truth]
    rejection = min(HIGHEST_REJECTION, float(np.quantile(right, REJECTED_PART))) if len(right) else HIGHEST_REJECTION
    return LanguageModel(languages, table.astype(np.float32), bias, float(temperature), rejection)


def score_texts(model: LanguageModel, texts: list[bytes]) -> np.ndarray:
    """Probabilities of each language, a row for each text."""
    sums = np.zeros((len(texts), len(model.languages)), dtype=np.float64)
    total = np.zeros(len(texts), dtype=np.int64)
    for buckets, counts in subword_buckets(texts):
        some = np.flatnonzero(counts)
        total += counts
        if len(some):
            starts = np.concatenate([[0], np.cumsum(counts)])[some]
            for k in range(len(model.languages)):
                sums[some, k] += np.add.reduceat(model.table[:, k][buckets], starts, dtype=np.float64)
    sums /= np.maximum(total, 1)[:, None]
    return _softmax((sums + model.bias) / model.temperature)


FOUND = "lang_pred string, score double, rejected boolean"


def language_of(spark: SparkSession, model: LanguageModel | None) -> Callable[[Column], Column]:
    """A function from a text column to a struct of ``lang_pred``, ``score`` and ``rejected``."""
    spread = spark.sparkContext.broadcast(model)  # BUCKETS x languages numbers

    @F.arrow_udf(FOUND)
    def found(column: pa.Array) -> pa.Array:
        known, originals = spread.value, column.to_pylist()
        predicted, scores = [UNKNOWN] * len(originals), np.zeros(len(originals))
        texts = [_lowered(t) for t in originals]
        for lo, hi in chunks(texts) if known else []:
            p = score_texts(known, texts[lo:hi])
            for i, (k, row) in enumerate(zip(p.argmax(axis=1), p, strict=True), lo):
                if originals[i] and has_letter(originals[i]):
                    predicted[i], scores[i] = known.languages[k], min(1.0, float(row[k]))
        rejected = [p == UNKNOWN or s < known.rejection for p, s in zip(predicted, scores, strict=True)]
        return pa.StructArray.from_arrays(
            [pa.array(predicted, pa.string()), pa.array(scores), pa.array(rejected, pa.bool_())],
            names=["lang_pred", "score", "rejected"],
        )

    return found


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` of every row."""
    find = language_of(prepare_text(docs.sparkSession), model)
    return id_and_text(docs).select("doc_id", find(F.col("text")).alias("found")).select("doc_id", "found.*")


def without_rejected(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """The rows, with all their columns, whose language was found."""
    find = language_of(prepare_text(docs.sparkSession), model)
    found = docs.select(F.struct("*").alias("doc"), find(F.col("text").cast("string")).alias("found"))
    return found.filter(~F.col("found.rejected")).select("doc.*")


def held_out() -> Column:
    return F.coalesce(fold("doc_id", 4) == 2, F.lit(False))


def op10(documents: DataFrame) -> DataFrame:
    model = train(documents.filter(~held_out()))
    return identify(documents, model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected"
    )
