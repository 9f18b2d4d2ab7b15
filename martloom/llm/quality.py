"""Quality classifier: a linear support vector machine on Naive Bayes features.

Features are the distinct word 1-grams and 2-grams of a text (A-Z lower-cased),
hashed into ``BUCKETS``, and a few word shapes. An indicator is scaled by the log ratio of
its smoothed counts in the two classes; on these a hinge loss is minimised by
dual coordinate descent. The margin becomes a score between 0 and 1 by a
logistic curve fitted on rows the margin was not trained on.

The model is fitted on at most ``SAMPLE`` labelled rows, taken by the hash of
their id, so its cost does not depend on the corpus; every text is scored whole.

Defined cases: rows without an id or without the label train nothing; different
labels for an id train on each, with one of the texts of that id; null and empty texts have no feature and get the
score of the bias; with no labelled rows, or only one class, every score is the
share of label 1 (0.5 without rows). Columns besides doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import batches, gram_hashes, mixed, slices, tidied, word_hashes

BUCKETS = 1 << 18
SAMPLE = 6_000  # labelled rows that the model is fitted on, at most
FOLDS = 5
_SHAPE = np.uint64(0x5348415045)


@dataclass
class Model:
    weights: np.ndarray  # float32, one per bucket
    bias: float
    slope: float
    offset: float


def features(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Sorted distinct buckets of each text, in order."""
    for _, _, raws in slices(texts, lower=True):
        words, bounds = word_hashes(raws)
        pairs = gram_hashes(words, 2)
        word_ids = (words & np.uint64(BUCKETS - 1)).astype(np.int32)
        pair_ids = (mixed(pairs) & np.uint64(BUCKETS - 1)).astype(np.int32)
        for raw, first, last in zip(raws, bounds[:-1], bounds[1:], strict=True):
            yield np.unique(np.concatenate([word_ids[first:last], pair_ids[first : max(first, last - 1)], _shape(raw, last - first)]))


def _shape(raw: bytes, n_words: int) -> np.ndarray:
    """Buckets for the share of bytes and words of a few kinds, in steps of powers of two."""
    if not n_words:
        return np.zeros(0, dtype=np.int32)
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    marks = [counts[ord(c)] for c in "!#$%&*|.,\n"]
    digits = counts[48:58].sum()
    values = [int(n_words).bit_length(), *(int(16 * x / n_words).bit_length() for x in [*marks, digits])]
    keys = np.array([(i << 8) + v for i, v in enumerate(values)], dtype=np.uint64)
    return (mixed(keys + (_SHAPE << np.uint64(16))) & np.uint64(BUCKETS - 1)).astype(np.int32)


def _extract(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(rows):
        found = [x.tobytes() for x in features(batch.column("text").to_pylist())]
        yield pa.record_batch([batch.column("label"), pa.array(found, pa.binary())], names=["label", "ids"])


def ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Log-count ratio of every bucket, with a count of one added on either side."""
    good, bad = np.ones(BUCKETS), np.ones(BUCKETS)
    for ids, label in zip(rows, labels, strict=True):
        (good if label else bad)[ids] += 1
    return np.log(good / good.sum()) - np.log(bad / bad.sum())


def descend(rows: list[np.ndarray], labels: np.ndarray, scale: np.ndarray, cost: float = 1.0, rounds: int = 12) -> tuple[np.ndarray, float]:
    """Weights and bias of the least hinge loss, by dual coordinate descent.

    Rows are scaled to length one. One dual variable per row moves at a time to
    its optimum between 0 and its cost; classes weigh the same in all.
    """
    signs = np.where(labels > 0, 1.0, -1.0)
    caps = cost * len(rows) / 2 / np.where(signs > 0, max(1, (signs > 0).sum()), max(1, (signs < 0).sum()))
    norms = [max(1e-9, float(np.sqrt((scale[ids] ** 2).sum()))) for ids in rows]
    values = [scale[ids] / n for ids, n in zip(rows, norms, strict=True)]
    duals, weights, bias = np.zeros(len(rows)), np.zeros(BUCKETS), 0.0
    order = np.random.default_rng(0)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(rows)):
            ids, x = rows[i], values[i]
            slope = signs[i] * (float(weights[ids] @ x) + bias) - 1.0
            new = min(max(duals[i] - slope / 2.0, 0.0), caps[i])  # |x|^2 + 1 for the bias
            if step := (new - duals[i]) * signs[i]:
                duals[i] = new
                weights[ids] += step * x
                bias += step
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return weights * scale, bias


def margins(rows: list[np.ndarray], weights: np.ndarray, bias: float, scale: np.ndarray) -> np.ndarray:
    out = np.empty(len(rows))
    for i, ids in enumerate(rows):
        norm = float(np.sqrt((scale[ids] ** 2).sum()))
        out[i] = (float(weights[ids].sum()) / norm if norm else 0.0) + bias
    return out


def logistic(margin: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(1) = 1 / (1 + exp(-(slope m + offset))), by Newton steps, slightly shrunk."""
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-6)
        gradient = np.array([((p - labels) * margin).sum() + 1e-2 * slope, (p - labels).sum() + 1e-2 * offset])
        cross = (w * margin).sum()
        hessian = np.array([[(w * margin * margin).sum() + 1e-2, cross], [cross, w.sum() + 1e-2]])
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 5 / max(1e-9, float(np.abs(step).max())))
        slope, offset = slope - step[0], offset - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(max(slope, 1e-3)), float(offset)


def train(rows: list[np.ndarray], labels: np.ndarray) -> tuple[Model, np.ndarray]:
    """The model, and the scale of each bucket (folded into the scores' norm)."""
    labels = np.asarray(labels)
    flat = Model(np.zeros(BUCKETS, np.float32), 0.0, 0.0, 0.0)
    if not len(rows) or labels.min() == labels.max():
        share = float(labels.mean()) if len(rows) else 0.5
        flat.offset = float(np.clip(np.log((share + 1e-9) / (1 - share + 1e-9)), -20, 20))
        return flat, np.zeros(BUCKETS, np.float32)
    held = np.arange(len(rows)) % FOLDS == 0
    if len(rows) >= 10 * FOLDS and len(set(labels[~held])) == 2:  # the curve is fitted on rows left out of a first fit
        part = [r for r, h in zip(rows, held, strict=True) if not h]
        scale = ratios(part, labels[~held])
        weights, bias = descend(part, labels[~held], scale)
        rest = [r for r, h in zip(rows, held, strict=True) if h]
        slope, offset = logistic(margins(rest, weights, bias, scale), labels[held])
    else:
        slope, offset = 2.0, 0.0
    scale = ratios(rows, labels)
    weights, bias = descend(rows, labels, scale)
    return Model(weights.astype(np.float32), bias, slope, offset), scale.astype(np.float32)


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fifth of the ids that trains nothing."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> tuple[Model, np.ndarray]:
    """Fit on at most ``sample`` labelled rows that are not held out; only their texts move."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
    rows = rows.select("doc_id", F.col(label).cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "label").limit(sample)
    texts = docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id")  # bounded by ``sample``
    texts = texts.groupBy("doc_id", "label").agg(F.min("text").alias("text"))  # however often the id occurs
    found = texts.select("label", "text").mapInArrow(_extract, "label int, ids binary").collect()
    found.sort(key=lambda r: (bytes(r["ids"]), r["label"]))
    return train([np.frombuffer(r["ids"], dtype=np.int32) for r in found], np.array([r["label"] for r in found]))


def logit_scores(rows: list[np.ndarray], model: Model, scale: np.ndarray) -> np.ndarray:
    """Probability of label 1 of each row of features."""
    margin = margins(rows, model.weights, model.bias, scale)
    return 1 / (1 + np.exp(-np.clip(model.slope * margin + model.offset, -30, 30)))


def score(docs: DataFrame, model: Model, scale: np.ndarray, column: str = "score") -> DataFrame:
    """The documents with the probability of label 1, between 0 and 1."""
    shared = docs.sparkSession.sparkContext.broadcast((model, scale))  # two numbers per bucket
    schema = docs.drop(column).schema.add(column, "double")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, scale = shared.value
        for batch in batches(rows):
            found = list(features(batch.column("text").to_pylist()))
            scores = logit_scores(found, model, scale)
            yield pa.record_batch([*batch.columns, pa.array(scores)], names=[*batch.schema.names, column])

    return docs.drop(column).mapInArrow(tidied(run), schema)


def quality_scores(docs: DataFrame, labels: DataFrame, cut: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from ``cut`` on) of every document."""
    scored = score(docs.select("doc_id", "text"), *fit(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= cut).cast("int").alias("predicted"),
    )
