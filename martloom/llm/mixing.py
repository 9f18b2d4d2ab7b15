"""Mixing to target weights when it is not known which domain a document belongs to.

A table of labelled documents trains one classifier per domain; every document
gets a posterior over the domains and belongs to all of them in part. Each
document has a rate, how often it is to be seen, and the expected tokens of a
domain are the sum of rate x tokens x posterior. The rates are fitted so that
these totals come as near as possible, in least squares, to weight x budget.

Rates are fitted by projected gradient: every rate moves against the document's part
in the miss and is cut at zero (and at ``cap``, if there is one). Rates weigh as
many as their document has tokens, so one step length fits all; steps are accelerated,
and start afresh where the miss grows. A rate follows from the document's posteriors
and the steps so far, one number per domain each, so no rate is stored or collected:
a pass over the stored rows makes the rates again and sends a few sums per task.

Defined cases: documents without words have no tokens, and count only in their
own rate; null ids take part; labels without an id or value train nothing; with
no labels all domains are equally likely; without a cap scarce documents are seen
more than once; with one, a target nobody can fill is filled as far as it goes; an
empty table gives an empty result. Columns besides
doc_id and text are carried along or not read.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import batches, stored, tidied
from martloom.llm.quality import SAMPLE, features, held_out, logit_scores, train

DOMAINS = ("plain", "toxic", "poor")
TARGETS = {"plain": 0.92, "toxic": 0.03, "poor": 0.05}
FOLD = 32  # steps that a pass makes again, at most
SETTLED, PASSES = 1e-5, 300  # miss, or movement of the rates, as a share of all tokens; passes after which the fit says that it has not settled
STALE = 50  # passes that lower the miss by two percent, or the fit ends


def domain(quality: str = "quality", toxic: str = "toxic") -> Column:
    """Position in DOMAINS of a labelled row."""
    return F.when(F.col(toxic) == 1, 1).when(F.col(quality) == 0, 2).when(F.col(quality) == 1, 0)


def _extract(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(rows):
        found = [x.tobytes() for x in features(batch.column("text").to_pylist())]
        yield pa.record_batch([batch.column("domain"), pa.array(found, pa.binary())], names=["domain", "ids"])


def fit_domains(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list:
    """One classifier per domain, fitted on at most ``sample`` labelled rows."""
    rows = labels.select("doc_id", domain().alias("domain")).where(F.col("doc_id").isNotNull() & F.col("domain").isNotNull() & ~held_out())
    rows = rows.orderBy(F.xxhash64("doc_id"), "domain").limit(sample)
    texts = docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id")  # bounded by ``sample``
    texts = texts.groupBy("doc_id", "domain").agg(F.min("text").alias("text"))  # however often the id occurs
    found = texts.select("domain", "text").mapInArrow(_extract, "domain int, ids binary").collect()
    found.sort(key=lambda r: (bytes(r["ids"]), r["domain"]))
    ids, own = [np.frombuffer(r["ids"], dtype=np.int32) for r in found], np.array([r["domain"] for r in found])
    return [train(ids, (own == k).astype(int)) for k in range(len(DOMAINS))]


def with_posteriors(docs: DataFrame, models: list, tokens: str = "n_tokens", posterior: str = "posterior") -> DataFrame:
    """The documents with their number of words and the probability of every domain (they sum to one)."""
    shared = docs.sparkSession.sparkContext.broadcast(models)  # two numbers per bucket and domain
    names = [n for n in docs.columns if n not in (tokens, posterior)]
    schema = docs.select(*names).schema.add(tokens, "long").add(posterior, T.ArrayType(T.DoubleType()))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            texts = batch.column("text").to_pylist()
            found = list(features(texts))
            raw = np.maximum(np.stack([logit_scores(found, *m) for m in shared.value], axis=1), 1e-9)
            raw /= raw.sum(axis=1, keepdims=True)
            counts = [len((t or "").encode("utf-8", "surrogatepass").split()) for t in texts]
            yield pa.record_batch(
                [*(batch.column(n) for n in names), pa.array(counts, pa.int64()), pa.array(list(raw), pa.list_(pa.float64()))],
                names=[*names, tokens, posterior],
            )

    return docs.select(*names).mapInArrow(tidied(run), schema)


class Steps:
    """The steps of a fit: per step the change for each domain, and how far the movement before carries on."""

    def __init__(self, cap: float | None = None):
        self.cap = np.inf if cap is None else cap
        self.taken: list[tuple[np.ndarray, float]] = []

    def rates(self, posteriors: np.ndarray, state: tuple | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rates after the last step, where they would be carried to, and where the last step began; ``state`` is the first two before the steps."""
        rate, ahead = state or [np.full(len(posteriors), min(1.0, self.cap))] * 2
        begun = ahead
        for step, carry in self.taken:
            begun = ahead
            new = np.clip(ahead - posteriors @ step, 0, self.cap)
            rate, ahead = new, new + carry * (new - rate)
        return rate, ahead, begun


def _wanted(weights: np.ndarray, totals: np.ndarray, budget: float | None) -> np.ndarray:
    """Without a ``budget`` it is the one at which the domain with the largest target is used up once."""
    return weights * (budget or totals[weights.argmax()] / weights.max())


def measure(tokens: np.ndarray, posteriors: np.ndarray, steps: Steps, state: tuple | None = None) -> np.ndarray:
    """Totals of the domains at the rates, and where they are carried to; movement of the last step; second moments of the posteriors."""
    rate, ahead, begun = steps.rates(posteriors, state)
    moments = posteriors.T @ (posteriors * tokens[:, None])
    return np.concatenate([(tokens * rate) @ posteriors, (tokens * ahead) @ posteriors, [tokens @ np.abs(rate - begun)], moments.ravel()])


def _posteriors(batch: pa.RecordBatch, column: str = "posterior") -> np.ndarray:
    return batch.column(column).flatten().to_numpy().reshape(-1, len(DOMAINS))


def _given(batch: pa.RecordBatch) -> tuple[np.ndarray, tuple | None]:
    """Posteriors of a batch, and the state of its rates if they were stored."""
    state = (batch.column("_rate").to_numpy(), batch.column("_ahead").to_numpy()) if "_rate" in batch.schema.names else None
    return _posteriors(batch), state


def _measured(rows: DataFrame, steps: Steps) -> np.ndarray:
    """measure() over all rows; a task sends the driver one row of sums."""
    n = len(DOMAINS)
    size = 2 * n + 1 + n * n

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size)
        for batch in found:
            posteriors, state = _given(batch)
            sums += measure(batch.column("n_tokens").to_numpy().astype(float), posteriors, steps, state)
        yield pa.record_batch([pa.array([sums], pa.list_(pa.float64()))], names=["sums"])

    parts = rows.mapInArrow(run, "sums array<double>").collect()
    return np.array([r["sums"] for r in parts] or [[0.0] * size]).sum(axis=0)


def _folded(rows: DataFrame, steps: Steps) -> DataFrame:
    """The rows with the state of their rates after the steps, stored, so that later passes begin there."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            posteriors, state = _given(batch)
            rate, ahead, _ = steps.rates(posteriors, state)
            yield pa.record_batch([batch.column("n_tokens"), batch.column("posterior"), pa.array(rate), pa.array(ahead)], names=["n_tokens", "posterior", "_rate", "_ahead"])

    made = rows.mapInArrow(run, rows.select("n_tokens", "posterior").schema.add("_rate", "double").add("_ahead", "double"))
    return stored(made, "mixing-rates")


def fit_rates(
    rows: DataFrame, targets: Mapping[str, float], budget: float | None = None, cap: float | None = None
) -> tuple[Steps, np.ndarray, np.ndarray]:
    """(steps, reached totals, wanted totals) of the rates with the least squared miss, for rows with n_tokens and posterior."""
    n = len(DOMAINS)
    weights = np.array([targets[d] for d in DOMAINS], dtype=float)
    weights /= weights.sum()
    rows = rows.select("n_tokens", "posterior")
    steps, recent = Steps(cap), Steps(cap)  # all steps, and those since rates were stored
    now = _measured(rows, Steps())
    moments, totals = now[2 * n + 1 :].reshape(n, n), now[:n]
    whole = totals.sum()
    if not whole:
        return steps, np.zeros(n), np.zeros(n)
    wanted = _wanted(weights, totals, budget)
    length = 1 / np.linalg.eigvalsh(moments / whole).max()
    now, before, speed = (now if steps.cap >= 1 else _measured(rows, recent)), np.inf, 1.0
    misses: list[float] = []
    for _ in range(PASSES):
        miss = (now[:n] - wanted) / whole
        if steps.taken and np.abs(miss).max() < SETTLED or len(steps.taken) > 1 and now[2 * n] / whole < 0.1 * SETTLED * length:
            return steps, now[:n], wanted
        if miss @ miss > before:  # the movement has carried too far
            speed = 1.0
            steps.taken[-1] = recent.taken[-1] = (steps.taken[-1][0], 0.0)
            ahead = miss
        else:
            ahead = (now[n : 2 * n] - wanted) / whole
        before = miss @ miss
        misses.append(float(np.sqrt(before)))
        if len(misses) > STALE and misses[-1] > 0.98 * misses[-1 - STALE]:
            return steps, now[:n], wanted
        faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
        if len(recent.taken) > FOLD:  # all but the last, whose carrying may be taken back
            done = Steps(cap)
            done.taken, recent.taken = recent.taken[:-1], recent.taken[-1:]
            rows = _folded(rows, done)
        steps.taken.append((length * ahead, (speed - 1) / faster))
        recent.taken.append(steps.taken[-1])
        speed = faster
        now = _measured(rows, recent)
    warnings.warn(f"the mixture's rates have not settled: {np.abs(now[:n] - wanted).max() / whole:.1e} of all tokens", stacklevel=2)
    return steps, now[:n], wanted


def with_rates(rows: DataFrame, steps: Steps, rate: str = "rate", posterior: str = "posterior") -> DataFrame:
    """The rows with the rate that the steps give for their posterior."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            rates = steps.rates(_posteriors(batch, posterior))[0]
            yield pa.record_batch([*batch.columns, pa.array(rates)], names=[*batch.schema.names, rate])

    return rows.mapInArrow(run, rows.select("*").schema.add(rate, "double"))


def chance(doc_id: str = "doc_id") -> Column:
    """A number in [0, 1) that depends on the id only."""
    return F.pmod(F.xxhash64(F.col(doc_id), F.lit(9)), F.lit(1 << 40)) / F.lit(float(1 << 40))


def mixed_rates(
    docs: DataFrame, labels: DataFrame, targets: Mapping[str, float] = TARGETS, cap: float | None = None
) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """The documents with n_tokens, posterior, rate and copies (the rate rounded up or down by chance); reached and wanted totals."""
    models = fit_domains(docs, labels)
    rows = stored(with_posteriors(docs.select("doc_id", "text"), models).drop("text"), "mixing-posteriors")
    steps, reached, wanted = fit_rates(rows, targets, cap=cap)
    rated = with_rates(rows, steps)
    return rated.withColumn("copies", F.floor(F.col("rate") + chance()).cast("int")), reached, wanted


def mixed(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float] = TARGETS, cap: float = 1.0) -> DataFrame:
    """The documents of the mixture: each row is in it with the probability of its rate, at most once."""
    models = fit_domains(docs, labels)
    names = ("__n_tokens", "__posterior")
    rows = stored(with_posteriors(docs, models, *names), "mixing-documents")
    steps, _, _ = fit_rates(rows.select(*[F.col(n).alias(n.strip("_")) for n in names]), targets, cap=min(1.0, cap))
    rated = with_rates(rows, steps, "__rate", names[1])
    return rated.where(F.floor(F.col("__rate") + chance()) >= 1).select(*docs.columns)


def mixing_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, n_tokens, the posterior of every domain, rate and copies; on every row the reached and wanted tokens of each domain."""
    rated, reached, wanted = mixed_rates(docs, labels)
    shares = [F.col("posterior")[k].alias(f"p_{d}") for k, d in enumerate(DOMAINS)]
    totals = [F.lit(float(x[k])).alias(f"{side}_{d}") for side, x in (("reached", reached), ("wanted", wanted)) for k, d in enumerate(DOMAINS)]
    return rated.select("doc_id", "n_tokens", *shares, "rate", "copies", *totals)
