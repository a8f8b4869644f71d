"""A quality classifier that learns from positives and unlabelled text.

The model is linear in text statistics and byte frequencies. It minimises the
non-negative unbiased risk: with the class prior p, positives P and unlabelled U,
p R+(P) + max(0, R-(U) - p R-(P)), where the part under the maximum estimates the
risk on negatives that nobody labelled. Where a batch makes that part negative, the
step goes the other way, as such a batch only rewards overfitting.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reliefgrid.llm.arrow import append, steps, texts
from reliefgrid.llm.outliers import counts

#: At most so many positives, and so many unlabelled texts, are learned from; the ones first in hash order.
SAMPLE = 6000
EPOCHS, BATCH, RATE, DECAY = 60, 512, 0.01, 1e-3
#: Lower bound of a batch's negative risk before its step is reversed.
SLACK = 0.0
#: A share of positives that no estimate leaves.
PRIOR = (0.05, 0.95)
SCORE_FROM = 0.3


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float


def features(some: list[bytes | None]) -> np.ndarray:
    """One row of numbers per text; a text without words has statistics 0."""
    out = np.zeros((len(some), 262), np.float32)
    for row, text in zip(out, some):
        if not text:
            continue
        n, points, symbols, lines, repeats = counts(text)
        m = max(n, 1)
        row[:6] = np.log1p(n), points / m, np.log1p(symbols / m), np.log1p(lines), np.arcsin(np.sqrt(repeats / m)), len(text) / max(points, 1)
        row[6:] = np.sqrt(np.bincount(np.frombuffer(text, np.uint8), minlength=256) / len(text))
    return out


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _sample(ids: DataFrame, kind: int) -> DataFrame:
    return ids.where("doc_id is not null").orderBy(F.xxhash64("doc_id", F.lit(kind)), "doc_id").limit(SAMPLE).select("doc_id", F.lit(kind).alias("kind"))


def _minimise(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias at the end of mini-batch steps on the non-negative risk, by Adam; logistic loss."""
    rng = np.random.default_rng(7)
    w = np.zeros(positive.shape[1] + 1)
    m, v, t = np.zeros_like(w), np.zeros_like(w), 0
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    size = min(BATCH, len(positive), len(unlabelled))
    for _ in range(EPOCHS * max(1, max(len(positive), len(unlabelled)) // size)):
        p = positive[rng.integers(0, len(positive), size)]
        u = unlabelled[rng.integers(0, len(unlabelled), size)]
        zp, zu = p @ w[:-1] + w[-1], u @ w[:-1] + w[-1]
        sp, su = sigmoid(zp), sigmoid(zu)
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        mean = lambda x, g: np.append(x.T @ g, g.sum()) / size
        gn = mean(u, su) - prior * mean(p, sp)
        grad = -gn if negative < -SLACK else prior * mean(p, sp - 1) + gn
        grad[:-1] += DECAY * w[:-1]
        t += 1
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Model:
    """A model from the trusted positives of ``labels`` (doc_id, quality) and unlabelled ``docs``.

    Labels of held-out rows are not read. The prior is the share of label 1 among the
    other labels; the unlabelled sample is taken from the documents outside the held-out
    rows whatever their labels. Of documents with one doc_id one is learned from. Without positives or texts the model scores the prior
    everywhere. Rows with a null id or label teach nothing.
    """
    known = labels.where(F.col("quality").isNotNull() & ~held_out()).select("doc_id", "quality")
    share = known.agg(F.avg("quality")).first()[0]
    prior = float(np.clip(0.5 if share is None else share, *PRIOR))
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    chosen = _sample(known.where("quality = 1").select("doc_id").distinct(), 1).unionByName(_sample(own.where(~held_out()).select("doc_id").distinct(), 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            rows = features(texts(batch, "text"))
            packed = pa.array([r.tobytes() for r in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("kind"), packed], ["doc_id", "kind", "row"])

    # At most 2 x SAMPLE ids go to the scans and as many rows of numbers come back: of rows with one id the least.
    made = own.join(F.broadcast(chosen), "doc_id").mapInArrow(run, "doc_id long, kind int, row binary")
    found = made.groupBy("kind", "doc_id").agg(F.min("row").alias("row")).orderBy("kind", "doc_id").toPandas()
    rows = {k: np.array([np.frombuffer(r, np.float32) for r in found["row"][found["kind"] == k]], np.float32).reshape(-1, 262) for k in (0, 1)}
    everything = np.concatenate([rows[0], rows[1]])
    mean = everything.mean(axis=0) if len(everything) else np.zeros(262)
    scale = np.maximum(everything.std(axis=0), 1e-3) if len(everything) else np.ones(262)
    if not (len(rows[0]) and len(rows[1])):
        return Model(mean, scale, np.zeros(262), float(np.log(prior / (1 - prior))), prior)
    weights, bias = _minimise(*(np.clip((rows[k] - mean) / scale, -8, 8).astype(float) for k in (1, 0)), prior)
    return Model(mean, scale, weights, bias, prior)


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """All columns of ``docs`` with a score from 0 to 1; null and empty texts are scored by their zeros."""

    def run(some: list[bytes | None]) -> np.ndarray:
        z = np.clip((features(some) - model.mean) / model.scale, -8, 8) @ model.weights + model.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    return append(docs, text, run, name, T.DoubleType())
