"""Toxicity grades by cumulative-link ordinal regression over sparse text features.

P(grade <= k) = sigmoid(t_k - w x): one weight per feature for all thresholds
t_1 < t_2 < t_3. Features are hashed words and word beginnings, so that inflected
forms of a marker share a weight. The output is the expected grade, 0 to 3.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reliefgrid.llm.arrow import steps, texts
from reliefgrid.llm.pulearn import held_out

#: At most so many toxic and so many other labelled texts are learned from; the ones first in hash order.
SAMPLE = {1: 3000, 0: 4500}
BUCKETS = 1 << 20
#: Features kept, by how far their share of toxic texts is from the others', of those in at least LEAST_TEXTS texts and FAR standard errors off.
KEPT, LEAST_TEXTS, FAR = 4000, 4, 2.0
#: Toxic texts are graded by the rate of words that mark toxic texts: upper shares of grades 1 and 2.
GRADES = (0.5, 0.85)
STEPS, RATE, DECAY = 400, 0.05, 1e-3
#: P(grade > 0) from which a text counts as toxic: labelled toxic texts are about one in ten.
TOXIC_FROM = 0.3
EDGES = b".,;:!?\"'()[]{}<>|*#$%&"
REMEMBERED = 1_000_000


@dataclass
class Model:
    weights: dict[int, float]
    per_words: float
    thresholds: tuple[float, ...]


def buckets(word: bytes) -> tuple[int, ...]:
    """The features of a lower-case word without its punctuation: itself and its first 4 and 5 letters."""
    word = word.strip(EDGES)
    if not word:
        return ()
    letters = word.decode("utf-8", "replace")
    names = [b"w" + word, *(b"p" + letters[:k].encode() for k in (4, 5) if len(letters) > k)]
    return tuple(xxhash.xxh32_intdigest(n) % BUCKETS for n in names)


def found(text: bytes | None, known: dict[bytes, tuple[int, ...]]) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct features, how often each occurs, and the number of words."""
    words = (text or b"").lower().split()
    if len(known) > REMEMBERED:
        known.clear()
    hits: list[int] = []
    for w in words:
        b = known.get(w)
        if b is None:
            b = known[w] = buckets(w)
        hits += b
    ids, n = np.unique(np.array(hits, np.int64), return_counts=True)
    return ids, n, len(words)


def _samples(docs: DataFrame, labels: DataFrame, doc_id: str, text: str) -> tuple[list, dict[int, int]]:
    """Features of the sampled texts, and how many texts of each label there are."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct()
    of = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    parts = [known.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for k, n in SAMPLE.items()]
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[bytes, tuple[int, ...]] = {}
        for batch in steps(batches, "text"):
            rows = [found(t, memory) for t in texts(batch, "text")]
            columns = [pa.array([r[0].astype(np.int32).tobytes() for r in rows], pa.binary()), pa.array([np.minimum(r[1], 65535).astype(np.uint16).tobytes() for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), *columns], ["doc_id", "toxic", "ids", "n", "words"])

    chosen = F.broadcast(parts[0].unionByName(parts[1]))  # at most SAMPLE rows
    made = own.join(chosen, "doc_id").mapInArrow(run, "doc_id long, toxic int, ids binary, n binary, words long")
    # of documents with one doc_id the least is learned from
    one = made.groupBy("doc_id", "toxic").agg(F.min(F.struct("words", "ids", "n")).alias("r")).select("doc_id", "toxic", "r.ids", "r.n", "r.words")
    return one.orderBy("doc_id", "toxic").collect(), of


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Model:
    """A model from ``labels`` (doc_id, toxic 0 or 1) outside the held-out rows.

    Labels have no grades, so toxic texts are graded 1 to 3 by their rate of marker
    words - features far more frequent in toxic texts - against that of the other toxic
    texts. Without texts of both kinds the model grades everything 0.
    """
    rows, held = _samples(docs, labels, doc_id, text)
    toxic = np.array([r["toxic"] for r in rows], int)
    if not (toxic.any() and (1 - toxic).any()):
        return Model({}, 0.0, (30.0, 31.0, 32.0))
    ids = [np.frombuffer(r["ids"], np.int32) for r in rows]
    n = [np.frombuffer(r["n"], np.uint16) for r in rows]
    words = np.array([r["words"] for r in rows], float)
    row = np.repeat(np.arange(len(rows)), [len(i) for i in ids])
    col, value = np.concatenate(ids), np.log1p(np.concatenate(n))
    of = [np.bincount(col[toxic[row] == k], minlength=BUCKETS) for k in (0, 1)]
    total = np.array([(toxic == k).sum() for k in (0, 1)], float)
    share = [(of[k] + 0.5) / (total[k] + 1) for k in (0, 1)]
    spread = np.sqrt(share[0] * (1 - share[0]) / total[0] + share[1] * (1 - share[1]) / total[1])
    far = np.where(of[0] + of[1] >= LEAST_TEXTS, np.abs(share[1] - share[0]) / spread, 0)
    kept = np.sort(np.argsort(-far, kind="stable")[:KEPT])
    kept = kept[far[kept] > FAR]
    place = np.full(BUCKETS, -1)
    place[kept] = np.arange(len(kept))
    use = place[col] >= 0
    row, col, value, times = row[use], place[col[use]], value[use], np.concatenate(n)[use]
    marker = (share[1] > 20 * share[0])[kept]
    rate = np.bincount(row, weights=times * marker[col], minlength=len(rows)) / np.maximum(words, 1)
    edges = np.quantile(rate[toxic == 1], GRADES)
    grade = np.where(toxic == 1, 1 + (rate > edges[0]) + (rate > edges[1]), 0)
    length = np.log1p(words)
    # the sample has its own shares of toxic and other texts; weights restore those of all labels
    weight = np.where(toxic == 1, held[1] / total[1], held[0] / total[0])
    weight /= weight.sum()

    w, per_words, t, gap = np.zeros(len(kept)), 0.0, 1.0, np.zeros(2)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    m = v = np.zeros(len(kept) + 4)
    for step in range(1, STEPS + 1):
        at = np.array([t, t + np.exp(gap[0]), t + np.exp(gap).sum()])
        f = np.bincount(row, weights=value * w[col], minlength=len(rows)) + per_words * length
        below = np.c_[np.zeros(len(rows)), sigmoid(at[None, :] - f[:, None]), np.ones(len(rows))]
        lean = below * (1 - below)
        i = np.arange(len(rows))
        p = np.maximum(below[i, grade + 1] - below[i, grade], 1e-12)
        up, low = lean[i, grade + 1] / p, lean[i, grade] / p
        df = (up - low) * weight  # of the mean negative log-likelihood
        dt = np.array([(weight * (np.where(grade == k, -up, 0) + np.where(grade == k + 1, low, 0))).sum() for k in range(3)])
        grad = np.concatenate([np.bincount(col, weights=value * df[row], minlength=len(kept)) + DECAY * w, [df @ length, dt.sum(), dt[1:].sum() * np.exp(gap[0]), dt[2] * np.exp(gap[1])]])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, per_words, t, gap = w - move[:-4], per_words - move[-4], t - move[-3], gap - move[-2:]
    at = (t, t + float(np.exp(gap[0])), t + float(np.exp(gap).sum()))
    return Model({int(b): float(x) for b, x in zip(kept, w)}, float(per_words), tuple(float(x) for x in at))


def severity(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, severity, grade) of every row: P(grade > 0), the expected and the likeliest grade.

    Null and empty texts have no features and are graded by the thresholds alone.
    """
    thresholds = np.array(model.thresholds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(BUCKETS)
        weights[list(model.weights)] = list(model.weights.values())
        memory: dict[bytes, tuple[int, ...]] = {}  # of words with a weight; most words have none
        for batch in steps(batches, "text"):
            z = []
            for t in texts(batch, "text"):
                ids, n, words = found(t, memory)
                z.append(weights[ids] @ np.log1p(n) + model.per_words * np.log1p(words))
            below = np.c_[1 / (1 + np.exp(-np.clip(thresholds[None, :] - np.array(z)[:, None], -30, 30))), np.ones(len(z))]
            each = np.diff(below, axis=1, prepend=0)
            columns = [pa.array(1 - below[:, 0]), pa.array(each @ np.arange(4)), pa.array(each.argmax(axis=1).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "score", "severity", "grade"])

    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id long, score double, severity double, grade int")
