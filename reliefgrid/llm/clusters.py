"""Lloyd rounds whose nearest centroid is found by equal-average equal-variance search.

Centroids are sorted by the mean of their components. For each vector the search scans
outward from its own mean: with k components, k (mean - mean')^2 is a lower bound of the
squared distance, so the scan ends once that passes the best distance so far; with the
deviations s from the means, k (mean - mean')^2 + (s - s')^2 is a lower bound too and
rejects single centroids. What neither rejects is measured in exact integers. Both
bounds are lowered by more than doubles can err, so that ties are always measured.

Only (centroid, count, sums) of tasks are shuffled and only the centroids reach the
driver: clusters x components numbers, whatever the size of the table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reliefgrid.rounds import Rounds

#: Integers per unit of a component.
SCALE = 1024
#: Components' integers beyond this could give squared distances that no long holds.
MOST = 1 << 27
#: More than the bounds can err, as a share of the numbers that they are made of.
SLACK = 1e-9


def integers(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", size: int = 64) -> DataFrame:
    """(vec_id, x): the vectors of ``size`` components as floor(SCALE * component).

    Null vectors, those of another size, with null or non-finite components, or with
    integers of MOST or beyond are left out. Null ids and repeated rows stay.
    """
    e = F.col(embedding)
    fits = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float(MOST) / SCALE)
    whole = F.when(F.size(e) == size, F.forall(e, lambda v: F.coalesce(fits(v.cast("double")), F.lit(False))))
    x = F.transform(e, lambda v: F.floor(v.cast("double") * SCALE).cast("long"))
    return vectors.where(F.coalesce(whole, F.lit(False))).select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("x"))


def first_centroids(rows: DataFrame, k: int, seed: int, size: int) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of "seed:vec_id", in that order; null ids come last."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(digest.asc_nulls_last(), "x").select("x").limit(k).collect()
    return np.array([r["x"] for r in first], np.int64).reshape(len(first), size)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The centroid of least squared distance (of equals the smallest number), that distance, and how many distances were measured."""
    n, size = x.shape
    means, own = centroids.mean(axis=1), x.mean(axis=1)
    spread = np.sqrt(((centroids - means[:, None]) ** 2).sum(axis=1))
    own_spread = np.sqrt(((x - own[:, None]) ** 2).sum(axis=1))
    by_mean = np.argsort(means, kind="stable")
    ordered = means[by_mean]
    above = np.searchsorted(ordered, own)  # the scan's next place upward, and downward
    below = above - 1
    best = np.full(n, np.iinfo(np.int64).max)
    cluster = np.full(n, len(centroids), np.int64)
    measured = 0
    active = np.arange(n)
    while len(active):
        up, down, m = above[active], below[active], own[active]
        to_up = np.where(up < len(ordered), np.abs(ordered[np.minimum(up, len(ordered) - 1)] - m), np.inf)
        to_down = np.where(down >= 0, np.abs(ordered[np.maximum(down, 0)] - m), np.inf)
        upward = to_up <= to_down
        gap = np.where(upward, to_up, to_down)
        c = by_mean[np.clip(np.where(upward, up, down), 0, len(ordered) - 1)]
        above[active] += upward
        below[active] -= ~upward
        # all that are left on either side are farther in mean: the scan ends
        scale = np.abs(m) + np.abs(means[c]) + 1
        bound = size * np.maximum(0, gap - SLACK * scale) ** 2
        open_ = bound <= best[active]
        active, c, bound = active[open_], c[open_], bound[open_]
        apart = np.abs(own_spread[active] - spread[c])
        apart = np.maximum(0, apart - SLACK * (own_spread[active] + spread[c] + scale[open_] * size))
        some = bound + apart**2 <= best[active]
        at, to = active[some], c[some]
        d = ((x[at] - centroids[to]) ** 2).sum(axis=1)
        measured += len(at)
        better = (d < best[at]) | ((d == best[at]) & (to < cluster[at]))
        best[at[better]], cluster[at[better]] = d[better], to[better]
        active = active[(above[active] < len(ordered)) | (below[active] >= 0)]
    return cluster, best, measured


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    x = batch.column("x")
    return x.flatten().to_numpy().reshape(batch.num_rows, -1)


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid replaced by the floor of its vectors' means; those without vectors stay."""
    k, size = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, size), np.int64)
        for batch in batches:
            x = _vectors(batch)
            cluster = nearest(x, centroids)[0]
            counts += np.bincount(cluster, minlength=k)
            for c in range(k):
                sums[c] += x[cluster == c].sum(axis=0)
        columns = [np.repeat(np.arange(k), size), np.tile(np.arange(size), k), np.repeat(counts, size), sums.ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["cluster", "i", "n", "total"])

    tasks = rows.select("x").mapInArrow(run, "cluster long, i long, n long, total long")
    made = centroids.copy()
    for r in tasks.groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).where("n > 0").collect():
        made[r["cluster"], r["i"]] = r["total"] // r["n"]
    return made


def assigned(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, distance, _ = nearest(_vectors(batch), centroids)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return rows.mapInArrow(run, "vec_id long, cluster int, distance long")


def clustered(vectors: DataFrame, rounds: Rounds, k: int = 8, turns: int = 10, seed: int = 3, size: int = 64) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that ``integers`` keeps.

    Fewer vectors than ``k`` make fewer centroids; no vectors give no rows. Equal
    vectors go to one cluster, and repeated rows count and return as often as they occur.
    Of equally near centroids the smaller number wins. Other columns, whatever their
    names, are not read.
    """
    rows = rounds.put(integers(vectors, size=size), "integers")
    centroids = first_centroids(rows, k, seed, size)
    for _ in range(turns if len(centroids) else 0):
        centroids = moved(rows, centroids)
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        told = rows.sparkSession.createDataFrame([], schema)
        return rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).join(told, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    placed = rounds.put(assigned(rows, centroids), "assigned")
    sums = {r["cluster"]: r["s"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    told = F.array(*(F.struct(F.lit(sums.get(i, 0)).cast("long").alias("s"), F.lit(d).alias("d")) for i, d in enumerate(digest)))
    own = F.get(told, F.col("cluster"))
    return placed.select("vec_id", "cluster", "distance", own["s"].alias("cluster_inertia"), F.lit(sum(sums.values())).cast("long").alias("inertia"), own["d"].alias("centroid_sha256"))
