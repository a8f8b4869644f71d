"""Centroid clustering against a plain loop."""

import hashlib
import math

import numpy as np
import pytest

from reliefgrid.llm import clusters

SCHEMA = "vec_id long, embedding array<float>, label int, x string, cluster int"


def brute(rows, k=8, turns=10, seed=3, size=64):
    kept = []
    for vec_id, e in rows:
        if e is not None and len(e) == size and all(v is not None and math.isfinite(v) and abs(v) < clusters.MOST / 1024 for v in e):
            kept.append((vec_id, [math.floor(1024 * float(np.float32(v))) for v in e]))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    c = [x for _, x in order[:k]]

    def near(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, y)), i) for i, y in enumerate(c))

    for _ in range(turns):
        groups = {}
        for _, x in kept:
            groups.setdefault(near(x)[1], []).append(x)
        c = [[sum(v) // len(g) for v in zip(*g)] if (g := groups.get(i)) else y for i, y in enumerate(c)]
    placed = [(v, *near(x)[::-1]) for v, x in kept]
    total = sum(d for *_, d in placed)
    return sorted(((v, i, d, sum(q for _, j, q in placed if j == i), total, hashlib.sha256(",".join(map(str, c[i])).encode()).hexdigest()) for v, i, d in placed), key=str)


def vectors(kind):
    rng = np.random.default_rng(5)
    some = [rng.normal(0, 0.2, 64).astype(np.float32).tolist() for _ in range(60)]
    some += [some[0]] * 25 + [[0.0] * 64, [-1e-9] * 64, [1e4] * 64]
    rows = [(i, e, i % 3, "a", 1) for i, e in enumerate(some)]
    if kind == "ties":
        rows = [(i, [float(i % 2)] * 64, 0, None, None) for i in range(20)] + [(3, [0.5] * 64, 0, None, None)]
    if kind == "odd":
        rows += [(100, None, 1, None, None), (101, [], 1, None, None), (102, some[1][:63], 1, None, None), (103, [*some[1][:63], None], 1, None, None)]
        rows += [(104, [*some[1][:63], float("nan")], 1, None, None), (105, [*some[1][:63], float("inf")], 1, None, None), (106, [3e38] * 64, 1, None, None)]
        rows += [(None, some[2], None, None, None), rows[4], rows[4]]
    return rows[:3] if kind == "few" else rows


@pytest.mark.parametrize("kind", ["plain", "ties", "odd", "few", "none"])
def test_clustered(spark, rounds, kind):
    rows = [] if kind == "none" else vectors(kind)
    made = clusters.clustered(spark.createDataFrame(rows, SCHEMA), rounds())
    assert made.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, made.collect()), key=str) == brute([r[:2] for r in rows])


def test_search_is_exact_and_skips():
    rng = np.random.default_rng(1)
    for size, most in ((1, 3), (7, 100), (64, 1 << 20), (64, clusters.MOST - 1)):
        x, c = rng.integers(-most, most, (400, size)), rng.integers(-most, most, (9, size))
        c[8], c[5] = c[0], x[3]
        d = ((x[:, None] - c) ** 2).sum(axis=2)
        cluster, best, _ = clusters.nearest(x, c)
        assert (cluster == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    groups = np.repeat(np.arange(8) * 500, 50)[:, None] + rng.integers(-50, 50, (400, 64))
    assert clusters.nearest(groups, np.arange(8)[:, None] * 500 + np.zeros((8, 64), np.int64))[2] < 800
