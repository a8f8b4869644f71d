"""Resampling between lattices of other ratios, against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from reliefgrid.operators import regrid as rg


def dense(df, shape, name="z"):
    out = np.full(shape, np.nan)
    for r in df.collect():
        out[r.row, r.col] = np.nan if r[name] is None else r[name]
    return out


def kernel(x):
    a = np.abs(x)
    return np.where(a <= 1, 1.5 * a**3 - 2.5 * a**2 + 1, np.where(a < 2, -0.5 * a**3 + 2.5 * a**2 - 4 * a + 2, 0))


def matrix(n, m, ratio, width):
    """Weights of n source cells in m targets, the rim mirrored."""
    out = np.zeros((m, n))
    mirror = np.r_[np.arange(n), np.arange(n)[::-1]]
    for t in range(m):
        u = (t + 0.5) * ratio - 0.5
        j = np.arange(int(np.floor(u - 2 * width)) - 1, int(np.ceil(u + 2 * width)) + 2)
        w = kernel((u - j) / width)
        np.add.at(out[t], mirror[j % (2 * n)], w / w.sum())
    return out


def at(a, u, v, rule):
    """A single sample by the rule, along columns and then rows; the rim's outer points are extrapolated."""

    def one(line, x):
        i, f = int(np.floor(x)), x - np.floor(x)
        if rule == "nearest":
            return line[i] if f < 0.5 else line[i + 1]
        if f == 0:
            return line[i]
        if rule == "linear":
            return (1 - f) * line[i] + f * line[i + 1]
        pad = np.r_[3 * line[0] - 3 * line[1] + line[2], line, 3 * line[-1] - 3 * line[-2] + line[-3]]
        return sum(kernel(k - f) * pad[i + 1 + k] for k in (-1, 0, 1, 2))

    return one([one(row, v) for row in a], u)


@pytest.mark.parametrize("rule", ["linear", "nearest", "cubic"])
@pytest.mark.parametrize("step,row0,col0", [(0.25, 0.0, 0.0), (0.8, -3.1, 0.3), (1.0, 0.5, -2.25), (2.5, 1.2, 0.0)])
def test_resample(spark, grid, rule, step, row0, col0):
    rng = np.random.default_rng(3)
    a = rng.normal(100, 5, (9, 7))
    a[4, 3] = np.nan
    lattices = spark.createDataFrame([("a", row0, col0, step)], "k string, row0 double, col0 double, step double")
    got = {(r.row, r.col): r.z for r in rg.resample(grid({"a": a, "b": a}, row0=0, col0=0), ["k"], lattices, {"z": rule}).collect()}
    want = {}
    for r in range(-60, 60):
        for c in range(-60, 60):
            u, v = row0 + r * step, col0 + c * step
            if 0 <= u <= 8 and 0 <= v <= 6:
                want[r, c] = at(a, u, v, rule)
    assert set(got) == set(want)
    for key, value in want.items():
        assert (got[key] is None) == bool(np.isnan(value)), key
        assert got[key] is None or got[key] == pytest.approx(value, abs=1e-9), key


def test_blocks_meet(spark, grid):
    a = np.random.default_rng(4).normal(0, 1, (3, 600))
    got = rg.enlarge_cubic(grid({"a": a}), ["k"], "z", 2)
    want = matrix(3, 6, 1 / 2, 1) @ a @ matrix(600, 1200, 1 / 2, 1).T
    assert np.allclose(dense(got, (6, 1200)), want)


@pytest.mark.parametrize("k", [2, 3, 5])
@pytest.mark.parametrize("shape", [(1, 1), (2, 5), (11, 8)])
def test_cubic_both_ways(spark, grid, k, shape):
    a = np.random.default_rng(k).normal(50, 9, shape)
    n, m = shape
    big = matrix(n, n * k, 1 / k, 1) @ a @ matrix(m, m * k, 1 / k, 1).T
    assert np.allclose(dense(rg.enlarge_cubic(grid({"a": a}), ["k"], "z", k), big.shape), big)
    small = matrix(n, -(-n // k), k, k) @ a @ matrix(m, -(-m // k), k, k).T
    assert np.allclose(dense(rg.shrink_cubic(grid({"a": a}), ["k"], "z", k), small.shape), small)


def test_shrink_by_a_broken_ratio_with_gaps(spark, grid):
    a = np.random.default_rng(6).normal(50, 9, (12, 10))
    want = matrix(12, 5, 2.5, 2.5) @ a @ matrix(10, 4, 2.5, 2.5).T
    assert np.allclose(dense(rg.shrink_cubic(grid({"a": a}), ["k"], "z", 2.5), want.shape), want)
    a[0, 0] = np.nan
    got = dense(rg.shrink_cubic(grid({"a": a}), ["k"], "z", 2.5), want.shape)
    assert np.isnan(got[0, 0]) and np.isclose(got[-1, -1], want[-1, -1])
    assert rg.shrink_cubic(grid({"a": a}).filter(F.lit(False)), ["k"], "z", 2).count() == 0
