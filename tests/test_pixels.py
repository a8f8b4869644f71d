"""Kernels, components and merges against brute force on small rasters."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from reliefgrid.operators import components as cc
from reliefgrid.operators import hulls, kernels as kn, masks as mk, merge as mg, resample as rs

RNG = np.random.default_rng(7)


def flood(mask, diagonal):
    lab = np.zeros(mask.shape, int)
    n = 0
    for r0, c0 in zip(*np.nonzero(mask)):
        if lab[r0, c0]:
            continue
        n += 1
        todo = [(r0, c0)]
        lab[r0, c0] = n
        while todo:
            r, c = todo.pop()
            for dr in (-1, 0, 1):
                for dc in (-1, 0, 1):
                    if (not diagonal and dr and dc) or not (dr or dc):
                        continue
                    y, x = r + dr, c + dc
                    if 0 <= y < mask.shape[0] and 0 <= x < mask.shape[1] and mask[y, x] and not lab[y, x]:
                        lab[y, x] = n
                        todo.append((y, x))
    return lab


def to_array(df, col, shape, key="a"):
    out = np.full(shape, np.nan, dtype=object)
    for r in df.filter(F.col("k") == key).select("row", "col", col).collect():
        out[r.row, r.col] = r[col]
    return out


@pytest.mark.parametrize("connectivity", [4, 8])
@pytest.mark.parametrize("block", [4, 512])
def test_components_match_flood_fill(grid, monkeypatch, connectivity, block):
    monkeypatch.setattr(cc, "GRAPH_BLOCK", block)
    monkeypatch.setattr(cc, "COLUMN_BUCKET", 5)
    masks = {k: RNG.random((24, 19)) < p for k, p in (("a", 0.45), ("b", 0.6))}
    got = cc.component_sizes(grid(masks, "m"), ["k"], F.col("m"), connectivity).collect()
    for k, m in masks.items():
        want = sorted(np.bincount(flood(m, connectivity == 8).ravel())[1:])
        assert sorted(r.cells for r in got if r.k == k) == want


def test_serpentine_is_one_component(grid, monkeypatch):
    monkeypatch.setattr(cc, "GRAPH_BLOCK", 3)
    m = np.zeros((41, 15), bool)
    m[::2] = True
    m[1::4, -1] = True
    m[3::4, 0] = True
    got = cc.component_sizes(grid({"a": m}, "m"), ["k"], F.col("m"), 4).collect()
    assert [r.cells for r in got] == [m.sum()]


def test_fill_holes_and_drop_small(grid):
    m = RNG.random((20, 20)) < 0.65
    d = cc.fill_holes(grid({"a": m}, "m"), ["k"], F.col("m"), "f")
    back = flood(~m, False)
    rim = set(np.concatenate([back[0], back[-1], back[:, 0], back[:, -1]])) - {0}
    want = m | ~np.isin(back, list(rim))
    assert (to_array(d, "f", m.shape).astype(bool) == want).all()
    lab = flood(m, True)
    sizes = np.bincount(lab.ravel())
    small = cc.drop_small(grid({"a": m}, "m"), ["k"], F.col("m"), 6, "s")
    assert (to_array(small, "s", m.shape).astype(bool) == (m & (sizes[lab] >= 6))).all()


@pytest.mark.parametrize("n", [5, 6, 11])
def test_density_is_the_same_in_small_blocks(grid, n):
    m = RNG.random((40, 33)) < 0.5
    got = to_array(kn.density_map(grid({"a": m}, "m"), ["k"], F.col("m"), n, block=16), "density", m.shape).astype(float)
    lo, hi = (n - 1) // 2, n // 2
    pad = np.pad(m.astype(float), ((lo, hi), (lo, hi)))
    want = sum(pad[i : i + 40, j : j + 33] for i in range(n) for j in range(n)) / n**2
    assert np.allclose(got, want)


def test_distance_and_nearest_value(grid):
    z = RNG.integers(0, 50, (15, 17)).astype(float)
    d = kn.distance_to(grid({"a": z}), ["k"], F.col("z") > 45, carry=F.col("z"))
    rr, cc_ = np.nonzero(z > 45)
    got = to_array(d, "dist", z.shape)
    for r in range(15):
        for c in range(17):
            assert got[r, c] == (abs(rr - r) + abs(cc_ - c)).min()


def test_grow_reaches_the_fixpoint(grid):
    ok = RNG.random((30, 30)) < 0.25
    seed = np.zeros_like(ok)
    seed[10, 10] = True
    px = grid({"a": np.where(seed, 2.0, np.where(ok, 1.0, 0.0))})
    d = mk.grow_to_fixpoint(px, ["k"], F.col("z") == 2, F.col("z") > 0, 5, "g")
    ok = ok | seed
    cur = seed
    while True:
        pad = np.pad(cur, 2)
        nxt = np.any([pad[i : i + 30, j : j + 30] for i in range(5) for j in range(5)], axis=0) & ok
        if (nxt == cur).all():
            break
        cur = nxt
    assert (to_array(d, "g", ok.shape).astype(bool) == cur).all()


def test_fill_voids_keeps_known_and_interpolates(grid):
    r, c = np.indices((16, 16))
    z = (r + c).astype(float)
    hole = z.copy()
    hole[5:9, 5:9] = np.nan
    got = to_array(mg.fill_voids(grid({"a": hole}), ["k"], "z"), "z", z.shape).astype(float)
    assert np.allclose(got[~np.isnan(hole)], z[~np.isnan(hole)])
    assert np.abs(got - z).max() < 0.5


def _shift(spark, dz, dx, dy):
    return spark.createDataFrame([("a", dz, dx, dy)], "k string, dz double, dx double, dy double")


def test_shift_zero_is_identity_and_plane_is_exact(spark, grid):
    r, c = np.indices((12, 12))
    z = 3.0 * c - 2.0 * r
    px = grid({"a": z})
    same = rs.shift_resample(px, ["k"], _shift(spark, 0.0, 0.0, 0.0), 1.0, {"z": "linear"})
    assert np.allclose(to_array(same, "z", z.shape).astype(float), z)
    # subtracting dx, dy moves the raster: the cell at x shows what was at x + dx
    moved = rs.shift_resample(px, ["k"], _shift(spark, 1.0, 0.25, -0.5), 1.0, {"z": "linear"})
    got = to_array(moved, "z", z.shape)
    assert np.isclose(float(got[4, 4]), 3.0 * 4.25 - 2.0 * 4.5 - 1.0)
    assert got[11, 4] is None or np.isnan(float(got[11, 4]))


def _layers(spark, grid, a, b):
    mk_ = lambda x: grid({"a": x}).withColumns({"ortho": F.lit(5), "mt": F.lit(True), "dy": F.lit(7)})
    return mg.two_layers(mk_(a), mk_(b), ["k"])


def test_feather_stays_between_its_inputs(spark, grid):
    a = np.full((30, 60), np.nan)
    b = a.copy()
    a[:, :40] = 10.0
    b[:, 20:] = 14.0
    w = mg.feather_weights(_layers(spark, grid, a, b), ["k"], 5, min_island=50)
    z = to_array(mg.blend(w, ["k"]), "z", a.shape).astype(float)
    assert (z >= 10 - 1e-9).all() and (z <= 14 + 1e-9).all()
    assert (z[:, :20] == 10).all() and (z[:, 40:] == 14).all()
    assert (np.diff(z[15, 20:40]) >= -1e-9).all() and z[15, 21] < 11 and z[15, 38] > 13


def test_warp_keeps_old_and_tapers(spark, grid):
    a = np.full((20, 60), np.nan)
    b = a.copy()
    a[:, :30] = 10.0 + RNG.normal(0, 0.01, (20, 30))
    b[:, 20:] = 11.0 + RNG.normal(0, 0.5, (20, 40))
    d = mg.warp(_layers(spark, grid, a, b), ["k"], 11)
    z = to_array(d, "z", a.shape).astype(float)
    assert np.allclose(z[:, :30], a[:, :30])
    assert np.allclose(z[:, 45:], b[:, 45:])
    inside = mg.warp(_layers(spark, grid, a, np.where(np.indices(a.shape)[1] < 20, a + 1, np.nan)), ["k"], 11)
    assert {r.status for r in inside.select("status").distinct().collect()} == {"inside"}


def test_hull_and_outline(grid):
    m = np.zeros((20, 20), bool)
    m[3:15, 4:12] = True
    h = hulls.data_hull(grid({"a": m}, "m"), ["k"], F.col("m")).collect()[0].hull
    assert {(p.x, p.y) for p in h} == {(4, 3), (11, 3), (11, 14), (4, 14)}
    d = hulls.inside_hull(grid({"a": m}, "m"), ["k"], F.col("m"), "i")
    assert (to_array(d, "i", m.shape).astype(bool) == m).all()


def test_simplify_ring():
    ring = [(0.0, 0.0), (5.0, 0.1), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (0.0, 0.0)]
    assert hulls.simplify_ring(ring, tol_sq=0.05) == [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (0.0, 0.0)]
    assert len(hulls.simplify_ring(ring, tol_sq=1e9)) == 4
    assert len(hulls.simplify_ring(ring, keep_share=0.8)) == 5
    assert hulls.simplify_ring(ring[:3] + ring[:1], tol_sq=1e9) == ring[:3] + ring[:1]


def test_rings_of_a_batch_are_simplified_at_once_as_each_alone(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rings = []
    for n in [3, 4, 5, 8, 8, 8, 33, 33, 60] * 4:
        at = np.sort(rng.uniform(0, 2 * np.pi, n))
        pts = [(float(x), float(y)) for x, y in np.round(np.column_stack([np.cos(at), np.sin(at)]) * rng.uniform(50, 60, (n, 1)) * 4) / 4]
        rings.append([*pts, pts[0]])
    want = {kw: [hulls.simplify_ring(r, **dict([kw])) for r in rings] for kw in (("tol_sq", 9.0), ("keep_share", 0.4))}
    plain = [hulls.simplify_ring(r) for r in rings]
    monkeypatch.setattr(hulls, "simplify_ring", None)  # not called ring by ring
    rows = [(i, [{"x": x, "y": y} for x, y in r]) for i, r in enumerate(rings)] + [(len(rings), None)]
    df = spark.createDataFrame(rows, "k int, poly array<struct<x:double,y:double>>")
    for name, kw in (*((w, dict([k])) for k, w in want.items()), (plain, {})):
        got = {r.k: r.poly if r.poly is None else [(v.x, v.y) for v in r.poly] for r in hulls.simplify_footprints(df, **kw).collect()}
        assert got == {**dict(enumerate(name)), len(rings): None}



def test_edge_merge_makes_tiles_equal_on_the_overlap(spark, grid):
    frames = []
    for name, row, col, v in (("00_00", 0, 0, 1.0), ("00_01", 0, 1, 2.0), ("01_00", 1, 0, 4.0)):
        f = grid({name: np.full((10, 10), v)}, row0=row * 7, col0=col * 7).withColumnRenamed("k", "tile_id")
        frames.append(f.withColumns({"ortho": F.lit(3), "mt": F.lit(False), "dy": F.lit(0)}))
    px = frames[0].unionByName(frames[1]).unionByName(frames[2])
    tiles = spark.createDataFrame([("00_00", 0, 0), ("00_01", 0, 1), ("01_00", 1, 0)], "tile_id string, tile_row int, tile_col int")
    d = mg.merge_tile_edges(px, tiles).cache()
    assert d.count() == 300
    a, b = (d.filter(F.col("tile_id") == t).select("row", "col", F.col("z").alias("z" + t[-1])) for t in ("00_00", "00_01"))
    a = a.filter("row < 7")
    both = a.join(b, ["row", "col"]).collect()
    assert len(both) == 21 and all(r.z0 == r.z1 for r in both)
    assert {round(r.z0, 6) for r in both} == {1.0, 1.5, 2.0}
