"""Whole jobs on small planted rasters."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from reliefgrid.plans import mosaic as pm
from reliefgrid.plans import strips as ps
from reliefgrid.sources.rasters import export_tiles


def _surface(r, c):
    return 200.0 + (r * r + 2.0 * c * c - r * c) / 256.0


def _scene(spark, strip, seq, rows, cols, shift=(0.0, 0.0, 0.0)):
    r, c = np.meshgrid(np.arange(*rows), np.arange(*cols), indexing="ij")
    dz, dx, dy = shift
    z = _surface(r - dy, c + dx) + dz
    f = pd.DataFrame({"strip_id": strip, "seq": seq, "row": r.ravel(), "col": c.ravel(), "z": z.ravel(), "mt": True, "ortho": 5})
    return spark.createDataFrame(f, "strip_id string, seq int, row int, col int, z double, mt boolean, ortho int")


def test_strips_find_planted_offsets_and_gaps(spark):
    # strip a: two scenes that overlap, the second half a cell off and 3 m high; strip b: a gap
    a = _scene(spark, "a", 1, (0, 70), (0, 40)).unionByName(_scene(spark, "a", 2, (40, 110), (0, 40), (3.0, 0.5, 0.0)))
    b = _scene(spark, "b", 1, (0, 45), (0, 40)).unionByName(_scene(spark, "b", 2, (60, 105), (0, 40)))
    px, rows = ps.build_strips(a.unionByName(b), 1.0, 200)
    got = {(r["strip_id"], r["seq"]): r for r in rows.collect()}
    # strips start at their lowest scene
    assert {k: r["segment"] for k, r in got.items()} == {("a", 1): 1, ("a", 2): 1, ("b", 1): 2, ("b", 2): 1}
    moved = got["a", 1]
    assert abs(moved["dz"] + 3.0) < 0.1 and abs(moved["dx"] - 0.5) < 0.1 and abs(moved["dy"]) < 0.1
    off = [abs(r["z"] - 3.0 - _surface(r["row"], r["col"] + 0.5)) for r in px.filter("strip_id = 'a' and z is not null").collect()]
    assert max(off) < 0.2
    none, _ = ps.build_strips(b, 1.0, 200, done=b.select("strip_id").distinct())
    assert none.count() == 0


def test_export_is_dense(spark):
    px = spark.createDataFrame([("t", r, r, float(r), True, 3, 7) for r in range(10)], "tile_id string, row int, col int, z double, mt boolean, ortho int, dy int")
    bounds = spark.createDataFrame([("t", -2, 13, -1, 11)], "tile_id string, r0 int, r1 int, c0 int, c1 int")
    rows = export_tiles(px, None, 2, bounds, dense=True).collect()
    assert len(rows) == 12 * 9 and sum(r["z"] > -9999 for r in rows) == 9
    assert {(r["mt"], r["ortho"], r["dy"]) for r in rows if r["z"] == -9999} == {(0, 0, 0)}


def test_tiles_are_skipped_and_use_every_strip(spark):
    parts = [_scene(spark, s, 1, rows, (0, 30)) for s, rows in (("s1", (0, 30)), ("s2", (20, 50)))]
    px = parts[0].unionByName(parts[1]).withColumns({"tile_id": F.lit("t"), "dy": F.lit(9)}).drop("seq")
    strips = spark.createDataFrame([("t", "s1", 1, 1), ("t", "s2", 2, 1)], "tile_id string, strip_id string, idx int, qc int")
    tiles = spark.createDataFrame([("t", 0, 0)], "tile_id string, tile_row int, tile_col int")
    out, log = pm.build_mosaic(px, strips, tiles, 1.0, None, "underprint", buffer_px=0)
    assert {r["strip_id"] for r in log.filter("kind = 'merge'").collect()} == {"s1", "s2"}
    rows = out.collect()
    assert len(rows) == 50 * 30
    assert max(abs(r["z"] - _surface(r["row"], r["col"])) for r in rows) < 0.5
    skipped, _ = pm.build_mosaic(px, strips, tiles, 1.0, None, "underprint", buffer_px=0, done=tiles.select("tile_id"))
    assert skipped.count() == 0
