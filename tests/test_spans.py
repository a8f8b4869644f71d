"""Column ranges of polygons and alignment tables of reports, against plain Python."""

import numpy as np
from pyspark.sql import functions as F

from reliefgrid.operators import footprints as fp
from reliefgrid.sources import reports as rp


def inside(ring, x, y):
    hit = False
    for (ax, ay), (bx, by) in zip(ring, ring[1:]):
        if (ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay):
            hit = not hit
    return hit


def test_ranges_of_any_polygon(spark):
    rng = np.random.default_rng(2)
    comb = [(0, 0), (0, 300), (40, 300), (40, 60), (80, 60), (80, 300), (120, 300), (120, 0), (0, 0)]
    star = [(150 + r * np.cos(t), 150 + r * np.sin(t)) for t, r in zip(np.linspace(0, 2 * np.pi, 40, endpoint=False), rng.uniform(20, 140, 40))]
    rings = {"comb": comb, "star": star + star[:1], "beyond": [(-90, -90), (-90, 500), (500, 200), (-90, -90)], "apart": [(900, 900), (900, 950), (950, 950), (900, 900)]}
    pairs = spark.createDataFrame(
        [("t", k, [(float(x), float(y)) for x, y in ring], 0.0, 300.0, 0.0, 300.0) for k, ring in rings.items()],
        "tile_id string, strip_id string, poly array<struct<x:double,y:double>>, x0 double, x1 double, y0 double, y1 double",
    )
    k = ["tile_id", "strip_id"]
    res, pad = 3.0, 2
    got = {(r.strip_id, r.row, r.col) for r in fp.rasterise(pairs, k, res, pad).collect()}
    want = {
        (name, r, c) for name, ring in rings.items() for r in range(105) for c in range(105)
        if inside([(float(x), float(y)) for x, y in ring], -6 + c * res, 306 - r * res)
    }
    assert got == want and {n for n, _, _ in got} == {"comb", "star", "beyond"}
    sums = {r.strip_id: (r.n, r.rows, r.cols, r.cross_) for r in fp.cell_sums(fp.spans(pairs, k, res, pad), k).collect()}
    for name in sums:
        mine = [(r, c) for n, r, c in want if n == name]
        assert sums[name] == (len(mine), sum(r for r, _ in mine), sum(c for _, c in mine), sum(r * c for r, c in mine))
    # a spacing of its own for each polygon
    own = pairs.withColumn("dx", F.when(F.col("strip_id") == "comb", 3.0).otherwise(10.0))
    mixed = fp.rasterise(own, [*k, "dx"], F.col("dx"), 0)
    plain = fp.rasterise(pairs, k, 3.0, 0).filter("strip_id = 'comb'").unionByName(fp.rasterise(pairs, k, 10.0, 0).filter("strip_id <> 'comb'"))
    assert mixed.drop("dx").exceptAll(plain).isEmpty() and mixed.count() == plain.count()
    assert fp.spans(pairs.limit(0), k, res, 0).isEmpty()


def test_alignment_tables(spark):
    head = "Strip Metadata\n\nMosaicking Alignment Statistics (meters)  \nscene, rmse, dz, dx, dy\n"
    texts = {
        "whole": head + "a 0.10 1.0000 2.0000 -3.0000\nb 0.00 nan 0 0 \t\n\nscene 1 name=a\nx 1 2 3 4\n",
        "last": head + "a 0.5 1 2 3",
        "odd": head + "only four words here\nc 1 2 x 4\n  \nd 1 2 3 4\n",
        "bare": head, "none": "no table\na 1 2 3 4\n", "title": "Mosaicking Alignment Statistics (meters)", "empty": "", "null": None,
    }
    d = rp.parse_strip_scenes(spark.createDataFrame(list(texts.items()), "path string, value string"))
    got = {(r.path, r.seq): (r.scene_id, r.rmse, r.dz, r.dx, r.dy) for r in d.collect()}
    assert set(got) == {("whole", 1), ("whole", 2), ("last", 1), ("odd", 1), ("odd", 2)}
    assert got["whole", 1] == ("a", 0.1, 1.0, 2.0, -3.0) and got["last", 1] == ("a", 0.5, 1.0, 2.0, 3.0)
    name, rmse, dz, dx, dy = got["whole", 2]
    assert (name, rmse, dx, dy) == ("b", 0.0, 0.0, 0.0) and np.isnan(dz)
    assert got["odd", 1] == ("", None, None, None, None) and got["odd", 2] == ("c", 1.0, 2.0, None, 4.0)
