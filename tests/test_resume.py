"""Jobs that break off go on after their last whole round; tiles lie on their own lattice."""

from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from reliefgrid.operators.lattice import gaps, on_common_lattice, tile_bounds
from reliefgrid.plans import mosaic as pm
from reliefgrid.rounds import Journal, shared_folder
from reliefgrid.session import journal
from reliefgrid.sources.rasters import export_tiles


def _strip(spark, tile, strip, rows, cols, lift=0.0):
    r, c = np.meshgrid(np.arange(*rows), np.arange(*cols), indexing="ij")
    z = 200.0 + (r * r + 2.0 * c * c - r * c) / 256.0 + lift
    f = pd.DataFrame({"tile_id": tile, "strip_id": strip, "row": r.ravel(), "col": c.ravel(), "z": z.ravel(), "mt": True, "ortho": 5, "dy": 9})
    return spark.createDataFrame(f, "tile_id string, strip_id string, row int, col int, z double, mt boolean, ortho int, dy int")


def _job(spark):
    # tile t: four strips apart, one merge a round; tile u is whole after one round; w's second strip adds nothing
    parts = [_strip(spark, "t", f"s{k}", (30 * k, 30 * k + 20), (0, 20)) for k in range(4)]
    parts += [_strip(spark, "u", "v", (0, 20), (0, 20)), _strip(spark, "w", "a", (0, 30), (0, 20)), _strip(spark, "w", "b", (5, 25), (2, 18))]
    px = parts[0]
    for p in parts[1:]:
        px = px.unionByName(p)
    rows = [("t", f"s{k}", k, 1) for k in range(4)] + [("u", "v", 9, 1), ("w", "a", 7, 1), ("w", "b", 8, 1)]
    return px, spark.createDataFrame(rows, "tile_id string, strip_id string, idx int, qc int")


def _found(built):
    px, log = built
    order = ["tile_id", "row", "col"]
    return px.toPandas().sort_values(order).reset_index(drop=True), sorted(map(tuple, log.collect()), key=str)


def test_a_broken_job_goes_on(spark, monkeypatch):
    px, strips = _job(spark)
    want, log = _found(pm.build_tiles(px, strips, 1.0, "underprint", anchors=False))
    assert set(want["tile_id"]) == {"t", "u", "w"} and len(want) == 4 * 400 + 400 + 600
    assert [(r[1], r[3]) for r in log if r[2] == "b"] == [(3, "redundant")]
    close, rounds = Journal.close, []

    def broken(self):
        if self.number == 2:
            raise RuntimeError("lost")
        close(self)
        rounds.append(self.number)

    monkeypatch.setattr(Journal, "close", broken)
    with pytest.raises(RuntimeError):
        pm.build_tiles(px, strips, 1.0, "underprint", anchors=False, name="broken")
    assert rounds == [0, 1, 2]
    folder = Path(shared_folder(spark).removeprefix("file://")) / "tiles-broken"
    (folder / "entry-000000009").mkdir()  # an entry broken off while it was written
    monkeypatch.setattr(Journal, "close", lambda self: (close(self), rounds.append(self.number)))
    # the inputs are those read at first
    got, again = _found(pm.build_tiles(px.limit(0), strips.limit(0), 1.0, "underprint", anchors=False, name="broken"))
    assert rounds[:4] == [0, 1, 2, 3] and rounds[3:] == sorted(set(rounds[3:]))  # rounds 1 and 2 aren't made again
    pd.testing.assert_frame_equal(want, got)
    assert again == log
    with pytest.raises(ValueError, match="settings"):
        pm.build_tiles(px, strips, 2.0, "underprint", anchors=False, name="broken")
    kept = {p.name.split("-")[0] for p in folder.iterdir()}
    assert kept == {"entry", "px", "cover", "pool", "mosaic", "log"} and len(list(folder.glob("entry-*"))) == 1 and len(list(folder.glob("pool-*"))) == 1
    whole = pm.build_tiles(px, strips, 1.0, "underprint", anchors=False, name="broken")
    assert _found(whole)[0].equals(got)  # a job that ended gives its result again
    journal(spark, "tiles", "broken", res=1.0, method="underprint", coreg_test=True, anchors=False).clear()
    assert not folder.exists()


def test_a_job_without_strips(spark):
    px, strips = _job(spark)
    built, log = pm.build_tiles(px.limit(0), strips.limit(0), 1.0, "underprint", anchors=False)
    assert built.count() == 0 and log.count() == 0 and log.columns == ["tile_id", "seq", "strip_id", "kind", "overlap", "rmse", "dz", "dx", "dy"]


def test_journal(spark, tmp_path):
    base = f"file://{tmp_path}/j"
    j = Journal(spark, base, {"a": 1})
    j.put(spark.range(3), "x")
    assert j.number == -1
    j = Journal(spark, base, {"a": 1})  # nothing was closed
    assert j.number == -1 and not list((tmp_path / "j").iterdir())
    j.put(spark.range(3), "x")
    parts = spark.range(4).withColumn("on", F.col("id") < 3)
    assert j.put_split(parts, "on", "y", "rest").count() == 3
    j.close()
    j.put(spark.range(9), "x")
    assert j.put_split(parts.filter("not on"), "on", "y", "more").count() == 0
    j = Journal(spark, base, {"a": 1})  # the second round was not closed
    assert j.number == 0 and j.table("x").count() == 3 and j.table("rest").collect()[0]["id"] == 3 and j.labels("more") == []
    j.put_split(parts.filter("not on"), "on", "y", "more")
    j.close()
    j = Journal(spark, base, {"a": 1})
    assert j.number == 1 and j.table("y").count() == 0 and j.table("y").columns == ["id"]
    assert [j.table(n).count() for n in ("rest", "more", "x")] == [1, 1, 3]
    assert len(list((tmp_path / "j").glob("y-*/on=true"))) == 0


def test_tiles_lie_on_their_own_lattice(spark):
    tiles = spark.createDataFrame([("t", 0, 0, -8.0, 52.0, -70.0, -4.0)], "tile_id string, tile_row int, tile_col int, x0 double, x1 double, y0 double, y1 double")
    assert tuple(tile_bounds(tiles, 2.0, 3).first()) == ("t", -1, 38, -7, 29)
    # two strips: one inside, one that reaches beyond the widened tile
    px = _strip(spark, "t", "a", (5, 20), (3, 20)).unionByName(_strip(spark, "t", "b", (12, 60), (3, 20)))
    strips = spark.createDataFrame([("t", "a", 1, 1), ("t", "b", 2, 1)], "tile_id string, strip_id string, idx int, qc int")
    out, _ = pm.build_mosaic(px, strips, tiles, 2.0, None, "underprint", buffer_px=3)
    rows = out.collect()
    assert {(r["row"], r["col"]) for r in rows} == {(r, c) for r in range(2, 36) for c in range(-4, 27)} and len(rows) == 34 * 31
    assert {(r["row"], r["col"]) for r in rows if r["z"] > -9999} == {(r, c) for r in range(5, 36) for c in range(3, 20)}


def test_gaps(spark):
    rng = np.random.default_rng(5)
    cells = {k: {(int(r), int(c)) for r, c in rng.integers(0, (6, 9), (n, 2))} for k, n in (("a", 0), ("b", 1), ("c", 20), ("d", 200))}
    px = spark.createDataFrame([(k, r, c) for k, s in cells.items() for r, c in s], "k string, row int, col int")
    bounds = spark.createDataFrame([(k, 0, 5, 0, 8) for k in cells] + [("none", 3, 2, 0, 8)], "k string, r0 int, r1 int, c0 int, c1 int")
    got = {k: set() for k in cells}
    for r in gaps(px, ["k"], bounds).collect():
        run = {(r["row"], c) for c in range(r["c_from"], r["c_to"] + 1)}
        assert run and not run & got[r["k"]]
        got[r["k"]] |= run
    assert all(got[k] == {(r, c) for r in range(6) for c in range(9)} - s for k, s in cells.items())


def test_cells_of_a_tile_on_the_common_lattice(spark):
    tiles = spark.createDataFrame([("t", -8.0, 52.0, -70.0, -4.0)], "tile_id string, x0 double, x1 double, y0 double, y1 double")
    px = spark.createDataFrame([("t", 0, 0, 1), ("t", 33, 30, 2)], "tile_id string, row int, col int, v int")
    assert {(r["row"], r["col"]) for r in on_common_lattice(px, tiles, 2.0).collect()} == {(2, -4), (35, 26)}
    out = export_tiles(px.selectExpr("tile_id", "row + 2 as row", "col - 4 as col", "1.5D as z", "true as mt", "1 as ortho", "2 as dy"), None, 0, tile_bounds(tiles, 2.0, 0), dense=True)
    assert out.count() == 34 * 31
