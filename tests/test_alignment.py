"""Solvers recover planted offsets; edge cases return a status, never a wrong fit."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from reliefgrid.functions.quantiles import group_quantiles
from reliefgrid.operators import pairs, points as pt, select as sel, solve

def surface(r, c):
    return 100 + (r * r + 2.0 * c * c - r * c) / 64.0


def raster(spark, fn, rows=40, cols=40, key="a"):
    r, c = np.indices((rows, cols))
    z = fn(r.astype(float), c.astype(float)).ravel()
    df = pd.DataFrame({"k": key, "row": r.ravel().astype("int32"), "col": c.ravel().astype("int32"), "z": z, "m": True})
    return spark.createDataFrame(df, "k string, row int, col int, z double, m boolean")


def test_coregister_recovers_a_planted_shift_and_reports_failures(spark):
    res = 2.0
    ref = raster(spark, surface).unionByName(raster(spark, lambda r, c: 0 * r + 5, key="flat")).unionByName(raster(spark, surface, 10, 10, key="apart"))
    # sampling the surface at (row + 1/2, col - 1) is a raster shifted by dy = -1/2 cell... in map units
    flt = raster(spark, lambda r, c: surface(r + 0.5, c - 1.0) + 3.0)
    flt = flt.unionByName(raster(spark, lambda r, c: 0 * r + 7, key="flat"))
    flt = flt.unionByName(raster(spark, surface, 10, 10, key="apart").withColumn("row", F.col("row") + 500))
    got = {r.k: r for r in solve.coregister(ref, flt, ["k"], res).collect()}
    a = got["a"]
    assert a.status == "converged" and a.rmse < 0.05
    assert abs(a.dz - 3.0) < 0.05 and abs(a.dx - 1.0 * res) < 0.1 and abs(a.dy - 0.5 * res) < 0.1
    assert got["flat"].dz == pytest.approx(2.0) and got["flat"].dx == 0 and got["flat"].status in ("singular", "vertical_only")
    assert got["apart"].status == "no_overlap" and got["apart"].dz is None


def test_points_recover_a_planted_shift(spark):
    px = raster(spark, surface).drop("m")
    rng = np.random.default_rng(3)
    n = 300
    r, c = rng.uniform(4, 34, n), rng.uniform(4, 34, n)
    # the raster must be raised by 2, moved +0.5 in x and -0.25 in y to fit
    pts = pd.DataFrame({"k": "a", "gcp_id": np.arange(n), "x": c + 0.5, "y": -r - 0.25, "z": surface(r, c) + 2.0 + rng.normal(0, 0.01, n)})
    few = pd.DataFrame({"k": "b", "gcp_id": np.arange(3), "x": [5.0, 6.0, 7.0], "y": [-5.0, -6.0, -7.0], "z": [1.0, 2.0, 3.0]})
    px = px.unionByName(raster(spark, surface, key="b").drop("m"))
    fit, res = solve.register_to_points(px, spark.createDataFrame(pd.concat([pts, few])), ["k"], 1.0)
    got = {r.k: r for r in fit.collect()}
    assert got["b"].status == "too_few_points" and got["b"].dz is None
    assert got["a"].dz == pytest.approx(2.0, abs=0.1)
    assert got["a"].dx == pytest.approx(0.5, abs=0.05) and got["a"].dy == pytest.approx(-0.25, abs=0.05)
    assert res.filter("k = 'a'").count() == n and res.filter("k = 'b'").count() == 0


def midpoint(v, p):
    v = np.sort(v)
    return np.interp(len(v) * p + 0.5, np.arange(1, len(v) + 1), v)


def test_quantiles_use_the_midpoint_rule_for_small_and_large_groups(spark):
    rng = np.random.default_rng(1)
    groups = {"one": [4.0], "five": [1.0, 2, 3, 4, 5], "big": list(rng.normal(0, 1, 9000)) + [1e6] * 500, "ties": [2.0] * 5001}
    df = spark.createDataFrame([(k, float(x)) for k, v in groups.items() for x in v] + [("five", None)], "k string, v double")
    probs = {"p50": 0.5, "p75": 0.75, "p95": 0.95, "p100": 1.0}
    for r in group_quantiles(df, ["k"], F.col("v"), probs).collect():
        assert r.n == len(groups[r.k])
        for name, p in probs.items():
            assert r[name] == pytest.approx(midpoint(groups[r.k], p)), (r.k, name)


def test_quantiles_of_a_million_values_ties_and_extremes(spark, tmp_path):
    rng = np.random.default_rng(2)
    inf = float("inf")
    groups = {
        "heavy": np.r_[np.full(3000, 7.5), rng.normal(7.5, 1e-9, 50)],
        "wide": np.r_[-1.7e308, 1.7e308, 10.0 ** np.arange(-300, 300, 7)], "inf": np.r_[-inf, inf, inf, 1, 2, 3], "zeros": np.array([0.0, -0.0, 0.0, -1.0]),
        "close": np.nextafter(1.0, 2.0) * np.ones(3), "two": np.array([1.0, np.nextafter(1.0, 2.0)]),
    }
    rows = [(k, float(x)) for k, v in groups.items() for x in v] + [("two", float("nan")), ("two", None), (None, 1.0)]
    groups["million"] = rng.normal(0, 1, 1_000_000)
    pd.DataFrame({"k": "million", "v": groups["million"]}).to_parquet(tmp_path / "million.parquet")
    million = spark.read.parquet(f"file://{tmp_path}/million.parquet")
    df = spark.createDataFrame(rows, "k string, v double").unionByName(million)
    probs = {"p10": 0.1, "p50": 0.5, "p95": 0.95}
    got = {r.k: r for r in group_quantiles(df, ["k"], F.col("v"), probs).collect()}
    assert set(got) == set(groups)
    for k, v in groups.items():
        assert got[k].n == len(v)
        for name, p in probs.items():
            at = min(max(len(v) * p + 0.5, 1), len(v))
            lo, hi = np.sort(v)[[int(np.floor(at)) - 1, int(np.ceil(at)) - 1]]
            want = lo if lo == hi or np.isinf(lo) or np.isinf(hi) else lo + (hi - lo) * (at - np.floor(at))
            assert got[k][name] == want or np.isinf(want), (k, name)
    all_ = group_quantiles(df, [], F.col("v"), probs).collect()
    assert len(all_) == 1 and all_[0].n == sum(map(len, groups.values())) + 1
    assert group_quantiles(df.filter("k = 'none'"), ["k"], F.col("v"), probs).count() == 0


def test_season_window_wraps_the_year_and_widens(spark):
    rows = [("s", "2001-01-15", f"2000-{m:02d}-03") for m in (12, 12, 1, 2, 7)] + [("t", "2001-06-01", f"2000-{m:02d}-03") for m in (6, 9, 9, 10, 1)]
    d = spark.createDataFrame(rows, "strip_id string, d string, t string").select("strip_id", F.to_date("d").alias("d"), F.to_date("t").alias("t"))
    got = pt.season_window(d, "strip_id", "d", "t").groupBy("strip_id").agg(F.max("month_range").alias("m"), F.count("*").alias("n")).collect()
    assert {(r.strip_id, r.m, r.n) for r in got} == {("s", 1, 4), ("t", 4, 4)}


def test_distributed_rank_matches_row_number(spark):
    d = spark.range(0, 1000, 7).withColumn("k", F.col("id") % 2)
    got = pt.sequence_number(d, ["k"], "id", width=64).orderBy("k", "id").collect()
    for k in (0, 1):
        seq = [r.seq for r in got if r.k == k]
        assert seq == list(range(1, len(seq) + 1)) and {r.group_rows for r in got if r.k == k} == {len(seq)}


def greedy(boxes):
    left, order, seg = dict(boxes), [], 0
    while left:
        seg += 1
        wide = max(b[1] for b in left.values()) - min(b[0] for b in left.values()) >= max(b[3] for b in left.values()) - min(b[2] for b in left.values())
        s = min(left, key=lambda i: (left[i][0 if wide else 2], i))
        u, pos = left.pop(s), 1
        order.append((s, seg, pos))
        while left:
            area = {i: max(0, min(u[1], b[1]) - max(u[0], b[0])) * max(0, min(u[3], b[3]) - max(u[2], b[2])) for i, b in left.items()}
            best = min(area, key=lambda i: (-area[i], i))
            if area[best] <= 0:
                break
            b, pos = left.pop(best), pos + 1
            u = (min(u[0], b[0]), max(u[1], b[1]), min(u[2], b[2]), max(u[3], b[3]))
            order.append((best, seg, pos))
    return order


def test_scene_order_matches_the_greedy_rule(spark):
    rng = np.random.default_rng(5)
    rows, want = [], set()
    for s in range(6):
        boxes = {}
        for i in range(1 + s):
            x, y = rng.integers(0, 40, 2)
            boxes[i] = (float(x), float(x + 12), float(y), float(y + 12))
        rows += [(f"s{s}", i, *b) for i, b in boxes.items()]
        want |= {(f"s{s}", *o) for o in greedy(boxes)}
    d = spark.createDataFrame(rows, "strip_id string, seq int, xmin double, xmax double, ymin double, ymax double")
    got = {(r.strip_id, r.seq, r.segment, r.position) for r in sel.order_scenes(d).collect()}
    assert got == want
    first = {(r.strip_id, r.seq, r.position) for r in sel.order_scenes(d, segments=False).collect()}
    assert first == {(a, b, p) for a, b, g, p in want if g == 1}


def test_scene_order_writes_one_table_for_many_rounds(spark, monkeypatch):
    from reliefgrid import session

    rng = np.random.default_rng(6)
    rows, want = [], set()
    for s in range(5):
        corners = [rng.integers(0, 60, 2) for _ in range(3 + s)]
        boxes = {i: (float(x), float(x + 12), float(y), float(y + 12)) for i, (x, y) in enumerate(corners)}
        rows += [(f"s{s}", i, *b) for i, b in boxes.items()]
        want |= {(f"s{s}", *o) for o in greedy(boxes)}
    d = spark.createDataFrame([*rows, (None, 0, 0.0, 1.0, 0.0, 1.0)], "strip_id string, seq int, xmin double, xmax double, ymin double, ymax double")

    def tables_and_rows():
        before = session._rounds_of(spark).count
        out = sel.order_scenes(d)
        return session._rounds_of(spark).count - before, {(r.strip_id, r.seq, r.segment, r.position) for r in out.collect()}

    assert tables_and_rows() == (1, want)
    monkeypatch.setattr(sel, "ROUNDS_OF_A_JOB", 3)
    assert tables_and_rows() == (3, want)


def test_registered_tiles_use_every_control_point(spark, monkeypatch):
    from pyspark.sql import functions as F

    from reliefgrid.plans import registration as pr
    from workload import loops

    cells = spark.range(1600).select((F.col("id") / 40).cast("int").alias("row"), (F.col("id") % 40).cast("int").alias("col"))
    z = 100.0 + (F.col("row") * F.col("row") + F.col("col") * F.col("col")) / 16.0
    px = cells.withColumns({"tile_id": F.lit("t"), "cluster": F.lit(2), "z": z, "ortho": F.lit(1), "mt": F.lit(True), "dy": F.lit(1)})
    points = cells.filter("row between 5 and 34 and col between 5 and 34").select((F.col("row") * 40 + F.col("col")).cast("long").alias("gcp_id"), (F.col("col") * 8.0).alias("x"), (-F.col("row") * 8.0).alias("y"), F.lit(0.0).alias("z"))
    used = []
    fit = pr.register_to_points
    monkeypatch.setattr(loops, "_tiles_px", lambda spark, sf: px)
    monkeypatch.setattr(loops, "gp", lambda spark, sf: points)
    monkeypatch.setattr(pr, "register_to_points", lambda px, pts, *a: used.append(pts.count()) or fit(px, pts, *a))
    assert loops._r5(spark, "").count() == 1600
    assert used == [900]


def counted_puts(monkeypatch):
    from reliefgrid.rounds import Rounds

    made, put = [], Rounds.put
    monkeypatch.setattr(Rounds, "put", lambda self, df, label: made.append(label) or put(self, df, label))
    return made


def test_a_round_of_small_pairs_writes_one_table_and_agrees_with_the_counting_rounds(spark, monkeypatch):
    rough = lambda r, c: 3.0 + ((7 * r + 13 * c) % 17) / 64.0
    ref = raster(spark, surface).unionByName(raster(spark, surface, 30, 50, key="b"))
    flt = raster(spark, lambda r, c: surface(r + 0.5, c - 1.0) + rough(r, c)).unionByName(raster(spark, lambda r, c: surface(r, c) + rough(r, c), 30, 50, key="b"))
    made = counted_puts(monkeypatch)
    got = sorted(map(tuple, solve.coregister(ref, flt, ["k"], 2.0).collect()))
    assert len(made) <= 3 + max(r[-1] for r in got)  # both rasters, the state, and one table a round
    monkeypatch.setattr(solve, "GROUP_CELLS", 0)
    want = sorted(map(tuple, solve.coregister(ref, flt, ["k"], 2.0).collect()))
    assert [(r[0], *r[5:]) for r in got] == [(r[0], *r[5:]) for r in want]
    assert np.allclose([r[1:5] for r in got], [r[1:5] for r in want], atol=1e-8)


def test_medians_by_one_sort_skip_null_and_nan(spark):
    rows = [("a", v) for v in (3.0, 1.0, None, float("nan"), 2.0)] + [("b", 1.0), ("b", 4.0), ("c", None)]
    d = solve.with_median(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", "m")
    assert {(r.k, r.m) for r in d.collect()} == {("a", 2.0), ("b", 2.5), ("c", None)}


def test_waves_along_a_row_of_tiles_write_only_what_they_reach(spark, monkeypatch):
    from reliefgrid.plans import registration as pr

    tile = lambda n, dz: raster(spark, lambda r, c: surface(r, c + 30 * n) + dz, key=f"t{n}").withColumn("col", F.col("col") + 30 * n).withColumnRenamed("k", "tile_id").withColumnRenamed("m", "mt")
    more = lambda d: d.withColumns({"cluster": F.lit(2), "ortho": F.lit(1), "dy": F.lit(1)})
    open_px = more(tile(1, 1.0).unionByName(tile(2, 3.0)).unionByName(tile(4, 9.0)))
    tiles = spark.createDataFrame([(f"t{n}", 0, n) for n in range(5)], "tile_id string, tile_row int, tile_col int")
    made = counted_puts(monkeypatch)
    reg, off = pr.spread_alignment(open_px, more(tile(0, 0.0)), tiles, 2.0)
    got = {r.tile_id: r for r in off.collect()}
    assert set(got) == {"t1", "t2"}  # t3 has no cells, so t4 is never reached
    assert got["t1"].dz == pytest.approx(1.0, abs=0.05) and got["t2"].dz == pytest.approx(3.0, abs=0.05)
    assert {r.tile_id: r["count"] for r in reg.groupBy("tile_id").count().collect()} == {"t0": 1600, "t1": 1600, "t2": 1600}
    assert len(made) <= 3 + 2 * 15  # every wave writes a bounded number of tables


def test_blocks_of_a_pair_give_the_differences_of_the_cells(spark):
    rng = np.random.default_rng(3)
    rows = [
        (k, int(r), int(c), None if rng.random() < 0.1 else float("nan") if rng.random() < 0.002 else float(rng.random()), None if rng.random() < 0.05 else bool(rng.random() < 0.9), side)
        for k in "abcd" for side in ("ref", "flt") for r in range(-20, 20) for c in range(240, 275) if rng.random() < 0.95 and (k, side) not in (("c", "ref"), ("d", "flt"))
    ]
    d = spark.createDataFrame(rows + rows[:50], "k string, row int, col int, z double, m boolean, side string")
    ref, flt = (d.filter(F.col("side") == side).drop("side") for side in ("ref", "flt"))
    trial = spark.createDataFrame(pd.DataFrame({"k": list("abcd"), "pz": [0.0, 0.5, 0.0, 0.0], "px": [0.0, 14.75, 1.0, 1.0], "py": [0.0, -7.0, 1.0, 1.0]}))
    blocks = pairs.pair_blocks(ref, flt, ["k"], 1.0, solve.MAX_HORIZONTAL)
    assert {r.k for r in blocks.filter("_flt").collect()} == set("abc")
    told = lambda t: sorted(tuple("-" if v is None else repr(v) for v in (r.k, r.dz, r.sx, r.sy)) for r in t.select("k", "dz", "sx", "sy").collect())
    got = told(pairs.block_differences(blocks, trial, ["k"], 1.0, solve.MAX_HORIZONTAL))
    assert got and got == told(solve.trial_differences(ref, flt, trial, ["k"], 1.0))


def test_an_alignment_reads_both_rasters_once(spark, monkeypatch):
    made = counted_puts(monkeypatch)
    flt = raster(spark, lambda r, c: surface(r + 0.5, c - 1.0))
    got = solve.coregister(raster(spark, surface), flt, ["k"], 2.0).collect()
    assert len(made) <= 2 + got[0].rounds  # the blocks, the state, and one table a round
