"""Loops run to their end, kernels count positions, and round tables lie in the shared folder."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from reliefgrid.operators import kernels as kn
from reliefgrid.operators import masks as mk
from reliefgrid.operators import merge as mg
from reliefgrid.session import clear_rounds, cut
from reliefgrid.rounds import Rounds, shared_folder


def to_array(df, name, shape):
    out = np.full(shape, np.nan, dtype=object)
    for r in df.select("row", "col", name).collect():
        out[r["row"], r["col"]] = r[name]
    return out


@pytest.mark.parametrize("n", [3, 7, 11, 21])
def test_kernels_on_absent_cells(spark, n):
    rng = np.random.default_rng(n)
    cells = [(r, c) for r in (0, 1, 2, 9, 10) for c in [*range(10), *range(60, 70)]]
    seeds = {x for x in cells if rng.random() < 0.08} | {(0, 9)}
    px = spark.createDataFrame(pd.DataFrame([("a", r, c, (r, c) in seeds) for r, c in {*cells, (0, 9)}], columns=["k", "row", "col", "m"]), "k string, row int, col int, m boolean")
    got = {(r["row"], r["col"]): r["d"] for r in kn.dilate(px, ["k"], F.col("m"), n, "d").collect()}
    h = n // 2
    assert got == {(r, c): any(abs(r - a) <= h and abs(c - b) <= h for a, b in seeds) for r, c in got}
    share = {(r["row"], r["col"]): r["density"] for r in kn.density_map(px, ["k"], F.col("m"), n).collect()}
    for (r, c), v in share.items():
        assert np.isclose(v, sum(abs(r - a) <= h and abs(c - b) <= h for a, b in seeds) / n**2)


def test_growth_runs_to_its_end(spark):
    cells = [("a", 0, c, c == 0, True) for c in range(64)] + [("b", 0, c, False, True) for c in range(5)]
    px = spark.createDataFrame(cells, "k string, row int, col int, s boolean, ok boolean")
    got = mk.grow_to_fixpoint(px, ["k"], F.col("s"), F.col("ok"), 11, "g").collect()
    assert len(got) == 69 and all(r["g"] == (r["k"] == "a") for r in got)


def test_wide_void_of_a_plane(spark, grid):
    r, c = np.indices((40, 40))
    plane = 2.0 * c + 1.0 * r
    hole = plane.copy()
    hole[6:34, 6:34] = np.nan
    px = grid({"a": hole, "none": np.full((4, 4), np.nan), "whole": plane[:5, :5]})
    d = mg.fill_voids(px, ["k"], "z", 1e-6).cache()
    assert np.abs(to_array(d.filter("k = 'a'"), "z", plane.shape).astype(float) - plane).max() < 1e-3
    assert d.filter("k = 'none' and z is null").count() == 16 and d.filter("k = 'whole' and z is not null").count() == 25


def test_one_corner_fills_all(spark, grid):
    z = np.full((30, 30), np.nan)
    z[0, 0] = 4.0
    got = to_array(mg.fill_voids(grid({"a": z}), ["k"], "z"), "z", z.shape).astype(float)
    assert np.allclose(got, 4.0, atol=0.1)


def test_round_tables(spark):
    from pathlib import Path

    shared = Path(shared_folder(spark).removeprefix("file://"))
    assert spark.conf.get("spark.checkpoint.dir") == f"file://{shared}"
    held = {p.name for p in shared.iterdir()}
    job = Rounds(spark, "job")
    a = job.put(spark.range(5), "x")
    b = job.put(a.selectExpr("id + 1 as id"), "x")
    assert b.agg(F.sum("id")).first()[0] == 15 and len(list(shared.glob("job-*/x-*"))) == 1  # the table replaced is gone
    job.clear()
    assert {p.name for p in shared.iterdir()} == held
    clear_rounds(spark)
    assert cut(spark.range(3).withColumn("none", F.lit(None))).count() == 3
    assert list(shared.glob("rounds-*"))
    clear_rounds(spark)
    assert not list(shared.glob("rounds-*"))


def test_a_large_polygon_is_many_tasks(spark):
    from reliefgrid.operators.footprints import rasterise

    ring = [(0.0, 0.0), (0.0, 1000.0), (1000.0, 1000.0), (1000.0, 0.0), (0.0, 0.0)]
    pair = spark.createDataFrame([("t", "s", ring, 0.0, 1000.0, 0.0, 1000.0)], "tile_id string, strip_id string, poly array<struct<x:double,y:double>>, x0 double, x1 double, y0 double, y1 double")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        d = rasterise(pair, ["tile_id", "strip_id"], 2.0, 0).withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(d) > 1 and sum(r["count"] for r in d) >= 249000


def test_settings_bound_what_a_task_holds(spark):
    """A table of cells that is small only as files isn't broadcast, and shuffles have parts to spare."""
    from pyspark.sql import functions as F

    from reliefgrid import session
    from workload.inputs import Inputs

    fresh = spark.newSession()
    for name in session.BOUNDED:
        fresh.conf.unset(name)
    Inputs(fresh, "")
    cells = session.cut(spark.range(400_000).select(F.lit("s").alias("k"), F.col("id").cast("int").alias("row"), (F.col("id") % 7).cast("double").alias("z")))
    path = cells.inputFiles()[0].rsplit("/", 1)[0]
    one, two = (fresh.read.parquet(path) for _ in range(2))
    joined = one.join(two.withColumnRenamed("z", "g"), ["k", "row"], "left")
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in joined._jdf.queryExecution().executedPlan().toString()
    assert int(fresh.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) >= 200
    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "7")
    session.bounded_tasks(own)
    assert own.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == "7"
