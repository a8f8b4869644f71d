"""Operators that take several masks or bands at once agree with one at a time, and need fewer exchanges."""

import numpy as np
from pyspark.sql import functions as F

from reliefgrid.operators import kernels, merge as mg
from reliefgrid.operators.components import drop_small, drop_small_kinds


def cells(spark, seed=5):
    rng = np.random.default_rng(seed)
    rows = [(k, int(r), int(c), int(rng.integers(0, 4))) for k in "ab" for r in range(30) for c in range(250, 290) if rng.random() < 0.97]
    return spark.createDataFrame(rows, "k string, row int, col int, v int")


def told(d, *names):
    return sorted(tuple(r) for r in d.select("k", "row", "col", *names).collect())


def test_distances_of_two_regions_and_of_none(spark):
    d = cells(spark)
    a, b, none = (F.col("v") == 3) & (F.col("col") % 5 == 0), (F.col("k") == "b") & (F.col("row") == 7), F.col("v") > 9
    got = kernels.distances_to(d, ["k"], {"x": a, "y": b, "n": none})
    want = kernels.distance_to(kernels.distance_to(kernels.distance_to(d, ["k"], a, "x"), ["k"], b, "y"), ["k"], none, "n")
    assert got.columns == want.columns
    assert told(got, "x", "y", "n") == told(want, "x", "y", "n")


def test_small_areas_of_two_kinds(spark):
    d = cells(spark)
    got = drop_small_kinds(d, ["k"], F.when(F.col("v") > 1, 1).when(F.col("v") == 0, 0), 4, "kind")
    want = drop_small(drop_small(d, ["k"], F.col("v") > 1, 4, "one"), ["k"], F.col("v") == 0, 4, "zero")
    assert told(got, "kind") == told(want.withColumn("kind", F.when(F.col("one"), 1).when(F.col("zero"), 0)), "kind")


def test_erosion_of_two_masks(spark):
    d = cells(spark).withColumn("n", F.when(F.col("v") > 0, True))
    got = kernels.erode_each(d, ["k"], {"a": F.col("n"), "b": F.col("row") % 9 < 8}, 3)
    want = kernels.erode(kernels.erode(d, ["k"], F.col("n"), 3, "a"), ["k"], F.col("row") % 9 < 8, 3, "b")
    assert told(got, "a", "b") == told(want, "a", "b")


def test_feather_weights_label_both_sides_at_once(spark, monkeypatch):
    from reliefgrid.operators import components

    calls, label = [], components.label_runs
    monkeypatch.setattr(components, "label_runs", lambda *a: calls.append(1) or label(*a))
    d = cells(spark).select("k", "row", "col", F.when(F.col("col") < 275, 1.0).alias("z0"), F.when(F.col("col") > 265, 2.0).alias("z1"))
    w = mg.feather_weights(d, ["k"], 3, min_island=10, islands="new")
    at = {(r.k, r.row, r.col): (r.w, r.new) for r in w.collect()}
    assert len(calls) == 1
    assert at["a", 5, 250] == (1.0, False) and at["a", 5, 288] == (0.0, False)
    assert all(0 <= v <= 1 for v, _ in at.values()) and any(0 < v < 1 for v, _ in at.values())


def test_a_pass_reads_each_neighbour_once(spark):
    from reliefgrid.operators import resample

    d = cells(spark).select("k", "row", "col", F.col("v").cast("double").alias("z"), F.lit(1).alias("mt"), F.lit(2.0).alias("ortho"))
    shifts = spark.createDataFrame([("a", 0.0, 0.5, -0.25)], "k string, dz double, dx double, dy double")
    moved = resample.shift_resample(d, ["k"], shifts, 1.0, {"z": "linear", "mt": "nearest", "ortho": "cubic"})
    plan = moved._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("windowspecdefinition") <= 16  # on each axis the position of three neighbours and five of their values
