"""Points in footprints summed per outline against one row per pair."""

import random

from pyspark.sql import functions as F

from reliefgrid.functions import polygon as pg
from reliefgrid.operators import footprints as fp, points as pt


def _inputs(spark):
    rng = random.Random(5)
    points = []
    for i in range(900):
        x, y = (rng.uniform(-40, 60), rng.uniform(-40, 60)) if i % 2 else (rng.randrange(-8, 12) * 5.0, rng.randrange(-8, 12) * 5.0)
        points += [(x, y, rng.randrange(64) / 8.0 if i % 7 else None, i % 12 + 1 if i % 11 else None)] * (1 + i % 3)
    boxes = []
    for i in range(120):
        x, y = rng.randrange(-8, 8) * 5.0, rng.randrange(-8, 8) * 5.0
        w, h = (25.0, 20.0) if i % 3 else (rng.uniform(0, 30), rng.uniform(0, 30))
        # a notch in the upper side: lines near it cross the outline four times
        boxes.append((f"s{i}", x, x + w, y, y + h, [(x, y), (x + w * 0.75, y), (x + w, y + h), (x + w / 2, y + h / 3), (x + w / 4, y + h), (x, y)]))
    boxes += [("far", 500.0, 510.0, 500.0, 510.0, [(500.0, 500.0), (510.0, 500.0), (510.0, 510.0), (500.0, 500.0)]), ("none", 0.0, 30.0, 0.0, 30.0, None)]
    p = spark.createDataFrame(points, "x double, y double, z double, month int")
    return p, spark.createDataFrame(boxes, "strip_id string, xmin double, xmax double, ymin double, ymax double, poly array<struct<x:double,y:double>>")


def _both(spark, rectangle):
    p, f = _inputs(spark)
    got = fp.point_sums(p, f, 20.0, ["z"], by="month", rectangle=rectangle)
    want = fp.points_in_polygons(p, f, 20.0, rectangle=rectangle).groupBy("strip_id", "month").agg(F.count("*").alias("n"), F.sum("z").alias("z"))
    rows = lambda d: sorted((r["strip_id"], r["month"] or 0, r["n"], r["z"] is None, r["z"] or 0.0) for r in d.collect())
    return rows(got), rows(want)


def test_sums_in_boxes_and_polygons(spark, monkeypatch):
    for rectangle in (True, False):
        got, want = _both(spark, rectangle)
        assert len(want) > 500 and got == want
    monkeypatch.setattr(fp, "CELL_SHAPES", 7)
    monkeypatch.setattr(fp, "CELL_PLACES", 5)
    got, want = _both(spark, False)
    assert got == want


def test_equal_places_and_outlines_meet_once(spark):
    p = spark.createDataFrame([(1.0, 1.0, 2.0)], "x double, y double, z double").crossJoin(spark.range(20000)).drop("id")
    f = spark.range(20000).select(F.col("id").cast("string").alias("strip_id"), *[F.lit(v).alias(c) for c, v in (("xmin", 0.0), ("xmax", 9.0), ("ymin", 0.0), ("ymax", 9.0))])
    f = f.withColumn("poly", pg.box_ring(F.col("xmin"), F.col("xmax"), F.col("ymin"), F.col("ymax")))
    rows = fp.point_sums(p, f, 4.0, ["z"]).groupBy("n", "z").count().collect()  # 400 million pairs
    assert [tuple(r) for r in rows] == [(20000, 40000.0, 20000)]


def test_window_of_months_is_that_of_points(spark):
    p, f = _inputs(spark)
    f = f.withColumn("strip_date", F.expr("make_date(2001, cast(substring(strip_id, 2, 9) as int) % 12 + 1, 3)")).filter("strip_id like 's%'")
    by_point = pt.season_window(fp.points_in_polygons(p.withColumn("t", F.expr("make_date(2002, month, 9)")), f, 20.0), "strip_id", "strip_date", "t")
    by_month = pt.season_window_of_months(fp.point_sums(p, f, 20.0, ["z"], by="month"), "strip_id", "strip_date", "month", "n")
    keys = ["strip_id", "month_range", "month"]
    want = by_point.withColumn("month", F.month("t")).groupBy(*keys).count()
    assert sorted(map(tuple, by_month.select(*keys, "n").collect())) == sorted(map(tuple, want.collect()))


def test_sparse_ids_make_few_ranges(spark):
    d = spark.range(3000).select((F.col("id") % 2).alias("k"), (F.col("id") * 100_000_007 - 50_000_000_000).alias("i"))
    got = pt.sequence_number(d, ["k"], "i")
    rows = got.orderBy("k", "i").collect()
    assert [r["seq"] for r in rows] == [*range(1, 1501)] * 2 and {r["group_rows"] for r in rows} == {1500}
    # the ranks before a range come from a table of at most a row per key and partition
    d = d.withColumn("i", F.col("i").cast("long"))
    seen = pt.cut

    def counted(frame):
        kept = seen(frame)
        assert kept.select("k", "_rng").distinct().count() <= 2 * 4
        return kept

    pt.cut = counted
    try:
        pt.sequence_number(d, ["k"], "i").count()
    finally:
        pt.cut = seen
