"""Scans and sinks on files; the driver contract's shape."""

import pytest
from pyspark.sql import functions as F

from reliefgrid.functions.nodata import normalise
from reliefgrid.sources import inventory as inv, points as sp, rasters as sr, reports as rp


def test_point_files(spark, tmp_path):
    (tmp_path / "laser.csv").write_text("1.0,2.0,3.0,2003-10-14 18:58:57.794,0.0840\n1.0,2.0,9.0,2004-10-14 18:58:57.794,0.1\n,2.0,3.0,2003-10-14 18:58:57.794,0.1\n")
    got = sp.read_timed_points(spark, str(tmp_path / "laser.csv")).collect()
    assert len(got) == 1 and got[0].z == 3.0 and got[0].dataset == "laser" and got[0].t.year == 2003


def test_pixel_files_prune_by_raster_and_block(spark, tmp_path):
    px = spark.range(64 * 64).select(
        (F.col("id") % 2).cast("string").alias("raster_id"), F.floor(F.col("id") / 64).cast("int").alias("row"), (F.col("id") % 64).cast("int").alias("col"), F.col("id").cast("double").alias("z")
    )
    sr.write_pixels(px, str(tmp_path / "px"), "raster_id", block=16)
    back = sr.pixel_window(sr.read_pixels(spark, str(tmp_path / "px")), 3, 20, 5, 9, block=16)
    assert back.count() == 18 * 5
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(row,3)" in plan


def test_report_files(spark, tmp_path):
    f = spark.createDataFrame([("a", "01-Jan-2001", "p", [(0.0, 0.0), (5.0, 0.0), (0.0, 0.0)])], "strip_id string, created string, projection string, poly array<struct<x:double,y:double>>")
    s = spark.createDataFrame([("a", 1, "one_dem.tif", 0.0, 0.0, 0.0, 0.0), ("a", 2, "two_dem.tif", 0.125, 1.0, -2.5, 0.00005)], "strip_id string, seq int, scene_id string, rmse double, dz double, dx double, dy double")
    text = rp.write_strip_meta(f, s).collect()[0].value
    assert "two_dem.tif 0.12 1.0000 -2.5000" in text
    (tmp_path / "WV01_20010101_x_y_meta.txt").write_text(text)
    r = rp.read_reports(spark, str(tmp_path), "meta.txt")
    assert str(rp.parse_strip_meta(r).collect()[0].strip_date) == "2001-01-01"
    assert [x.scene_id for x in rp.parse_strip_scenes(r).orderBy("seq").collect()] == ["one_dem.tif", "two_dem.tif"]


def test_a_strip_report_gathers_its_scenes_once(spark):
    f = spark.createDataFrame([("a", "01-Jan-2001", "p", [(0.0, 0.0), (5.0, 0.0)]), ("b", "02-Jan-2001", "p", [(1.0, 1.0)])], "strip_id string, created string, projection string, poly array<struct<x:double,y:double>>")
    kind = "strip_id string, seq int, scene_id string, rmse double, dz double, dx double, dy double"
    s = spark.createDataFrame([("a", 2, "two_dem.tif", 0.125, 1.0, -2.5, 0.00005), ("a", 1, "one_dem.tif", 0.0, 0.0, 0.0, 0.0), ("a", 3, "odd_dem.tif", 0.5, 0.0, 0.0, 0.0)], kind)
    meta = spark.createDataFrame([("one_dem.tif", "x"), ("one_dem.tif", "y"), ("odd_dem.tif", None)], "scene_id string, value string")
    d = rp.write_strip_meta(f, s, meta)
    got = {r.strip_id: r.value for r in d.collect()}
    assert got["a"].split("scene, rmse, dz, dx, dy\n")[1] == (
        "one_dem.tif 0.00 0.0000 0.0000 0.0000\ntwo_dem.tif 0.12 1.0000 -2.5000 0.0000\nodd_dem.tif 0.50 0.0000 0.0000 0.0000\n\nScene Metadata \n\n"
        "scene 1 name=one_dem.tif\nx\n \nscene 1 name=one_dem.tif\ny\n \n"
        "scene 2 name=two_dem.tif\ntwo_meta.txt not found\n \nscene 3 name=odd_dem.tif\nodd_meta.txt not found\n "
    )
    assert got["b"].endswith("scene, rmse, dz, dx, dy\n\n\nScene Metadata \n\n")
    plan = d._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list(struct(seq") == 1


def test_errors_are_raised(spark):
    d = spark.createDataFrame([("t", 1), ("t", 2), ("t", 3)], "tile_id string, seq int")
    ok = inv.trim_restart(d, d.filter("seq <= 2"))
    assert ok.count() == 2
    with pytest.raises(Exception, match="reconciled"):
        inv.trim_restart(d, d.filter("seq <= 1")).collect()
    with pytest.raises(ValueError):
        normalise(F.lit(1.0), "other")


def test_contract_shape():
    import __spark_entry__ as e

    q, o = e.queries(), e.oracle_sql()
    assert len(q) > 100 and set(o) <= set(q)
