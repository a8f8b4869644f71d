"""Scenes to strips: order, align, blend; every strip advances in each round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.kernels import erode_each
from ..operators.lattice import crop_to_data
from ..operators.merge import blend, feather_weights, two_layers
from ..operators.resample import resample_bands
from ..operators.select import order_scenes
from ..operators.solve import coregister
from ..session import cut
from ..sources.inventory import not_done

# fixed values: fewest overlap / new cells, weight range, border trim
MIN_CELLS = 1000
F0, F1 = 0.25, 0.55
TRIM = 6


def scene_boxes(scenes: DataFrame) -> DataFrame:
    """Extent of every scene in lattice units, y up."""
    return scenes.groupBy("strip_id", "seq").agg(
        F.min("col").cast("double").alias("xmin"), F.max("col").cast("double").alias("xmax"),
        (-F.max("row")).cast("double").alias("ymin"), (-F.min("row")).cast("double").alias("ymax"),
    )


def join_scene(strip: DataFrame, scene: DataFrame, res: float, min_cells: int = MIN_CELLS) -> tuple[DataFrame, DataFrame]:
    """Merge one scene into each strip.

    Returns (blended pixels of strips whose scene was accepted, verdicts).
    Verdicts: strip_id, verdict ('merged', 'redundant', 'break'), dz, dx, dy, rmse.
    """
    k = ["strip_id"]
    layers = two_layers(strip.withColumn("dy", F.lit(0)), scene.withColumn("dy", F.lit(0)), k)
    layers = feather_weights(cut(layers), k, int(10 * res + 1), F0, F1, min_cells, islands="_island")
    layers = cut(layers)
    a, b = F.col("z0").isNotNull(), F.col("z1").isNotNull()
    tally = layers.groupBy(*k).agg(F.count_if(a & b).alias("_both"), F.count_if("_island").alias("_new"))
    kept0, kept1 = F.col("w") > 0, F.col("w") < 1
    ref = layers.select(*k, "row", "col", F.when(kept0, F.col("z0")).alias("z"), (F.coalesce("mt0", F.lit(False)) & kept0).alias("m"))
    flt = layers.select(*k, "row", "col", F.when(kept1, F.col("z1")).alias("z"), (F.coalesce("mt1", F.lit(False)) & kept1).alias("m"))
    able = cut(tally.filter((F.col("_both") > min_cells) & (F.col("_new") > min_cells)).select(*k))
    fit = coregister(ref.join(able, k, "left_semi"), flt.join(able, k, "left_semi"), k, res)
    fit = cut(fit.select(*k, "dz", "dx", "dy", "rmse"))
    verdict = (
        F.when(F.col("_both") <= min_cells, "break").when(F.col("_new") <= min_cells, "redundant").when(F.col("rmse").isNull(), "break").otherwise("merged")
    )
    said = cut(tally.join(fit, k, "left").select(*k, verdict.alias("verdict"), "dz", "dx", "dy", "rmse"))
    ok = said.filter("verdict = 'merged'")
    moving = layers.join(ok.select(*k), k, "left_semi").select(
        *k, "row", "col", F.when(kept1, F.col("z1")).alias("z"), (F.coalesce("mt1", F.lit(False)) & kept1).alias("mt"),
        F.when(kept1, F.coalesce("ortho1", F.lit(0))).otherwise(0).alias("ortho"),
    )
    new = resample_bands(moving, k, ok.select(*k, "dz", "dx", "dy"), res)
    new = erode_each(new, k, {"_in": F.col("z").isNotNull(), "_oin": F.col("ortho") != 0}, TRIM)
    new = new.select(
        *k, "row", "col", F.when(F.col("_in"), F.col("z")).alias("z1"), (F.col("mt") & F.col("_in")).alias("mt1"),
        F.when(F.col("_oin"), F.col("ortho").cast("int")).otherwise(0).alias("ortho1"), F.lit(0).alias("dy1"),
    )
    old = layers.join(ok.select(*k), k, "left_semi").select(
        *k, "row", "col", F.when(kept0, F.col("z0")).alias("z0"), (F.coalesce("mt0", F.lit(False)) & kept0).alias("mt0"),
        F.when(kept0, F.coalesce("ortho0", F.lit(0))).otherwise(0).alias("ortho0"), F.lit(0).alias("dy0"), "w",
    )
    both = old.join(new, [*k, "row", "col"], "left")
    return blend(both, k).drop("dy"), said


def build_segment(scenes: DataFrame, order: DataFrame, res: float, min_cells: int = MIN_CELLS) -> tuple[DataFrame, DataFrame]:
    """One segment per strip: (pixels, used scenes with alignment)."""
    at = lambda n: scenes.join(order.filter(F.col("position") == n).select("strip_id", "seq"), ["strip_id", "seq"])
    bands = ["strip_id", "row", "col", "z", "mt", "ortho"]
    strip = cut(at(1).select(*bands))
    zero = F.lit(0.0)
    used = order.filter("position = 1").select("strip_id", "seq", "position", *[zero.alias(c) for c in ("rmse", "dz", "dx", "dy")])
    closed = order.select("strip_id").limit(0)
    n = 1
    while True:
        n += 1
        todo = cut(order.filter(F.col("position") == n).join(closed, "strip_id", "left_anti").select("strip_id", "seq", "position"))
        if todo.limit(1).count() == 0:
            break
        scene = at(n).join(todo, ["strip_id", "seq"], "left_semi").select(*bands)
        blended, said = join_scene(strip.join(todo, "strip_id", "left_semi"), scene, res, min_cells)
        closed = cut(closed.unionByName(said.filter("verdict = 'break'").select("strip_id")))
        rows = todo.join(said.filter("verdict <> 'break'"), "strip_id")
        stat = lambda c: F.coalesce(F.col(c), zero).alias(c)
        used = used.unionByName(rows.select("strip_id", "seq", "position", *[stat(c) for c in ("rmse", "dz", "dx", "dy")]))
        merged = said.filter("verdict = 'merged'").select("strip_id")
        strip = cut(strip.join(merged, "strip_id", "left_anti").unionByName(blended.select(*bands)))
    return crop_to_data(strip, ["strip_id"]), cut(used)


def build_strips(scenes: DataFrame, res: float, min_cells: int = MIN_CELLS, done: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """All strips in segments, but those that ``done`` (strip_id) lists.

    ``scenes``: strip_id, seq, row, col, z, mt, ortho on the common lattice,
    masks applied.  Scenes without data are dropped; what a gap or a failed
    alignment leaves over starts the next segment.  Returns pixels and
    alignment rows, both with ``segment``.
    """
    if done is not None:
        scenes = not_done(scenes, done, "strip_id")
    has = scenes.filter("z is not null").select("strip_id", "seq").distinct()
    left = cut(scenes.join(has, ["strip_id", "seq"], "left_semi"))
    px, rows = [], []
    segment = 0
    while not left.isEmpty():  # every segment uses at least the first scene of each strip
        segment += 1
        order = cut(order_scenes(scene_boxes(left), segments=False))
        p, used = build_segment(left, order, res, min_cells)
        px.append(cut(p.withColumn("segment", F.lit(segment))))
        rows.append(used.withColumn("segment", F.lit(segment)))
        left = cut(left.join(used.select("strip_id", "seq"), ["strip_id", "seq"], "left_anti"))
    if not px:
        empty = scenes.limit(0).withColumn("segment", F.lit(0))
        zero = [F.lit(0.0).alias(c) for c in ("rmse", "dz", "dx", "dy")]
        return empty.select("strip_id", "row", "col", "z", "mt", "ortho", "segment"), empty.select("strip_id", "seq", F.lit(0).alias("position"), *zero, "segment")
    out_px, out_rows = px[0], rows[0]
    for p, r in zip(px[1:], rows[1:]):
        out_px, out_rows = out_px.unionByName(p), out_rows.unionByName(r)
    return out_px, out_rows
