"""Counting, scrubbing and ranking strips; scene order; coverage replay."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import polygon as pg
from ..functions.quantiles import group_quantiles
from ..session import cut
from .lattice import tile_cells, tile_lattice


# ---- scrubbing --------------------------------------------------------------


def with_defaults(footprints: DataFrame) -> DataFrame:
    """Add the optional footprint columns that are absent, check the required ones."""
    required = ["strip_id", "xmin", "xmax", "ymin", "ymax", "poly", "avg_rmse"]
    lacking = [c for c in required if c not in footprints.columns]
    if lacking:
        raise ValueError(f"footprint table lacks {', '.join(lacking)}")
    masks = F.array().cast("array<array<struct<x:double,y:double>>>")
    optional = {
        "sigma_all": F.lit(None).cast("double"),
        "sigma_1yr": F.lit(None).cast("double"),
        "max_rmse": F.lit(None).cast("double"),
        "qc": F.lit(1),
        "masks": masks,
    }
    return footprints.withColumns({c: e for c, e in optional.items() if c not in footprints.columns})


def scrub_quality(footprints: DataFrame) -> DataFrame:
    """Better of the two sigmas, none above 1; a zero alignment error means one scene."""
    sigma = F.least("sigma_all", "sigma_1yr")
    return footprints.withColumn("sigma", F.when(sigma <= 1, sigma)).withColumn("avg_rmse", F.nullif(F.col("avg_rmse"), F.lit(0.0)))


def scrub_registration(reg: DataFrame, limit: float = 4.0) -> DataFrame:
    """Registrations whose 75th-percentile residual exceeds the limit lose their offsets."""
    ok = F.col("p75") <= limit
    return reg.withColumns({c: F.when(ok, F.col(c)) for c in ("dz", "dx", "dy", "p75")})


def large_enough(footprints: DataFrame, min_km2: float = 500.0) -> DataFrame:
    return footprints.withColumn("area_km2", pg.area(F.col("poly")) / 1e6).filter(F.col("area_km2") >= min_km2)


# ---- statistics -------------------------------------------------------------


def strip_alignment_stats(scenes: DataFrame, strips: DataFrame) -> DataFrame:
    """avg / median / max rmse over scenes 2..n and the scene count.

    The count is the number of used rows plus one; a single-scene strip has no
    statistics and counts one.
    """
    later = scenes.filter("seq > 1")
    base = later.groupBy("strip_id").agg(
        F.avg("rmse").alias("avg_rmse"), F.max("rmse").alias("max_rmse"), F.count("*").alias("_rows"),
        F.median("rmse").alias("med_rmse"),  # a strip has few scenes
    )
    return (
        strips.select("strip_id")
        .join(base, "strip_id", "left")
        .withColumn("n_scenes", (F.coalesce("_rows", F.lit(0)) + 1).cast("long"))
        .drop("_rows")
    )


PERCENTILES = list(range(50, 101, 5))  # fixed values


def residual_stats(residuals: DataFrame, keys: Sequence[str], dz: str = "dz") -> DataFrame:
    """Inlier count, mean and median; percentiles of abs(dz) over all residuals."""
    from .solve import inliers

    keys = list(keys)
    r = residuals.filter(F.col(dz).isNotNull()).select(*keys, F.col(dz).alias("dz"))
    good = inliers(r, keys, strict=True)
    base = good.groupBy(*keys).agg(F.count("*").alias("n_gcps"), F.avg("dz").alias("mean_dz"))
    med = group_quantiles(good, keys, F.col("dz"), {"median_dz": 0.5}).drop("n")
    pct = group_quantiles(r, keys, F.abs("dz"), {f"p{p}": p / 100.0 for p in PERCENTILES}).drop("n")
    out = pct.join(base, keys, "left").join(med, keys, "left")
    return out.withColumn("n_gcps", F.coalesce("n_gcps", F.lit(0)))


# ---- coverage ---------------------------------------------------------------


def overlap_counts(cover: DataFrame, covered: DataFrame) -> DataFrame:
    """Per (tile, strip): cells already covered and cells that would be new."""
    c = covered.select("tile_id", "row", "col", F.lit(True).alias("_has"))
    return (
        cover.join(c, ["tile_id", "row", "col"], "left")
        .groupBy("tile_id", "strip_id")
        .agg(F.count_if(F.col("_has")).alias("overlap"), F.count_if(F.col("_has").isNull()).alias("new_px"))
    )


def covered_rectangle(covered: DataFrame) -> DataFrame:
    return covered.groupBy("tile_id").agg(
        F.min("row").alias("cr0"), F.max("row").alias("cr1"), F.min("col").alias("cc0"), F.max("col").alias("cc1")
    )


def percent_filled(sizes: DataFrame, covered: DataFrame) -> DataFrame:
    """100 x covered / total cells per tile.

    ``sizes``: tile_id and cells, as ``lattice.tile_cells`` counts them from the tiles'
    bounds; ``covered`` holds cells of these lattices, repeats included.  Only covered cells are rows.
    """
    c = covered.select("tile_id", "row", "col").distinct().groupBy("tile_id").agg(F.count("*").alias("_n"))
    filled = F.coalesce("_n", F.lit(0))
    return sizes.select("tile_id", "cells").join(c, "tile_id", "left").select(
        "tile_id", "cells", filled.alias("filled"), (100.0 * filled / F.col("cells")).alias("percent_filled")
    )


def water_cells(tiles: DataFrame, land: DataFrame, res: float, buffer_px: int = 100, min_percent: float = 0.2) -> DataFrame:
    """Cells outside every coastline polygon, where they exceed the share that counts.

    The share follows from counts; only the lattices of tiles beyond it are made.
    """
    share = percent_filled(tile_cells(tiles, res, buffer_px), land)
    wet = share.filter(100.0 * (F.col("cells") - F.col("filled")) / F.col("cells") > min_percent).select("tile_id")
    cells = tile_lattice(tiles.join(wet, "tile_id", "left_semi"), res, buffer_px).select("tile_id", "row", "col")
    return cells.join(land.select("tile_id", "row", "col"), ["tile_id", "row", "col"], "left_anti")


def drop_complete_tiles(tiles: DataFrame, filled: DataFrame) -> DataFrame:
    """Skip tiles whose coverage share is already one."""
    done = filled.filter(F.col("filled") == F.col("cells")).select("tile_id")
    return tiles.join(done, "tile_id", "left_anti")


def redundant(counts: DataFrame, min_new: int = 1) -> Column:
    return F.col("new_px") < min_new


def split_redundant(candidates: DataFrame, min_new: int = 1) -> tuple[DataFrame, DataFrame]:
    """(kept, records of dropped strips with null alignment)."""
    nul = F.lit(None).cast("double")
    gone = candidates.filter(redundant(candidates, min_new)).withColumns({c: nul for c in ("rmse", "dz", "dx", "dy")})
    return candidates.filter(~redundant(candidates, min_new)), gone


# ---- ranking ----------------------------------------------------------------


def selection_key() -> Column:
    """Ascending sort key of the strip choice: rmse (null last), qc, most new cells, overlap, index."""
    return F.struct(
        F.col("rmse").isNull().alias("a"),
        F.coalesce("rmse", F.lit(0.0)).alias("b"),
        F.col("qc").alias("c"),
        (-F.col("new_px")).alias("d"),
        F.col("overlap").alias("e"),
        F.col("idx").alias("f"),
    )


def selection_rank(candidates: DataFrame) -> DataFrame:
    w = Window.partitionBy("tile_id").orderBy(selection_key())
    return candidates.withColumn("rank", F.row_number().over(w))


def best_per_tile(candidates: DataFrame) -> DataFrame:
    """First in rank per tile, as one combinable aggregation."""
    cols = [c for c in candidates.columns if c != "tile_id"]
    return candidates.groupBy("tile_id").agg(F.min_by(F.struct(*cols), selection_key()).alias("_b")).select("tile_id", "_b.*")


def review_score() -> Column:
    """Share of new cells in percent plus the inverse squared alignment error."""
    gain = 100.0 * F.col("new_px") / F.col("cells")
    return F.coalesce(gain, F.lit(0.0)) + F.coalesce(1.0 / (F.col("avg_rmse") * F.col("avg_rmse")), F.lit(0.0))


def review_rank(candidates: DataFrame, skip: int = 0) -> DataFrame:
    w = Window.partitionBy("tile_id").orderBy(F.col("score").desc(), F.col("idx"))
    d = candidates.withColumn("score", review_score()).withColumn("rank", F.row_number().over(w))
    return d.filter(F.col("rank") > skip)


def anchor_order(registered: DataFrame) -> DataFrame:
    """Registered strips per tile by 75th-percentile residual."""
    w = Window.partitionBy("tile_id").orderBy(F.col("p75").asc_nulls_last(), F.col("idx"))
    return registered.filter("p75 is not null").withColumn("seq", F.row_number().over(w))


def reset_last_reviewed(qc: DataFrame, group: str, order: str) -> DataFrame:
    """The last reviewed row of each store goes back to unreviewed with no masks."""
    last = qc.filter("flag <> 0").groupBy(group).agg(F.max(order).alias("_last"))
    d = qc.join(last, group, "left")
    hit = F.coalesce(F.col(order) == F.col("_last"), F.lit(False))
    none = F.array().cast("array<array<struct<x:double,y:double>>>")
    out = d.withColumn("flag", F.when(hit, 0).otherwise(F.col("flag")))
    if "masks" in qc.columns:
        out = out.withColumn("masks", F.when(hit, none).otherwise(F.col("masks")))
    return out.drop("_last")


def cluster_of_merges(merges: DataFrame) -> DataFrame:
    """Cluster label along the merge order: each start without alignment opens the next.

    ``merges``: tile_id, seq, strip_id, anchored, rmse (NULL = independent start).
    """
    w = Window.partitionBy("tile_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    starts = F.sum(F.when(F.col("rmse").isNull() & ~F.col("anchored"), 1).otherwise(0)).over(w)
    return merges.withColumn("cluster", F.when(F.col("anchored"), 1).otherwise(1 + starts).cast("int"))


def cluster_cells(cover: DataFrame, merges: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """Each covered cell takes the cluster of the first strip that covers it.

    ``of`` (strip_id, outline_id) tells that ``cover`` has the cells of outlines, which strips share.
    """
    lab = cluster_of_merges(merges).select("tile_id", "strip_id", "seq", "cluster")
    unit = "strip_id"
    if of is not None:
        unit = "outline_id"
        lab = lab.join(of, "strip_id").groupBy("tile_id", unit).agg(F.min("seq").alias("seq"), F.min_by("cluster", "seq").alias("cluster"))
    return (
        cover.join(lab, ["tile_id", unit])
        .groupBy("tile_id", "row", "col")
        .agg(F.min_by("cluster", "seq").alias("cluster"))
    )


def cluster_starts(merges: DataFrame) -> DataFrame:
    """Number of strips per tile with offset exactly zero."""
    zero = (F.col("dz") == 0) & (F.col("dx") == 0) & (F.col("dy") == 0)
    return merges.groupBy("tile_id").agg(F.count_if(zero).alias("clusters"))


def replay_reviews(sizes: DataFrame, cover: DataFrame, decisions: DataFrame, masked: DataFrame) -> DataFrame:
    """Coverage per tile after recorded decisions: flags 1-3 add (3 minus its masks), 4-5 drop."""
    ok = decisions.filter(F.col("flag").between(1, 3)).select("strip_id", "flag")
    c = cover.join(ok, "strip_id")
    hit = masked.select("tile_id", "strip_id", "row", "col", F.lit(True).alias("_m"))
    c = c.join(hit, ["tile_id", "strip_id", "row", "col"], "left").filter((F.col("flag") != 3) | F.col("_m").isNull())
    return percent_filled(sizes, c)


# ---- scene order ------------------------------------------------------------


ROUNDS_OF_A_JOB = 8  # scenes that a strip takes between two tables


def _take_scene(d: DataFrame, segments: bool) -> DataFrame:
    """Every strip takes its next open scene; the strip's state (``_u..``) is on each of its rows.

    One window by strip serves a round, so rounds in a row need no further shuffle or sort.
    """
    box = ["xmin", "xmax", "ymin", "ymax"]
    mine = Window.partitionBy("strip_id")
    is_open, begun = F.col("_open"), F.col("_usegment") > 0
    scene = F.struct("_id", "seq", *box)
    first = lambda ok, *key: F.min_by(scene, F.when(ok, F.struct(*key, "seq", "_id"))).over(mine)
    most, least = (lambda c, f=f: f(F.when(is_open, F.col(c))).over(mine) for f in (F.max, F.min))
    area = F.when(begun, pg.box_overlap(*[F.col(f"_u{c}") for c in box], *[F.col(c) for c in box]))
    d = d.withColumn("_area", area)
    d = d.withColumns({
        "_wide": (most("xmax") - least("xmin")) >= (most("ymax") - least("ymin")),
        "_near": first(is_open & (F.col("_area") > 0), (-F.col("_area")).alias("a")),
        "_x": first(is_open, "xmin"), "_y": first(is_open, "ymin"),
    })
    d = d.withColumns({"_fresh": F.col("_near").isNull(), "_got": F.coalesce("_near", F.when(F.col("_wide"), F.col("_x")).otherwise(F.col("_y")))})
    got, fresh = F.col("_got"), F.col("_fresh")
    goes_on = F.lit(True) if segments else ~(begun & fresh)
    segment = F.when(fresh, F.col("_usegment") + 1).otherwise(F.col("_usegment"))
    position = F.when(fresh, 1).otherwise(F.col("_uposition") + 1)
    picked = is_open & goes_on & (F.col("_id") == got["_id"])
    grown = {f"_u{c}": F.when(fresh, got[c]).otherwise((F.least if "min" in c else F.greatest)(got[c], F.col(f"_u{c}"))) for c in box}
    d = d.withColumns({
        "segment": F.when(picked, segment).otherwise(F.col("segment")), "position": F.when(picked, position).otherwise(F.col("position")),
        "_usegment": segment, "_uposition": position, **grown, "_open": is_open & goes_on & ~F.col("seq").eqNullSafe(got["seq"]),
    })
    return d.drop("_area", "_wide", "_near", "_x", "_y", "_fresh", "_got")


def order_scenes(scenes: DataFrame, segments: bool = True) -> DataFrame:
    """Order scenes of every strip by overlap with the growing footprint.

    ``scenes``: strip_id, seq, xmin, xmax, ymin, ymax.  All strips take their
    next scene in each round.  With ``segments`` a strip that hits a gap starts
    its next segment with the remaining scenes; otherwise they are left out.
    Returns strip_id, seq, segment, position.
    """
    box = ["xmin", "xmax", "ymin", "ymax"]
    nul = F.lit(None)
    # constants join the rows after the shuffle that brings strips together
    left = scenes.filter("strip_id is not null").select("strip_id", "seq", *box).repartition("strip_id")
    left = left.select(
        "strip_id", "seq", *box, F.monotonically_increasing_id().alias("_id"), F.lit(True).alias("_open"),
        *[nul.cast("int").alias(c) for c in ("segment", "position")], *[F.lit(0).alias(c) for c in ("_usegment", "_uposition")],
        *[nul.cast("double").alias(f"_u{c}") for c in box],
    )
    out = None
    while True:
        for _ in range(ROUNDS_OF_A_JOB):
            left = _take_scene(left, segments)
        left = cut(left.filter("_open or segment is not null"))
        chosen = left.filter("segment is not null").select("strip_id", "seq", "segment", "position")
        out = chosen if out is None else out.unionByName(chosen)
        left = left.filter("_open")
        if left.isEmpty():
            return out
