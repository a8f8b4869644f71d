"""Bad-pixel masks built from kernels, components and hulls.

Each function takes the pixel tables of many rasters and adds one boolean
column (true = good unless said otherwise).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .components import drop_small, fill_holes, fill_small_gaps
from .hulls import inside_hull
from .kernels import (
    _box_sum, _dilate, _gradient, _mean, _run, _slope_deviation, density_map, dilate, erode, local_entropy,
    local_std, moving_range, range_scaled, residual_topography, to_bytes,
)
from .lattice import coarsen, enlarge_nearest
from .merge import fill_voids


def density_mask(px, keys: Sequence[str], mask: Column, n: int = 21, pmin: float = 0.3, amin: int = 1000, amax: int = 10000, out: str = "good"):
    """Dense areas without small clusters and with small gaps filled.

    A raster where nothing is dense stays all false; gaps are not filled there.
    """
    d = density_map(px, keys, mask, n, "_p").withColumn("_m", F.col("_p") >= pmin)
    d = drop_small(d, keys, F.col("_m"), amin, "_m2")
    d = fill_small_gaps(d, keys, F.col("_m2"), amax, "_m3")
    any_ = d.groupBy(*keys).agg(F.bool_or("_m").alias("_any"))
    return d.join(any_, list(keys)).withColumn(out, F.col("_m3") & F.col("_any")).drop("_p", "_m", "_m2", "_m3", "_any")


def edge_mask(px, keys: Sequence[str], mask: Column, n: int = 21, pmin: float = 0.8, amin: float = 1000, crop: int | None = None,
              also: Column | None = None, out: str = "edge_ok"):
    """Hull of the dense area, cut back by ``crop``."""
    d = density_map(px, keys, mask, n, "_p")
    m = F.col("_p") >= pmin
    d = d.withColumn("_m", m | F.coalesce(also, F.lit(False)) if also is not None else m)
    d = fill_holes(d, keys, F.col("_m"), "_f")
    d = drop_small(d, keys, F.col("_f"), int(-(-amin // 1)), "_k")
    d = inside_hull(d, keys, F.col("_k"), "_h")
    return erode(d, keys, F.col("_h"), crop or n, out).drop("_p", "_m", "_f", "_k", "_h")


def data_mask(px, keys: Sequence[str], mt: str = "mt", edge_ok: str = "edge_ok", out: str = "data_ok", **params):
    """Density mask of the matches that survive the edge mask."""
    return density_mask(px, keys, F.col(mt) & F.col(edge_ok), out=out, **params)


def edge_slope_mask(px, keys: Sequence[str], z: str = "z", dx: float = 1.0, out: str = "edge_ok"):
    """Hull of the area whose mean slope is below 1 and not near steep edges."""

    def fn(d, k):
        d = _gradient(d, k, z, dx, "_gc", "_gr")
        d = _mean(d, k, F.hypot("_gc", "_gr"), 5, "_ms")
        d = _dilate(d, k, F.col("_ms") > 1, 13, "_steep")
        return d.withColumn("_m", F.coalesce(F.col("_ms") < 1, F.lit(False)) & ~F.col("_steep")).drop("_gc", "_gr", "_ms", "_steep")

    d = _run(px, keys, 20, None, fn)
    d = fill_holes(d, keys, F.col("_m"), "_f")
    d = drop_small(d, keys, F.col("_f"), 1000, "_k")
    return inside_hull(d, keys, F.col("_k"), out).drop("_m", "_f", "_k")


def mask_8m(px, keys: Sequence[str], dx: float = 8.0, out: str = "good"):
    """Edge slope mask, density mask, small leftovers dropped."""
    d = edge_slope_mask(px, keys, "z", dx, "_e").withColumn("_e", F.col("_e") & F.col("z").isNotNull())
    d = density_mask(d, keys, F.col("_e"), 21, 0.90, 1000, 1000, "_d")
    return drop_small(d, keys, F.col("_d"), 500, out).drop("_e", "_d")


def grow_to_fixpoint(px, keys: Sequence[str], seed: Column, allowed: Column, n: int = 11, out: str = "grown"):
    """Repeat: dilate by n, keep allowed cells; until no raster's mask changes.

    Rasters whose count is stable leave the working set, so a round costs only
    what still grows.
    """
    keys = list(keys)
    base = cut(px.withColumn("_ok", F.coalesce(allowed, F.lit(False))).withColumn("_g", F.coalesce(seed, F.lit(False))))
    live, settled = base.select(*keys, "row", "col", "_ok", "_g"), []
    # the first round is never compared with the seeds: it also drops those not allowed
    counts = live.select(*keys).distinct().withColumn("_n", F.lit(-1).cast("long"))
    while True:  # masks only lose or gain cells a finite raster has, so every raster settles
        nxt = dilate(live, keys, F.col("_g"), n, "_d").select(*keys, "row", "col", "_ok", (F.col("_d") & F.col("_ok")).alias("_g"))
        nxt = cut(nxt)
        now = nxt.groupBy(*keys).agg(F.count_if("_g").alias("_m"))
        moved = cut(now.join(counts, keys).select(*keys, F.col("_m").alias("_n"), (F.col("_m") != F.col("_n")).alias("_more")))
        settled.append(nxt.join(moved.filter("not _more"), keys, "left_semi"))
        live = nxt.join(moved.filter("_more"), keys, "left_semi")
        counts = moved.filter("_more").select(*keys, "_n")
        if counts.limit(1).count() == 0:
            break
    done = settled[0]
    for s in settled[1:]:
        done = done.unionByName(s)
    done = done.select(*keys, "row", "col", F.col("_g").alias(out))
    return base.drop("_ok", "_g").join(done, [*keys, "row", "col"])


def cloud_mask(px, keys: Sequence[str], dx: float = 8.0, out: str = "good", edge: bool = True):
    """Slope/density cloud mask: crop edges, seed on rough and thin cells, grow, tidy."""
    d = px
    if edge:
        d = edge_slope_mask(px, keys, "z", dx, "_e").withColumn("z0", F.col("z"))
        d = d.withColumn("z", F.when(F.col("_e"), F.col("z"))).drop("_e")
    else:
        d = d.withColumn("z0", F.col("z"))

    def fn(b, k):
        # slopes come from the whole raster, then lose the cells outside the edge mask
        b = _gradient(b, k, "z0", dx, "_gc", "_gr")
        b = b.withColumns({c: F.when(F.col("z").isNotNull(), F.col(c)) for c in ("_gc", "_gr")})
        b = _slope_deviation(b, k, "_gc", "_gr", 5, "_sd")
        b = b.withColumn("_m1", F.coalesce(F.col("mt"), F.lit(False)).cast("int"))
        return _box_sum(b, k, "_m1", 5, "_p").drop("_gc", "_gr", "_m1")

    d = cut(_run(d, keys, 6, None, fn))
    seed = (F.col("_sd") > 0.75) & (F.col("_p") < 25) & F.col("z").isNotNull()
    d = drop_small(d, keys, seed, 10, "_seed")
    background = F.col("z").isNull() | F.col("_sd").isNull()
    d = grow_to_fixpoint(d, keys, F.col("_seed"), ~(background | (F.col("_sd") < 0.1)), 11, "_bad")
    d = fill_small_gaps(d, keys, F.col("_bad"), 5000, "_bad2")
    d = dilate(d, keys, F.col("z").isNull(), 5, "_rim").withColumn("_bad3", F.col("_bad2") | F.col("_rim"))
    d = fill_small_gaps(d, keys, F.col("_bad3"), 5000, "_bad4")
    return d.withColumn(out, ~F.col("_bad4")).withColumn("z", F.col("z0")).drop("z0", "_sd", "_p", "_seed", "_bad", "_bad2", "_rim", "_bad3", "_bad4")


def water_mask(px, keys: Sequence[str], ortho: str = "ortho", factor: int = 1, corrected: str = "wv_correct", min_px: int = 1000,
               threshold: float = 0.2, out: str = "water"):
    """Low-entropy areas of the ortho image (true = water); ``factor`` cells per 8 m cell."""
    keys = list(keys)
    d = px.select(*keys, "row", "col", F.col(ortho).cast("double").alias("_o"), F.col(corrected).cast("int").alias("_w"))
    if factor != 1:
        d = coarsen(d, keys, ["_o", "_w"], factor)
    d = moving_range(d, keys, "_o", 5, "_r")
    d = range_scaled(d, keys, "_r", "_scaled")
    d = d.withColumn("_b", F.when(F.col("_w") > 0, F.col("_scaled")).otherwise(to_bytes(F.col("_r"))))
    d = local_entropy(d, keys, "_b", 5, "_j")
    d = drop_small(d, keys, F.col("_j") < threshold, min_px, "_m")
    d = fill_small_gaps(d, keys, F.col("_m"), min_px, "_m2").select(*keys, "row", "col", F.col("_m2").alias("_m"))
    if factor != 1:
        d = enlarge_nearest(d, factor)
    return px.join(d, [*keys, "row", "col"], "left").withColumn(out, F.coalesce("_m", F.lit(False)) & (F.col(ortho) != 0)).drop("_m")


def topography_noise(px, keys: Sequence[str], z: str = "z", ref: str = "zr", n: int = 5):
    """Adds ``spread``, ``ref_spread`` and ``noisy``: excess residual topography against a reference."""
    d = residual_topography(px, keys, z, n, "_a")
    d = residual_topography(d, keys, ref, n, "_b")
    d = local_std(d, keys, "_a", n, "spread")
    d = local_std(d, keys, "_b", n, "ref_spread")
    b = F.when(F.col("ref_spread") > 0, F.greatest(F.lit(0.01), F.col("ref_spread")))
    excess = F.col("spread") - b
    return d.withColumn("ref_spread", b).withColumn("noisy", (excess / b >= 10) & (excess > 0.5)).drop("_a", "_b")


def topography_mask(px, keys: Sequence[str], z: str = "z", ref: str = "zr", min_px: int = 10000, out: str = "good"):
    """Cells whose residual topography agrees with the reference, small clusters dropped."""
    keys = list(keys)
    d = topography_noise(px, keys, z, ref)
    flag = F.when(F.col("spread").isNull() | (F.col("spread") == 0), F.lit(None).cast("double")).otherwise(
        F.coalesce(F.col("noisy"), F.lit(False)).cast("double")
    )
    d = cut(d.withColumn("_f", F.when(F.col(z).isNull(), 0.0).otherwise(flag)))
    filled = fill_voids(d, keys, "_f").withColumnRenamed("_f", "_bad")
    d = d.join(filled, [*keys, "row", "col"]).withColumn("_ok", ((F.col("_bad") < 0.01) | F.col(ref).isNull()) & F.col(z).isNotNull())
    return drop_small(d, keys, F.col("_ok"), min_px, out).drop("_f", "_bad", "_ok", "spread", "ref_spread", "noisy")
