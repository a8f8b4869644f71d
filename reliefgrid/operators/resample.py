"""Shift-resampling: a constant horizontal offset per raster.

The fractional part of a shift is one number per raster, so bilinear and cubic
interpolation become an integer move plus weighted neighbours along each axis.
Offsets carry a ``sense``: subtracting (dz, dx, dy) moves the raster's
coordinates to x - dx, y - dy and its values to z - dz.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import along_col, along_row, blocked, core, with_halo


def negate(df: DataFrame, names: Sequence[str] = ("dz", "dx", "dy")) -> DataFrame:
    """Convert between offsets to add and offsets to subtract."""
    return df.withColumns({n: -F.col(n) for n in names})


def source_position(df: DataFrame, res: float, dx: str = "dx", dy: str = "dy") -> DataFrame:
    """Integer and fractional part of where each lattice cell samples the raster."""
    sc, sr = F.col(dx) / res, -F.col(dy) / res
    return df.withColumns(
        {
            "_ic": F.floor(sc).cast("int"),
            "_fc": sc - F.floor(sc),
            "_ir": F.floor(sr).cast("int"),
            "_fr": sr - F.floor(sr),
        }
    )


def _ahead(v: str, k: int, w, axis: str) -> Column:
    """Value k cells further on, only if that cell exists at the right index."""
    if k == 0:
        return F.col(v)
    f = F.lead if k > 0 else F.lag
    return F.when(f(axis, abs(k)).over(w) == F.col(axis) + k, f(v, abs(k)).over(w))


# A rule takes ``p(k)``, the value k cells further on if that cell exists, ``there(k)``, whether it does, and the fraction.


def _linear(p, there, f: Column) -> Column:
    return F.when(f == 0, p(0)).otherwise((1 - f) * p(0) + f * p(1))


def _cubic(p, there, f: Column) -> Column:
    """Four-point convolution (a = -1/2); at the rim the outer point is extrapolated."""
    p0, p1, far, near = p(0), p(1), p(2), p(-1)
    pm = F.when(there(-1), near).otherwise(3 * p0 - 3 * p1 + far)
    pp = F.when(there(2), far).otherwise(3 * p1 - 3 * p0 + near)
    t = (
        p0
        + 0.5 * f * (p1 - pm)
        + f * f * (pm - 2.5 * p0 + 2 * p1 - 0.5 * pp)
        + f * f * f * (1.5 * (p0 - p1) + 0.5 * (pp - pm))
    )
    return F.when(f == 0, p0).otherwise(t)


def _nearest(p, there, f: Column) -> Column:
    return F.when(f < 0.5, p(0)).otherwise(p(1))


RULES = {"linear": _linear, "cubic": _cubic, "nearest": _nearest}
STEPS = {_linear: (1,), _cubic: (-1, 1, 2), _nearest: (1,)}


def _pass_along(d, w, axis: str, frac: str, bands: dict) -> DataFrame:
    """One axis of (column, rule) by output name; a neighbour is read once, as a window that a plan names twice runs twice."""
    step = lambda c, k: F.lead(c, k).over(w) if k > 0 else F.lag(c, -k).over(w)
    at = {k: f"_at_{i}" for i, k in enumerate(sorted({k for _, rule in bands.values() for k in STEPS[rule]}))}
    of = {(v, k): f"_p_{i}" for i, (v, k) in enumerate((v, k) for v, rule in bands.values() for k in STEPS[rule])}
    d = d.withColumns({**{n: step(axis, k) for k, n in at.items()}, **{n: step(v, k) for (v, k), n in of.items()}})
    there = lambda k: F.coalesce(F.col(at[k]) == F.col(axis) + k, F.lit(False))
    value = lambda v: lambda k: F.when(there(k), F.col(of[v, k])) if k else F.col(v)
    return d.withColumns({out: rule(value(v), there, F.col(frac)) for out, (v, rule) in bands.items()}).drop(*at.values(), *of.values())


def _pass_all(d, keys, bands: dict) -> DataFrame:
    """Row pass, then column pass of (output, rule) by band: one sort each."""
    d = _pass_along(d, along_row(keys), "col", "_fc", {f"_h_{b}": (b, rule) for b, (_, rule) in bands.items()})
    d = _pass_along(d, along_col(keys), "row", "_fr", {out: (f"_h_{b}", rule) for b, (out, rule) in bands.items()})
    return d.drop(*(f"_h_{b}" for b in bands))


def _pass_two(d, keys, bands: dict[str, str], rule):
    """Row pass then column pass of an interpolation rule for several bands."""
    return _pass_all(d, keys, {b: (out, rule) for b, out in bands.items()})


def moved_cells(px: DataFrame, keys: Sequence[str], shifts: DataFrame, res: float) -> DataFrame:
    """Attach each raster's shift and move its cells by the integer part.

    Rasters without a shift row keep their place.
    """
    # renamed: a raster may carry a day-number band called dy
    s = source_position(shifts, res).select(*keys, F.col("dz").alias("_dz"), "_ic", "_fc", "_ir", "_fr")
    d = px.join(s, list(keys), "left").na.fill({"_dz": 0.0, "_ic": 0, "_fc": 0.0, "_ir": 0, "_fr": 0.0})
    return d.withColumn("row", (F.col("row") - F.col("_ir")).cast("int")).withColumn(
        "col", (F.col("col") - F.col("_ic")).cast("int")
    )


def shift_resample(
    px: DataFrame,
    keys: Sequence[str],
    shifts: DataFrame,
    res: float,
    bands: dict[str, str],
    vertical: Sequence[str] = ("z",),
) -> DataFrame:
    """Resample every raster to the lattice after subtracting its (dz, dx, dy).

    ``bands`` maps a column to 'linear', 'cubic' or 'nearest'.  Bands named in
    ``vertical`` also lose dz.  A sample with any missing weighted neighbour is
    NULL; nearest and cubic bands treat 0/false as given by the caller.
    """
    halo = 3 if "cubic" in bands.values() else 1
    d = moved_cells(px, keys, shifts, res)
    for b in vertical:
        if b in bands:
            d = d.withColumn(b, F.col(b) - F.col("_dz"))
    d = with_halo(d, keys, halo)
    d = core(_pass_all(d, blocked(keys), {b: (f"_o_{b}", RULES[rule]) for b, rule in bands.items()}), halo)
    keep = [c for c in px.columns if c not in bands]
    return d.select(*keep, *[F.col(f"_o_{b}").alias(b) for b in bands])


def vertical_shift(px: DataFrame, keys: Sequence[str], shifts: DataFrame) -> DataFrame:
    """Offsets without a horizontal part need no resampling."""
    return (
        px.join(shifts.filter((F.col("dx") == 0) & (F.col("dy") == 0)).select(*keys, "dz"), list(keys))
        .withColumn("z", F.col("z") - F.col("dz"))
        .drop("dz")
    )


def regrid_to_integer(px: DataFrame, keys: Sequence[str], origins: DataFrame, res: float) -> DataFrame:
    """Move rasters whose origin (x0, y0) is not a whole number of cells.

    The integer grid starts at the first whole cell inside the raster, so a cell
    samples the raster at a constant fraction of a cell further on.
    """
    # sense: the lattice cell is ahead of the raster cell by the missing fraction
    gap_x = F.ceil(F.col("x0") / res) * res - F.col("x0")
    gap_y = F.col("y0") - F.floor(F.col("y0") / res) * res
    shifts = origins.select(*keys, F.lit(0.0).alias("dz"), gap_x.alias("dx"), (-gap_y).alias("dy"))
    nulls = px.withColumn("ortho", F.when(F.col("ortho") != 0, F.col("ortho").cast("double"))).withColumn(
        "mt", F.col("mt").cast("int")
    )
    out = shift_resample(nulls, keys, shifts, res, {"z": "linear", "mt": "nearest", "ortho": "cubic"})
    return finish_bands(out)


def finish_bands(px: DataFrame) -> DataFrame:
    """Nearest masks and cubic ortho back to boolean and 16-bit with 0 = nodata."""
    ortho = F.greatest(F.lit(-32768.0), F.least(F.lit(32767.0), F.round("ortho")))
    return px.withColumn("mt", F.coalesce(F.col("mt") > 0, F.lit(False))).withColumn(
        "ortho", F.coalesce(ortho, F.lit(0.0)).cast("smallint")
    )


def resample_bands(px: DataFrame, keys: Sequence[str], shifts: DataFrame, res: float) -> DataFrame:
    """Elevation bilinear, match mask nearest, ortho cubic: the strip/scene triple."""
    ready = px.withColumn("ortho", F.when(F.col("ortho") != 0, F.col("ortho").cast("double"))).withColumn(
        "mt", F.col("mt").cast("int")
    )
    return finish_bands(shift_resample(ready, keys, shifts, res, {"z": "linear", "mt": "nearest", "ortho": "cubic"}))


def move_nearest(px: DataFrame, keys: Sequence[str], shifts: DataFrame, res: float, bands: Sequence[str]) -> DataFrame:
    """Nearest-neighbour shift as a plain index move (a half cell goes to the next one)."""
    s = shifts.select(*keys, F.floor(F.col("dx") / res + 0.5).cast("int").alias("_ic"), F.floor(-F.col("dy") / res + 0.5).cast("int").alias("_ir"))
    # the cell whose sample position rounds to this one: position frac 1/2 rounds up
    d = px.join(s, list(keys))
    return d.select(*keys, (F.col("row") - F.col("_ir")).cast("int").alias("row"), (F.col("col") - F.col("_ic")).cast("int").alias("col"), *bands)


# fixed values: interpolation of each tile band when a 3-D offset is applied
BAND_RULES = {
    "z": "linear", "z_mad": "linear", "tmin": "linear", "tmax": "linear", "ortho": "cubic",
    "mt": "nearest", "dy": "nearest", "n": "nearest", "nmt": "nearest",
}


def apply_offsets(px: DataFrame, shifts: DataFrame, res: float) -> DataFrame:
    """Each cluster of each tile moved by its own offset (to subtract), cells of others ignored.

    ``px``: tile_id, cluster, row, col and any bands of ``BAND_RULES``;
    ``shifts``: tile_id, cluster, dz, dx, dy.  Clusters without offsets are
    dropped.  One row per (tile, cluster, cell); smooth and nearest bands may
    come in separate rows and are brought together by ``combine_clusters``.
    """
    keys = ["tile_id", "cluster"]
    ok = shifts.filter("dz is not null and dx is not null and dy is not null").select(*keys, "dz", "dx", "dy")
    mine = px.join(ok.select(*keys), keys, "left_semi")
    smooth = {b: r for b, r in BAND_RULES.items() if b in px.columns and r != "nearest"}
    near = [b for b, r in BAND_RULES.items() if b in px.columns and r == "nearest"]
    src = mine.select(*keys, "row", "col", *smooth)
    if "ortho" in smooth:
        src = src.withColumn("ortho", F.when(F.col("ortho") != 0, F.col("ortho").cast("double")))
    out = shift_resample(src, keys, ok, res, smooth)
    for b in ("ortho", "tmin", "tmax"):
        if b in smooth:
            hi = 32767.0 if b == "ortho" else 65535.0
            lo = -32768.0 if b == "ortho" else 0.0
            v = F.greatest(F.lit(lo), F.least(F.lit(hi), F.round(b)))
            out = out.withColumn(b, F.coalesce(v, F.lit(0.0)).cast("int"))
    if near:
        out = out.unionByName(move_nearest(mine, keys, ok, res, near), allowMissingColumns=True)
    return out


def combine_clusters(moved: DataFrame) -> DataFrame:
    """One row per tile cell: elevation of the first cluster with data, matches joined,
    ortho and day number of the first cluster where they are not zero."""
    first = {"z": F.col("z")} if "z" in moved.columns else {}
    for b in ("z_mad",):
        if b in moved.columns:
            first[b] = F.col(b)
    for b in ("ortho", "dy", "n", "nmt", "tmin", "tmax"):
        if b in moved.columns:
            first[b] = F.when(F.col(b) != 0, F.col(b))
    aggs = []
    for b, v in first.items():
        top = F.min_by(F.when(v.isNotNull(), v), F.when(v.isNotNull(), F.col("cluster")))
        aggs.append((top if b.startswith("z") else F.coalesce(top, F.lit(0))).alias(b))
    if "mt" in moved.columns:
        aggs.append(F.coalesce(F.bool_or("mt"), F.lit(False)).alias("mt"))
    return moved.groupBy("tile_id", "row", "col").agg(*aggs)
