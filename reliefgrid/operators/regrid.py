"""Resampling between lattices of any ratio.

Each target cell lies between two source columns and two source rows; which, and how
far between, varies from cell to cell.  Source cells are dealt into blocks once; along
an axis a cell takes its neighbours by windows, and the targets that lie between it and
the next cell are made beside it with their own weights.  So one shuffle serves both
axes, and nothing is made but the targets.

Shrinking by a kernel as wide as the target's cells is a weighted sum instead: each cell
adds to the few targets around it, and partial sums are combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import along_row, blocked, core, with_halo
from .resample import _ahead

REACH = 3


def _neighbours(v: str, w, axis: str, rule: str) -> dict[str, Column]:
    """The cells that targets from this cell to the next one are made of; at the rim the cubic's outer ones are extrapolated."""
    p0, p1 = F.col(v), _ahead(v, 1, w, axis)
    if rule != "cubic":
        return {"_0": p0, "_1": p1}
    before, after = F.lag(axis).over(w) == F.col(axis) - 1, F.lead(axis, 2).over(w) == F.col(axis) + 2
    near, far = _ahead(v, -1, w, axis), _ahead(v, 2, w, axis)
    first = F.when(F.coalesce(before, F.lit(False)), near).otherwise(3 * p0 - 3 * p1 + far)
    last = F.when(F.coalesce(after, F.lit(False)), far).otherwise(3 * p1 - 3 * p0 + near)
    return {"_m": first, "_0": p0, "_1": p1, "_p": last}


def _between(v: str, rule: str, f: Column) -> Column:
    p0, p1 = F.col(f"{v}_0"), F.col(f"{v}_1")
    if rule == "nearest":
        return F.when(f < 0.5, p0).otherwise(p1)
    if rule == "linear":
        return F.when(f == 0, p0).otherwise((1 - f) * p0 + f * p1)
    pm, pp = F.col(f"{v}_m"), F.col(f"{v}_p")
    t = p0 + f * (0.5 * (p1 - pm) + f * (pm - 2.5 * p0 + 2 * p1 - 0.5 * pp + f * (1.5 * (p0 - p1) + 0.5 * (pp - pm))))
    return F.when(f == 0, p0).otherwise(t)


def _along(d: DataFrame, w, axis: str, target: str, start: Column, ratio: Column, rules: dict[str, str], keep: Sequence[str]) -> DataFrame:
    """The targets of one axis: number t lies ``start + t * ratio`` source cells from source cell 0."""
    parts = {f"{v}{s}": c for v, r in rules.items() for s, c in _neighbours(v, w, axis, r).items()}
    d = d.select(*keep, axis, start.alias("_s"), ratio.alias("_q"), *[c.alias(n) for n, c in parts.items()])
    # one target more on either side than rounding can miss; the cell that a target belongs to is asked in one place
    lo, hi = F.floor((F.col(axis) - F.col("_s")) / F.col("_q")) - 1, F.ceil((F.col(axis) + 1 - F.col("_s")) / F.col("_q")) + 1
    d = d.select("*", F.explode(F.sequence(lo.cast("int"), hi.cast("int"))).alias(target))
    # a target within rounding of a cell lies on it, so that the rim's last one is not lost
    at = F.col("_s") + F.col(target) * F.col("_q")
    at = F.when(F.abs(at - F.round(at)) < 1e-9, F.round(at)).otherwise(at)
    d = d.withColumn("_at", at).filter(F.floor("_at") == F.col(axis))
    f = F.col("_at") - F.col(axis)
    # the last cell has no next one: only a target right on it is inside
    inside = (f == 0) | F.coalesce(F.col("_next"), F.lit(False)) if "_next" in keep else F.lit(True)
    return d.filter(inside).select(*[c for c in keep if c != "_next"], axis, target, *[_between(v, r, f).alias(v) for v, r in rules.items()])


def resample(px: DataFrame, keys: Sequence[str], lattices: DataFrame, bands: dict[str, str]) -> DataFrame:
    """Every raster's bands on a lattice of its own.

    ``lattices`` has per raster where its targets lie, in source cells: target column c
    at col0 + c * step and target row r at row0 + r * step.  ``bands`` maps a column to
    'linear', 'cubic' or 'nearest' (halves go to the next cell).  Targets outside the
    source's cells aren't made; a target with a missing neighbour of any weight is NULL.
    Rasters are whole lattices with nodata cells as rows; those without a lattice vanish.
    """
    keys = list(keys)
    kk = blocked(keys)
    to = lattices.select(*keys, *[F.col(c).cast("double").alias(f"_{c}") for c in ("row0", "col0", "step")])
    d = with_halo(px.select(*keys, "row", "col", *bands).join(to, keys), keys, REACH)
    wr = along_row(kk)
    d = d.withColumn("_next", F.coalesce(F.lead("col").over(wr) == F.col("col") + 1, F.lit(False)))
    d = _along(d, wr, "col", "_tc", F.col("_col0"), F.col("_step"), bands, [*kk, "row", "_row0", "_step", "_next"])
    wc = Window.partitionBy(*kk, "_tc").orderBy("row")
    d = d.withColumn("_next", F.coalesce(F.lead("row").over(wc) == F.col("row") + 1, F.lit(False)))
    d = _along(d, wc, "row", "_tr", F.col("_row0"), F.col("_step"), bands, [*kk, "col", "_tc", "_next"])
    return core(d, REACH).select(*keys, F.col("_tr").alias("row"), F.col("_tc").alias("col"), *bands)


def mirrored(px: DataFrame, keys: Sequence[str], by: int) -> DataFrame:
    """Whole rasters with their ``by`` outer rows and columns mirrored about the rim, again and again where a raster is narrower."""
    keys = list(keys)
    size = px.groupBy(*keys).agg(*[f(a).alias(f"_{a}{i}") for a in ("row", "col") for i, f in enumerate((F.min, F.max))])
    d = px.join(size, keys)
    for axis in ("row", "col"):
        n = F.col(f"_{axis}1") - F.col(f"_{axis}0") + 1
        i = F.col(axis) - F.col(f"_{axis}0")
        # places of the endless mirror image that show this cell: i and -1 - i, every 2n
        turns = F.sequence(F.floor((-by - n) / (2 * n)), F.ceil((n + by + n) / (2 * n)))
        places = F.flatten(F.transform(turns, lambda t: F.array(i + 2 * n * t, -1 - i + 2 * n * t)))
        shown = F.filter(places, lambda p: (p >= -by) & (p < n + by))
        d = d.withColumn(axis, F.explode(shown)).withColumn(axis, (F.col(axis) + F.col(f"_{axis}0")).cast("int"))
    return d.select(*px.columns)


def enlarge_cubic(px: DataFrame, keys: Sequence[str], value: str, k: int) -> DataFrame:
    """k-fold enlargement by four-point cubic convolution, cell centres aligned, the rim mirrored."""
    keys = list(keys)
    size = px.groupBy(*keys).agg(F.min("row").alias("_r0"), F.max("row").alias("_r1"), F.min("col").alias("_c0"), F.max("col").alias("_c1"))
    # a block's middle lies on its cell: target t of the raster is at (t + 1/2) / k - 1/2
    first = F.lit(0.5 / k - 0.5)
    to = px.select(*keys).distinct().select(*keys, first.alias("row0"), first.alias("col0"), F.lit(1.0 / k).alias("step"))
    d = resample(mirrored(px.select(*keys, "row", "col", value), keys, 2), keys, to, {value: "cubic"}).join(size, keys)
    own = F.col("row").between(F.col("_r0") * k, F.col("_r1") * k + k - 1) & F.col("col").between(F.col("_c0") * k, F.col("_c1") * k + k - 1)
    return d.filter(own).select(*keys, "row", "col", value)


def _cubic_weight(x: Column) -> Column:
    """The cubic convolution kernel (a = -1/2) at a distance."""
    a = F.abs(x)
    return F.when(a <= 1, (1.5 * a - 2.5) * a * a + 1).when(a < 2, ((-0.5 * a + 2.5) * a - 4) * a + 2).otherwise(0.0)


def shrink_cubic(px: DataFrame, keys: Sequence[str], value: str, ratio: float) -> DataFrame:
    """Shrunk by ``ratio`` (over 1): a cubic kernel widened by it, its weights made to sum to one, the rim mirrored.

    A raster of n cells becomes ceil(n / ratio) along each axis, numbered from 0 at its
    first cell.  A target that a missing value has weight in is NULL.
    """
    keys = list(keys)
    reach = int(2 * ratio) + 2
    size = px.groupBy(*keys).agg(F.min("row").alias("_row0"), F.max("row").alias("_row1"), F.min("col").alias("_col0"), F.max("col").alias("_col1"))
    d = mirrored(px.select(*keys, "row", "col", value), keys, reach).join(size, keys)
    ends = [c for c in size.columns if c not in keys]
    for axis, other in (("col", "row"), ("row", "col")):
        i = F.col(axis) - F.col(f"_{axis}0")
        n = F.ceil((F.col(f"_{axis}1") - F.col(f"_{axis}0") + 1) / F.lit(float(ratio)))
        near = F.sequence(F.ceil((i + 0.5) / ratio - 2.5), F.floor((i + 0.5) / ratio + 1.5))
        t = d.select(*keys, *ends, other, value, i.alias("_i"), n.alias("_n"), F.explode(near).alias("_t")).filter("_t >= 0 and _t < _n")
        w = _cubic_weight(((F.col("_t") + 0.5) * ratio - 0.5 - F.col("_i")) / ratio)
        t = t.withColumn("_w", w).filter("_w <> 0")
        sums = t.groupBy(*keys, *ends, other, F.col("_t").cast("int").alias(axis)).agg(
            F.sum(F.col("_w") * F.col(value)).alias("_s"), F.sum("_w").alias("_ws"), F.count_if(F.col(value).isNull()).alias("_gone")
        )
        d = sums.select(*keys, *ends, "row", "col", F.when(F.col("_gone") == 0, F.col("_s") / F.col("_ws")).alias(value))
    return d.select(*keys, "row", "col", value)
