"""Neighbourhood kernels on dense lattices (nodata cells present, value NULL).

Every public operator takes the whole pixel table of many rasters, moves it
into haloed blocks once, and runs separable passes there.  The ``_``-prefixed
passes expect a table that is already blocked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import along_col, along_row, blocked, core, with_halo

PREFIX_FROM = 9  # kernels at least this wide use running sums, O(1) per cell


def offsets(n: int) -> tuple[int, int]:
    """Cells covered by an n-wide kernel; even n leans toward higher indices."""
    return -((n - 1) // 2), n // 2


def _sum_over(w, value: str, n: int, exact: bool) -> Column:
    """Sum of the n positions around each cell of a line; ``exact`` marks non-negative integer input."""
    lo, hi = offsets(n)
    if n < PREFIX_FROM or not exact:
        return F.coalesce(F.sum(value).over(w.rangeBetween(lo, hi)), F.lit(0))
    # sums over everything up to a position: both frames only ever grow
    upto = lambda end: F.coalesce(F.sum(value).over(w.rangeBetween(Window.unboundedPreceding, end)), F.lit(0))
    return upto(hi) - upto(lo - 1)


def _box_sums(df: DataFrame, keys, sums: dict[str, tuple[str, bool]], n: int) -> DataFrame:
    """n x n sums, zero outside, of (column, exact) by output name: all rows in one pass, then all columns."""
    names = {out: f"_h{i}" for i, out in enumerate(sums)}
    df = df.withColumns({names[out]: _sum_over(along_row(keys), v, n, exact) for out, (v, exact) in sums.items()})
    df = df.withColumns({out: _sum_over(along_col(keys), names[out], n, exact) for out, (_, exact) in sums.items()})
    return df.drop(*names.values())


def _box_sum(df, keys, value: str, n: int, out: str, exact: bool = False) -> DataFrame:
    return _box_sums(df, keys, {out: (value, exact)}, n)


def _count(df, keys, cond: Column, n: int, out: str) -> DataFrame:
    df = df.withColumn("_m", F.when(cond, 1).otherwise(0).cast("long"))
    return _box_sum(df, keys, "_m", n, out, exact=True).drop("_m")


def _dilate(df, keys, mask: Column, n: int, out: str) -> DataFrame:
    if n % 2 == 0:
        raise ValueError("dilation needs an odd kernel")
    return _count(df, keys, mask, n, "_cnt").withColumn(out, F.col("_cnt") > 0).drop("_cnt")


def _erode(df, keys, mask: Column, n: int, out: str) -> DataFrame:
    df = _count(df, keys, ~F.coalesce(mask, F.lit(False)), n, "_cnt")
    return df.withColumn(out, F.col("_cnt") == 0).drop("_cnt")


def _means(df, keys, values: dict[str, tuple[Column, str]], n: int) -> DataFrame:
    """Kernel means with zero padding outside; any NULL in the kernel gives NULL.

    ``values``: output name to (value, name of its NULLs); values that are NULL in the
    same cells share a name and one count.
    """
    of = {out: f"_v{i}" for i, out in enumerate(values)}
    nulls = {}
    for out, (_, same) in values.items():
        nulls.setdefault(same, (f"_n{len(nulls)}", of[out]))
    df = df.withColumns({of[out]: v for out, (v, _) in values.items()})
    df = df.withColumns({name: F.when(F.col(v).isNull(), 1).otherwise(0).cast("long") for name, v in nulls.values()})
    sums = {f"_s{of[out]}": (of[out], False) for out in values} | {f"_s{name}": (name, True) for name, _ in nulls.values()}
    df = _box_sums(df, keys, sums, n)
    whole = {out: F.when(F.col(f"_s{nulls[same][0]}") == 0, F.col(f"_s{of[out]}") / float(n * n)) for out, (_, same) in values.items()}
    return df.withColumns(whole).drop(*sums, *of.values(), *(name for name, _ in nulls.values()))


def _mean(df, keys, value: Column, n: int, out: str) -> DataFrame:
    return _means(df, keys, {out: (value, "v")}, n)


def _gradient(df, keys, z: str, dx: float, gcol: str, grow: str) -> DataFrame:
    """Per-unit slope along columns and along rows: central inside, one-sided at edges."""

    def diff(df, w, axis: str, out: str) -> DataFrame:
        # neighbours as columns first: a window that a plan names twice runs twice
        df = df.withColumns({f"_{n}{c}": f(v).over(w) for n, f in (("b", F.lag), ("a", F.lead)) for c, v in (("at", axis), ("z", z))})
        b = F.coalesce(F.col("_bat") == F.col(axis) - 1, F.lit(False))
        a = F.coalesce(F.col("_aat") == F.col(axis) + 1, F.lit(False))
        zb, za = F.col("_bz"), F.col("_az")
        slope = F.when(a & b, (za - zb) / (2.0 * dx)).when(a, (za - F.col(z)) / dx).when(b, (F.col(z) - zb) / dx)
        return df.withColumn(out, slope).drop("_bat", "_bz", "_aat", "_az")

    df = diff(df, along_row(keys), "col", gcol)
    return diff(df, along_col(keys), "row", grow)


def _run(px, keys, reach, block, fn, *, drop=()):
    kw = {"block": block} if block else {}
    d = with_halo(px, keys, reach, **kw)
    return core(fn(d, blocked(keys)), reach, **kw).drop(*drop)


def density_map(px: DataFrame, keys: Sequence[str], mask: Column, n: int = 11, out: str = "density", block=None):
    """Share of true cells in an n x n kernel, counting outside as false."""

    def fn(d, k):
        d = _count(d, k, mask, n, "_cnt")
        return d.withColumn(out, F.col("_cnt") / float(n * n)).drop("_cnt")

    return _run(px, keys, n, block, fn)


def gradient(px, keys, z: str = "z", dx: float = 1.0, gcol: str = "gcol", grow: str = "grow", block=None):
    return _run(px, keys, 1, block, lambda d, k: _gradient(d, k, z, dx, gcol, grow))


def mean_slope(px, keys, z: str = "z", dx: float = 1.0, n: int = 5, out: str = "mean_slope", block=None):
    """Kernel mean of the slope magnitude."""

    def fn(d, k):
        d = _gradient(d, k, z, dx, "_gc", "_gr").withColumn("_g", F.hypot("_gc", "_gr"))
        return _mean(d, k, F.col("_g"), n, out).withColumnRenamed("_g", "slope").drop("_gc", "_gr")

    return _run(px, keys, n + 1, block, fn)


def _slope_deviation(d, k, gc: str, gr: str, n: int, out: str):
    values = {}
    for axis, g in (("_c", F.col(gc)), ("_r", F.col(gr))):
        values |= {f"_m{axis}": (g, axis), f"_q{axis}": (g * g, axis)}
    d = _means(d, k, values, n)
    var = lambda a: F.greatest(F.lit(0.0), F.col(f"_q{a}") - F.col(f"_m{a}") * F.col(f"_m{a}"))
    return d.withColumn(out, F.sqrt(var("_c") + var("_r"))).drop(*values)


def slope_deviation(px, keys, z: str = "z", dx: float = 1.0, n: int = 5, out: str = "slope_dev", block=None):
    """Kernel standard deviation of both slope components, combined."""

    def fn(d, k):
        d = _gradient(d, k, z, dx, "_gc", "_gr")
        return _slope_deviation(d, k, "_gc", "_gr", n, out).drop("_gc", "_gr")

    return _run(px, keys, n + 1, block, fn)


def dilate(px, keys, mask: Column, n: int, out: str = "dilated", block=None):
    return _run(px, keys, n, block, lambda d, k: _dilate(d, k, mask, n, out))


def erode(px, keys, mask: Column, n: int, out: str = "eroded", block=None):
    return _run(px, keys, n, block, lambda d, k: _erode(d, k, mask, n, out))


def erode_each(px, keys, masks: dict[str, Column], n: int, block=None):
    """``erode`` of several masks by output name, in one shuffle and the same sorts."""

    def fn(d, k):
        d = d.withColumns({f"_m_{out}": F.when(F.coalesce(mask, F.lit(False)), 0).otherwise(1).cast("long") for out, mask in masks.items()})
        d = _box_sums(d, k, {f"_n_{out}": (f"_m_{out}", True) for out in masks}, n)
        return d.withColumns({out: F.col(f"_n_{out}") == 0 for out in masks}).drop(*(f"{a}{out}" for out in masks for a in ("_m_", "_n_")))

    return _run(px, keys, n, block, fn)


def moving_range(px, keys, value: str, n: int = 5, out: str = "range", block=None):
    """max - min over n cells down each column, shrinking at the edges."""

    def fn(d, k):
        w = along_col(k).rangeBetween(*offsets(n))
        return d.withColumn(out, F.max(value).over(w) - F.min(value).over(w))

    return _run(px, keys, n, block, fn)


def raster_extent(px: DataFrame, keys: Sequence[str]) -> DataFrame:
    return px.groupBy(*keys).agg(
        F.min("row").alias("r0"), F.max("row").alias("r1"), F.min("col").alias("c0"), F.max("col").alias("c1")
    )


def mirror_pad(px: DataFrame, keys: Sequence[str], pad: int) -> DataFrame:
    """Copy cells near the rim outward as if reflected at the outer cell edge."""

    def images(axis: str, lo: str, hi: str) -> Column:
        a, l, h = F.col(axis), F.col(lo), F.col(hi)
        return F.explode(
            F.filter(
                F.array(
                    a,
                    F.when(a - l < pad, 2 * l - 1 - a),
                    F.when(h - a < pad, 2 * h + 1 - a),
                ),
                lambda v: v.isNotNull(),
            )
        )

    d = px.join(raster_extent(px, keys), list(keys))
    others = [c for c in px.columns if c not in ("row", "col")]
    d = d.select(*others, "col", "c0", "c1", images("row", "r0", "r1").alias("row"))
    return d.select(*others, "row", images("col", "c0", "c1").alias("col"))


def _inside_extent(df, px, keys):
    e = raster_extent(px, keys)
    return (
        df.join(e, list(keys))
        .filter(F.col("row").between(F.col("r0"), F.col("r1")) & F.col("col").between(F.col("c0"), F.col("c1")))
        .drop("r0", "r1", "c0", "c1")
    )


def local_std(px, keys, value: str, n: int = 5, out: str = "local_std", block=None):
    """Sample standard deviation over n x n with mirrored edges; NULL contaminates."""
    padded = mirror_pad(px, keys, n // 2)
    size = float(n * n)

    def fn(d, k):
        d = d.withColumn("_v", F.col(value)).withColumn("_vv", F.col(value) * F.col(value))
        d = d.withColumn("_m", F.when(F.col("_v").isNull(), 1).otherwise(0).cast("long"))
        d = _box_sums(d, k, {"_s": ("_v", False), "_ss": ("_vv", False), "_nulls": ("_m", True)}, n)
        var = (F.col("_ss") - F.col("_s") * F.col("_s") / size) / (size - 1)
        return d.withColumn(out, F.when(F.col("_nulls") == 0, F.sqrt(F.greatest(F.lit(0.0), var)))).drop(
            "_v", "_vv", "_m", "_s", "_ss", "_nulls"
        )

    return _inside_extent(_run(padded, keys, n, block, fn), px, keys)


def residual_topography(px, keys, z: str = "z", n: int = 5, out: str = "residual", block=None):
    """Value minus its kernel mean."""

    def fn(d, k):
        return _mean(d, k, F.col(z), n, "_mean").withColumn(out, F.col(z) - F.col("_mean")).drop("_mean")

    return _run(px, keys, n, block, fn)


def local_entropy(px, keys, value: str, n: int = 5, out: str = "entropy", block=None):
    """Base-2 entropy of the n x n value histogram (0..255), mirrored edges."""
    lo, hi = offsets(n)
    padded = mirror_pad(px, keys, n // 2)

    def fn(d, k):
        rows = F.collect_list(value).over(along_row(k).rangeBetween(lo, hi))
        d = d.withColumn("_h", rows)
        cells = F.flatten(F.collect_list("_h").over(along_col(k).rangeBetween(lo, hi)))
        d = d.withColumn("_cells", cells)
        total = F.size("_cells").cast("double")
        share = lambda v: F.size(F.filter("_cells", lambda c: c == v)) / total
        bits = F.aggregate(
            F.transform(F.array_distinct("_cells"), lambda v: share(v)),
            F.lit(0.0),
            lambda acc, p: acc - p * F.log2(p),
        )
        return d.withColumn(out, bits).drop("_h", "_cells")

    return _inside_extent(_run(padded, keys, n, block, fn), px, keys)


def to_bytes(v: Column) -> Column:
    """Saturate to 0..255 as an 8-bit image."""
    return F.greatest(F.lit(0), F.least(F.lit(255), F.round(v))).cast("int")


def range_scaled(px: DataFrame, keys, value: str, out: str) -> DataFrame:
    """Rescale each raster's value range to 0..255."""
    e = px.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    span = F.col("_hi") - F.col("_lo")
    scaled = F.when(span == 0, 0.0).otherwise((F.col(value) - F.col("_lo")) * 255.0 / span)
    return px.join(e, list(keys)).withColumn(out, to_bytes(scaled)).drop("_lo", "_hi")


def distance_to(px, keys, region: Column, out: str = "dist", carry: Column | None = None, carry_out: str = "nearest"):
    """City-block distance to the nearest region cell, optionally carrying its value.

    Distances are unbounded, so this runs on whole rows and whole columns: two
    exchanges, groups no larger than one side of a raster.  The backward frames
    use a descending order, which keeps each running minimum linear.
    """
    val = carry if carry is not None else F.lit(None).cast("double")
    far = lambda c: F.struct(c.alias("d"), F.col("_r"), F.col("_c"), F.col("_x"))
    d = px.withColumn("_in", F.coalesce(region, F.lit(False))).withColumn("_val", val)

    def sweep(d, group, axis, base, best):
        """Nearest along one axis from both directions, given struct column ``base``."""
        part = Window.partitionBy(*keys, group)
        fwd = part.orderBy(axis).rowsBetween(Window.unboundedPreceding, 0)
        bwd = part.orderBy(F.col(axis).desc()).rowsBetween(Window.unboundedPreceding, 0)
        a = F.col(axis)
        d = d.withColumn("_f", F.min(shift(base, -a)).over(fwd)).withColumn("_b", F.min(shift(base, a)).over(bwd))
        f = F.when(F.col("_f").isNotNull(), shift(F.col("_f"), a))
        b = F.when(F.col("_b").isNotNull(), shift(F.col("_b"), -a))
        return d.withColumn(best, F.least(f, b)).drop("_f", "_b")

    def shift(s: Column, by: Column) -> Column:
        moved = F.struct((s["d"] + by).alias("d"), s["_r"].alias("_r"), s["_c"].alias("_c"), s["_x"].alias("_x"))
        return F.when(s.isNotNull(), moved)

    seed = F.struct(
        F.lit(0).cast("long").alias("d"), F.col("row").alias("_r"), F.col("col").alias("_c"), F.col("_val").alias("_x")
    )
    d = d.withColumn("_seed", F.when(F.col("_in"), seed))
    d = sweep(d, "row", "col", F.col("_seed"), "_h")
    d = sweep(d, "col", "row", F.col("_h"), "_n")
    d = d.withColumn(out, F.col("_n")["d"])
    if carry is not None:
        d = d.withColumn(carry_out, F.col("_n")["_x"])
    return d.drop("_in", "_val", "_seed", "_h", "_n")


def distances_to(px, keys, regions: dict[str, Column]):
    """``distance_to`` of several regions by output name, all in the same two exchanges and four sorts."""
    d = px.withColumns({f"_in_{out}": F.when(F.coalesce(region, F.lit(False)), F.col("col").cast("long")) for out, region in regions.items()})
    for group, axis in (("row", "col"), ("col", "row")):
        part, a = Window.partitionBy(*keys, group), F.col(axis)
        upto = lambda order: part.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        # the nearest before a cell and after it: of the row's region cells, then of the distances that its column holds
        before = (lambda out: -F.col(f"_in_{out}")) if axis == "col" else (lambda out: F.col(f"_h_{out}") - a)
        after = (lambda out: F.col(f"_in_{out}")) if axis == "col" else (lambda out: F.col(f"_h_{out}") + a)
        d = d.withColumns({f"_f_{out}": F.min(before(out)).over(upto(axis)) for out in regions})
        d = d.withColumns({f"_b_{out}": F.min(after(out)).over(upto(a.desc())) for out in regions})
        best = {out: F.least(F.col(f"_f_{out}") + a, F.col(f"_b_{out}") - a) for out in regions}
        d = d.withColumns({f"_h_{out}" if axis == "col" else out: v for out, v in best.items()})
    return d.drop(*(f"{n}{out}" for out in regions for n in ("_in_", "_f_", "_b_", "_h_")))
