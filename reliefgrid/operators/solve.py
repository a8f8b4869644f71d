"""Iterated least-squares alignment, all rasters of a job in each round.

A round is one Spark job over every pair still active; the driver sees only
how many remain.  Offsets returned by ``coregister`` are to be subtracted,
those of ``register_to_points`` to be added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.quantiles import group_median
from ..session import cut
from .blocks import BLOCK, blocked, core, with_halo
from .kernels import _gradient, gradient
from .pairs import block_differences, pair_blocks, pair_fits, reach_of
from .points import sample
from .resample import RULES, _pass_two, source_position

MAX_HORIZONTAL = 15.0  # fixed value: largest accepted dx or dy
MIN_GAIN = 0.001  # fixed value: rmse improvement that counts as progress
GROUP_CELLS = 1 << 20  # groups of at most so many rows are sorted whole; larger ones take the rounds of group_median


def normal_sums(sx: Column, sy: Column, dz: Column) -> list[Column]:
    """Aggregates of the 3-parameter normal equations dz = p1 + p2 sx + p3 sy."""
    one = F.lit(1.0)
    terms = {
        "s1": one, "sx": sx, "sy": sy, "sxx": sx * sx, "sxy": sx * sy, "syy": sy * sy,
        "sz": dz, "sxz": sx * dz, "syz": sy * dz,
    }
    return [F.sum(t).alias(f"_{n}") for n, t in terms.items()]


def solve_sums() -> dict[str, Column]:
    """Cramer's rule on the columns of ``normal_sums``; singular -> NULL."""
    c = lambda n: F.col(f"_{n}")

    def det(a, b, d):  # columns of a 3x3 matrix
        return (
            a[0] * (b[1] * d[2] - b[2] * d[1]) - b[0] * (a[1] * d[2] - a[2] * d[1]) + d[0] * (a[1] * b[2] - a[2] * b[1])
        )

    u, v, w = (c("s1"), c("sx"), c("sy")), (c("sx"), c("sxx"), c("sxy")), (c("sy"), c("sxy"), c("syy"))
    rhs = (c("sz"), c("sxz"), c("syz"))
    full = det(u, v, w)
    scale = c("s1") * c("sxx") * c("syy")
    d = F.when(F.abs(full) > 1e-12 * F.abs(scale), full)
    return {"qz": det(rhs, v, w) / d, "qx": det(u, rhs, w) / d, "qy": det(u, v, rhs) / d}


def least_squares(df: DataFrame, keys: Sequence[str], sx: str = "sx", sy: str = "sy", dz: str = "dz") -> DataFrame:
    s = df.groupBy(*keys).agg(*normal_sums(F.col(sx), F.col(sy), F.col(dz)))
    q = solve_sums()
    return s.select(*keys, F.col("_s1").cast("long").alias("n"), *[e.alias(n) for n, e in q.items()])


def spread(df: DataFrame, keys: Sequence[str], v: str = "dz", written: bool = False) -> DataFrame:
    """Exact median and n-1 standard deviation per group."""
    std = df.groupBy(*keys).agg(F.stddev_samp(v).alias("std"))
    return group_median(df, keys, F.col(v), written=written).join(std, list(keys))


def inliers(df: DataFrame, keys: Sequence[str], v: str = "dz", strict: bool = False, written: bool = False) -> DataFrame:
    """Rows within one standard deviation of the group median."""
    d = df.join(spread(df, keys, v, written), list(keys))
    off = F.abs(F.col(v) - F.col("median"))
    return d.filter(off < F.col("std") if strict else off <= F.col("std")).drop("median", "std")


def with_median(df: DataFrame, keys: Sequence[str], v: str, name: str, std: str | None = None) -> DataFrame:
    """Each row with the exact median of its group and, if named, the n-1 standard deviation; NULL and NaN have no rank.

    One sort by group serves: for groups of at most GROUP_CELLS rows.
    """
    group = Window.partitionBy(*keys)
    told = F.col(v).isNotNull() & ~F.isnan(v)
    d = df.withColumns({"_at": F.row_number().over(group.orderBy(F.col(v).asc_nulls_last())), "_n": F.count_if(told).over(group)})
    middle = (F.col("_n") + 1) / 2
    of_rank = lambda at: F.max(F.when(told & (F.col("_at") == at), F.col(v))).over(group)
    d = d.withColumns({"_lo": of_rank(F.floor(middle)), "_hi": of_rank(F.ceil(middle)), **({std: F.stddev_samp(v).over(group)} if std else {})})
    median = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(F.col("_lo") + (F.col("_hi") - F.col("_lo")) * 0.5)
    return d.withColumn(name, median).drop("_at", "_n", "_lo", "_hi")


def rmse(v: Column) -> Column:
    return F.sqrt(F.avg(v * v))


def trial_differences(ref: DataFrame, flt: DataFrame, trial: DataFrame, keys: Sequence[str], res: float) -> DataFrame:
    """dz and slopes of each floating raster, shifted by its trial offset, on the reference lattice.

    Both rasters are stacked and meet in one shuffle: cells of the two tables
    with the same block and index are merged by an aggregation that the block
    partitioning already co-locates.  ``trial`` has pz, px, py per key.
    """
    keys = list(keys)
    shifts = source_position(trial.select(*keys, "pz", F.col("px").alias("dx"), F.col("py").alias("dy")), res)
    f = flt.join(shifts, keys)
    f = f.select(
        *keys,
        (F.col("row") - F.col("_ir")).cast("int").alias("row"),
        (F.col("col") - F.col("_ic")).cast("int").alias("col"),
        (F.col("z") - F.col("pz")).alias("z2"),
        F.col("m").cast("int").alias("m2"),
        "_fc",
        "_fr",
        F.lit(True).alias("_flt"),
    )
    r = ref.join(trial.select(*keys), keys, "left_semi").select(
        *keys, "row", "col", F.col("z").alias("z1"), F.col("m").cast("int").alias("m1"), F.lit(True).alias("_ref")
    )
    both = with_halo(r.unionByName(f, allowMissingColumns=True), keys, 3)
    kk = blocked(keys)
    d = both.groupBy(*kk, "row", "col").agg(*[F.max(c).alias(c) for c in ("z1", "m1", "_ref", "z2", "m2", "_flt", "_fc", "_fr")])
    d = _pass_two(d, kk, {"z2": "z2n"}, RULES["linear"])
    d = _pass_two(d, kk, {"m2": "m2n"}, RULES["nearest"])
    # outside the reference lattice there is no resampled value to take a slope from
    d = d.filter("_ref")
    d = _gradient(d, kk, "z2n", res, "_gc", "_gr")
    ok = (F.col("m1") > 0) & (F.coalesce(F.col("m2n"), F.lit(0)) > 0)
    d = core(d, 3).withColumn("dz", F.when(ok, F.col("z2n") - F.col("z1")))
    return d.filter(F.col("dz").isNotNull()).select(*keys, "row", "col", "dz", (-F.col("_gc")).alias("sx"), F.col("_gr").alias("sy"))


def _fits(dz: DataFrame, keys: list[str], first: bool, small: bool) -> DataFrame:
    """Cells, rmse and normal sums of the inliers of each pair; of the first round also their median and the rmse about it.

    ``small``: no pair has more than GROUP_CELLS cells, and the round is one plan; else ``dz`` is read from files.
    """
    if small:
        return pair_fits(dz, keys, first)
    whole = F.col("sx").isNotNull() & F.col("sy").isNotNull()
    sums = [rmse(F.col("dz")).alias("d1"), *normal_sums(F.col("sx"), F.col("sy"), F.col("dz"))]
    good = cut(inliers(dz, keys, written=True).filter(whole))
    fit = good.groupBy(*keys).agg(*sums)
    if first:
        med = group_median(good, keys, F.col("dz"), "m1", written=True)
        about = [rmse(F.col("dz") - F.col("m1")).alias("r1"), F.first("m1").alias("m1")]
        fit = fit.join(good.join(med, keys).groupBy(*keys).agg(*about), keys)
    return dz.groupBy(*keys).agg(F.count("*").alias("_cells")).join(fit, keys, "left")


def coregister(ref: DataFrame, flt: DataFrame, keys: Sequence[str], res: float, written: bool = False) -> DataFrame:
    """Offsets (dz, dx, dy) to subtract from each floating raster, with rmse and status.

    A round that doesn't lower a pair's rmse by MIN_GAIN is its last, so all pairs settle.

    ``ref`` and ``flt`` hold keys, row, col, z, m (match mask) on one global lattice.
    ``written``: ref is read from files.
    """
    keys = list(keys)
    zero = F.lit(0.0)
    nul = F.lit(None).cast("double")
    # read again every round: from files, with their plans cut off
    if arrays := reach_of(res, MAX_HORIZONTAL) <= BLOCK:
        blocks = cut(pair_blocks(ref, flt, keys, res, MAX_HORIZONTAL))
        size = blocks.groupBy(*keys).agg(F.sum("_n").alias("_size"), F.bool_or("_flt").alias("_flt")).filter("_flt")
    else:  # cells so small that the largest offset spans blocks
        ref, flt = ref if written else cut(ref), cut(flt)
        size = flt.select(*keys).distinct().join(ref.groupBy(*keys).agg(F.count("*").alias("_size")), keys, "left")
    state = cut(
        size.select(
            *keys, *[zero.alias(n) for n in ("pz", "px", "py", "az", "ax", "ay")],
            nul.alias("d0"), nul.alias("med1"), nul.alias("rms1"), "_size",
        )
    )
    finished = []
    it = 0
    # a round has at most a difference per cell of ref
    active, most = state.agg(F.count("*"), F.coalesce(F.max("_size"), F.lit(0))).first()
    state, small = state.drop("_size"), most <= GROUP_CELLS
    while active:
        it += 1
        dz = block_differences(blocks, state, keys, res, MAX_HORIZONTAL) if arrays else trial_differences(ref, flt, state, keys, res)
        fit = _fits(dz if small else cut(dz), keys, it == 1, small)
        q = solve_sums()
        d = state.join(fit, keys, "left").withColumns(q)
        if it == 1:
            d = d.withColumn("med1", F.col("m1")).withColumn("rms1", F.col("r1")).drop("m1", "r1")
        stop = F.col("d0").isNotNull() & ((F.col("d0") - F.col("d1") < MIN_GAIN) | F.isnan("d1"))
        d = d.withColumns({"nz": F.col("pz") + F.col("qz"), "nx": F.col("px") + F.col("qx"), "ny": F.col("py") + F.col("qy")})
        far = (F.abs("nx") > MAX_HORIZONTAL) | (F.abs("ny") > MAX_HORIZONTAL)
        status = (
            F.when(F.col("_cells").isNull(), "no_overlap")
            .when(F.col("d1").isNull(), "all_filtered")
            .when(stop, "vertical_only" if it == 2 else "converged")
            .when(F.col("nx").isNull(), "singular")
            .when(far, "over_limit")
            .otherwise("active")
        )
        d = cut(d.withColumn("status", status))
        vertical = F.col("status").isin("vertical_only", "singular", "over_limit")
        ok = F.col("status") == "converged"
        result = lambda v, a: F.when(vertical, v).when(ok, a)
        done = d.filter("status <> 'active'").select(
            *keys,
            result(F.col("med1"), F.col("az")).alias("dz"),
            result(zero, F.col("ax")).alias("dx"),
            result(zero, F.col("ay")).alias("dy"),
            result(F.col("rms1"), F.col("d0")).alias("rmse"),
            "status",
            F.lit(it).alias("rounds"),
        )
        finished.append(done)
        state = d.filter("status = 'active'").select(
            *keys,
            F.col("nz").alias("pz"), F.col("nx").alias("px"), F.col("ny").alias("py"),
            F.col("pz").alias("az"), F.col("px").alias("ax"), F.col("py").alias("ay"),
            F.col("d1").alias("d0"), "med1", "rms1",
        )
        active = state.count()
    if not finished:
        return state.selectExpr(*keys, "pz dz", "px dx", "py dy", "d0 rmse", "'' status", "0 rounds")
    out = finished[0]
    for f in finished[1:]:
        out = out.unionByName(f)
    return out


def point_slopes(px: DataFrame, keys: Sequence[str], res: float) -> DataFrame:
    """Elevation and slopes of each raster, taken once before the point rounds."""
    d = gradient(px.select(*keys, "row", "col", "z"), keys, "z", res, "_gc", "_gr")
    return d.select(*keys, "row", "col", "z", (-F.col("_gc")).alias("sx"), F.col("_gr").alias("sy"))


def point_residuals(slopes: DataFrame, points: DataFrame, state: DataFrame, keys: Sequence[str], res: float) -> DataFrame:
    """Raster minus point at the raster's current position, for every point."""
    keys = list(keys)
    moved = points.join(state.select(*keys, "az", "ax", "ay"), keys)
    at = sample(
        moved.select(*keys, "gcp_id", (F.col("x") + F.col("ax")).alias("x"), (F.col("y") + F.col("ay")).alias("y")),
        slopes, keys, "gcp_id", ["z", "sx", "sy"], res,
    )
    return moved.join(at, [*keys, "gcp_id"], "left").select(
        *keys, "gcp_id", (F.col("z_at") - F.col("az") - F.col("z")).alias("dz"), F.col("sx_at").alias("sx"), F.col("sy_at").alias("sy")
    )


def register_to_points(
    px: DataFrame, points: DataFrame, keys: Sequence[str], res: float, min_points: int = 4
) -> tuple[DataFrame, DataFrame]:
    """(offsets to add, residuals) of rasters against control points.

    Offsets: keys, dz, dx, dy, rmse, status.  Residuals are those of the last
    accepted round, all points (NULL where the raster has no value).
    """
    keys = list(keys)
    slopes = cut(point_slopes(px, keys, res))
    points = cut(points.select(*keys, "gcp_id", "x", "y", "z"))
    zero, nul = F.lit(0.0), F.lit(None).cast("double")
    state = cut(points.select(*keys).distinct().select(*keys, *[zero.alias(n) for n in ("az", "ax", "ay", "tz", "tx", "ty")], nul.alias("d0")))
    finished, residuals = [], []
    it, active = 0, state.count()
    while active:
        it += 1
        r = cut(point_residuals(slopes, points, state, keys, res))
        residuals.append(r)
        valid = r.filter("dz is not null and sx is not null and sy is not null")
        good = inliers(valid, keys, strict=True)
        fit = good.groupBy(*keys).agg(
            F.count("*").alias("_n"), rmse(F.col("dz")).alias("d1"), *normal_sums(F.col("sx"), F.col("sy"), F.col("dz"))
        )
        d = state.join(fit, keys, "left").withColumns(solve_sums())
        worse = F.col("d0").isNotNull() & ((F.col("d1") >= F.col("d0")) | F.isnan("d1"))
        small = F.col("d0").isNotNull() & ((F.col("d0") - F.col("d1")) / F.col("d0") <= 1e-3)
        status = (
            F.when(F.coalesce("_n", F.lit(0)) < min_points, "too_few_points")
            .when(worse, "previous")
            .when(small, "current")
            .when(F.col("qx").isNull(), "singular")
            .otherwise("active")
        )
        d = cut(d.withColumn("status", status))
        failed = F.col("status") == "too_few_points"
        back = F.col("status") == "previous"
        pick = lambda prev, cur: F.when(failed, nul).when(back, -F.col(prev)).otherwise(-F.col(cur))
        finished.append(
            d.filter("status <> 'active'").select(
                *keys,
                pick("tz", "az").alias("dz"), pick("tx", "ax").alias("dx"), pick("ty", "ay").alias("dy"),
                F.when(failed, nul).when(back, F.col("d0")).otherwise(F.col("d1")).alias("rmse"),
                "status",
                F.when(failed, 0).when(back, it - 1).otherwise(it).alias("accepted"),
            )
        )
        state = d.filter("status = 'active'").select(
            *keys,
            (F.col("az") + F.col("qz")).alias("az"), (F.col("ax") + F.col("qx")).alias("ax"), (F.col("ay") + F.col("qy")).alias("ay"),
            F.col("az").alias("tz"), F.col("ax").alias("tx"), F.col("ay").alias("ty"),
            F.col("d1").alias("d0"),
        )
        active = state.count()
    out = None
    for f in finished:
        out = f if out is None else out.unionByName(f)
    res_df = None
    for i, r in enumerate(residuals, start=1):
        part = r.join(out.filter(F.col("accepted") == i).select(*keys), keys, "left_semi").select(*keys, "gcp_id", "dz")
        res_df = part if res_df is None else res_df.unionByName(part)
    return out, res_df
