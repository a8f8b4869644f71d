"""Lattices: generation, cropping, indexing, resampling, edge ramps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import along_col, along_row, blocked, core, with_halo


def _last_index(axis: str, res: float, pad: float) -> Column:
    return F.floor((F.col(f"{axis}1") - F.col(f"{axis}0") + 2 * pad) / res).cast("int")


def tile_cells(tiles: DataFrame, res: float, buffer_px: int = 100) -> DataFrame:
    """(tile_id, cells) of the tiles' lattices, without making them."""
    pad = buffer_px * res
    cells = (_last_index("y", res, pad) + 1).cast("long") * (_last_index("x", res, pad) + 1)
    return tiles.select("tile_id", cells.alias("cells"))


def _first_row_col(res: float, pad: float) -> tuple[Column, Column]:
    return F.round(-(F.col("y1") + pad) / res).cast("int"), F.round((F.col("x0") - pad) / res).cast("int")


def tile_bounds(tiles: DataFrame, res: float, buffer_px: int = 100) -> DataFrame:
    """(tile_id, r0, r1, c0, c1): first and last row and column of each widened tile.

    Rows and columns count from the origin of the map, as all tiles' cells must where neighbours meet.
    """
    r0, c0 = _first_row_col(res, buffer_px * res)
    last = [_last_index(a, res, buffer_px * res) for a in "yx"]
    return tiles.select("tile_id", r0.alias("r0"), (r0 + last[0]).alias("r1"), c0.alias("c0"), (c0 + last[1]).alias("c1"))


def on_common_lattice(px: DataFrame, tiles: DataFrame, res: float) -> DataFrame:
    """Cells counted from each tile's corner, as ``strips_in_tiles`` gives them, counted from the origin of the map.

    ``tiles`` has the same bounds that the cells were read with.
    """
    r0, c0 = _first_row_col(res, 0.0)
    corner = tiles.select("tile_id", r0.alias("_r0"), c0.alias("_c0"))
    return px.join(corner, "tile_id").withColumns({"row": F.col("row") + F.col("_r0"), "col": F.col("col") + F.col("_c0")}).drop("_r0", "_c0")


def gaps(px: DataFrame, keys: Sequence[str], bounds: DataFrame) -> DataFrame:
    """The complement of ``px`` in lattices, as runs: keys, row, c_from, c_to (columns, both included).

    ``bounds``: keys, r0, r1, c0, c1; the cells of ``px`` lie inside.  Only cells that
    exist are sorted, per row; a row without any is one run.
    """
    keys = list(keys)
    of_row = Window.partitionBy(*keys, "row").orderBy("col")
    d = px.select(*keys, "row", "col").join(bounds, keys)
    start = F.when(F.lag("col").over(of_row).isNull(), F.col("c0"))
    after = F.coalesce(F.lead("col").over(of_row), F.col("c1") + 1)
    runs = F.array(F.struct(start.alias("c_from"), (F.col("col") - 1).alias("c_to")), F.struct((F.col("col") + 1).alias("c_from"), (after - 1).alias("c_to")))
    between = d.select(*keys, "row", runs.alias("_runs")).select(*keys, "row", F.explode("_runs").alias("_run")).select(*keys, "row", "_run.c_from", "_run.c_to").filter("c_from <= c_to")
    rows = bounds.filter("r0 <= r1 and c0 <= c1").select(*keys, F.explode(F.sequence("r0", "r1")).alias("row"), F.col("c0").alias("c_from"), F.col("c1").alias("c_to"))
    return between.unionByName(rows.join(px.select(*keys, "row").distinct(), [*keys, "row"], "left_anti"))


def tile_lattice(tiles: DataFrame, res: float, buffer_px: int = 100) -> DataFrame:
    """One row per cell of every tile: x ascending with col, y descending with row.

    ``tiles`` needs tile_id, x0, x1, y0, y1.  Rows are generated in two steps so
    that a single tile is spread over tasks before its columns are expanded.
    """
    pad = buffer_px * res
    n_row, n_col = _last_index("y", res, pad), _last_index("x", res, pad)
    rows = tiles.select("*", F.explode(F.sequence(F.lit(0), n_row)).alias("row"))
    rows = rows.repartition("tile_id", "row")
    cells = rows.select("*", F.explode(F.sequence(F.lit(0), n_col)).alias("col"))
    return cells.select(
        "tile_id",
        "row",
        "col",
        (F.col("x0") - pad + F.col("col") * res).alias("x"),
        (F.col("y1") + pad - F.col("row") * res).alias("y"),
    )


def densified(px: DataFrame, keys: Sequence[str], real: str = "_real") -> DataFrame:
    """Every cell of each raster's extent; ``real`` marks the cells that were there.

    Separable kernels need whole rows and columns; pairings of unequal layers lack some.
    """
    keys = list(keys)
    ext = px.groupBy(*keys).agg(F.min("row").alias("_r0"), F.max("row").alias("_r1"), F.min("col").alias("_c0"), F.max("col").alias("_c1"))
    rows = ext.select("*", F.explode(F.sequence("_r0", "_r1")).alias("row")).repartition(*keys, "row")
    cells = rows.select(*keys, "row", F.explode(F.sequence("_c0", "_c1")).alias("col"))
    return cells.join(px.withColumn(real, F.lit(True)), [*keys, "row", "col"], "left").withColumn(real, F.coalesce(real, F.lit(False)))


def data_extent(px: DataFrame, keys: Sequence[str], z: str = "z") -> DataFrame:
    """Bounding rows and columns of cells that hold data."""
    has = F.col(z).isNotNull()
    return (
        px.filter(has)
        .groupBy(*keys)
        .agg(F.min("row").alias("r0"), F.max("row").alias("r1"), F.min("col").alias("c0"), F.max("col").alias("c1"))
    )


def crop_to_data(px: DataFrame, keys: Sequence[str], buffer: int = 0, z: str = "z") -> DataFrame:
    """Cells inside the data extent grown by ``buffer``; all-null rasters vanish."""
    e = data_extent(px, keys, z)
    inside = F.col("row").between(F.col("r0") - buffer, F.col("r1") + buffer) & F.col("col").between(
        F.col("c0") - buffer, F.col("c1") + buffer
    )
    return px.join(e, list(keys)).filter(inside).drop("r0", "r1", "c0", "c1")


def nearest_index(v: Column, origin: Column, step: Column, n: Column) -> Column:
    """0-based nearest cell index, clamped to the raster."""
    return F.least(n - 1, F.greatest(F.lit(0), F.round((v - origin) / step))).cast("int")


def coarsen(px: DataFrame, keys: Sequence[str], values: Sequence[str], k: int) -> DataFrame:
    """Block mean over k x k cells (NULL skipped); replaces an antialiased shrink."""
    return px.groupBy(*keys, F.floor(F.col("row") / k).cast("int").alias("row"), F.floor(F.col("col") / k).cast("int").alias("col")).agg(
        *[F.avg(v).alias(v) for v in values]
    )


def pick_every(px: DataFrame, k: int) -> DataFrame:
    """Nearest-neighbour shrink: keep the centre cell of each k x k block."""
    c = k // 2
    mid = (F.pmod("row", F.lit(k)) == c) & (F.pmod("col", F.lit(k)) == c)
    return px.filter(mid).withColumn("row", F.floor(F.col("row") / k).cast("int")).withColumn(
        "col", F.floor(F.col("col") / k).cast("int")
    )


def enlarge_nearest(px: DataFrame, k: int) -> DataFrame:
    """Each cell becomes a k x k block."""
    step = F.sequence(F.lit(0), F.lit(k - 1))
    d = px.select("*", F.explode(step).alias("_i"))
    d = d.select("*", F.explode(step).alias("_j"))
    return (
        d.withColumn("row", F.col("row") * k + F.col("_i"))
        .withColumn("col", F.col("col") * k + F.col("_j"))
        .drop("_i", "_j")
    )


def enlarge_bilinear(px: DataFrame, keys: Sequence[str], value: str, k: int) -> DataFrame:
    """k-fold enlargement with cell-centre alignment, held constant past the rim.

    A fine cell at offset i in its block sits at (i + 1/2)/k - 1/2 coarse cells
    from the block centre, between the block and one neighbour.
    """
    d = with_halo(px.select(*keys, "row", "col", value), keys, 1)
    kk = blocked(keys)

    def side(w, axis, col, step):
        step_to = F.lag if step < 0 else F.lead
        moved = F.when(step_to(axis).over(w) == F.col(axis) + step, step_to(col).over(w))
        return F.coalesce(moved, F.col(col))

    d = d.withColumn("_l", side(along_row(kk), "col", value, -1)).withColumn("_r", side(along_row(kk), "col", value, 1))
    for c in ("_l", value, "_r"):
        d = d.withColumn(f"_u{c}", side(along_col(kk), "row", c, -1)).withColumn(f"_d{c}", side(along_col(kk), "row", c, 1))
    d = core(d, 1)
    step = F.sequence(F.lit(0), F.lit(k - 1))
    d = d.select("*", F.explode(step).alias("_i"))
    d = d.select("*", F.explode(step).alias("_j"))
    fr = (F.col("_i") + 0.5) / k - 0.5
    fc = (F.col("_j") + 0.5) / k - 0.5

    def blend(lo, mid, hi, f):
        return F.when(f < 0, mid * (1 + f) - lo * f).otherwise(mid * (1 - f) + hi * f)

    at = lambda pre: blend(F.col(f"{pre}_l") if pre else F.col("_l"), F.col(f"{pre}{value}"), F.col(f"{pre}_r") if pre else F.col("_r"), fc)
    v = blend(at("_u"), at(""), at("_d"), fr)
    return d.select(
        *keys,
        (F.col("row") * k + F.col("_i")).cast("int").alias("row"),
        (F.col("col") * k + F.col("_j")).cast("int").alias("col"),
        v.alias(value),
    )


def edge_ramp(overlap: DataFrame, pair_keys: Sequence[str], axis: str, out: str = "w") -> DataFrame:
    """Weight of the first tile falling 1 -> 0 along ``axis`` across each overlap.

    The range per pair is aggregated and joined back: an ordered frame per pair
    would put a whole overlap in one task.
    """
    span = overlap.groupBy(*pair_keys).agg(F.min(axis).alias("_a0"), F.max(axis).alias("_a1"))
    w = F.when(F.col("_a1") == F.col("_a0"), 0.5).otherwise(
        (F.col("_a1") - F.col(axis)) / (F.col("_a1") - F.col("_a0"))
    )
    return overlap.join(span, list(pair_keys)).withColumn(out, w).drop("_a0", "_a1")
