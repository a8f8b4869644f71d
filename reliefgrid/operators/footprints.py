"""Footprint, tile and polygon joins.

Interval and containment joins are written as equi-joins on square grid cells:
both sides list the cells they touch, and a pair is kept only in the cell that
holds its overlap's lower corner, so nothing needs a distinct.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import polygon as pg
from ..session import cut


def _cells(lo: Column, hi: Column, size: float) -> Column:
    return F.explode(F.sequence(F.floor(lo / size), F.floor(hi / size)))


def boxes_meet(left: DataFrame, right: DataFrame, cell: float) -> DataFrame:
    """Strict box overlap of footprints (xmin..ymax) and tiles (x0..y1)."""
    a = left.select("*", _cells(F.col("xmin"), F.col("xmax"), cell).alias("_gx"))
    a = a.select("*", _cells(F.col("ymin"), F.col("ymax"), cell).alias("_gy"))
    b = right.select("*", _cells(F.col("x0"), F.col("x1"), cell).alias("_gx"))
    b = b.select("*", _cells(F.col("y0"), F.col("y1"), cell).alias("_gy"))
    meet = (
        (F.col("xmax") > F.col("x0"))
        & (F.col("xmin") < F.col("x1"))
        & (F.col("ymax") > F.col("y0"))
        & (F.col("ymin") < F.col("y1"))
    )
    first = (F.floor(F.greatest("xmin", "x0") / cell) == F.col("_gx")) & (
        F.floor(F.greatest("ymin", "y0") / cell) == F.col("_gy")
    )
    return a.join(b, ["_gx", "_gy"]).filter(meet & first).drop("_gx", "_gy")


def polygons_meet(pairs: DataFrame) -> DataFrame:
    """Keep pairs where a strip vertex is in the tile or a tile corner in the strip."""
    tile = pg.box_ring(F.col("x0"), F.col("x1"), F.col("y0"), F.col("y1"))
    return (
        pairs.withColumn("_tile", tile)
        .filter(pg.any_vertex_inside(F.col("poly"), F.col("_tile")) | pg.any_vertex_inside(F.col("_tile"), F.col("poly")))
        .drop("_tile")
    )


ROW_BAND = 32  # lattice rows of a polygon that one task expands


def spans(pairs: DataFrame, keep: Sequence[str], res: float | Column, buffer_px: int, poly: str = "poly") -> DataFrame:
    """Column ranges (row, c0, c1) of each tile's lattice whose cell centres lie inside each polygon.

    ``pairs`` carries a polygon and the tile's x0, x1, y0, y1; ``res`` may be one of the
    columns kept, for lattices of several spacings.  One scanline per lattice row turns
    the polygon into ranges, so cost follows its height.  A polygon is sent in bands of
    rows, each with the edges that meet it alone.
    """
    pad = buffer_px * res
    left, top = F.col("x0") - pad, F.col("y1") + pad
    n_col = F.floor((F.col("x1") - F.col("x0") + 2 * pad) / res).cast("int")
    n_row = F.floor((F.col("y1") - F.col("y0") + 2 * pad) / res).cast("int")
    ys = F.transform(F.col(poly), lambda v: v.y)
    r0 = F.greatest(F.lit(0), F.floor((top - F.array_max(ys)) / res).cast("int"))
    r1 = F.least(n_row, F.ceil((top - F.array_min(ys)) / res).cast("int"))
    d = pairs.select(*keep, pg.edges(F.col(poly)).alias("_e"), left.alias("_left"), top.alias("_top"), n_col.alias("_nc"), r0.alias("_r0"), r1.alias("_r1"))
    band = F.explode_outer(F.sequence(F.floor(F.col("_r0") / ROW_BAND), F.floor(F.col("_r1") / ROW_BAND)))
    d = d.filter("_r0 <= _r1").withColumn("_band", band)
    first, last = F.greatest("_r0", F.col("_band") * ROW_BAND).cast("int"), F.least("_r1", (F.col("_band") + 1) * ROW_BAND - 1).cast("int")
    d = d.select(*keep, "_e", "_left", "_top", "_nc", "_band", first.alias("_r0"), last.alias("_r1"))
    high, low = F.col("_top") - F.col("_r0") * res, F.col("_top") - F.col("_r1") * res
    meets = F.filter("_e", lambda e: (F.greatest(e.ay, e.by) > low) & (F.least(e.ay, e.by) <= high))
    # few pairs become many ranges: bands are spread first, so one large polygon is many tasks
    # few pairs become many ranges: bands are spread first, so one large polygon is many tasks
    d = d.withColumn("_e", meets).repartition(*keep, "_band")
    d = d.select("*", F.explode_outer(F.sequence("_r0", "_r1")).alias("row"))
    # crossings come before the pieces they pair up to, so that a row's are computed once
    d = d.withColumn("_x", pg.edge_crossings(F.col("_e"), F.col("_top") - F.col("row") * res))
    d = d.select(*keep, "row", "_left", "_nc", "_x", F.explode_outer(F.sequence(F.lit(0), F.greatest(F.size("_e") - 2, F.lit(0)), F.lit(2))).alias("_i"))
    d = d.select(*keep, "row", "_left", "_nc", F.struct(F.get("_x", F.col("_i")).alias("a"), F.get("_x", F.col("_i") + 1).alias("b")).alias("_s"))
    d = d.filter(F.col("_s.b").isNotNull())
    # one spare column on both sides, then the exact centre test
    a = F.greatest(F.lit(0), F.floor((F.col("_s.a") - F.col("_left")) / res).cast("int"))
    b = F.least(F.col("_nc"), F.ceil((F.col("_s.b") - F.col("_left")) / res).cast("int"))
    d = d.withColumn("_a", a).withColumn("_b", b)
    x = lambda c: F.col("_left") + c * res
    c0, c1 = F.col("_a"), F.col("_b")
    from_ = F.when(x(c0) >= F.col("_s.a"), c0).when(x(c0 + 1) >= F.col("_s.a"), c0 + 1).otherwise(c0 + 2)
    to = F.when(x(c1) < F.col("_s.b"), c1).when(x(c1 - 1) < F.col("_s.b"), c1 - 1).otherwise(c1 - 2)
    return d.select(*keep, "row", from_.alias("c0"), to.alias("c1")).filter("c0 <= c1")


def rasterise(pairs: DataFrame, keep: Sequence[str], res: float | Column, buffer_px: int, poly: str = "poly") -> DataFrame:
    """The cells of ``spans``, one row each: cost follows the area covered, not the bounding box."""
    d = spans(pairs, keep, res, buffer_px, poly)
    return d.select(*keep, "row", F.explode(F.sequence("c0", "c1")).alias("col"))


def cell_sums(ranges: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Cells of each polygon in closed form from its ranges: n and the sums of row, col and row * col."""
    n = (F.col("c1") - F.col("c0") + 1).cast("long")
    cols = F.expr("(cast(c0 as long) + c1) * (c1 - c0 + 1) div 2")
    d = ranges.select(*keep, "row", n.alias("_n"), cols.alias("_c"))
    return d.groupBy(*keep).agg(
        F.sum("_n").alias("n"), F.sum(F.col("row") * F.col("_n")).alias("rows"), F.sum("_c").alias("cols"), F.sum(F.col("row") * F.col("_c")).alias("cross_")
    )


def exclude_masks(cover: DataFrame, mask_cover: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Remove cells inside any mask polygon."""
    return cover.join(mask_cover.select(*keys, "row", "col"), [*keys, "row", "col"], "left_anti")


def explode_masks(footprints: DataFrame, keep: Sequence[str], review_only: bool = False) -> DataFrame:
    """One row per non-empty mask polygon; under review rules only for flag 3."""
    d = footprints.filter(F.col("qc") == 3) if review_only else footprints
    return d.select(*keep, F.explode("masks").alias("poly")).filter(F.size("poly") > 0)


def points_in_polygons(
    points: DataFrame,
    footprints: DataFrame,
    cell: float,
    key: str = "strip_id",
    rectangle: bool = False,
    min_points: int = 4,
) -> DataFrame:
    """Points inside each footprint; footprints with fewer than ``min_points`` drop out."""
    p = points.withColumn("_gx", F.floor(F.col("x") / cell)).withColumn("_gy", F.floor(F.col("y") / cell))
    f = footprints.select("*", pg.edges(F.col("poly")).alias("_edges")) if not rectangle else footprints
    f = f.select("*", _cells(F.col("xmin"), F.col("xmax"), cell).alias("_gx"))
    f = f.select("*", _cells(F.col("ymin"), F.col("ymax"), cell).alias("_gy"))
    # left to the join: a crowded cell of its own exchange is split by the optimizer
    box = F.col("x").between(F.col("xmin"), F.col("xmax")) & F.col("y").between(F.col("ymin"), F.col("ymax"))
    hit = p.join(f, ["_gx", "_gy"]).filter(box)
    if not rectangle:
        hit = hit.filter(pg.edges_enclose(F.col("_edges"), F.col("x"), F.col("y"))).drop("_edges")
    hit = hit.drop("_gx", "_gy")
    if min_points <= 1:
        return hit
    enough = hit.groupBy(key).count().filter(F.col("count") >= min_points).select(key)
    return hit.join(enough, key, "left_semi")


CELL_SHAPES, CELL_PLACES = 20_000, 100_000  # so many outlines and places of points of a cell meet in one group


def point_sums(
    points: DataFrame,
    footprints: DataFrame,
    cell: float,
    values: Sequence[str],
    by: str | None = None,
    key: str = "strip_id",
    rectangle: bool = False,
    min_points: int = 4,
) -> DataFrame:
    """Counts and sums of the points inside each footprint, without a row per pair.

    One row per footprint and value of ``by`` (few values) that has points: the footprint's
    columns, ``by``, ``n`` and the sum of each of ``values`` (finite or NULL; NULL without any
    value).  Footprints with fewer than ``min_points`` points in all drop out.  Points of one place
    are one row and footprints of one outline another before they meet; in a cell an outline
    takes prefix sums along each line of points of equal y, so its cost follows the lines it
    crosses and not the points inside.  Crowded cells are split, as sums of parts add up.
    """
    by_ = [by] if by else []
    outline = ["xmin", "xmax", "ymin", "ymax"] + ([] if rectangle else ["poly"])
    kind = points.select(*by_).schema.fields[0].dataType.simpleString() if by else "int"
    sums = [F.struct(F.sum(v).cast("double").alias("s"), F.count(v).alias("c")).alias(f"_v{i}") for i, v in enumerate(values)]
    p = points.withColumns({"_gx": F.floor(F.col("x") / cell), "_gy": F.floor(F.col("y") / cell), "_by": F.col(by) if by else F.lit(0)})
    p = p.groupBy("_gx", "_gy", "x", "y", "_by").agg(F.count("*").alias("_n"), *sums)
    p = p.select("_gx", "_gy", "x", "y", "_by", "_n", *[F.col(f"_v{i}.{c}").alias(f"_{c}{i}") for i in range(len(values)) for c in "sc"])
    shapes = cut(footprints.select(*outline).dropna().distinct().withColumn("_shape", F.monotonically_increasing_id()))
    f = shapes.withColumn("_edges", F.lit(None).cast("array<double>") if rectangle else F.flatten(F.transform(pg.edges(F.col("poly")), lambda e: F.array(e.ax, e.ay, e.bx, e.by))))
    f = f.select("_shape", "xmin", "xmax", "ymin", "ymax", "_edges", _cells(F.col("xmin"), F.col("xmax"), cell).alias("_gx"))
    f = f.select("*", _cells(F.col("ymin"), F.col("ymax"), cell).alias("_gy"))
    at = ["_gx", "_gy"]
    parts = lambda d, size, out: d.groupBy(*at).agg(F.ceil(F.count("*") / size).cast("int").alias(out))
    p = cut(p)
    split = parts(p, CELL_PLACES, "_np").join(parts(f, CELL_SHAPES, "_nf"), at)
    copies = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    p = p.join(split, at).withColumn("_pp", F.pmod(F.xxhash64("y"), F.col("_np")).cast("int")).withColumn("_pf", copies("_nf")).drop("_np", "_nf")
    f = f.join(split, at).withColumn("_pf", F.pmod(F.xxhash64("_shape"), F.col("_nf")).cast("int")).withColumn("_pp", copies("_np")).drop("_np", "_nf")
    meet = [*at, "_pp", "_pf"]
    found = "".join(f", _s{i} double, _c{i} long" for i in range(len(values)))
    part = p.groupBy(*meet).cogroup(f.groupBy(*meet)).applyInPandas(_line_sums, f"_shape long, _by {kind}, _n long{found}")
    names = [f"_{c}{i}" for i in range(len(values)) for c in "sc"]
    got = part.groupBy("_shape", "_by").agg(*[F.sum(c).alias(c) for c in ("_n", *names)])
    got = shapes.join(got, "_shape").drop("_shape")
    got = footprints.join(got, outline)
    if min_points > 1:
        enough = got.groupBy(key).agg(F.sum("_n").alias("_all")).filter(F.col("_all") >= min_points).select(key)
        got = got.join(enough, key, "left_semi")
    totals = [F.when(F.col(f"_c{i}") > 0, F.col(f"_s{i}")).alias(v) for i, v in enumerate(values)]
    return got.select(*footprints.columns, *([F.col("_by").alias(by)] if by else []), F.col("_n").alias("n"), *totals)


def _line_sums(p: pd.DataFrame, f: pd.DataFrame) -> pd.DataFrame:
    """Sums per outline and group of the points of one cell: ``_shape``, ``_by``, ``_n`` and the value columns."""
    names = ["_n"] + [c for c in p.columns if c[:2] in ("_s", "_c")]
    none = pd.DataFrame({c: [] for c in ["_shape", "_by", *names]})
    if p.empty or f.empty:
        return none
    p = p.sort_values(["y", "x"])
    code, groups = pd.factorize(p["_by"], use_na_sentinel=False)
    width = len(groups)
    w = np.zeros((len(p) + 1, len(names) * width))
    for k, c in enumerate(names):
        w[np.arange(1, len(p) + 1), k * width + code] = np.nan_to_num(p[c].to_numpy(dtype=float))
    run = np.cumsum(w, axis=0)
    x, y = p["x"].to_numpy(), p["y"].to_numpy()
    x0, x1, y0, y1 = (f[c].to_numpy(dtype=float) for c in ("xmin", "xmax", "ymin", "ymax"))
    edges = None
    if f["_edges"].notna().any():
        # an even number of edges each, so that the signs of the crossings cancel beyond the last one
        most = max(len(e) for e in f["_edges"]) // 4
        edges = np.zeros((len(f), most + most % 2, 4))
        for i, e in enumerate(f["_edges"]):
            edges[i, : len(e) // 4] = np.reshape(e, (-1, 4))
    out = np.zeros((len(f), w.shape[1]))
    lines, first = np.unique(y, return_index=True)
    for at, a, b in zip(lines, first, [*first[1:], len(y)]):
        on = np.flatnonzero((y0 <= at) & (at <= y1))
        if not len(on):
            continue
        xs = x[a:b]
        lo, hi = np.searchsorted(xs, x0[on], "left"), np.searchsorted(xs, x1[on], "right")
        if edges is None:
            hi = np.maximum(lo, hi)
            out[on] += run[a + hi] - run[a + lo]
            continue
        ax, ay, bx, by = np.moveaxis(edges[on], 2, 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            cross = np.where((ay > at) != (by > at), ax + (at - ay) * (bx - ax) / (by - ay), -np.inf)
        # a point lies inside if an odd number of crossings is right of it
        cross = -np.sort(-cross, axis=1)
        for k in range(cross.shape[1]):
            i = a + np.minimum(np.maximum(np.searchsorted(xs, cross[:, k], "left"), lo), np.maximum(lo, hi))
            out[on] += run[i] if k % 2 == 0 else -run[i]
    out = out.reshape(len(f), len(names), width)
    shape, group = np.nonzero(out[:, 0, :] > 0)
    return pd.DataFrame({"_shape": f["_shape"].to_numpy()[shape], "_by": np.asarray(groups)[group], **{c: out[shape, k, group] if c[1] == "s" else out[shape, k, group].astype("int64") for k, c in enumerate(names)}})


def by_outline(footprints: DataFrame, also: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Each outline (box, ring and the columns ``also``) once, as ``outline_id``, and the outline of each ``strip_id``.

    What follows from the outline alone is worked out once for all strips that share it.
    """
    outline = ["xmin", "xmax", "ymin", "ymax", "poly", *also]
    once = cut(footprints.select(*outline).distinct().withColumn("outline_id", F.monotonically_increasing_id()))
    same = [footprints[c].eqNullSafe(once[c]) for c in outline]
    return once, footprints.join(once, same).select(footprints["strip_id"], once["outline_id"])


def qc_attach(strips: DataFrame, qc: DataFrame) -> DataFrame:
    """Strip rows with their review flag and masks (0 and none by default).

    Names are matched on the browse-image suffix; only if not a single strip
    matches that way is the elevation suffix tried.
    """
    s = strips.withColumn("_k", F.replace(F.col("path"), F.lit("_meta.txt"), F.lit("")))
    a = qc.withColumn("_ka", F.replace(F.col("browse_path"), F.lit("_dem_browse.tif"), F.lit("")))
    a = a.withColumn("_kb", F.replace(F.col("browse_path"), F.lit("_dem.tif"), F.lit("")))
    hits = s.join(a, s["_k"] == a["_ka"], "left_semi").limit(1).agg((F.count("*") > 0).alias("_primary"))
    # a one-row flag decides which key the join uses
    keyed = a.crossJoin(F.broadcast(hits)).withColumn("_k", F.when(F.col("_primary"), F.col("_ka")).otherwise(F.col("_kb")))
    keyed = keyed.select("_k", F.col("flag").alias("_flag"), F.col("masks").alias("_masks"))
    out = s.drop("qc", "masks").join(keyed, "_k", "left")
    return out.withColumn("qc", F.coalesce("_flag", F.lit(0)).cast("int")).withColumn(
        "masks", F.coalesce("_masks", F.array().cast("array<array<struct<x:double,y:double>>>"))
    ).drop("_k", "_flag", "_masks")


def qc_carry_over(files: DataFrame, store: DataFrame) -> DataFrame:
    """Current browse files with earlier flags kept and new files at flag 0."""
    d = files.select("browse_path").join(store, "browse_path", "left")
    return d.withColumn("flag", F.coalesce("flag", F.lit(0)))


def first_tile_entry(tile_region: DataFrame, order: str) -> DataFrame:
    """First row per tile name."""
    first = F.min_by(F.struct("region_num"), F.col(order))
    return tile_region.groupBy("tile_name").agg(first.alias("_f")).select("tile_name", "_f.region_num")


def tiles_of_region(tiles: DataFrame, tile_region: DataFrame, region: int | Column, order: str) -> DataFrame:
    pick = first_tile_entry(tile_region, order).filter(F.col("region_num") == region)
    return tiles.join(pick, tiles["tile_id"] == pick["tile_name"], "left_semi")


NEIGHBOUR_OFFSETS = [(0, 1), (1, 0), (-1, 0), (0, -1)]  # fixed values: right, up, down, left


def tile_neighbours(tiles: DataFrame, others: DataFrame) -> DataFrame:
    """4-neighbour pairs (tile_id, other_id, d_row, d_col)."""
    off = F.explode(F.array(*[F.struct(F.lit(a).alias("d_row"), F.lit(b).alias("d_col")) for a, b in NEIGHBOUR_OFFSETS]))
    t = tiles.select("tile_id", "tile_row", "tile_col", off.alias("_o")).select(
        "tile_id",
        F.col("_o.d_row").alias("d_row"),
        F.col("_o.d_col").alias("d_col"),
        (F.col("tile_row") + F.col("_o.d_row")).alias("tile_row"),
        (F.col("tile_col") + F.col("_o.d_col")).alias("tile_col"),
    )
    o = others.select(F.col("tile_id").alias("other_id"), "tile_row", "tile_col")
    return t.join(o, ["tile_row", "tile_col"]).select("tile_id", "other_id", "d_row", "d_col")


def unordered_pairs(neighbours: DataFrame) -> DataFrame:
    return neighbours.select(
        F.least("tile_id", "other_id").alias("tile_a"), F.greatest("tile_id", "other_id").alias("tile_b")
    ).distinct()


def tile_pair_overlap(px: DataFrame, pairs: DataFrame) -> DataFrame:
    """Cells both tiles of a pair hold, on the global integer lattice.

    Columns of the first tile end in 0, of the second in 1; extents are closed.
    """
    bands = [c for c in px.columns if c not in ("tile_id", "row", "col")]
    ends = px.groupBy("tile_id").agg(F.min("row").alias("_r0"), F.max("row").alias("_r1"), F.min("col").alias("_c0"), F.max("col").alias("_c1"))
    at = lambda t: ends.select(F.col("tile_id").alias(f"tile_{t}"), *[F.col(c).alias(f"{c}{t}") for c in ("_r0", "_r1", "_c0", "_c1")])
    both = pairs.join(at("a"), "tile_a").join(at("b"), "tile_b")
    low, high = (lambda c: F.greatest(f"{c}a", f"{c}b")), (lambda c: F.least(f"{c}a", f"{c}b"))
    # only the rectangle that both extents share can hold common cells
    shared = both.select(*pairs.columns, low("_r0").alias("_top"), high("_r1").alias("_bottom"), low("_c0").alias("_left"), high("_c1").alias("_right"))
    inside = F.col("row").between(F.col("_top"), F.col("_bottom")) & F.col("col").between(F.col("_left"), F.col("_right"))
    ra = px.select(F.col("tile_id").alias("tile_a"), "row", "col", *[F.col(b).alias(f"{b}0") for b in bands])
    rb = px.select(F.col("tile_id").alias("tile_b"), "row", "col", *[F.col(b).alias(f"{b}1") for b in bands])
    box = ["_top", "_bottom", "_left", "_right"]
    a = shared.join(ra, "tile_a").filter(inside).drop(*box)
    b = shared.select("tile_a", "tile_b", *box).join(rb, "tile_b").filter(inside).drop(*box)
    return a.join(b, ["tile_a", "tile_b", "row", "col"])
