"""Footprint outlines: convex hull of data cells and vertex removal.

Pixels are reduced natively to one leftmost and one rightmost column per row;
Python sees only those points, first per chunk of rows, then the chunk hulls.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_ROWS = 4096


def row_extremes(px: DataFrame, keys: Sequence[str], mask: Column) -> DataFrame:
    return px.filter(F.coalesce(mask, F.lit(False))).groupBy(*keys, "row").agg(F.min("col").alias("c0"), F.max("col").alias("c1"))


def hull_points(pts: np.ndarray) -> np.ndarray:
    """Counter-clockwise convex hull of (x, y) rows without collinear points."""
    pts = np.unique(pts, axis=0)
    if len(pts) < 3:
        return pts

    def chain(points):
        out: list = []
        for p in points:
            while len(out) > 1:
                a, b = out[-2], out[-1]
                if (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0]) > 0:
                    break
                out.pop()
            out.append(p)
        return out

    lower, upper = chain(pts), chain(pts[::-1])
    return np.array(lower[:-1] + upper[:-1])


def data_hull(px: DataFrame, keys: Sequence[str], mask: Column) -> DataFrame:
    """keys, hull: closed ring of (col, row) points around the true cells; rasters without any drop out."""
    keys = list(keys)
    ext = row_extremes(px, keys, mask).withColumn("_chunk", F.floor(F.col("row") / CHUNK_ROWS))
    key_type = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in px.select(*keys).schema.fields)

    def chunk_hull(pdf: pd.DataFrame) -> pd.DataFrame:
        pts = np.vstack([pdf[["c0", "row"]].to_numpy(float), pdf[["c1", "row"]].to_numpy(float)])
        h = hull_points(pts)
        out = pd.DataFrame({"x": h[:, 0], "y": h[:, 1]})
        for k in keys:
            out[k] = pdf[k].iloc[0]
        return out[[*keys, "x", "y"]]

    def whole_hull(pdf: pd.DataFrame) -> pd.DataFrame:
        h = hull_points(pdf[["x", "y"]].to_numpy(float))
        closed = [{"x": float(a), "y": float(b)} for a, b in np.vstack([h, h[:1]])]
        row = {k: [pdf[k].iloc[0]] for k in keys}
        return pd.DataFrame({**row, "hull": [closed]})

    parts = ext.groupBy(*keys, "_chunk").applyInPandas(chunk_hull, f"{key_type}, x double, y double")
    return parts.groupBy(*keys).applyInPandas(whole_hull, f"{key_type}, hull array<struct<x:double,y:double>>")


def hull_spans(hulls: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Closed column span of a convex ring on every lattice row it crosses."""
    ys = F.transform("hull", lambda v: v.y)
    d = hulls.select(*keys, "hull", F.explode(F.sequence(F.ceil(F.array_min(ys)).cast("int"), F.floor(F.array_max(ys)).cast("int"))).alias("row"))
    pairs = F.zip_with(F.slice("hull", 1, F.size("hull") - 1), F.slice("hull", 2, F.size("hull") - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    met = F.filter(pairs, lambda e: F.col("row").between(F.least(e.a.y, e.b.y), F.greatest(e.a.y, e.b.y)))
    xs = F.flatten(
        F.transform(
            met,
            lambda e: F.when(e.a.y == e.b.y, F.array(e.a.x, e.b.x)).otherwise(
                F.array(e.a.x + (F.col("row") - e.a.y) * (e.b.x - e.a.x) / F.when(e.a.y != e.b.y, e.b.y - e.a.y))
            ),
        )
    )
    d = d.withColumn("_xs", xs)
    # hull corners are whole cells, so rounding noise is far below this slack
    return d.select(*keys, "row", F.ceil(F.array_min("_xs") - 1e-9).cast("int").alias("h0"), F.floor(F.array_max("_xs") + 1e-9).cast("int").alias("h1"))


def inside_hull(px: DataFrame, keys: Sequence[str], mask: Column, out: str = "inside") -> DataFrame:
    """Cells inside the convex hull of the true cells of their raster."""
    spans = hull_spans(data_hull(px, keys, mask), keys)
    d = px.join(spans, [*keys, "row"], "left")
    return d.withColumn(out, F.coalesce(F.col("col").between(F.col("h0"), F.col("h1")), F.lit(False))).drop("h0", "h1")


# ---- vertex removal -----------------------------------------------------------


def _offset_sq(prev, v, nxt, clamp: bool = True) -> float:
    """Squared distance of ``v`` to the segment (or line) that would replace it."""
    ex, ey = nxt[0] - prev[0], nxt[1] - prev[1]
    length = ex * ex + ey * ey
    if length == 0:
        return math.nan if not clamp else (v[0] - prev[0]) ** 2 + (v[1] - prev[1]) ** 2
    t = ((v[0] - prev[0]) * ex + (v[1] - prev[1]) * ey) / length
    if clamp:
        t = min(1.0, max(0.0, t))
    return (prev[0] + t * ex - v[0]) ** 2 + (prev[1] + t * ey - v[1]) ** 2


def simplify_ring(ring: list, tol_sq: float | None = None, keep_share: float | None = None) -> list:
    """Closed ring of (x, y) with vertices of least accumulated offset removed.

    ``tol_sq`` bounds the squared accumulated offset.  With ``keep_share`` the
    bound instead grows by sqrt(1.5) whenever nothing qualifies, until that
    share of vertices is left.  Without either the bound is half the shortest
    edge.  Never fewer than three vertices.
    """
    if len(ring) <= 4:
        return ring
    pts = ring[:-1]
    n = len(pts)
    floor = 3
    if keep_share is not None:
        target = math.floor(n * keep_share + 0.5)
        if target == n:
            return ring
        floor = max(3, target)
    if tol_sq is None:
        tol_sq = keep_share if keep_share is not None else min(math.dist(p, r) for p, r in zip(ring, ring[1:])) / 2
    ahead = [*range(1, n), 0]
    behind = [n - 1, *range(n - 1)]
    carried = [0.0] * n
    # first scores measure to the whole line, later ones to the segment
    score = {i: _offset_sq(pts[behind[i]], pts[i], pts[ahead[i]], clamp=False) for i in range(n)}
    left = n
    queue = [(s, i) for i, s in score.items() if not math.isnan(s)]
    heapq.heapify(queue)
    while left > floor:
        while queue and score.get(queue[0][1]) != queue[0][0]:
            heapq.heappop(queue)  # removed, or scored anew since
        if not queue:
            break
        best, i = queue[0]
        if not best < tol_sq:
            if keep_share is None:
                break
            while not best < tol_sq:
                tol_sq *= math.sqrt(1.5)
        debt = carried[i] + math.sqrt(best)
        a, b = behind[i], ahead[i]
        del score[i]
        ahead[a], behind[b] = b, a
        left -= 1
        for j in (a, b):
            carried[j] = debt
            score[j] = (math.sqrt(_offset_sq(pts[behind[j]], pts[j], pts[ahead[j]])) + debt) ** 2
            heapq.heappush(queue, (score[j], j))
    kept = [pts[i] for i in range(n) if i in score]
    return [*kept, kept[0]]


def _offsets_sq(p: np.ndarray, v: np.ndarray, q: np.ndarray, clamp: bool = True) -> np.ndarray:
    """``_offset_sq`` of many vertices: rows of (x, y)."""
    e, d = q - p, v - p
    length = e[..., 0] * e[..., 0] + e[..., 1] * e[..., 1]
    with np.errstate(invalid="ignore", divide="ignore"):
        t = (d[..., 0] * e[..., 0] + d[..., 1] * e[..., 1]) / length
        if clamp:
            t = np.minimum(1.0, np.maximum(0.0, t))
        off = (p + t[..., None] * e) - v
        out = off[..., 0] * off[..., 0] + off[..., 1] * off[..., 1]
    return np.where(length == 0, d[..., 0] * d[..., 0] + d[..., 1] * d[..., 1] if clamp else np.nan, out)


def simplify_rings(pts: np.ndarray, tol_sq: float | None = None, keep_share: float | None = None) -> np.ndarray:
    """``simplify_ring`` for rings of the same number of vertices, one vertex of each per step: a mask of the vertices kept.

    ``pts``: (rings, vertices, 2), without the closing vertex; at least four vertices.
    """
    m, n = pts.shape[:2]
    kept = np.ones((m, n), bool)
    floor = 3
    if keep_share is not None:
        target = math.floor(n * keep_share + 0.5)
        if target == n:
            return kept
        floor = max(3, target)
    if tol_sq is None and keep_share is None:
        gap = np.roll(pts, -1, axis=1) - pts
        tol = np.hypot(gap[..., 0], gap[..., 1]).min(axis=1) / 2
    else:
        tol = np.full(m, tol_sq if tol_sq is not None else keep_share)
    ahead = np.tile(np.roll(np.arange(n), -1), (m, 1))
    behind = np.tile(np.roll(np.arange(n), 1), (m, 1))
    carried = np.zeros((m, n))
    # first scores measure to the whole line, later ones to the segment; infinite: removed, or without a score
    score = _offsets_sq(np.roll(pts, 1, axis=1), pts, np.roll(pts, -1, axis=1), clamp=False)
    score[np.isnan(score)] = np.inf
    rings = np.arange(m)
    for _ in range(n - floor):
        i = score[rings].argmin(axis=1)
        best = score[rings, i]
        if keep_share is not None:
            go = best < np.inf
            while (low := go & ~(best < tol[rings])).any():
                tol[rings[low]] *= math.sqrt(1.5)
        else:
            go = best < tol[rings]
        rings, i, best = rings[go], i[go], best[go]
        if not len(rings):
            break
        debt = carried[rings, i] + np.sqrt(best)
        a, b = behind[rings, i], ahead[rings, i]
        kept[rings, i], score[rings, i] = False, np.inf
        ahead[rings, a], behind[rings, b] = b, a
        for j in (a, b):
            carried[rings, j] = debt
            off = _offsets_sq(pts[rings, behind[rings, j]], pts[rings, j], pts[rings, ahead[rings, j]])
            fresh = np.sqrt(off) + debt
            score[rings, j] = fresh * fresh
    return kept


def simplify_footprints(
    footprints: DataFrame, poly: str = "poly", tol_sq: float | None = None, keep_share: float | None = None
) -> DataFrame:
    """Every ring of the table simplified; the rings of a batch with equal numbers of vertices at once."""
    if tol_sq is not None and tol_sq <= 0:
        raise ValueError("tolerance must be positive")
    if keep_share is not None and not 0 < keep_share < 1:
        raise ValueError("share of vertices must lie between 0 and 1")
    schema = footprints.schema

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            at = batch.schema.get_field_index(poly)
            rings = batch.column(at)
            vertices = rings.flatten()
            xy = np.column_stack([vertices.field(c).to_numpy(zero_copy_only=False) for c in ("x", "y")])
            sizes = pc.fill_null(pc.list_value_length(rings), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            start = np.concatenate([[0], np.cumsum(sizes)])
            kept = np.ones(len(xy), bool)
            for n in np.unique(sizes[sizes > 4]):
                which = start[:-1][sizes == n]
                rows = which[:, None] + np.arange(n - 1)
                kept[rows] = simplify_rings(xy[rows], tol_sq, keep_share)
                # the ring is closed by the first vertex kept
                first = rows[np.arange(len(rows)), kept[rows].argmax(axis=1)]
                xy[which + n - 1] = xy[first]
            ends = np.concatenate([[0], np.cumsum(kept)])[start].astype(np.int32)
            kind = rings.type.value_type
            values = pa.StructArray.from_arrays([pa.array(xy[kept, k], kind.field(k).type) for k in range(2)], fields=[kind.field(k) for k in range(2)])
            gone = pc.is_null(rings).to_numpy(zero_copy_only=False)
            new = pa.ListArray.from_arrays(pa.array(ends), values, type=rings.type, mask=pa.array(gone) if gone.any() else None)
            yield pa.RecordBatch.from_arrays([new if k == at else c for k, c in enumerate(batch.columns)], schema=batch.schema)

    return footprints.mapInArrow(batches, schema)


def outline(px: DataFrame, keys: Sequence[str], res: float, z: str = "z") -> DataFrame:
    """Simplified hull of data cells in map coordinates (col * res, -row * res)."""
    h = data_hull(px, keys, F.col(z).isNotNull())
    h = simplify_footprints(h, "hull", tol_sq=1.0)
    return h.select(*keys, F.transform("hull", lambda v: F.struct((v.x * res).alias("x"), (-v.y * res).alias("y"))).alias("poly"))
