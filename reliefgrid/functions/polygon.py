"""Polygons as ``ARRAY<STRUCT<x,y>>`` columns (closed rings), native functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ring(*points) -> Column:
    """Closed ring from (x, y) column pairs."""
    pts = [F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in points]
    return F.array(*pts, pts[0])


def box_ring(x0: Column, x1: Column, y0: Column, y1: Column) -> Column:
    return ring((x0, y0), (x0, y1), (x1, y1), (x1, y0))


def edges(poly: Column) -> Column:
    """Consecutive vertex pairs as structs (ax, ay, bx, by)."""
    return F.zip_with(
        F.slice(poly, 1, F.greatest(F.size(poly) - 1, F.lit(0))),
        F.slice(poly, 2, F.greatest(F.size(poly) - 1, F.lit(0))),
        lambda a, b: F.struct(a.x.alias("ax"), a.y.alias("ay"), b.x.alias("bx"), b.y.alias("by")),
    )


def contains(poly: Column, px: Column, py: Column) -> Column:
    """Even-odd test of a point against a ring."""
    return edges_enclose(edges(poly), px, py)


def edges_enclose(ring_edges: Column, px: Column, py: Column) -> Column:
    """The same test on prepared edges, for rings that meet many points."""
    hits = F.filter(
        ring_edges,
        lambda e: ((e.ay > py) != (e.by > py))
        & (px < e.ax + (py - e.ay) * (e.bx - e.ax) / F.when(e.by != e.ay, e.by - e.ay)),
    )
    return F.size(hits) % 2 == 1


def edge_crossings(ring_edges: Column, py: Column) -> Column:
    """Sorted x where prepared edges cross the horizontal line at ``py``."""
    hit = F.filter(ring_edges, lambda e: (e.ay > py) != (e.by > py))
    return F.sort_array(
        F.transform(hit, lambda e: e.ax + (py - e.ay) * (e.bx - e.ax) / (e.by - e.ay))
    )


def any_vertex_inside(points: Column, poly: Column) -> Column:
    return F.exists(points, lambda v: contains(poly, v.x, v.y))


def signed_area(poly: Column) -> Column:
    return (
        F.aggregate(edges(poly), F.lit(0.0), lambda acc, e: acc + (e.ax * e.by - e.bx * e.ay)) / 2
    )


def area(poly: Column) -> Column:
    return F.abs(signed_area(poly))


def edge_lengths(poly: Column) -> Column:
    return F.transform(edges(poly), lambda e: F.hypot(e.bx - e.ax, e.by - e.ay))


def perimeter(poly: Column) -> Column:
    return F.aggregate(edge_lengths(poly), F.lit(0.0), lambda acc, d: acc + d)


def shortest_edge(poly: Column) -> Column:
    return F.array_min(edge_lengths(poly))


def box_overlap(ax0, ax1, ay0, ay1, bx0, bx1, by0, by1) -> Column:
    """Area shared by two axis-aligned boxes."""
    w = F.greatest(F.lit(0.0), F.least(ax1, bx1) - F.greatest(ax0, bx0))
    h = F.greatest(F.lit(0.0), F.least(ay1, by1) - F.greatest(ay0, by0))
    return w * h
