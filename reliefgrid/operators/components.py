"""Connected components of masks through a run graph.

Cells are first reduced to horizontal runs; runs of neighbouring rows that
touch form edges.  Edges inside one square block are resolved block by block
(a block holds a bounded number of runs); what crosses blocks is contracted
round by round, every node hooking to its smallest neighbour, until no edge
joins two different labels.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .kernels import raster_extent

COLUMN_BUCKET = 64
GRAPH_BLOCK = 512


def _node(row: Column, col: Column) -> Column:
    """A run's id from its first cell, scrambled by a bijection.

    Ids in scan order would form long descending chains down a shape, and
    hooking to the smallest neighbour would shorten them by a constant only.
    Shift-and-xor steps are invertible, so ids stay unique.
    """
    x = F.shiftleft(row.cast("long"), 32).bitwiseOR(col.cast("long"))
    for _ in range(2):
        x = x.bitwiseXOR(F.shiftleft(x, 13))
        x = x.bitwiseXOR(F.shiftrightunsigned(x, 7))
        x = x.bitwiseXOR(F.shiftleft(x, 17))
    return x


def mark_runs(px: DataFrame, keys: Sequence[str], mask: Column) -> DataFrame:
    """Add ``_on`` and, for true cells, ``_run``: the run's first column."""
    w = Window.partitionBy(*keys, "row").orderBy("col")
    d = px.withColumn("_on", F.coalesce(mask, F.lit(False)))
    joined = F.lag("_on").over(w) & (F.lag("col").over(w) == F.col("col") - 1)
    start = F.when(F.col("_on") & ~F.coalesce(joined, F.lit(False)), F.col("col"))
    d = d.withColumn("_start", start)
    latest = F.last("_start", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return d.withColumn("_run", F.when(F.col("_on"), latest)).drop("_start")


def runs_of(marked: DataFrame, keys: Sequence[str]) -> DataFrame:
    return (
        marked.filter("_on")
        .groupBy(*keys, "row", F.col("_run").alias("c0"))
        .agg(F.max("col").alias("c1"))
        .withColumn("node", _node(F.col("row"), F.col("c0")))
    )


def run_edges(runs: DataFrame, keys: Sequence[str], connectivity: int = 8) -> DataFrame:
    """(keys, u, v, gr, gc) for touching runs of adjacent rows.

    Runs are bucketed by column so that a row with many runs is not compared
    with itself in full; a pair is emitted only in the bucket its overlap starts
    in.  gr, gc name the graph block both runs start in, NULL if they differ.
    """
    k = {4: 0, 8: 1}[connectivity]

    def bucketed(d, lo, hi):
        return d.withColumn("_b", F.explode(F.sequence(F.floor(lo / COLUMN_BUCKET), F.floor(hi / COLUMN_BUCKET))))

    up = bucketed(
        runs.select(*keys, "row", F.col("c0").alias("a0"), F.col("c1").alias("a1"), F.col("node").alias("u")),
        F.col("a0"),
        F.col("a1"),
    )
    down = bucketed(
        runs.select(
            *keys,
            (F.col("row") - 1).alias("row"),
            (F.col("c0") - k).alias("b0"),
            (F.col("c1") + k).alias("b1"),
            F.col("node").alias("v"),
        ),
        F.col("b0"),
        F.col("b1"),
    )
    start = F.greatest("a0", "b0")
    block = lambda c: F.floor(c / GRAPH_BLOCK)
    same = (block(F.col("row")) == block(F.col("row") + 1)) & (block(F.col("a0")) == block(F.col("b0") + k))
    return (
        up.join(down, [*keys, "row", "_b"])
        .filter((F.col("a0") <= F.col("b1")) & (F.col("b0") <= F.col("a1")))
        .filter(F.floor(start / COLUMN_BUCKET) == F.col("_b"))
        .select(*keys, "u", "v", F.when(same, block(F.col("row"))).alias("gr"), F.when(same, block(F.col("a0"))).alias("gc"))
    )


def smallest_reachable(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, smallest node of each one's component) of a small edge list."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    root = np.arange(len(nodes))
    while True:
        ra, rb = root[a], root[b]
        if (ra == rb).all():
            return nodes, nodes[root]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while (root != root[root]).any():
            root = root[root]


def resolve_blocks(edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, n, to: component label inside each block for every node with a local edge."""
    keys = list(keys)
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in edges.select(*keys).schema.fields)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        nodes, label = smallest_reachable(pdf["u"].to_numpy(), pdf["v"].to_numpy())
        out = pd.DataFrame({"n": nodes, "to": label})
        for key in keys:
            out[key] = pdf[key].iloc[0]
        return out[[*keys, "n", "to"]]

    local = edges.filter(F.col("gr").isNotNull())
    return local.groupBy(*keys, "gr", "gc").applyInPandas(one, f"{types}, n long, to long" if types else "n long, to long")


def _relabel(edges: DataFrame, step: DataFrame, keys: list[str]) -> DataFrame:
    """Both ends through the map ``n -> to``; loops and repeats removed."""
    d = edges.join(step.select(*keys, F.col("n").alias("u"), F.col("to").alias("u2")), [*keys, "u"], "left")
    d = d.join(step.select(*keys, F.col("n").alias("v"), F.col("to").alias("v2")), [*keys, "v"], "left")
    a, b = F.coalesce("u2", "u"), F.coalesce("v2", "v")
    return d.select(*keys, F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).filter("u <> v").distinct()


def contract(nodes: DataFrame, edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, node, label``: one label per component.

    Blocks first.  Then each round maps every endpoint to its smallest
    neighbour's smallest neighbour, rewrites and de-duplicates the edges and
    drops loops, so the edge list shrinks geometrically.
    """
    keys = list(keys)
    edges = cut(edges)
    step = cut(resolve_blocks(edges, keys))
    follow = lambda lab, st: lab.join(st.withColumnRenamed("n", "label"), [*keys, "label"], "left").select(
        *keys, "node", F.coalesce("to", "label").alias("label")
    )
    labels = cut(follow(nodes.select(*keys, "node", F.col("node").alias("label")), step))
    edges = cut(_relabel(edges.filter(F.col("gr").isNull()).select(*keys, "u", "v"), step, keys))
    while not edges.isEmpty():  # every node with an edge but the smallest of its neighbourhood is hooked away
        both = edges.unionByName(edges.select(*keys, F.col("v").alias("u"), F.col("u").alias("v")))
        hook = both.groupBy(*keys, "u").agg(F.min("v").alias("m")).select(*keys, F.col("u").alias("n"), F.least("u", "m").alias("p"))
        grand = hook.select(*keys, F.col("n").alias("p"), F.col("p").alias("g"))
        step = cut(hook.join(grand, [*keys, "p"], "left").select(*keys, "n", F.coalesce("g", "p").alias("to")))
        labels = cut(follow(labels, step))
        edges = cut(_relabel(edges, step, keys))
    return labels


def label_runs(runs: DataFrame, keys: Sequence[str], connectivity: int = 8) -> DataFrame:
    """Runs with the component ``label`` each belongs to."""
    runs = cut(runs)
    labels = contract(runs, run_edges(runs, keys, connectivity), keys)
    return runs.join(labels, [*keys, "node"])


def drop_small(px, keys: Sequence[str], mask: Column, min_cells: int, out: str = "mask", connectivity: int = 8):
    """True cells whose component has at least ``min_cells`` cells."""
    marked = cut(mark_runs(px, keys, mask))
    lab = cut(label_runs(runs_of(marked, keys), keys, connectivity))
    size = lab.groupBy(*keys, "label").agg(F.sum(F.col("c1") - F.col("c0") + 1).alias("_size"))
    big = (
        lab.join(size.filter(F.col("_size") >= min_cells), [*keys, "label"])
        .select(*keys, "row", F.col("c0").alias("_run"), F.lit(True).alias("_keep"))
    )
    joined = marked.join(big, [*keys, "row", "_run"], "left")
    # _run is NULL off the mask, so those cells never match
    return joined.withColumn(out, F.coalesce("_keep", F.lit(False))).drop("_on", "_run", "_keep")


def drop_small_kinds(px, keys: Sequence[str], kind: Column, min_cells: int, out: str = "kind", connectivity: int = 8):
    """The kind of cells whose component of cells of that kind has at least ``min_cells`` cells, else NULL.

    All kinds share each step of the run graph; a cell has one kind or, by NULL, none.
    """
    w = Window.partitionBy(*keys, "row").orderBy("col")
    d = px.withColumn("_kind", kind)
    joined = (F.lag("_kind").over(w) == F.col("_kind")) & (F.lag("col").over(w) == F.col("col") - 1)
    d = d.withColumn("_start", F.when(F.col("_kind").isNotNull() & ~F.coalesce(joined, F.lit(False)), F.col("col")))
    latest = F.last("_start", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    marked = cut(d.withColumn("_run", F.when(F.col("_kind").isNotNull(), latest)).drop("_start"))
    k = [*keys, "_kind"]
    lab = cut(label_runs(runs_of(marked.withColumn("_on", F.col("_kind").isNotNull()), k), k, connectivity))
    size = lab.groupBy(*k, "label").agg(F.sum(F.col("c1") - F.col("c0") + 1).alias("_size"))
    big = lab.join(size.filter(F.col("_size") >= min_cells), [*k, "label"]).select(*k, "row", F.col("c0").alias("_run"), F.lit(True).alias("_keep"))
    return marked.join(big, [*k, "row", "_run"], "left").withColumn(out, F.when(F.col("_keep"), F.col("_kind"))).drop("_kind", "_run", "_keep")


def fill_small_gaps(px, keys, mask: Column, max_cells: int, out: str = "mask", connectivity: int = 8):
    """Turn false components below ``max_cells`` true."""
    d = drop_small(px, keys, ~F.coalesce(mask, F.lit(False)), max_cells, "_gap", connectivity)
    return d.withColumn(out, ~F.col("_gap")).drop("_gap")


def component_sizes(px, keys, mask: Column, connectivity: int = 8) -> DataFrame:
    """One row per component: label cell, cells, bounding rows."""
    lab = label_runs(runs_of(mark_runs(px, keys, mask), keys), keys, connectivity)
    return lab.groupBy(*keys, "label").agg(
        F.sum(F.col("c1") - F.col("c0") + 1).cast("long").alias("cells"),
        F.min("row").alias("r0"),
        F.max("row").alias("r1"),
    )


def fill_holes(px, keys: Sequence[str], mask: Column, out: str = "mask") -> DataFrame:
    """Background not 4-connected to the raster's rim becomes true."""
    marked = cut(mark_runs(px, keys, ~F.coalesce(mask, F.lit(False))))
    ext = raster_extent(marked, keys).withColumnsRenamed({"r0": "_r0", "r1": "_r1", "c0": "_c0", "c1": "_c1"})
    lab = cut(label_runs(runs_of(marked, keys), keys, 4))
    rim = (F.col("row") == F.col("_r0")) | (F.col("row") == F.col("_r1")) | (F.col("c0") == F.col("_c0")) | (F.col("c1") == F.col("_c1"))
    open_ = lab.join(ext, list(keys)).groupBy(*keys, "label").agg(F.bool_or(rim).alias("_open"))
    holes = (
        lab.join(open_.filter(~F.col("_open")), [*keys, "label"])
        .select(*keys, "row", F.col("c0").alias("_run"), F.lit(True).alias("_hole"))
    )
    d = marked.join(holes, [*keys, "row", "_run"], "left")
    return d.withColumn(out, ~F.col("_on") | F.coalesce("_hole", F.lit(False))).drop("_on", "_run", "_hole")


def boundary_cells(px, keys: Sequence[str], mask: Column, out: str = "boundary") -> DataFrame:
    """Outer boundary: filled cells with a false or outside 4-neighbour.

    Each axis pass groups by one raster line, so no group exceeds one side.
    """
    d = fill_holes(px, keys, mask, "_solid")
    on = F.col("_solid")
    for part, axis in (("row", "col"), ("col", "row")):
        w = Window.partitionBy(*keys, part).orderBy(axis)
        prev = F.when(F.lag(axis).over(w) == F.col(axis) - 1, F.lag("_solid").over(w))
        nxt = F.when(F.lead(axis).over(w) == F.col(axis) + 1, F.lead("_solid").over(w))
        flat = F.coalesce(prev, F.lit(False)) & F.coalesce(nxt, F.lit(False))
        d = d.withColumn(f"_in_{axis}", flat)
    return d.withColumn(out, on & ~(F.col("_in_col") & F.col("_in_row"))).drop("_solid", "_in_col", "_in_row")
