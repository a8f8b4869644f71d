"""Embedding near-duplicates through an inverted multi-index.

Unit vectors are cut in halves, and each half has a codebook of its own, fitted on a
bounded sample; the product of the two is the grid of cells. Every vector lies in the
cell of its nearest codes, and visits the nearest cells in the order in which a
multi-sequence traversal meets them: by the sum of its halves' distances. How many
cells it visits follows from the target recall: on pairs planted at the threshold
cosine, that share must lie in each other's visited cells. Whoever meets in a cell is
verified by cosine in double precision.

Vectors meet within their label only. Equal vectors are one class. A cell's members
and visitors are dealt into blocks, so a crowded cell is many tasks; a block returns
link counts and a spanning forest of its links, never the pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reliefgrid.llm.graph import components
from reliefgrid.rounds import Rounds

#: Members that a label's cells have on average, and most codes of a half.
CELL_ROWS, MOST_CODES = 400, 1024
#: Vectors that codebooks are fitted on, for each code, and the steps of the fit.
SAMPLE_PER_CODE, FIT_STEPS = 64, 15
#: Share of pairs planted at the threshold that must meet, and how many are planted.
TARGET_RECALL, PLANTED = 0.999, 4000
#: Rows of a side of a block.
BLOCK = 2048


@dataclass
class Index:
    """Codebooks of both halves, and the number of cells that a vector visits."""

    books: tuple[np.ndarray, np.ndarray]
    visited: int


def _distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(axis=1)[:, None] - 2 * x @ book.T + (book**2).sum(axis=1)[None, :], 0)


def _codebook(x: np.ndarray, codes: int, rng: np.random.Generator) -> np.ndarray:
    """Lloyd's steps from a random start; a code that loses all its vectors starts anew at a random one."""
    book = x[rng.permutation(len(x))[:codes]].copy()
    for _ in range(FIT_STEPS):
        own = _distances(x, book).argmin(axis=1)
        n = np.bincount(own, minlength=len(book))
        sums = np.zeros_like(book)
        np.add.at(sums, own, x)
        book = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], x[rng.integers(0, len(x), len(book))])
    return book


def halves(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = (unit.shape[1] + 1) // 2
    return unit[:, :cut], unit[:, cut:]


def traverse(unit: np.ndarray, index: Index, most: int) -> np.ndarray:
    """The first ``most`` cells of each vector's traversal, nearest first.

    The cell of the a-th and b-th nearest codes comes after all cells of nearer
    codes, so among the first ``most`` only pairs with (a + 1)(b + 1) <= most can be.
    """
    near, codes = [], len(index.books[1])
    for half, book in zip(halves(unit), index.books):
        d = _distances(half, book)
        order = np.argsort(d, axis=1, kind="stable")
        near.append((order, np.take_along_axis(d, order, axis=1)))
    pairs = np.array([(a, b) for a in range(len(index.books[0])) for b in range(codes) if (a + 1) * (b + 1) <= most])
    cost = near[0][1][:, pairs[:, 0]] + near[1][1][:, pairs[:, 1]]
    first = np.argsort(cost, axis=1, kind="stable")[:, :most]
    rows = np.arange(len(unit))[:, None]
    return near[0][0][rows, pairs[first, 0]] * codes + near[1][0][rows, pairs[first, 1]]


def unit_rows(values: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision."""
    values = values.astype(np.float64)
    values = values / np.abs(values).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return values / np.sqrt((values**2).sum(axis=1, keepdims=True))


def fit(sample: np.ndarray, codes: int, cosine: float, seed: int = 5) -> Index:
    """Codebooks from unit vectors, and the cells to visit for the target recall."""
    rng = np.random.default_rng(seed)
    codes = max(1, min(codes, len(sample)))
    index = Index(tuple(_codebook(x, codes, rng) if x.shape[1] else np.zeros((1, 0)) for x in halves(sample)), 1)
    u = sample[rng.integers(0, len(sample), PLANTED)]
    r = rng.normal(size=u.shape)
    r -= (r * u).sum(axis=1, keepdims=True) * u
    length = np.sqrt((r**2).sum(axis=1, keepdims=True))
    v = cosine * u + np.sqrt(1 - cosine**2) * np.divide(r, length, out=np.zeros_like(r), where=length > 0)
    home = traverse(v, index, 1)
    cells = len(index.books[0]) * len(index.books[1])
    most = min(cells, 16)
    while True:
        met = traverse(u, index, most) == home
        if most == cells or met.any(axis=1).mean() >= TARGET_RECALL:
            break
        most = min(cells, 2 * most)
    rank = np.where(met.any(axis=1), met.argmax(axis=1), cells - 1)
    index.visited = int(np.sort(rank)[int(np.ceil(TARGET_RECALL * len(rank))) - 1]) + 1
    return index


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _placed(classes: DataFrame, books: dict[int, Index]) -> DataFrame:
    """Classes with their home cell and the cells that they visit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                some = batch.filter(pa.array(dims == dim))
                at = traverse(unit_rows(_matrix(some.column("embedding"))), books[dim], books[dim].visited).astype(np.int32)
                visits = pa.ListArray.from_arrays(np.arange(0, at.size + 1, at.shape[1], dtype=np.int32), at.reshape(-1))
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(at[:, 0]), visits], [*some.schema.names, "home", "visits"])

    return classes.mapInArrow(run, "label string, dim int, id long, n long, embedding array<double>, home int, visits array<int>")


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Those of the links a-b that join what earlier ones have not."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = top(x), top(y)
        if p != q:
            parent[p] = q
            kept.append((x, y))
    return kept


def _verified(cosine: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Links of a block of visitors and a block of a cell's members: (a, null, links) counts and (a, b, 0) forest links."""

    def run(members: pa.Table, visitors: pa.Table) -> pa.Table:
        if not (len(members) and len(visitors)):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        u, v = (t.column("id").to_numpy() for t in (visitors, members))
        nu, nv = (t.column("n").to_numpy() for t in (visitors, members))
        home = visitors.column("home").to_numpy()
        cell = members.column("cell")[0].as_py()
        visits = _matrix(members.column("visits"))
        y = unit_rows(_matrix(members.column("embedding")))
        x = unit_rows(_matrix(visitors.column("embedding")))
        count_u, count_v = np.zeros(len(u), np.int64), np.zeros(len(v), np.int64)
        links: list[tuple[int, int]] = []
        homes, which = np.unique(home, return_inverse=True)
        back = np.array([(visits == h).any(axis=1) for h in homes])  # whether a member visits the visitors' home as well
        for begin in range(0, len(u), 512):
            some = slice(begin, begin + 512)
            near = x[some] @ y.T >= cosine
            smaller = u[some, None] < v[None, :]
            mutual = back[which[some]] | (home[some] == cell)[:, None]
            near &= smaller | ~mutual  # a pair that meets twice counts where the smaller one visits
            near &= u[some, None] != v[None, :]
            count_u[some] += near @ nv
            count_v += nu[some] @ near
            i, j = np.nonzero(near)
            links += _forest(u[some][i], v[j])
        links = _forest(*np.array(links, np.int64).reshape(-1, 2).T)
        ends = np.array(links, np.int64).reshape(-1, 2)
        a = np.concatenate([u, v, ends[:, 0]])
        b = pa.array(np.concatenate([np.zeros(len(u) + len(v), np.int64), ends[:, 1]]), mask=np.arange(len(a)) < len(u) + len(v))
        n = np.concatenate([count_u, count_v, np.zeros(len(ends), np.int64)])
        kept = np.concatenate([count_u > 0, count_v > 0, np.ones(len(ends), bool)])
        return pa.table({"a": a, "b": b, "n": n}).filter(pa.array(kept))

    return run


def near_duplicates(vectors: DataFrame, rounds: Rounds, cosine: float = 0.93, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    n_links counts the other rows of the label found with a cosine of at least
    ``cosine``; component_id is the smallest vec_id that links reach. A row whose id,
    label or vector is null, or whose vector is empty, zero or holds a null or
    non-finite number, has no links and is its own component. Only vectors of equal
    length meet. Repeated rows are vectors of their own. ``kept`` is null without an id.
    """
    numbers = F.transform(F.col(embedding), lambda x: x.cast("double"))
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), numbers.alias("embedding"))
    usable = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    keys = {"k1": F.when(usable, F.xxhash64("label", "embedding")), "k2": F.when(usable, F.xxhash64("embedding", F.lit(2)))}
    keyed = rows.withColumns(keys)
    usable_rows = keyed.where("k1 is not null").withColumn("dim", F.size("embedding"))
    classes = rounds.put(usable_rows.groupBy("label", "dim", "k1", "k2").agg(F.min("vec_id").alias("id"), F.count("*").alias("n"), F.first("embedding").alias("embedding")), "classes")
    books = {}
    sizes = classes.groupBy("label", "dim").agg(F.count("*").alias("n")).groupBy("dim").agg(F.max("n").alias("n")).collect()  # one row for each vector length
    for r in sizes:
        codes = int(min(MOST_CODES, max(2, round((r["n"] / CELL_ROWS) ** 0.5))))
        drawn = classes.where(F.col("dim") == r["dim"]).orderBy(F.xxhash64("id"), "id").limit(max(512, SAMPLE_PER_CODE * codes)).select("embedding").toPandas()
        books[r["dim"]] = fit(unit_rows(np.stack(drawn["embedding"].to_numpy())), codes, cosine)
    placed = rounds.put(_placed(classes.select("label", "dim", "id", "n", "embedding"), books), "placed")

    place = ["label", "dim", "cell"]
    members = placed.withColumn("cell", F.col("home"))
    visitors = rounds.again("placed").withColumn("cell", F.explode("visits"))
    blocks = lambda t, name: t.groupBy(*place).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name))
    grid = rounds.put(blocks(members, "m").join(blocks(visitors, "v"), place), "grid")
    share = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    one = members.join(grid, place).select(*place, share("m").alias("mb"), every("v").alias("vb"), "id", "n", "embedding", "visits")
    two = visitors.join(grid, place).select(*place, every("m").alias("mb"), share("v").alias("vb"), "id", "n", "embedding", "home")
    block = [*place, "mb", "vb"]
    found = rounds.put(one.groupBy(*block).cogroup(two.groupBy(*block)).applyInArrow(_verified(cosine), "a long, b long, n long"), "found")

    counts = found.where("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("found"))
    roots = components(found.where("b is not null"), rounds)
    named = classes.select("k1", "k2", "id", "n").join(counts, "id", "left").join(roots.withColumnRenamed("node", "id"), "id", "left")
    named = rounds.put(named.select("k1", "k2", "id", (F.coalesce("found", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "id").alias("root")), "named")
    least = named.groupBy("root").agg(F.min("id").alias("component"))
    told = named.join(least, "root").select("k1", "k2", "n_links", "component")
    out = keyed.join(told, ["k1", "k2"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
