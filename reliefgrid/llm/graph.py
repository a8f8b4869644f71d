"""Connected components of a link table, by contraction in rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reliefgrid.rounds import Rounds


def components(links: DataFrame, rounds: Rounds, label: str = "graph") -> DataFrame:
    """(a, b) links of long ids to (node, root) for every linked node.

    In each round a node moves to the first of itself and its neighbours, in an
    order scrambled anew per round, so a chain shrinks by a constant factor; links
    are then renamed, equal ones merged and loops dropped. Minima are combined
    before the shuffle, so a node with very many links is no hot group. The root
    names the component; it isn't its smallest node. Loops, repeated links and
    links with a null end are allowed; a null end links nothing.
    """
    edges = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    edges = rounds.put(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{label}-links")
    moves: list[DataFrame] = []
    while not edges.isEmpty():
        k = len(moves)
        ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = F.min(F.struct(F.xxhash64("b", F.lit(k)).alias("h"), F.col("b")))
        near = ends.groupBy("a").agg(first.alias("n"))
        own = F.struct(F.xxhash64("a", F.lit(k)).alias("h"), F.col("a").alias("b"))
        move = rounds.put(near.select(F.col("a").alias("node"), F.least("n", own)["b"].alias("root")), f"{label}-move{k}")
        moves.append(move)
        a, b = (move.select(F.col("node").alias(x), F.col("root").alias(f"{x}2")) for x in "ab")
        moved = edges.join(a, "a").join(b, "b").where("a2 <> b2")
        edges = rounds.put(moved.select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct(), f"{label}-links")
    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = moves[0]
    for move in moves[1:]:
        later = move.select(F.col("node").alias("root"), F.col("root").alias("next"))
        found = found.join(later, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return found
