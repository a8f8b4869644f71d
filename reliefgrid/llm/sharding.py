"""A reproducible shuffle into shards by a keyed permutation of row numbers.

Rows get global numbers 0..n-1 in the order of their key. A Feistel network
permutes a domain of r x c >= n numbers; numbers that land at n or beyond walk on
along their cycle until they are below n, which they must reach, as their cycle
holds the number they started from. So the permutation of 0..n-1 is exact, needs
no table, and shard and slot of any row are computable from its number: shard =
image mod shards, slot = image div shards. Shard sizes differ by at most one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reliefgrid.llm.arrow import fresh
from reliefgrid.rounds import Rounds

ROUNDS = 6


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x.astype(np.uint64) + np.uint64(key)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _keys(seed: int) -> list[int]:
    return [int(k) for k in _mix(np.arange(ROUNDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), seed % 2**64)]


def _sides(n: int) -> tuple[int, int]:
    """The sides of the smallest near-square domain that holds n numbers."""
    rows = max(1, int(np.ceil(np.sqrt(n))))
    while rows * rows < n:
        rows += 1
    return rows, max(1, -(-n // rows))


def _once(x: np.ndarray, rows: int, cols: int, keys: list[int], back: bool) -> np.ndarray:
    """One pass of the network over [0, rows * cols): the halves are added to in turn, each modulo its own side."""
    a, b = x // cols, x % cols
    for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
        if i % 2:
            move = (_mix(a, keys[i]) % np.uint64(cols)).astype(np.int64)
            b = (b - move if back else b + move) % cols
        else:
            move = (_mix(b, keys[i]) % np.uint64(rows)).astype(np.int64)
            a = (a - move if back else a + move) % rows
    return a * cols + b


def permute(number: np.ndarray, n: int, seed: int = 0, back: bool = False) -> np.ndarray:
    """The images of row numbers below n; with ``back`` the numbers of images."""
    rows, cols = _sides(n)
    keys = _keys(seed)
    with np.errstate(over="ignore"):
        x = _once(np.asarray(number, np.int64), rows, cols, keys, back)
        while len(far := np.flatnonzero(x >= n)):
            x[far] = _once(x[far], rows, cols, keys, back)
    return x


def numbered(rows: DataFrame, order: list[str], rounds: Rounds, name: str = "row_number") -> tuple[DataFrame, int]:
    """The rows with gapless numbers from 0 in the order of ``order``, and their count.

    Rows are dealt by range and numbered inside each range; the ranges' counts,
    one per partition, give the offsets. Equal rows get different numbers. A column
    called ``name`` raises an error; others keep their names and values.
    """
    _free(rows, name)
    place, part, inside, n, before = (fresh(rows.columns, c) for c in ("_at", "_range", "_in", "_n", "_before"))
    ranges = rounds.put(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(place, F.monotonically_increasing_id()), "ranges")
    split = ranges.withColumn(part, F.shiftright(place, 33)).withColumn(inside, F.col(place).bitwiseAND(F.lit((1 << 33) - 1)))
    sums = rounds.put(split.groupBy(part).agg(F.count("*").alias(n)), "sums")
    total = sums.agg(F.sum(n)).first()[0] or 0
    offset = F.sum(n).over(Window.orderBy(part)) - F.col(n)
    out = split.join(F.broadcast(sums.select(part, offset.alias(before))), part)
    return out.withColumn(name, F.col(before) + F.col(inside)).select(*rows.columns, name), total


def _free(rows: DataFrame, *names: str) -> None:
    if taken := {c.lower() for c in rows.columns} & {c.lower() for c in names}:
        raise ValueError(f"the input already has {sorted(taken)}")


def shard(rows: DataFrame, n: int, shards: int, seed: int = 0, number: str = "row_number") -> DataFrame:
    """Rows numbered 0..n-1 with their shard (int) and slot (long); columns called so raise an error, others stay."""
    _free(rows, "shard", "slot")
    made = fresh(rows.columns, "_image")

    @F.pandas_udf("long")
    def image(numbers: pd.Series) -> pd.Series:
        return pd.Series(permute(numbers.to_numpy(), n, seed))

    at = rows.withColumn(made, image(F.col(number)))
    return at.withColumn("shard", F.pmod(made, F.lit(shards)).cast("int")).withColumn("slot", F.floor(F.col(made) / F.lit(shards)).cast("long")).drop(made)


def locate(number: int, n: int, shards: int, seed: int = 0) -> tuple[int, int]:
    """Shard and slot of one row number, without any data."""
    image = int(permute(np.array([number]), n, seed)[0])
    return image % shards, image // shards


def number_at(shard_id: int, slot: int, n: int, shards: int, seed: int = 0) -> int:
    """The row number behind a shard and slot."""
    return int(permute(np.array([slot * shards + shard_id]), n, seed, back=True)[0])
