"""Square blocks with a halo: one shuffle serves a whole chain of kernels.

Cells are copied to every block they are within ``reach`` cells of, then hash
partitioned by (raster, block).  Any window over (raster, block, row) or
(raster, block, col) is already co-located by that hash, so the chain needs
sorts but no further exchange, and one huge raster is spread over many tasks.
Values near a block's rim are wrong by construction and dropped by ``core``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

BLOCK = 256
BLOCK_KEYS = ["_br", "_bc"]


def _span(axis: str, reach: int, block: int):
    lo = F.floor((F.col(axis) - reach) / block)
    hi = F.floor((F.col(axis) + reach) / block)
    return F.explode(F.sequence(lo, hi))


def with_halo(df: DataFrame, keys: Sequence[str], reach: int, block: int = BLOCK) -> DataFrame:
    block = max(block, 2 * reach)
    out = df.select("*", _span("row", reach, block).alias("_br"))
    out = out.select("*", _span("col", reach, block).alias("_bc"))
    return out.repartition(*keys, *BLOCK_KEYS)


def core(df: DataFrame, reach: int, block: int = BLOCK) -> DataFrame:
    block = max(block, 2 * reach)
    own = (F.floor(F.col("row") / block) == F.col("_br")) & (F.floor(F.col("col") / block) == F.col("_bc"))
    return df.filter(own).drop(*BLOCK_KEYS)


def along_row(keys: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys, "row").orderBy("col")


def along_col(keys: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys, "col").orderBy("row")


def blocked(keys: Sequence[str]) -> list[str]:
    return [*keys, *BLOCK_KEYS]
