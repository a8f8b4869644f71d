"""Exact group quantiles by repeated counting.

The built-in exact ``percentile``/``median`` keeps every distinct value of a group in
one aggregation buffer; a group with a third of all pixels would not fit.  Here every
wanted rank has a value range.  A round cuts each range into BINS bins, counts them, and
the bin that holds the rank becomes its range, drawn in to the smallest and largest value
in it, until the rank is the first or last of its range or both are equal.  Groups of all sizes, and all ranks, share the rounds; only
counts of bins are shuffled.  Bins of equal width take turns with bins by magnitude.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS = 4096


def _bin(v: Column, lo: Column, hi: Column, by_root: bool) -> Column:
    """0 .. BINS - 1, not falling with v: the ends are in the first and last bin, infinite ones alone.

    Bins are of equal width, of the values or of their 64th roots: the roots part values
    of many orders of magnitude.
    """
    x, a, b = (F.signum(c) * F.pow(F.abs(c), F.lit(1 / 64)) if by_root else c for c in (v, lo, hi))
    # halves, since the width of a range can be more than a double holds
    at = (x / 2 - a / 2) / (b / 2 - a / 2) * (BINS - 1)
    # not a number where the lower end is infinite: that end is alone then
    inner = F.when(F.isnan(at), 1).otherwise(F.greatest(F.lit(0), F.least(F.lit(BINS - 2), F.floor(at))))
    return F.when(v == hi, BINS - 1).when(v == lo, 0).otherwise(inner).cast("int")


def _narrowed(v: DataFrame, ranges: DataFrame, keys: list[str], by_root: bool) -> DataFrame:
    """(keys, lo, hi, count, below, ranks): each range replaced by those of its bins that hold a rank."""
    of = [*keys, "_lo", "_hi"]
    inside = v.join(ranges.select(*of), keys).filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))
    bins = inside.groupBy(*of, _bin(F.col("_v"), F.col("_lo"), F.col("_hi"), by_root).alias("_bin")).agg(
        F.count("*").alias("_c"), F.min("_v").alias("_min"), F.max("_v").alias("_max")
    )
    upto = F.sum("_c").over(Window.partitionBy(*of).orderBy("_bin"))  # at most BINS rows of a range
    placed = bins.withColumn("_upto", upto).join(ranges.drop("_count"), of).withColumn("_end", F.col("_below") + F.col("_upto"))
    held = placed.withColumn("_ranks", F.filter("_ranks", lambda r: (r <= F.col("_end")) & (r > F.col("_end") - F.col("_c"))))
    return held.filter(F.size("_ranks") > 0).select(
        *keys, F.col("_min").alias("_lo"), F.col("_max").alias("_hi"), F.col("_c").alias("_count"), (F.col("_end") - F.col("_c")).alias("_below"), "_ranks"
    )


def _known(rank: Column) -> Column:
    """The value of a rank that its range tells; null if it may lie inside."""
    at = rank - F.col("_below")
    return F.when(at == 1, F.col("_lo")).when((at == F.col("_count")) | (F.col("_lo") == F.col("_hi")), F.col("_hi"))


def group_quantiles(
    df: DataFrame, keys: Sequence[str], value: Column, probs: dict[str, float], written: bool = False
) -> DataFrame:
    """``keys, n, <name>...`` with sample k placed at (k - 1/2)/n and linear between.

    At probability 0.5 this is the ordinary median.  NULL and NaN values are skipped;
    rows with a NULL key belong to no group.  ``written``: df is read from files, so
    that each round can read it again.
    """
    from ..session import cut

    whole = F.lit(0).alias("_all")
    named = list(keys)
    keys = named or ["_all"]
    v = df.select(*(named or [whole]), value.cast("double").alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    v = v if written else cut(v)
    # adding zero makes one value of 0.0 and -0.0, which compare as equal
    v = v.select(*keys, (F.col("_v") + F.lit(0.0)).alias("_v"))
    place = {name: F.greatest(F.lit(1.0), F.least(F.col("_n").cast("double"), F.col("_n") * float(p) + 0.5)) for name, p in probs.items()}
    wanted = F.array_distinct(F.array(*(f(x).cast("long") for x in place.values() for f in (F.floor, F.ceil))))
    sizes = cut(v.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")))
    ranges = sizes.select(*keys, "_lo", "_hi", F.col("_n").alias("_count"), F.lit(0).cast("long").alias("_below"), wanted.alias("_ranks"))
    found = []
    while True:
        told = ranges.select("*", F.explode("_ranks").alias("_rank")).select(*keys, "_rank", _known(F.col("_rank")).alias("_v"))
        found.append(told.filter("_v is not null"))
        open_ = ranges.withColumn("_ranks", F.filter("_ranks", lambda r: _known(r).isNull())).filter(F.size("_ranks") > 0)
        if open_.isEmpty():
            break
        ranges = cut(_narrowed(v, open_, keys, len(found) % 2 == 0))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    values = every.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_at"))  # two ranks a name

    def value_of(position: Column) -> Column:
        lo, hi = (F.element_at("_at", f(position).cast("long")) for f in (F.floor, F.ceil))
        return F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (position - F.floor(position)))

    return sizes.join(values, keys).select(*named, F.col("_n").alias("n"), *[value_of(place[name]).alias(name) for name in probs])


def group_median(df: DataFrame, keys: Sequence[str], value: Column, name: str = "median", written: bool = False) -> DataFrame:
    return group_quantiles(df, keys, value, {name: 0.5}, written).drop("n")
