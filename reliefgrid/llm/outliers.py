"""Quality rules: robust multivariate outliers of text statistics.

Every language and source has its own minimum-covariance-determinant estimate of
where its texts' statistics lie; a text far from it in Mahalanobis distance goes.
All rows take part: concentration steps are aggregations (moments of the nearest
share of rows, found from counts of binned distances), so no group meets in one
task and what a group sends is a few sums per bin.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reliefgrid.llm.arrow import steps, texts
from reliefgrid.rounds import Rounds

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"


def repeated(words: list[bytes], width: int = 3) -> int:
    """Words inside a window of ``width`` words that the text holds twice or more."""
    if len(words) <= width:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    name = ids
    for k in range(1, width):  # windows are renamed densely at each step, so equal names are equal windows
        name = np.unique(name[:-1] * len(number) + ids[k:], return_inverse=True)[1]
    twice = np.bincount(name)[name] > 1
    covered = np.zeros(len(words) + 1, np.int64)
    begin = np.flatnonzero(twice)
    np.add.at(covered, begin, 1)
    np.add.at(covered, begin + width, -1)
    return int((np.cumsum(covered) > 0).sum())


def counts(text: bytes | None) -> tuple[int, int, int, int, int]:
    """The base counts of a text, in the order of COUNTS; all 0 for null."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.split()
    points = len(text) - sum(text.count(c) for c in SPACE) if text.isascii() else sum(len(w.decode("utf-8", "replace")) for w in words)
    lines = [x for x in text.split(b"\n") if x.strip(SPACE)]
    return len(words), points, sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines)), repeated(words)


def statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(doc_id, lang, source) and the counts of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            found = np.array([counts(t) for t in texts(batch, "text")], np.int64).reshape(-1, len(COUNTS))
            own = [batch.column(c) for c in ("doc_id", "lang", "source")]
            yield pa.RecordBatch.from_arrays([*own, *(pa.array(c) for c in found.T.copy())], ["doc_id", "lang", "source", *COUNTS])

    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), *(F.col(c).cast("string").alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))))
    return named.mapInArrow(run, "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS))


#: The transformed statistics, and the least standard deviation that each is granted: rates that are zero in most texts would else have none.
FEATURES = {
    "word_length": ("word_chars / greatest(n_words, 1)", 0.3),
    "symbol_rate": ("ln(1 + n_symbols / greatest(n_words, 1))", 0.04),
    "dup_lines": ("ln(1 + n_dup_lines)", 0.5),
    "repeat_rate": ("asin(sqrt(n_repeat_words / greatest(n_words, 1)))", 0.2),
}
NAMES = list(FEATURES)
FLOORS = np.array([floor for _, floor in FEATURES.values()])
CROSS = [(i, j) for i in range(len(NAMES)) for j in range(i, len(NAMES))]
#: Share of a group's rows that each concentration step keeps.
NEAREST = 0.5
#: Groups below this many rows are judged with their language's other small groups, and those below it all together.
LEAST_ROWS = 60
#: Squared distance beyond which a text goes: of four normal statistics 1 in 10^6 lies farther.
CUTOFF = 33.38
#: Median squared distance of four normal statistics.
MEDIAN = 3.357
#: Bins per doubling of the squared distance.
BINS = 16

_FAILED = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"
_NUMBERS = ", ".join([f"m{i} double" for i in range(len(NAMES))] + [f"p{i}_{j} double" for i, j in CROSS] + ["det double"])


def _grouped(rows: DataFrame) -> DataFrame:
    """Rows with their statistics, base verdict and first group name (language and source, nulls a name of their own)."""
    said = F.concat_ws(",", *(F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("?")) for c in ("lang", "source")))
    return rows.withColumns({n: F.expr(sql) for n, (sql, _) in FEATURES.items()} | {"base_failed": F.expr(_FAILED), "own_group": said})


def _pools(judged: DataFrame) -> DataFrame:
    """(own_group, pool): the group that judges each language and source."""
    n = judged.groupBy("own_group", "lang").agg(F.count("*").alias("n"))
    small = F.col("n") < LEAST_ROWS
    rest = F.sum(F.when(small, F.col("n"))).over(Window.partitionBy("lang"))
    pool = F.when(~small, F.concat(F.lit("group "), "own_group")).when(rest >= LEAST_ROWS, F.concat(F.lit("language "), F.coalesce("lang", F.lit("?")))).otherwise("rest")
    return n.select("own_group", pool.alias("pool"))


def _distance() -> F.Column:
    """Squared Mahalanobis distance of a row to the estimate beside it."""
    off = [F.col(n) - F.col(f"m{i}") for i, n in enumerate(NAMES)]
    return sum(((1 if i == j else 2) * F.col(f"p{i}_{j}") * off[i] * off[j] for i, j in CROSS), F.lit(0.0))


def _estimates(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Means and precision matrices from moments; the floors are added to the covariances."""
    for f in frames:
        rows = []
        for r in f.to_dict("records"):
            mean = np.array([r[f"s{i}"] for i in range(len(NAMES))]) / r["n"]
            cov = np.diag(FLOORS**2)
            for i, j in CROSS:
                c = r[f"s{i}_{j}"] / r["n"] - mean[i] * mean[j]
                cov[i, j] += c
                if i != j:
                    cov[j, i] += c
            precision = np.linalg.inv(cov)
            rows.append((r["pool"], *mean, *(precision[i, j] for i, j in CROSS), np.linalg.det(cov)))
        yield pd.DataFrame(rows, columns=["pool", *(f"m{i}" for i in range(len(NAMES))), *(f"p{i}_{j}" for i, j in CROSS), "det"])


def _binned(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    near = rows.join(estimates, "pool").withColumn("d2", _distance())
    return near.withColumn("bin", F.floor(BINS * F.log2(F.greatest("d2", F.lit(1e-12)))).cast("int"))


def _share(binned: DataFrame, share: float) -> DataFrame:
    """(pool, edge): the bin that holds the row at ``share`` of each group, from the counts of its bins."""
    sums = binned.groupBy("pool", "bin").agg(F.count("*").alias("n"))
    group = Window.partitionBy("pool")
    up = F.sum("n").over(group.orderBy("bin"))
    reached = sums.withColumn("up", up).withColumn("all", F.sum("n").over(group)).where(F.col("up") >= F.ceil(share * F.col("all")))
    return reached.groupBy("pool").agg(F.min("bin").alias("edge"))


def estimate(rows: DataFrame, rounds: Rounds) -> DataFrame:
    """(pool, means, precisions, scale): the estimate of every group of the rows' statistics.

    Each group starts at its medians with the least deviations and concentrates: the
    nearest half gives new moments, until no group's determinant falls by a thousandth.
    Determinants are bounded below by the floors, so the steps end. ``scale`` makes the
    median distance that of normal statistics; it never makes the rule stricter than the
    floors do.
    """
    medians = rows.groupBy("pool").agg(*(F.percentile(F.round(F.col(n) * 1024) / 1024, 0.5).alias(f"m{i}") for i, n in enumerate(NAMES)))
    start = {f"p{i}_{j}": F.lit(1 / FLOORS[i] ** 2 if i == j else 0.0) for i, j in CROSS} | {"det": F.lit(float("inf"))}
    best = rounds.put(medians.withColumns(start), "estimate")
    while True:
        binned = _binned(rows, best.drop("det"))
        near = binned.join(_share(binned, NEAREST), "pool").where("bin <= edge")
        sums = [F.sum(n).alias(f"s{i}") for i, n in enumerate(NAMES)] + [F.sum(F.col(NAMES[i]) * F.col(NAMES[j])).alias(f"s{i}_{j}") for i, j in CROSS]
        step = near.groupBy("pool").agg(F.count("*").alias("n"), *sums).mapInPandas(_estimates, f"pool string, {_NUMBERS}")
        before = best.select("pool", F.col("det").alias("before"))
        moved = rounds.put(step.join(before, "pool").withColumn("better", F.col("det") < 0.999 * F.col("before")), "step")
        if moved.where("better").isEmpty():
            break
        kept = best.join(moved.where("better").select("pool"), "pool", "left_anti")
        best = rounds.put(kept.unionByName(moved.where("better").drop("before", "better")), "estimate")
    middle = _share(_binned(rows, best.drop("det")), 0.5)
    scale = F.greatest(F.lit(1.0), F.pow(F.lit(2.0), (F.col("edge") + 1) / BINS) / MEDIAN)
    return rounds.put(best.drop("det").join(middle.select("pool", scale.alias("scale")), "pool"), "final")


def judged(rows: DataFrame, rounds: Rounds) -> DataFrame:
    """Rows of ``statistics`` (further columns stay) with base_failed, distance and kept.

    Rows that fail the base rule take no part in the estimates and go. A null text has
    no words and fails. A null language or source is a group of its own. A group whose
    statistics are all equal keeps its rows: the floors bound every deviation.
    """
    marked = _grouped(rows)
    fit = marked.where("not base_failed").select("own_group", "lang", *NAMES)
    pools = rounds.put(_pools(fit), "pools")
    final = estimate(fit.join(pools, "own_group"), rounds)
    known = pools.join(final, "pool").drop("pool")
    distance = F.when(F.col("base_failed"), None).otherwise(_distance() / F.col("scale"))
    near = marked.join(known, "own_group", "left").withColumn("distance", distance)
    kept = F.coalesce(~F.col("base_failed") & (F.col("distance") <= CUTOFF), F.lit(False))
    return near.select(*rows.columns, "base_failed", "distance", kept.alias("kept"))
