"""Control-point scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TIMED = "x DOUBLE, y DOUBLE, z DOUBLE, t TIMESTAMP, i_gmc DOUBLE"
PLAIN = "x DOUBLE, y DOUBLE, z DOUBLE"


def distinct_points(points: DataFrame, tie: list[Column] | None = None) -> DataFrame:
    """One row per (x, y) with x, y, z present; ties fall to the smallest ``tie`` key.

    An aggregation with map-side combine, so a repeated location cannot fill a task.
    """
    d = points.dropna(subset=["x", "y", "z"])
    others = [c for c in d.columns if c not in ("x", "y")]
    key = F.struct(*(tie or [F.col(c) for c in others]))
    return d.groupBy("x", "y").agg(F.min_by(F.struct(*others), key).alias("_p")).select("x", "y", "_p.*")


def _dataset() -> Column:
    return F.regexp_replace(F.regexp_replace(F.input_file_name(), r"^.*/", ""), r"\.[^.]*$", "")


def read_timed_points(spark: SparkSession, path: str) -> DataFrame:
    d = spark.read.schema(TIMED).option("timestampFormat", "yyyy-MM-dd HH:mm:ss[.SSS]").csv(path)
    return distinct_points(d.withColumn("dataset", _dataset()))


def read_plain_points(spark: SparkSession, path: str) -> DataFrame:
    return distinct_points(spark.read.schema(PLAIN).csv(path).withColumn("dataset", _dataset()))


def parse_points(lines: DataFrame, col: str, schema: str) -> DataFrame:
    """Same rows from a column of CSV lines."""
    opts = {"timestampFormat": "yyyy-MM-dd HH:mm:ss[.SSS]"}
    return distinct_points(lines.select(F.from_csv(col, schema, opts).alias("_r")).select("_r.*"))
