"""Text reports: readers return tables, writers return one text per report.

A report is a few kilobytes, so each file is one row (``path``, ``value``); a
report's lines are gathered per report only after being reduced to the lines
that are printed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names
from ..operators.select import PERCENTILES


def read_reports(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    d = spark.read.text(path, wholetext=True, pathGlobFilter=f"*{suffix}", recursiveFileLookup=True)
    return d.select(F.input_file_name().alias("path"), "value")


def after(text: Column, label: str) -> Column:
    """Rest of the first line that holds ``label``, or NULL."""
    import re

    v = F.regexp_extract(text, "(?m)^.*?" + re.escape(label) + r"[ \t]*(.*?)[ \t]*$", 1)
    return F.when(F.contains(text, F.lit(label)), v)


def numbers(text: Column) -> Column:
    """Doubles of a blank- or comma-separated list."""
    parts = F.filter(F.split(text, r"[,\s]+"), lambda s: s != "")
    return F.transform(parts, lambda s: s.try_cast("double"))


# ---- strip metadata ---------------------------------------------------------


def parse_strip_meta(reports: DataFrame) -> DataFrame:
    """path, name, strip_date, created, poly."""
    v = F.col("value")
    xs, ys = numbers(after(v, "X:")), numbers(after(v, "Y:"))
    name = names.base_name(F.col("path"))
    return reports.select(
        "path",
        name.alias("name"),
        names.name_date(name).alias("strip_date"),
        after(v, "Strip creation date:").alias("created"),
        F.zip_with(xs, ys, lambda x, y: F.struct(x.alias("x"), y.alias("y"))).alias("poly"),
    )


TABLE_TITLE = "Mosaicking Alignment Statistics (meters)"  # fixed value
SCENE_LINE = r"^\S+ \S+ \S+ \S+ \S+\s*$"


def parse_strip_scenes(reports: DataFrame) -> DataFrame:
    """One row per line of the alignment table: path, seq, scene_id, rmse, dz, dx, dy.

    The table begins two lines after its title and ends at the first empty line.
    A line that isn't a name and four words has an empty name and NULLs.
    """
    at = lambda text, n: F.substring(text, n, F.length(text))
    has = F.contains("value", F.lit(TABLE_TITLE))
    d = reports.select("path", F.when(has, at(F.col("value"), F.locate(TABLE_TITLE, "value"))).alias("_text"))
    body = at(F.col("_text"), F.length(F.substring_index("_text", "\n", 2)) + 2)
    table = F.split(body, r"\n\s*\n", 2)[0]
    lines = d.select("path", F.posexplode_outer(F.split(table, "\n")).alias("i", "line")).filter("line rlike '\\\\S'")
    whole = F.when(F.col("line").rlike(SCENE_LINE), F.split("line", " "))
    lines = lines.select("path", (F.col("i") + 1).alias("seq"), whole.alias("_w"))
    num = lambda n: F.get("_w", F.lit(n)).try_cast("double")
    return lines.select(
        "path", "seq", F.coalesce(F.get("_w", F.lit(0)), F.lit("")).alias("scene_id"),
        num(1).alias("rmse"), num(2).alias("dz"), num(3).alias("dx"), num(4).alias("dy"),
    )


def fixed(v: Column | str, digits: int) -> Column:
    """Fixed-point text, ties to even."""
    v = F.col(v) if isinstance(v, str) else v
    return F.format_string(f"%.{digits}f", F.bround(v, digits))


def _alignment(name: Column | str, r: Column | str, *d: Column | str) -> Column:
    """``name rmse dz dx dy`` with two and four decimals."""
    return F.concat_ws(" ", F.col(name) if isinstance(name, str) else name, fixed(r, 2), *[fixed(c, 4) for c in d])


def _vector() -> Column:
    return F.concat(
        F.lit("Translation Vector (dz,dx,dy)(m)= "), F.concat_ws(", ", *[fixed(c, 3) for c in ("dz", "dx", "dy")]), F.lit(" ")
    )


def _gather(lines: DataFrame, key: str, order: str, line: str) -> DataFrame:
    """Printed lines of a report in order, newline-joined."""
    return lines.groupBy(key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, line))), lambda s: s[line]), "\n").alias("_body")
    )


def _scene_line(seq: Column, scene_id: Column, text: Column) -> Column:
    found = F.coalesce(text, F.concat(names.sibling(scene_id, "meta.txt"), F.lit(" not found")))
    return F.concat(F.format_string("scene %d name=", seq.cast("int")), scene_id, F.lit("\n"), found, F.lit("\n "))


def scene_meta_lines(scenes: DataFrame, scene_meta: DataFrame) -> DataFrame:
    """Each scene's own report, or a note that it was not found."""
    d = scenes.join(scene_meta.select("scene_id", F.col("value").alias("_text")), "scene_id", "left")
    return d.select("strip_id", "seq", _scene_line(F.col("seq"), F.col("scene_id"), F.col("_text")).alias("line"))


def _both_bodies(scenes: DataFrame, scene_meta: DataFrame) -> DataFrame:
    """strip_id, ``_body`` and ``_scenes``: the alignment table and the scene reports.

    Scenes are gathered once for both, and texts are put together after the shuffle.
    """
    # reports of one scene side by side, so that a scene has one row in the table whatever their number
    texts = scene_meta.groupBy("scene_id").agg(F.collect_list(F.struct(F.col("value").alias("text"))).alias("_texts"))
    one = F.struct("seq", "scene_id", "rmse", "dz", "dx", "dy", "_texts")
    d = scenes.join(texts, "scene_id", "left").groupBy("strip_id").agg(F.collect_list(one).alias("_all"))
    line = lambda s: F.struct(s["seq"].alias("seq"), _alignment(*(s[c] for c in ("scene_id", "rmse", "dz", "dx", "dy"))).alias("line"))
    none = F.array(F.struct(F.lit(None).cast("string").alias("text")))
    report = lambda s: F.transform(
        F.coalesce(s["_texts"], none), lambda t: F.struct(s["seq"].alias("seq"), _scene_line(s["seq"], s["scene_id"], t["text"]).alias("line"))
    )
    joined = lambda lines: F.array_join(F.transform(F.array_sort(lines), lambda s: s["line"]), "\n")
    return d.select("strip_id", joined(F.transform("_all", line)).alias("_body"), joined(F.flatten(F.transform("_all", report))).alias("_scenes"))


# The words of all report lines below; readers look for them.


def write_strip_meta(footprints: DataFrame, scenes: DataFrame, scene_meta: DataFrame | None = None) -> DataFrame:
    """strip_id, value: header, vertices, alignment table, scene reports.

    ``footprints``: strip_id, created, projection, poly.
    """
    if scene_meta is None:
        table = _gather(scenes.select("strip_id", "seq", _alignment("scene_id", "rmse", "dz", "dx", "dy").alias("line")), "strip_id", "seq", "line")
    else:
        table = _both_bodies(scenes, scene_meta)
    verts = lambda axis: F.array_join(F.transform("poly", lambda v: F.format_string("%d", v[axis].cast("long"))), " ")
    head = F.concat_ws(
        "\n",
        F.lit("Strip Metadata "),
        F.concat(F.lit("Strip creation date: "), F.col("created")),
        F.concat(F.lit("Strip projection (proj4): "), F.col("projection")),
        F.lit("Strip Footprint Vertices "),
        F.concat(F.lit("X: "), verts("x"), F.lit(" ")),
        F.concat(F.lit("Y: "), verts("y"), F.lit(" ")),
        F.lit(""),
        F.lit("Mosaicking Alignment Statistics (meters) "),
        F.lit("scene, rmse, dz, dx, dy"),
        F.coalesce("_body", F.lit("")),
        F.lit(""),
        F.lit("Scene Metadata "),
        F.lit(""),
    )
    d = footprints.join(table, "strip_id", "left")
    if scene_meta is None:
        return d.select("strip_id", head.alias("value"))
    return d.select("strip_id", F.concat(head, F.lit("\n"), F.coalesce("_scenes", F.lit(""))).alias("value"))


# ---- scene key=value --------------------------------------------------------


def scene_settings(scenes: DataFrame, reports: DataFrame) -> DataFrame:
    """scene_id, version, wv_correct; absent report -> 3.0, absent line -> 2.03082016."""
    v = after(F.col("value"), "Version=").try_cast("double")
    wv = after(F.col("value"), "Image 1 wv_correct=")
    r = reports.select("scene_id", F.coalesce(v, F.lit(names.VERSION_NO_LINE)).alias("_v"), (wv.try_cast("int") != 0).alias("_w"))
    return (
        scenes.select("scene_id")
        .join(r, "scene_id", "left")
        .select("scene_id", F.coalesce("_v", F.lit(names.VERSION_NO_REPORT)).alias("version"), F.coalesce("_w", F.lit(False)).alias("wv_correct"))
    )


# ---- registration reports ---------------------------------------------------


def parse_registration(reports: DataFrame) -> DataFrame:
    """Point count, residual mean and median, offsets, percentiles of each report."""
    v = F.col("value")
    num = lambda label: after(v, label).try_cast("double")
    vec = numbers(F.coalesce(after(v, "Translation Vector (dz,dx,dy)(m)="), after(v, "Translation vector (dz,dx,dy)(meters)=")))
    return reports.select(
        "path",
        num("# GCPs=").alias("n_gcps"),
        num("Mean Vertical Residual (m)=").alias("mean_dz"),
        num("Median Vertical Residual (m)=").alias("median_dz"),
        F.get(vec, F.lit(0)).alias("dz"),
        F.get(vec, F.lit(1)).alias("dx"),
        F.get(vec, F.lit(2)).alias("dy"),
        *[num(f"{p}th percentile=").alias(f"p{p}") for p in PERCENTILES],
    )


# fixed values: labels of the wider report variant and the columns they fill
WIDE_LABELS = {
    "# Rock GCPs=": "n_rock",
    "# Ice GCPs=": "n_ice",
    "Quadrants with GCPs=": "quads",
    "Average Ice GCP time offset=": "ice_dt",
    "All GCP DZ AVG=": "avg_dz",
    "Rock GCP DZ AVG=": "avg_dz_rock",
    "Ice GCP DZ AVG=": "avg_dz_ice",
    "All GCP DZ MED=": "med_dz",
    "Rock GCP DZ MED=": "med_dz_rock",
    "Ice GCP DZ MED=": "med_dz_ice",
    "All GCP DZ STD=": "std_dz",
    "Rock GCP DZ STD=": "std_dz_rock",
    "Ice GCP DZ STD=": "std_dz_ice",
}
WIDE_LISTS = {"All=": "pc_all", "Rock=": "pc_rock", "Ice=": "pc_ice"}  # fixed values


def parse_registration_wide(reports: DataFrame) -> DataFrame:
    """All labels of the wider variant as columns; what a report lacks is NULL."""
    v = F.col("value")
    base = parse_registration(reports)
    wide = reports.select(
        "path",
        after(v, "Registration Dataset 1 Name:").alias("dataset"),
        *[after(v, lab).try_cast("double").alias(c) for lab, c in WIDE_LABELS.items()],
        *[numbers(F.when(F.regexp_like(v, F.lit("(?m)^" + lab)), F.regexp_extract(v, "(?m)^" + lab + "(.*)$", 1))).alias(c) for lab, c in WIDE_LISTS.items()],
    )
    return base.join(wide, "path")


def _stat_lines() -> list[Column]:
    f3 = lambda c: fixed(c, 3)
    return [
        F.concat(F.lit("# GCPs="), F.col("n_gcps").cast("string")),
        F.concat(F.lit("Mean Vertical Residual (m)="), f3("mean_dz")),
        F.concat(F.lit("Median Vertical Residual (m)="), f3("median_dz")),
        _vector(),
        F.lit("Vertical Deviation Percentiles(m):"),
        *[F.concat(F.lit(f"{p}th percentile="), f3(f"p{p}"), F.lit(" ")) for p in PERCENTILES],
    ]


def write_strip_registration(stats: DataFrame, datasets: list[str]) -> DataFrame:
    """strip_id, value.  ``stats``: strip_id, file, month_range, offsets and residual statistics."""
    head = [F.concat(F.lit("DEM Filename: "), F.col("file"))]
    head += [F.lit(f"Registration Dataset {i} Name: {d}") for i, d in enumerate(datasets, start=1)]
    head.append(F.concat(F.lit("GCP Month Range (+/- months)="), F.col("month_range").cast("string")))
    return stats.select("strip_id", F.concat_ws("\n", *head, *_stat_lines()).alias("value"))


def write_tile_registration(stats: DataFrame, datasets: list[str]) -> DataFrame:
    """tile_id, value: one block per cluster; the short form for neighbour alignment.

    ``stats``: tile_id, cluster, offsets, rmse and (long form) residual statistics.
    """
    short = [d.lower() for d in datasets] == ["neighbor align"]
    title = F.concat(F.lit("Statistics for Coregistration Cluster "), F.col("cluster").cast("string"), F.lit(":"))
    if short:
        body = [
            F.lit("# GCPs=NaN"),
            F.concat(F.lit("Mean Vertical Residual (m)="), fixed("rmse", 3)),
            F.lit("Median Vertical Residual (m)=NaN"),
            _vector(),
            F.lit("Vertical Deviation Percentiles(m):"),
            F.lit("NaN"),
        ]
    else:
        body = _stat_lines()
    blocks = stats.select("tile_id", "cluster", F.concat_ws("\n", title, *body, F.lit("")).alias("line"))
    d = _gather(blocks, "tile_id", "cluster", "line")
    head = [F.concat(F.lit("DEM Filename: "), F.col("tile_id"), F.lit("_reg_dem.mat"))]
    head += [F.lit(f"Registration Dataset {i} Name: {n}") for i, n in enumerate(datasets, start=1)]
    return d.select("tile_id", F.concat_ws("\n", *head, "_body").alias("value"))


def tile_report_rows(merges: DataFrame) -> DataFrame:
    """Strips that were used, path and suffix stripped, rank order kept."""
    used = F.coalesce("dz", "dx", "dy").isNotNull()
    name = F.replace(F.regexp_replace(names.base_name(F.col("path")), r"\.[^.]*$", ""), F.lit("_meta"), F.lit(""))
    return merges.filter(used).select("tile_id", "seq", name.alias("strip"), "rmse", "dz", "dx", "dy")


def write_tile_meta(merges: DataFrame, version: str = "1.0", created: Column | None = None) -> DataFrame:
    """tile_id, value: alignment statistics of used strips in rank order."""
    rows = tile_report_rows(merges).select(
        "tile_id", "seq", _alignment("strip", "rmse", "dz", "dx", "dy").alias("line")
    )
    body = _gather(rows, "tile_id", "seq", "line")
    date = F.date_format(F.current_timestamp(), "dd-MMM-yyyy HH:mm:ss") if created is None else created
    head = [
        F.lit("Mosaic Tile Metadata "),
        F.concat(F.lit("Creation Date: "), date),
        F.lit(f"Version: {version}"),
        F.lit(""),
        F.lit("Mosaicking Alignment Statistics (meters) in rank order"),
        F.lit("strip, rmse, dz, dx, dy"),
    ]
    return body.select("tile_id", F.concat_ws("\n", *head, "_body").alias("value"))


def write_reports(reports: DataFrame, path: str, key: str) -> None:
    """One text row per report, partitioned by report."""
    reports.select(key, "value").repartition(key).write.mode("overwrite").partitionBy(key).text(path)
