"""File-name parts, path rewrites, projection labels, version-driven parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pair_id(name: Column) -> Column:
    """The part between the second and fourth underscore."""
    return F.array_join(F.slice(F.split(name, "_"), 3, 2), "_")


def name_date(name: Column) -> Column:
    """Acquisition date: characters 6-13."""
    return F.to_date(F.substring(name, 6, 8), "yyyyMMdd")


def tile_row(name: Column) -> Column:
    return F.split(name, "_")[0].cast("int")


def tile_col(name: Column) -> Column:
    return F.split(name, "_")[1].cast("int")


def tile_name(row: Column, col: Column) -> Column:
    return F.format_string("%02d_%02d", row.cast("int"), col.cast("int"))


def sibling(name: Column, kind: str, of: str = "dem.tif") -> Column:
    """Companion file of a scene: swap the suffix."""
    return F.replace(name, F.lit(of), F.lit(kind))


def rebase(path: Column, old: str, new: str) -> Column:
    return F.replace(path, F.lit(old), F.lit(new))


def base_name(path: Column) -> Column:
    return F.regexp_replace(path, r"^.*/", "")


def projection_label(double_param: Column, ascii_params: Column) -> Column:
    """Polar stereographic by sign of the first parameter, else UTM zone + hemisphere."""
    hemi = F.when(F.contains(ascii_params, F.lit("Northern Hemisphere")), " North").otherwise(" South")
    zone = F.regexp_extract(ascii_params, r"Zone([^,]*),", 1)
    return (
        F.when(double_param > 0, "polar stereo north")
        .when(double_param.isNotNull(), "polar stereo south")
        .otherwise(F.concat(zone, hemi))
    )


# Generator version used when the report is absent / has no version line.
VERSION_NO_REPORT = 3.0
VERSION_NO_LINE = 2.03082016


# Fixed values in both functions: versions, kernel widths in map units, shares and areas.


def edge_mask_params(version: Column, dx: Column) -> dict[str, Column]:
    """Kernel, density and area limits of the edge mask by generator version."""
    old = version < 2.01292016
    n = F.when(old, F.floor(42 / dx)).otherwise(F.floor(202 / dx)).cast("int")
    return {"n": n, "pmin": F.when(old, 0.8).otherwise(0.99), "amin": 2000 / dx, "crop": n}


def data_mask_params(version: Column, dx: Column) -> dict[str, Column]:
    old = version <= 2.0
    return {
        "n": F.when(old, F.floor(42 / dx)).otherwise(F.floor(202 / dx)).cast("int"),
        "pmin": F.when(old, 0.3).otherwise(0.9),
        "amin": F.lit(1000),
        "amax": F.when(old, 10000).otherwise(1000),
    }


def day_number(date: Column, has_data: Column) -> Column:
    """Days since 2000-01-01 on cells with data, 0 elsewhere."""
    return F.when(has_data, F.datediff(date, F.lit("2000-01-01").cast("date"))).otherwise(0).cast("smallint")
