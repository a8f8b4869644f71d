"""Column-level helpers: nodata rules, casts, polygons, names, quantiles."""
