"""Elevation mosaics as Spark jobs over pixel, footprint and control-point tables."""
