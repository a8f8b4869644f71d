"""Scans and sinks: points, rasters, reports, inventories."""
