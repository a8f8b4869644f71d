"""DataFrame operators on pixel, footprint and point tables."""
