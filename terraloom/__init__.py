"""Spark-first engine for geospatial and raster data releases."""
