"""Raster analytics and data preparation as Spark DataFrame programs."""
