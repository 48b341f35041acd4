"""Relational, spatial and raster operators over DataFrames."""
