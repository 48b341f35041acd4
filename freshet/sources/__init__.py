"""Readers and writers of vector, raster and OSM files."""
