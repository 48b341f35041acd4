"""Raster operators on pixel tables: ``tile, row, col, value`` and what places them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions import wkb
from freshet.operators.spatial import signal
from freshet.session import ensure_importable
from freshet.vocabulary import CROPLAND, PIXEL_KM2


def binarise(value: Column, wanted: int = CROPLAND) -> Column:
    return F.when(value == wanted, 1).otherwise(0).cast("tinyint")


def class_area(pixels: DataFrame, wanted: int = CROPLAND, pixel_km2: float = PIXEL_KM2) -> DataFrame:
    """``cells, valid_cells, area_km2``: pixels of the class, pixels that are not nodata (0), and the class's area."""
    cells = F.count_if(F.col("value") == wanted)
    return pixels.agg(cells.alias("cells"), F.count_if(F.col("value") != 0).alias("valid_cells"), (cells * pixel_km2).alias("area_km2"))


def mosaic_max(pixels: DataFrame, *place: str) -> DataFrame:
    """The greatest value at each place."""
    return pixels.groupBy(*place).agg(F.max("value").alias("value"))


def mosaic_first(pixels: DataFrame, order: str, *place: str, nodata: int = 0) -> DataFrame:
    """The value of the first tile that has one at each place."""
    return pixels.where((F.col("value") != nodata) & F.col("value").isNotNull()).groupBy(*place).agg(F.min_by("value", order).alias("value"))


def metadata(tiles: DataFrame, analysis: str) -> DataFrame:
    """Layer metadata with the centre of the bounds from tile headers (``name, width, height, crs, nodata, dtype, bands``
    and ``gt``, a geotransform of six)."""
    left, top = F.col("gt")[0], F.col("gt")[3]
    right, bottom = left + F.col("width") * F.col("gt")[1], top + F.col("height") * F.col("gt")[5]
    out = tiles.select(
        F.lit(analysis).alias("analysis"), F.concat(F.lit(analysis.lower() + "_"), F.regexp_replace("name", r"\.[^.]*$", "")).alias("layer_name"),
        F.col("name").alias("raster_file"), "width", "height", "crs", F.least(left, right).alias("bounds_minx"), F.least(top, bottom).alias("bounds_miny"),
        F.greatest(left, right).alias("bounds_maxx"), F.greatest(top, bottom).alias("bounds_maxy"), "nodata", "dtype", F.col("bands").alias("count"),
    )
    return out.withColumns({"center_x": (F.col("bounds_minx") + F.col("bounds_maxx")) / 2, "center_y": (F.col("bounds_miny") + F.col("bounds_maxy")) / 2})


def has_signal(pixels: DataFrame) -> bool:
    """Whether any pixel is positive; outputs without one are not written."""
    return not pixels.where(signal(F.col("value"))).isEmpty()


def label_regions(mask: np.ndarray) -> np.ndarray:
    """4-connected regions of a boolean raster, numbered from 1; 0 outside. Labels spread as minima along runs until
    they settle, each step over the whole array."""
    n = mask.size
    label = np.where(mask, np.arange(1, n + 1).reshape(mask.shape), n + 1)
    while True:
        before = label.copy()
        for axis in (0, 1):
            for flip in (False, True):
                view = np.flip(label, axis) if flip else label
                ok = np.flip(mask, axis) if flip else mask
                lines = view if axis else view.T
                good = ok if axis else ok.T
                # minimum of the run so far: runs restart after a gap by adding a falling offset
                run = np.cumsum(~good, axis=1)
                shift = (run.max() - run) * (n + 2)
                lines[...] = np.where(good, np.minimum.accumulate(lines + shift, axis=1) - shift, lines)
        if np.array_equal(before, label):
            break
    values, inverse = np.unique(np.where(mask, label, 0), return_inverse=True)
    return inverse.reshape(mask.shape) + (0 if values[0] == 0 else 1)


def outline(region: np.ndarray) -> list[list[tuple[int, int]]]:
    """Closed rings (column, row corners) of a boolean region: shells one way round, holes the other. Where two pixels
    meet at a corner alone the ring turns so as to stay 4-connected."""
    padded = np.pad(region, 1)
    inside = padded[1:-1, 1:-1]
    step: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def add(rows: np.ndarray, cols: np.ndarray, a: tuple[int, int], b: tuple[int, int]) -> None:
        for r, c in zip(rows.tolist(), cols.tolist()):
            step.setdefault((c + a[0], r + a[1]), []).append((c + b[0], r + b[1]))

    add(*np.nonzero(inside & ~padded[:-2, 1:-1]), (0, 0), (1, 0))
    add(*np.nonzero(inside & ~padded[1:-1, 2:]), (1, 0), (1, 1))
    add(*np.nonzero(inside & ~padded[2:, 1:-1]), (1, 1), (0, 1))
    add(*np.nonzero(inside & ~padded[1:-1, :-2]), (0, 1), (0, 0))
    rings = []
    while step:
        start = min(step)
        ring, at, came = [start], start, None
        while True:
            options = step[at]
            pick = 0
            if len(options) > 1 and came is not None:  # turn towards the pixel just followed
                dx, dy = at[0] - came[0], at[1] - came[1]
                pick = max(range(len(options)), key=lambda k: dx * (options[k][1] - at[1]) - dy * (options[k][0] - at[0]))
            came, at = at, options.pop(pick)
            if not step[came]:
                del step[came]
            if at == start:
                break
            ring.append(at)
        corners = [p for i, p in enumerate(ring) if not (ring[i - 1][0] == p[0] == ring[(i + 1) % len(ring)][0] or ring[i - 1][1] == p[1] == ring[(i + 1) % len(ring)][1])]
        rings.append([*corners, corners[0]])
    return rings


def polygonize(pixels: DataFrame, wanted: int = CROPLAND, tile: str = "tile") -> DataFrame:
    """``tile, region, cells, rings`` of every 4-connected region of the wanted class in each tile, in pixel corners.

    A tile is one group: its size is fixed by how rasters are cut, not by the data. Regions that cross a seam come as
    one for each tile, which area sums do not notice.
    """
    ensure_importable(pixels.sparkSession)
    wanted_only = pixels.where(F.col("value") == wanted).select(F.col(tile).cast("long").alias("tile"), F.col("row").cast("int"), F.col("col").cast("int"))

    def trace(table: pa.Table) -> pa.Table:
        row, col = table["row"].to_numpy(), table["col"].to_numpy()
        r0, c0 = row.min(), col.min()
        mask = np.zeros((row.max() - r0 + 1, col.max() - c0 + 1), dtype=bool)
        mask[row - r0, col - c0] = True
        labels = label_regions(mask)
        out = []
        for k in range(1, labels.max() + 1):
            rows, cols = np.nonzero(labels == k)
            a, b = rows.min(), cols.min()
            rings = outline(labels[a : rows.max() + 1, b : cols.max() + 1] == k)
            out.append((k, len(rows), wkb.shape_row(6, [[(float(x + b + c0), float(y + a + r0)) for x, y in ring] for ring in rings])["rings"]))
        regions, cells, shapes = zip(*out)
        return pa.table({
            "tile": pa.array([table["tile"][0].as_py()] * len(out), pa.int64()), "region": pa.array(regions, pa.int32()),
            "cells": pa.array(cells, pa.int64()), "rings": pa.array(shapes, wkb.ARROW_RINGS),
        })

    return wanted_only.groupBy("tile").applyInArrow(trace, f"tile long, region int, cells long, rings {wkb.RINGS}")
