"""Spatial joins on grid cells, overlays and zonal sums.

A join of geometries is planned as an equi-join on the grid cells that their boxes cover, so that it hash-partitions,
spills and splits skewed cells like any other; a pair that shares several cells is kept in the one cell that holds the
lower corner of its common box, so no distinct is needed. Boxes and then exact predicates are residual conditions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions import geometry as g
from freshet.functions.projections import reproject

BOX = ("minx", "miny", "maxx", "maxy")


def with_box(df: DataFrame, rings: str = "rings", crs: str = "geographic") -> DataFrame:
    """Adds the box columns and ``edges`` of a geometry column, projected first if ``crs`` names a projection. Areas
    want ``cea``; lengths are planar in whatever is chosen."""
    df = df.withColumn(rings, reproject(F.col(rings), crs))
    out = df.withColumn("_box", g.bbox(F.col(rings)))
    return out.withColumns({b: F.col(f"_box.{b}") for b in BOX} | {"edges": g.edges(F.col(rings))}).drop("_box")


def with_cells(df: DataFrame, size: float) -> DataFrame:
    """One row for each grid cell that a row's box touches, as ``cx`` and ``cy``."""
    span = lambda a, b: F.sequence(F.floor(F.col(a) / size), F.floor(F.col(b) / size))
    return df.withColumn("cx", F.explode(span("minx", "maxx"))).withColumn("cy", F.explode(span("miny", "maxy")))


def _renamed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(f"{prefix}{c}") for c in df.columns])


def candidates(left: DataFrame, right: DataFrame, size: float) -> DataFrame:
    """Pairs whose boxes touch, columns prefixed ``l_`` and ``r_``. Both sides have the box columns; rows whose box is
    null (no geometry) pair with nothing."""
    a = _renamed(with_cells(left.where("minx is not null"), size), "l_")
    b = _renamed(with_cells(right.where("minx is not null"), size), "r_")
    low = lambda axis: F.floor(F.greatest(F.col(f"l_min{axis}"), F.col(f"r_min{axis}")) / size)
    touch = (
        (F.col("l_minx") <= F.col("r_maxx")) & (F.col("r_minx") <= F.col("l_maxx"))
        & (F.col("l_miny") <= F.col("r_maxy")) & (F.col("r_miny") <= F.col("l_maxy"))
    )
    same = (F.col("l_cx") == F.col("r_cx")) & (F.col("l_cy") == F.col("r_cy"))
    return a.join(b, same & touch & (F.col("l_cx") == low("x")) & (F.col("l_cy") == low("y")))


def spatial_join(left: DataFrame, right: DataFrame, size: float, left_area: bool = True, right_area: bool = True) -> DataFrame:
    """One row for each pair that intersects, border contact included; a left row on two right rows comes twice."""
    return candidates(left, right, size).where(g.intersects(F.col("l_edges"), F.col("r_edges"), left_area, right_area))


def spatial_semi(left: DataFrame, right: DataFrame, size: float, key: str, left_area: bool = True) -> DataFrame:
    """Left rows that intersect some right row, once each; ``key`` names a left row."""
    hits = spatial_join(left, right, size, left_area).select(F.col(f"l_{key}").alias(key)).distinct()
    return left.join(hits, key, "left_semi")


def _once(pairs: DataFrame, name: str, measure: Column, keep) -> DataFrame:
    """Adds a measure and keeps rows for which ``keep`` of it holds. Exploding it evaluates it once; a filter on it
    would be pushed into the join and evaluate it there too."""
    return pairs.withColumn(name, F.explode(F.filter(F.array(measure), keep)))


def _reach() -> Column:
    """The greatest coordinate of a pair's boxes."""
    return F.greatest(*(F.abs(F.col(f"{side}_{b}")) for side in "lr" for b in BOX))


def overlay_area(left: DataFrame, right: DataFrame, size: float) -> DataFrame:
    """Pairs whose interiors meet, with ``area`` of their intersection. What is no more than rounding, as along a common
    border at general coordinates, is no area."""
    pairs = candidates(left, right, size)
    low, high = (lambda axis: F.greatest(f"l_min{axis}", f"r_min{axis}")), (lambda axis: F.least(f"l_max{axis}", f"r_max{axis}"))
    rounding = _reach() * (high("x") - low("x") + high("y") - low("y")) * (g.NEAR / 100)
    return _once(pairs, "area", g.intersection_area(F.col("l_edges"), F.col("r_edges")), lambda m: m > rounding)


def overlay_length(lines: DataFrame, zones: DataFrame, size: float) -> DataFrame:
    """Pairs with ``length``, the length of the line inside the closed zone, and ``parts``, that piece of it; a run along
    a common border is in both."""
    pairs = candidates(lines, zones, size)
    rounding = _reach() * g.NEAR
    runs = _once(pairs, "_runs", g.clipped(F.col("l_edges"), F.col("r_edges")), lambda r: g.runs_length(r) > rounding)
    return runs.withColumns({"length": g.runs_length(F.col("_runs")), "parts": g.runs_parts(F.col("_runs"))}).drop("_runs")


def box_semi(left: DataFrame, right: DataFrame, size: float, key: str) -> DataFrame:
    """Left rows whose box touches some right row's box, once each: prunes tiles before they are read."""
    hits = candidates(left, right, size).select(F.col(f"l_{key}").alias(key)).distinct()
    return left.join(hits, key, "left_semi")


def signal(value: Column) -> Column:
    """Strictly positive and a number: in SQL a NaN is greater than anything."""
    return (value > 0) & ~F.isnan(value)


def zonal_pairs(pixels: DataFrame, zones: DataFrame, size: float, all_touched: bool = True) -> DataFrame:
    """Pairs of a pixel with each zone that its square touches, or that its centre is in."""
    pairs = candidates(pixels, zones, size)
    if all_touched:
        return pairs.where(g.intersects(F.col("l_edges"), F.col("r_edges")))
    x, y = (F.col("l_minx") + F.col("l_maxx")) / 2, (F.col("l_miny") + F.col("l_maxy")) / 2
    return pairs.where(g.covers(x, y, F.col("r_edges")))


def zonal_union(pixels: DataFrame, zones: DataFrame, size: float, key: str, all_touched: bool = True) -> DataFrame:
    """Pixels in the union of the zones, each once."""
    hits = zonal_pairs(pixels, zones, size, all_touched).select(F.col(f"l_{key}").alias(key)).distinct()
    return pixels.join(hits, key, "left_semi")
