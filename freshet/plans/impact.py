"""What lies inside the basins: people, cropland, buildings, infrastructure, roads and rails.

Zones need ``linkno`` and geometry, features their tags and geometry, both prepared by
:func:`freshet.operators.spatial.with_box`. ``size`` is the grid cell of the joins: about the side of a median basin.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions import geometry as g
from freshet.operators import reports, spatial, tags
from freshet.vocabulary import BUILDING, CRITICAL, CROPLAND, PIXEL_KM2, STRUCTURES, TRANSPORT

#: Ranges of distance that zones are ranked in.
RANGES = 256


def requested(zones: DataFrame, keys: Sequence[int] | DataFrame | None) -> DataFrame:
    """Zones of the given keys: a short list is pushed to the scan, a table of keys is a semi-join."""
    if keys is None:
        return zones
    if isinstance(keys, DataFrame):
        return zones.join(keys.select("linkno").distinct(), "linkno", "left_semi")
    return zones.where(F.col("linkno").isin(*keys))


def missing_keys(zones: DataFrame, keys: DataFrame) -> DataFrame:
    """Requested keys that no zone has."""
    return keys.select("linkno").distinct().join(zones, "linkno", "left_anti")


def zones_by_distance(zones: DataFrame, batch: int = 50) -> DataFrame:
    """``linkno, distance, batch``: zones in order of their centroid's distance from the origin, ties by key, and the
    number of their batch. Distances are dealt to ranges between their own quantiles, and ranks add the sizes of the
    ranges before, so no task sorts everything, whatever the unit of the coordinates. Zones at one distance
    are one range; those without geometry come last, with a null distance."""
    placed = zones.withColumn("_c", g.centroid(F.col("edges"), F.col("rings")))
    placed = placed.select("linkno", F.sqrt(F.pow("_c.x", 2.0) + F.pow("_c.y", 2.0)).alias("distance"))
    quantiles = placed.agg(F.percentile_approx("distance", [i / RANGES for i in range(1, RANGES)], 20 * RANGES).alias("q")).scalar()
    under = F.size(F.filter("_q", lambda q: q < F.col("distance")))
    ranged = placed.withColumn("_q", quantiles).withColumn("_range", F.when(F.col("distance").isNotNull(), under).otherwise(RANGES)).drop("_q")
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = sizes.select("_range", before.alias("_base"))
    rank = F.row_number().over(Window.partitionBy("_range").orderBy("distance", "linkno"))
    numbered = ranged.withColumn("_rank", rank).join(bases, "_range")
    return numbered.select("linkno", "distance", F.floor((F.col("_base") + F.col("_rank") - 1) / batch).alias("batch"))


def population(zones: DataFrame, pixels: DataFrame, size: float, key: str, all_touched: bool = True) -> DataFrame:
    """``total_population``: people on pixels in the union of the zones, each pixel once. Nodata, negatives and NaN are
    nobody; no pixel gives 0."""
    people = pixels.where(spatial.signal(F.col("value")))
    inside = spatial.zonal_union(people, zones, size, key, all_touched)
    return inside.agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias("total_population"))


def population_by_zone(zones: DataFrame, pixels: DataFrame, size: float, all_touched: bool = False) -> DataFrame:
    """``linkno, total_population`` of every zone; a pixel of two zones counts in both."""
    people = pixels.where(spatial.signal(F.col("value")))
    sums = spatial.zonal_pairs(people, zones, size, all_touched).groupBy(F.col("r_linkno").alias("linkno")).agg(F.sum("l_value").alias("v"))
    return zones.select("linkno").join(sums, "linkno", "left").select("linkno", F.coalesce("v", F.lit(0.0)).alias("total_population"))


def farmland(zones: DataFrame, crops: DataFrame, size: float, pair_duplicates: bool = False, unit: float = 1e6) -> DataFrame:
    """``linkno, area_km2`` of every zone, zero where nothing grows.

    Each crop polygon counts once in each zone. ``pair_duplicates`` counts it as often as it touches zones at all, which
    is what a prefilter join without a distinct does."""
    pairs = spatial.overlay_area(crops, zones, size).select(F.col("l_crop_id").alias("crop_id"), F.col("r_linkno").alias("linkno"), "area")
    if pair_duplicates:
        touched = spatial.spatial_join(crops, zones, size).groupBy(F.col("l_crop_id").alias("crop_id")).agg(F.count(F.lit(1)).alias("times"))
        pairs = pairs.join(touched, "crop_id").withColumn("area", F.col("area") * F.col("times"))
    sums = pairs.groupBy("linkno").agg(F.sum("area").alias("area"))
    return zones.select("linkno").join(sums, "linkno", "left").select("linkno", (F.coalesce("area", F.lit(0.0)) / unit).alias("area_km2"))


def farmland_raster(zones: DataFrame, pixels: DataFrame, size: float, key: str, wanted: int = CROPLAND, pixel_km2: float = PIXEL_KM2, all_touched: bool = False) -> DataFrame:
    """``total_farmland_cells, total_valid_cells, total_farmland_area_km2, total_area_km2, farmland_percentage`` of the
    pixels in the union of the zones; without a valid pixel the share is 0."""
    inside = spatial.zonal_union(pixels.where(F.col("value") != 0), zones, size, key, all_touched)
    cells, valid = F.count_if(F.col("value") == wanted), F.count(F.lit(1))
    return inside.agg(
        cells.alias("total_farmland_cells"), valid.alias("total_valid_cells"), (cells * pixel_km2).alias("total_farmland_area_km2"),
        (valid * pixel_km2).alias("total_area_km2"), F.when(valid > 0, cells / valid * 100).otherwise(0.0).alias("farmland_percentage"),
    )


def affected_buildings(zones: DataFrame, features: DataFrame, size: float, values: Sequence[str] = BUILDING) -> DataFrame:
    """Building-zone pairs: a building that touches two zones comes twice."""
    tags.require(features, "building")
    wanted = features.where(F.col("building").isin(*values))
    return spatial.spatial_join(wanted, zones, size)


def buildings(zones: DataFrame, features: DataFrame, size: float) -> DataFrame:
    """``category, building_type, count``."""
    return reports.total_detail(affected_buildings(zones, features, size), "l_building", "building_type", "All Buildings")


def building_points(pairs: DataFrame) -> DataFrame:
    """Layer of affected buildings as points: type, name and id where the source has them, and the centroid."""
    c = g.centroid(F.col("l_edges"), F.col("l_rings"))
    kept = [F.col(f"l_{n}").alias(n) for n in ("name", "osm_id") if f"l_{n}" in pairs.columns]
    return pairs.select(F.col("l_building").alias("building_type"), *kept, c["x"].alias("x"), c["y"].alias("y"))


def _tagged(zones: DataFrame, features: DataFrame, size: float, vocabulary: Mapping[str, Sequence[str]]) -> DataFrame:
    return spatial.spatial_join(tags.classify(features, vocabulary, "tag_type", "tag_value"), zones, size)


def critical_infrastructure(zones: DataFrame, features: DataFrame, size: float) -> DataFrame:
    """``category, infrastructure_type, count`` of seven keys; a feature is of the first key that matches."""
    pairs = _tagged(zones, features, size, CRITICAL)
    return reports.with_subtotals(pairs, "l_tag_type", "l_tag_value", "infrastructure_type", "All Critical Infrastructure")


def structures(zones: DataFrame, features: DataFrame, size: float) -> DataFrame:
    """``category, structure_type, count`` of three keys."""
    pairs = _tagged(zones, features, size, STRUCTURES)
    return reports.with_subtotals(pairs, "l_tag_type", "l_tag_value", "structure_type", "All Structures")


def affected_lines(zones: DataFrame, features: DataFrame, size: float, unit: float = 1000.0) -> DataFrame:
    """``infrastructure_type, feature_value, osm_id, linkno, length_km``, the layer and ``parts``, the geometry, of each
    clipped line."""
    lines = tags.classify(features, TRANSPORT, "infrastructure_type", "feature_value")
    pairs = spatial.overlay_length(lines, zones, size)
    layer = F.when(F.col("l_infrastructure_type") == "railway", "railways").when(F.col("l_feature_value") == "motorway", "motorways").otherwise("highways")
    kept = [F.col(f"l_{n}").alias(n) for n in ("osm_id", "name", "ref") if f"l_{n}" in pairs.columns]
    return pairs.select(
        F.col("l_infrastructure_type").alias("infrastructure_type"), F.col("l_feature_value").alias("feature_value"), *kept,
        F.col("r_linkno").alias("linkno"), (F.col("length") / unit).alias("length_km"), layer.alias("layer"), "parts",
    )


def transportation(zones: DataFrame, features: DataFrame, size: float, unit: float = 1000.0) -> DataFrame:
    """``category, feature_type, length_km``."""
    pairs = affected_lines(zones, features, size, unit)
    return reports.total_detail(pairs, "feature_value", "feature_type", "All Transportation", F.col("length_km"), "length_km")
