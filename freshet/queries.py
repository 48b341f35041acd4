"""One query for each operator of the engine over the synthetic geography, with the DuckDB SQL it must equal."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet import diagnostics
from freshet import vocabulary as v
from freshet.functions import geometry as g
from freshet.functions import wkb
from freshet.functions import projections as p
from freshet.functions import text
from freshet.geography import duckdb, relation, shapes
from freshet.operators import raster, reports, spatial, tags
from freshet.plans import impact, workflow
from freshet.sources import files, geotiff, vector
from freshet.workspace import new_folder, on_disk

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

#: Grid cell of the joins: the side of a basin.
CELL = 16.0


def query(sql: str | None = None, *relations: str):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = (duckdb(*relations) + " " if relations else "") + sql
        return f

    return add


def _in(values) -> str:
    return "(" + ", ".join(f"'{x}'" for x in values) + ")"


def _any(vocabulary) -> str:
    return " OR ".join(f"{k} IN {_in(x)}" for k, x in vocabulary.items())


def _case(vocabulary, value: bool) -> str:
    return "CASE " + " ".join(f"WHEN {k} IN {_in(x)} THEN {k if value else repr(k)}" for k, x in vocabulary.items()) + " END"


TOUCH = "a.minx <= b.maxx AND b.minx <= a.maxx AND a.miny <= b.maxy AND b.miny <= a.maxy"
PAIRS = f"FROM {{}} a JOIN basins b ON {TOUCH}"
OVERLAP = "(least(a.maxx, b.maxx) - greatest(a.minx, b.minx)) * (least(a.maxy, b.maxy) - greatest(a.miny, b.miny))"
ROAD = "least(x1, x2) AS minx, greatest(x1, x2) AS maxx, least(y1, y2) AS miny, greatest(y1, y2) AS maxy"
CLIP = "((least(a.maxx, b.maxx) - greatest(a.minx, b.minx)) + (least(a.maxy, b.maxy) - greatest(a.miny, b.miny)))"


# --- scans and filters -----------------------------------------------------------------------------------------------


@query("SELECT linkno, minx, miny FROM basins WHERE linkno IN (1, 3, 5, 24)", "basins")
def scan_key_in(spark, d):
    return impact.requested(relation(spark, d, "basins"), [1, 3, 5, 24]).select("linkno", "minx", "miny")


@query("SELECT linkno FROM basins WHERE linkno IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9000)", "basins")
def key_semi_join(spark, d):
    keys = spark.read.parquet(f"{d}/customer.parquet").where("c_acctbal > 9000").select(F.col("c_nationkey").cast("long").alias("linkno"))
    return impact.requested(relation(spark, d, "basins"), keys).select("linkno")


@query("SELECT k AS linkno FROM (SELECT unnest([3, 24, 25, 70, 70])::BIGINT AS k) WHERE k NOT IN (SELECT linkno FROM basins) GROUP BY k", "basins")
def anti_missing_keys(spark, d):
    keys = spark.createDataFrame([(3,), (24,), (25,), (70,), (70,)], "linkno long")
    return impact.missing_keys(relation(spark, d, "basins"), keys)


@query(f"SELECT osm_id, building FROM buildings WHERE building IN {_in(v.BUILDING)}", "buildings")
def filter_building_vocab(spark, d):
    df = relation(spark, d, "buildings")
    return df.where(tags.matches(df, {"building": v.BUILDING})).select("osm_id", "building")


@query(f"SELECT osm_id FROM roads WHERE {_any(v.TRANSPORT)}", "roads")
def filter_highway_or_railway(spark, d):
    df = relation(spark, d, "roads")
    return df.where(tags.matches(df, v.TRANSPORT)).select("osm_id")


@query(f"SELECT osm_id FROM buildings WHERE {_any(v.CRITICAL)}", "buildings")
def filter_infra7(spark, d):
    df = relation(spark, d, "buildings")
    return df.where(tags.matches(df, v.CRITICAL)).select("osm_id")


@query(f"SELECT osm_id, {_case(v.TRANSPORT, False)} AS infrastructure_type, {_case(v.TRANSPORT, True)} AS feature_value FROM roads WHERE {_any(v.TRANSPORT)}", "roads")
def classify_priority_transport(spark, d):
    return tags.classify(relation(spark, d, "roads"), v.TRANSPORT, "infrastructure_type", "feature_value").select("osm_id", "infrastructure_type", "feature_value")


@query(f"SELECT osm_id, {_case(v.CRITICAL, False)} AS tag_type, {_case(v.CRITICAL, True)} AS tag_value FROM buildings WHERE {_any(v.CRITICAL)}", "buildings")
def classify_priority_infra7(spark, d):
    return tags.classify(relation(spark, d, "buildings"), v.CRITICAL, "tag_type", "tag_value").select("osm_id", "tag_type", "tag_value")


@query("""SELECT osm_id, nullif(regexp_extract(other_tags, '"highway"=>"([^"]+)"', 1), '') AS highway,
          nullif(regexp_extract(other_tags, '"waterway"=>"([^"]+)"', 1), '') AS waterway FROM osm_tags""", "osm_tags")
def hstore_extract(spark, d):
    df = relation(spark, d, "osm_tags")
    return df.select("osm_id", tags.resolve(df, "highway").alias("highway"), tags.resolve(df, "waterway").alias("waterway"))


@query("SELECT osm_id, kind AS highway, CAST(NULL AS VARCHAR) AS railway FROM osm_tags WHERE kind IN ('click', 'view')", "osm_tags")
def map_tag_resolve(spark, d):
    df = relation(spark, d, "osm_tags").select("osm_id", F.create_map(F.lit("highway"), "kind").alias("tags"))
    out = df.select("osm_id", tags.resolve(df, "highway").alias("highway"), tags.resolve(df, "railway").alias("railway"))
    return out.where(F.col("highway").isin("click", "view"))


@query("SELECT osm_id, coalesce(CASE WHEN osm_id % 2 = 0 THEN kind END, CASE WHEN osm_id % 3 = 0 THEN 'x' || kind END) AS highway FROM osm_tags", "osm_tags")
def dotted_tag_coalesce(spark, d):
    df = relation(spark, d, "osm_tags").select(
        "osm_id", F.expr("CASE WHEN osm_id % 2 = 0 THEN kind END").alias("tags.highway"), F.expr("CASE WHEN osm_id % 3 = 0 THEN 'x' || kind END").alias("@highway")
    )
    return df.select("osm_id", tags.resolve(df, "highway").alias("highway"))


@query("SELECT place_id FROM places WHERE lon BETWEEN -90.5 AND -80.0 AND lat BETWEEN 10.0 AND 22.5", "places")
def bbox_point_filter(spark, d):
    return relation(spark, d, "places").where(g.in_box(F.col("lon"), F.col("lat"), (-90.5, 10.0, -80.0, 22.5))).select("place_id")


@query("SELECT osm_id FROM roads WHERE (x1 BETWEEN 8 AND 20 AND y1 BETWEEN 8 AND 30) OR (x2 BETWEEN 8 AND 20 AND y2 BETWEEN 8 AND 30)", "roads")
def bbox_any_vertex(spark, d):
    df = relation(spark, d, "roads")
    points = g.valid_points(F.array(g.point("x1", "y1"), g.point("x2", "y2")))
    return df.where((F.size(points) >= 2) & g.any_in_box(points, (8.0, 8.0, 20.0, 30.0))).select("osm_id")


@query("SELECT event_id AS fid, CASE event_id % 4 WHEN 0 THEN 2 ELSE 5 END AS kind FROM events WHERE event_id % 4 IN (0, 1)")
def geometry_type_filter(spark, d):
    # headers of WKB in both byte orders: point, line, multi-line, polygon
    ids = spark.read.parquet(f"{d}/events.parquet").select(F.col("event_id").alias("fid"))
    header = F.expr("CASE fid % 4 WHEN 0 THEN unhex('0102000000') WHEN 1 THEN unhex('0000000005') WHEN 2 THEN unhex('0101000000') ELSE unhex('0103000000') END")
    return ids.select("fid", g.wkb_type(header).alias("kind")).where(F.col("kind").isin(2, 5))


# --- measures and projections ----------------------------------------------------------------------------------------


@query("SELECT osm_id, (maxx - minx) * (maxy - miny) AS area FROM buildings", "buildings")
def area_shoelace(spark, d):
    return shapes(spark, d, "buildings").select("osm_id", g.area(F.col("edges")).alias("area"))


@query("SELECT coalesce(highway, 'none') AS highway, round(sum(abs(x2 - x1) + abs(y2 - y1)), 6) AS length FROM roads GROUP BY 1", "roads")
def length_sum(spark, d):
    df = shapes(spark, d, "roads").select(F.coalesce("highway", F.lit("none")).alias("highway"), g.length(F.col("edges")).alias("l"))
    return df.groupBy("highway").agg(F.round(F.sum("l"), 6).alias("length"))


@query("SELECT osm_id, round((minx + maxx) / 2, 6) AS x, round((miny + maxy) / 2, 6) AS y FROM buildings", "buildings")
def centroid(spark, d):
    c = g.centroid(F.col("edges"), F.col("rings"))
    return shapes(spark, d, "buildings").select("osm_id", F.round(c["x"], 6).alias("x"), F.round(c["y"], 6).alias("y"))


@query("SELECT min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy FROM buildings", "buildings")
def total_bounds(spark, d):
    return shapes(spark, d, "buildings").agg(F.min("minx").alias("minx"), F.min("miny").alias("miny"), F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy"))


_CEA = f"""SELECT place_id, round(radians(lon) * {p.A!r}, 3) AS x,
  round({p.A!r} / 2 * {1 - p.E2!r} * (sin(radians(lat)) / (1 - {p.E2!r} * sin(radians(lat)) * sin(radians(lat)))
    - ln((1 - {p.E!r} * sin(radians(lat))) / (1 + {p.E!r} * sin(radians(lat)))) / {2 * p.E!r}), 3) AS y FROM places"""


@query(_CEA, "places")
def cea_forward(spark, d):
    c = p.cea_forward(F.col("lon"), F.col("lat"))
    return relation(spark, d, "places").select("place_id", F.round(c["x"], 3).alias("x"), F.round(c["y"], 3).alias("y"))


@query("SELECT place_id, round(lon, 6) AS lon, round(lat, 6) AS lat FROM places", "places")
def cea_round_trip(spark, d):
    there = p.cea_forward(F.col("lon"), F.col("lat"))
    df = relation(spark, d, "places").select("place_id", there.alias("c"))
    back = p.cea_inverse(F.col("c.x"), F.col("c.y"))
    return df.select("place_id", F.round(back["lon"], 6).alias("lon"), F.round(back["lat"], 6).alias("lat"))


@query("SELECT place_id, CAST(floor((lon + 180) / 6) AS INT) % 60 + 1 AS zone, CAST(floor((lon + 180) / 6) AS INT) % 60 + 1 + CASE WHEN lat < 0 THEN 32700 ELSE 32600 END AS epsg FROM places", "places")
def utm_zone(spark, d):
    return relation(spark, d, "places").select("place_id", p.utm_zone(F.col("lon")).alias("zone"), p.utm_epsg(F.col("lon"), F.col("lat")).alias("epsg"))


_N = p.FLATTENING / (2 - p.FLATTENING)
_C = 2 * _N**0.5 / (1 + _N)
_SERIES = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_K0 = 0.9996 * p.A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)


def _kruger(own: str, along: str, across: str, outer: str) -> str:
    return own + "".join(f" + {a!r} * {along}({2 * j} * xi) * {across}({2 * j} * eta)" for j, a in enumerate(_SERIES, 1)) + outer


_UTM = f""", a AS (SELECT place_id, lat, sin(radians(lat)) AS s, radians(lon - ((CAST(floor((lon + 180) / 6) AS INT) % 60 + 1) * 6 - 183)) AS lam FROM places),
b AS (SELECT place_id, lat, lam, sinh(atanh(s) - {_C!r} * atanh({_C!r} * s)) AS t FROM a),
c AS (SELECT place_id, lat, atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + t * t)) AS eta FROM b)
SELECT place_id, round(({_kruger('eta', 'cos', 'sinh', '')}) * {_K0!r} + 500000, 3) AS x,
  round(({_kruger('xi', 'sin', 'cosh', '')}) * {_K0!r} + CASE WHEN lat < 0 THEN 10000000 ELSE 0 END, 3) AS y FROM c"""


@query(_UTM, "places")
def utm_forward(spark, d):
    c = p.utm_forward(F.col("lon"), F.col("lat"))
    return relation(spark, d, "places").select("place_id", F.round(c["x"], 3).alias("x"), F.round(c["y"], 3).alias("y"))


#: Newton's steps for the auxiliary angle, one table each.
_NEWTON = "".join(f", t{i} AS (SELECT place_id, lon, w, t - (2 * t + sin(2 * t) - w) / (2 + 2 * cos(2 * t)) AS t FROM t{i - 1})" for i in range(1, 13))
_MOLLWEIDE = f""", t0 AS (SELECT place_id, lon, pi() * sin(radians(lat)) AS w, radians(lat) * 0.95 AS t FROM places){_NEWTON}
SELECT place_id, round({p.A!r} * 2 * sqrt(2) / pi() * radians(lon) * cos(t), 3) AS x, round({p.A!r} * sqrt(2) * sin(t), 3) AS y FROM t12"""


@query(_MOLLWEIDE, "places")
def mollweide_forward(spark, d):
    c = p.mollweide_forward(F.col("lon"), F.col("lat"))
    return relation(spark, d, "places").select("place_id", F.round(c["x"], 3).alias("x"), F.round(c["y"], 3).alias("y"))


@query("""SELECT linkno, sqrt(pow((minx + maxx) / 2, 2) + pow((miny + maxy) / 2, 2)) AS distance,
  CAST(floor((row_number() OVER (ORDER BY sqrt(pow((minx + maxx) / 2, 2) + pow((miny + maxy) / 2, 2)), linkno) - 1) / 10.0) AS BIGINT) AS batch FROM basins""", "basins")
def batch_by_centroid_distance(spark, d):
    return impact.zones_by_distance(shapes(spark, d, "basins"), 10)


# --- spatial joins and reports ---------------------------------------------------------------------------------------


@query(f"SELECT osm_id, linkno {PAIRS.format('buildings')} WHERE building IS NOT NULL", "basins", "buildings")
def sjoin_intersects_pairs(spark, d):
    pairs = spatial.spatial_join(shapes(spark, d, "buildings").where("building is not null"), shapes(spark, d, "basins"), CELL)
    return pairs.select(F.col("l_osm_id").alias("osm_id"), F.col("r_linkno").alias("linkno"))


@query(f"SELECT count(DISTINCT osm_id) AS features {PAIRS.format('buildings')} WHERE building IS NOT NULL", "basins", "buildings")
def sjoin_distinct_features(spark, d):
    left = shapes(spark, d, "buildings").where("building is not null")
    return spatial.spatial_semi(left, shapes(spark, d, "basins"), CELL, "osm_id").agg(F.count("*").alias("features"))


_BUILDINGS = f"hit AS (SELECT building {PAIRS.format('buildings')} WHERE building IN {_in(v.BUILDING)})"


@query(f", {_BUILDINGS} SELECT 'TOTAL' AS category, 'All Buildings' AS building_type, count(*) AS count FROM hit UNION ALL SELECT 'DETAIL', building, count(*) FROM hit GROUP BY building", "basins", "buildings")
def buildings_report(spark, d):
    return reports.ordered(impact.buildings(shapes(spark, d, "basins"), shapes(spark, d, "buildings"), CELL), "building_type")


def _subtotals(vocabulary, label: str, total: str) -> str:
    return f""", hit AS (SELECT {_case(vocabulary, False)} AS tag, {_case(vocabulary, True)} AS val {PAIRS.format('buildings')} WHERE {_any(vocabulary)})
SELECT 'TOTAL' AS category, '{total}' AS {label}, count(*) AS count FROM hit
UNION ALL SELECT 'SUBTOTAL', 'All ' || upper(substr(tag, 1, 1)) || lower(substr(tag, 2)), count(*) FROM hit GROUP BY tag
UNION ALL SELECT 'DETAIL', val, count(*) FROM hit GROUP BY val"""


@query(_subtotals(v.CRITICAL, "infrastructure_type", "All Critical Infrastructure"), "basins", "buildings")
def infra_report_subtotals(spark, d):
    return reports.ordered(impact.critical_infrastructure(shapes(spark, d, "basins"), shapes(spark, d, "buildings"), CELL), "infrastructure_type")


@query(_subtotals(v.STRUCTURES, "structure_type", "All Structures"), "basins", "buildings")
def structures3_subtotals(spark, d):
    return reports.ordered(impact.structures(shapes(spark, d, "basins"), shapes(spark, d, "buildings"), CELL), "structure_type")


@query("SELECT 'TOTAL' AS category, 'All Buildings' AS building_type, CAST(0 AS BIGINT) AS count")
def empty_report_zero_row(spark, d):
    return impact.buildings(shapes(spark, d, "basins"), shapes(spark, d, "buildings").where("osm_id < 0"), CELL)


@query(f"SELECT building AS building_type, osm_id, name, round((a.minx + a.maxx) / 2, 6) AS x, round((a.miny + a.maxy) / 2, 6) AS y {PAIRS.format('buildings')} WHERE building IN {_in(v.BUILDING)}", "basins", "buildings")
def building_points_layer(spark, d):
    pairs = impact.affected_buildings(shapes(spark, d, "basins"), shapes(spark, d, "buildings"), CELL)
    return impact.building_points(pairs).withColumns({"x": F.round("x", 6), "y": F.round("y", 6)})


@query(f"SELECT crop_id, linkno, round({OVERLAP}, 6) AS area {PAIRS.format('crops')} WHERE {OVERLAP} > 0", "basins", "crops")
def overlay_area_pairs(spark, d):
    pairs = spatial.overlay_area(shapes(spark, d, "crops"), shapes(spark, d, "basins"), CELL)
    return pairs.select(F.col("l_crop_id").alias("crop_id"), F.col("r_linkno").alias("linkno"), F.round("area", 6).alias("area"))


@query(f"SELECT linkno, round(sum({OVERLAP}), 6) AS area {PAIRS.format('crops')} GROUP BY linkno HAVING sum({OVERLAP}) > 0", "basins", "crops")
def overlay_area_by_basin(spark, d):
    pairs = spatial.overlay_area(shapes(spark, d, "crops"), shapes(spark, d, "basins"), CELL)
    return pairs.groupBy(F.col("r_linkno").alias("linkno")).agg(F.round(F.sum("area"), 6).alias("area"))


_MORE = "more AS (SELECT * FROM basins UNION ALL SELECT 99, 1000, 1000, 1016, 1016)"


@query(f", {_MORE} SELECT b.linkno, round(coalesce(sum(CASE WHEN a.crop_id IS NOT NULL THEN {OVERLAP} END), 0), 6) AS area_km2 FROM more b LEFT JOIN crops a ON {TOUCH} GROUP BY b.linkno", "basins", "crops")
def overlay_area_zero_fill(spark, d):
    off = spark.createDataFrame([(99, 1000.0, 1000.0, 1016.0, 1016.0)], "linkno long, minx double, miny double, maxx double, maxy double")
    zones = spatial.with_box(relation(spark, d, "basins").unionByName(off).select("linkno", g.rectangle().alias("rings")))
    out = impact.farmland(zones, shapes(spark, d, "crops"), CELL, unit=1.0)
    return out.withColumn("area_km2", F.round("area_km2", 6))


@query(f", times AS (SELECT crop_id, count(*) AS n {PAIRS.format('crops')} GROUP BY crop_id) SELECT b.linkno, round(coalesce(sum({OVERLAP} * n), 0), 6) AS area_km2 FROM basins b LEFT JOIN crops a ON {TOUCH} LEFT JOIN times t ON t.crop_id = a.crop_id GROUP BY b.linkno", "basins", "crops")
def overlay_area_pair_dup_compat(spark, d):
    out = impact.farmland(shapes(spark, d, "basins"), shapes(spark, d, "crops"), CELL, pair_duplicates=True, unit=1.0)
    return out.withColumn("area_km2", F.round("area_km2", 6))


_LINES = f"line AS (SELECT osm_id, {_case(v.TRANSPORT, False)} AS kind, {_case(v.TRANSPORT, True)} AS val, {ROAD} FROM roads WHERE {_any(v.TRANSPORT)}), hit AS (SELECT a.*, linkno, {CLIP} AS len FROM line a JOIN basins b ON {TOUCH} WHERE {CLIP} > 0)"


@query(f", {_LINES} SELECT 'TOTAL' AS category, 'All Transportation' AS feature_type, round(coalesce(sum(len), 0), 6) AS length_km FROM hit UNION ALL SELECT 'DETAIL', val, round(sum(len), 6) FROM hit GROUP BY val", "basins", "roads")
def overlay_line_length_by_type(spark, d):
    out = impact.transportation(shapes(spark, d, "basins"), shapes(spark, d, "roads"), CELL, unit=1.0)
    return reports.ordered(out.withColumn("length_km", F.round("length_km", 6)), "feature_type")


@query(f", {_LINES} SELECT CASE WHEN kind = 'railway' THEN 'railways' WHEN val = 'motorway' THEN 'motorways' ELSE 'highways' END AS layer, osm_id, linkno, round(len, 6) AS length_km FROM hit", "basins", "roads")
def line_layer_split(spark, d):
    out = impact.affected_lines(shapes(spark, d, "basins"), shapes(spark, d, "roads"), CELL, unit=1.0)
    return out.select("layer", "osm_id", "linkno", F.round("length_km", 6).alias("length_km"))


@query(f", {_LINES} SELECT kind AS infrastructure_type, round(sum(len), 6) AS length_km FROM hit GROUP BY kind", "basins", "roads")
def length_by_infra_type(spark, d):
    out = impact.affected_lines(shapes(spark, d, "basins"), shapes(spark, d, "roads"), CELL, unit=1.0)
    return out.groupBy("infrastructure_type").agg(F.round(F.sum("length_km"), 6).alias("length_km"))


# Zones turned by 45 degrees (u = x + y, v = y - x): squares, and L-shapes with a hole, of rectangles in u and v. A road
# runs along an axis, so u and v are linear along it, and its part in a rectangle is one interval.
_TURNED = """turned AS (SELECT linkno, minx + miny AS u, miny - minx AS v FROM basins),
rect AS (SELECT linkno, 'square' AS shape, u AS u1, v AS v1, u + 12 AS u2, v + 12 AS v2 FROM turned
  UNION ALL SELECT linkno, 'ell', u, v, u + 2, v + 12 FROM turned UNION ALL SELECT linkno, 'ell', u + 4, v, u + 12, v + 4 FROM turned
  UNION ALL SELECT linkno, 'ell', u + 2, v, u + 4, v + 1 FROM turned UNION ALL SELECT linkno, 'ell', u + 2, v + 3, u + 4, v + 12 FROM turned),
way AS (SELECT osm_id, x1, y1, x2, y2, x1 + y1 AS ua, x2 + y2 AS ub, y1 - x1 AS va, y2 - x2 AS vb FROM roads),
part AS (SELECT osm_id, linkno, shape, x1, y1, x2, y2, greatest(0, least((u1 - ua) / (ub - ua), (u2 - ua) / (ub - ua)), least((v1 - va) / (vb - va), (v2 - va) / (vb - va))) AS k1,
  least(1, greatest((u1 - ua) / (ub - ua), (u2 - ua) / (ub - ua)), greatest((v1 - va) / (vb - va), (v2 - va) / (vb - va))) AS k2 FROM way JOIN rect
  ON least(ua, ub) <= u2 AND greatest(ua, ub) >= u1 AND least(va, vb) <= v2 AND greatest(va, vb) >= v1)"""


def _turned(spark, d, shape: str) -> DataFrame:
    """``square`` zones, or ``ell`` ones: concave, with a hole of 2 by 2."""
    corners = {"square": [[(0, 0), (12, 0), (12, 12), (0, 12)]], "ell": [[(0, 0), (12, 0), (12, 4), (4, 4), (4, 12), (0, 12)], [(2, 1), (2, 3), (4, 3), (4, 1)]]}[shape]
    u, w = "(minx + miny)", "(miny - minx)"

    def at(a, b):
        x, y = f"({u} + {a} - ({w} + {b})) / 2", f"({u} + {a} + {w} + {b}) / 2"
        return f"named_struct('x', CAST({x} AS DOUBLE), 'y', CAST({y} AS DOUBLE))"

    rings = ", ".join("array(" + ", ".join(at(a, b) for a, b in [*ring, ring[0]]) + ")" for ring in corners)
    return spatial.with_box(relation(spark, d, "basins").select("linkno", F.expr(f"array({rings})").alias("rings")))


@query(f", {_TURNED} SELECT linkno, round(sum(abs(x2 - x1) * (k2 - k1) + abs(y2 - y1) * (k2 - k1)), 6) AS length FROM part WHERE shape = 'ell' AND k2 > k1 GROUP BY linkno", "basins", "roads")
def overlay_line_length_turned(spark, d):
    pairs = spatial.overlay_length(shapes(spark, d, "roads"), _turned(spark, d, "ell"), CELL)
    return pairs.groupBy(F.col("r_linkno").alias("linkno")).agg(F.round(F.sum("length"), 6).alias("length"))


@query(f""", {_TURNED} SELECT osm_id, linkno, round(x1 + (x2 - x1) * k1, 6) AS x_from, round(y1 + (y2 - y1) * k1, 6) AS y_from,
  round(x1 + (x2 - x1) * k2, 6) AS x_to, round(y1 + (y2 - y1) * k2, 6) AS y_to FROM part WHERE shape = 'square' AND k2 > k1""", "basins", "roads")
def clipped_lines_turned(spark, d):
    pairs = spatial.overlay_length(shapes(spark, d, "roads"), _turned(spark, d, "square"), CELL)
    ends = pairs.select("l_osm_id", "r_linkno", F.col("parts")[0][0].alias("a"), F.element_at(F.element_at("parts", -1), -1).alias("b"))
    return ends.select(
        F.col("l_osm_id").alias("osm_id"), F.col("r_linkno").alias("linkno"), F.round("a.x", 6).alias("x_from"), F.round("a.y", 6).alias("y_from"),
        F.round("b.x", 6).alias("x_to"), F.round("b.y", 6).alias("y_to"),
    )


_CLIP_ENDS = ", ".join(f"CASE WHEN {c}1 <= {c}2 THEN greatest(least({c}1, {c}2), b.min{c}) ELSE least(greatest({c}1, {c}2), b.max{c}) END AS {c}_from, CASE WHEN {c}1 <= {c}2 THEN least(greatest({c}1, {c}2), b.max{c}) ELSE greatest(least({c}1, {c}2), b.min{c}) END AS {c}_to" for c in "xy")


@query(f", line AS (SELECT osm_id, x1, y1, x2, y2, {ROAD} FROM roads WHERE {_any(v.TRANSPORT)}) SELECT osm_id, linkno, {_CLIP_ENDS} FROM line a JOIN basins b ON {TOUCH} WHERE {CLIP} > 0", "basins", "roads")
def clipped_lines(spark, d):
    lines = impact.affected_lines(shapes(spark, d, "basins"), shapes(spark, d, "roads"), CELL)
    ends = lines.select("osm_id", "linkno", F.col("parts")[0][0].alias("a"), F.element_at(F.element_at("parts", -1), -1).alias("b"))
    return ends.select("osm_id", "linkno", F.col("a.x").alias("x_from"), F.col("b.x").alias("x_to"), F.col("a.y").alias("y_from"), F.col("b.y").alias("y_to"))


# --- files: written and read back ------------------------------------------------------------------------------------

_POLYGONS = "SELECT osm_id, coalesce(building, '') AS building, minx, miny, maxx, maxy FROM buildings"


def _written(spark, d) -> DataFrame:
    """Buildings with WKB geometry."""
    rings = relation(spark, d, "buildings").select("osm_id", F.coalesce("building", F.lit("")).alias("building"), g.rectangle().alias("rings"))
    return rings.select("osm_id", "building", wkb.encoded(F.lit(3), F.col("rings")).alias("geometry"))


def _read(df: DataFrame) -> DataFrame:
    box = g.bbox(F.col("rings"))
    shaped = wkb.decoded(df).select(F.col("osm_id").cast("long").alias("osm_id"), F.coalesce("building", F.lit("")).alias("building"), box.alias("b"))
    return shaped.select("osm_id", "building", "b.*")


@query(_POLYGONS, "buildings")
def geojson_round_trip(spark, d):
    path = new_folder(spark, "geojson")
    vector.write_geojson(_written(spark, d), path)
    return _read(vector.read_geojson(spark, path))


@query(_POLYGONS, "buildings")
def wkb_parquet_round_trip(spark, d):
    path = new_folder(spark, "wkb") + ".parquet"
    _written(spark, d).withColumn("geometry", F.hex("geometry")).write.parquet(path)
    return _read(vector.read_vector(spark, path))


@query(_POLYGONS, "buildings")
def gpkg_round_trip(spark, d):
    path = on_disk(new_folder(spark, "buildings") + ".gpkg")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    vector.write_gpkg({"buildings": _written(spark, d)}, path)
    return _read(vector.read_gpkg(spark, path, "Polygon"))


@query("SELECT place_id, lon, lat FROM places", "places")
def shapefile_round_trip(spark, d):
    path = on_disk(new_folder(spark, "places") + ".shp")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    vector.write_point_shapefile(relation(spark, d, "places"), path, "lon", "lat")
    point = F.col("rings")[0][0]
    return wkb.decoded(vector.read_shapefile(spark, path)).select(F.col("place_id").cast("long").alias("place_id"), point["x"].alias("lon"), point["y"].alias("lat"))


@query("SELECT row, col, CAST(sum(value) AS DOUBLE) AS value FROM cover_pixels GROUP BY row, col", "cover_pixels")
def geotiff_round_trip(spark, d):
    path, gt = new_folder(spark, "tiles"), [0.0, 1.5, 0.0, 0.0, 0.0, -1.5]
    pixels = relation(spark, d, "cover_pixels").groupBy("row", "col").agg(F.sum("value").alias("value"))
    geotiff.write_tiles(pixels, path, gt, 64, "int32")
    return geotiff.on_grid(geotiff.read_pixels(spark, path), gt).where("value <> 0").unionByName(_zeros(pixels), allowMissingColumns=True).select("row", "col", "value")


def _zeros(pixels: DataFrame) -> DataFrame:
    """Nodata, which a raster does not tell from places that no pixel has."""
    return pixels.where("value = 0").select("row", "col", F.col("value").cast("double").alias("value"))


# --- rasters ---------------------------------------------------------------------------------------------------------

_PEOPLE = "people AS (SELECT * FROM pop_pixels WHERE value > 0 AND NOT isnan(value))"
_CENTRE = "(a.minx + a.maxx) / 2 BETWEEN b.minx AND b.maxx AND (a.miny + a.maxy) / 2 BETWEEN b.miny AND b.maxy"


@query(f", {_PEOPLE} SELECT round(coalesce(sum(value), 0), 4) AS total_population FROM people WHERE pixel_id IN (SELECT pixel_id FROM people a JOIN basins b ON {TOUCH})", "basins", "pop_pixels")
def zonal_union_sum(spark, d):
    out = impact.population(shapes(spark, d, "basins"), shapes(spark, d, "pop_pixels"), CELL, "pixel_id")
    return out.select(F.round("total_population", 4).alias("total_population"))


@query(f", {_PEOPLE} SELECT round(coalesce(sum(value), 0), 4) AS total_population FROM people WHERE pixel_id IN (SELECT pixel_id FROM people a JOIN basins b ON {_CENTRE})", "basins", "pop_pixels")
def zonal_center_sum(spark, d):
    out = impact.population(shapes(spark, d, "basins"), shapes(spark, d, "pop_pixels"), CELL, "pixel_id", all_touched=False)
    return out.select(F.round("total_population", 4).alias("total_population"))


@query(f", {_PEOPLE} SELECT b.linkno, round(coalesce(sum(value), 0), 4) AS total_population FROM basins b LEFT JOIN people a ON {_CENTRE} GROUP BY b.linkno", "basins", "pop_pixels")
def zonal_per_basin_sum(spark, d):
    out = impact.population_by_zone(shapes(spark, d, "basins"), shapes(spark, d, "pop_pixels"), CELL)
    return out.withColumn("total_population", F.round("total_population", 4))


@query("SELECT count(*) FILTER (WHERE value = 40) AS cells, count(*) FILTER (WHERE value <> 0) AS valid_cells, count(*) FILTER (WHERE value = 40) * CAST(0.0001 AS DOUBLE) AS area_km2 FROM cover_pixels", "cover_pixels")
def raster_count_value_area(spark, d):
    return raster.class_area(relation(spark, d, "cover_pixels"))


@query("SELECT row, col, CAST(CASE WHEN value = 40 THEN 1 ELSE 0 END AS TINYINT) AS value FROM cover_pixels", "cover_pixels")
def raster_binarise(spark, d):
    return relation(spark, d, "cover_pixels").select("row", "col", raster.binarise(F.col("value")).alias("value"))


@query("SELECT row % 20 AS r, col % 25 AS c, max(value) AS value FROM cover_pixels GROUP BY 1, 2", "cover_pixels")
def raster_mosaic_max(spark, d):
    return raster.mosaic_max(relation(spark, d, "cover_pixels").select(F.expr("row % 20").alias("r"), F.expr("col % 25").alias("c"), "value"), "r", "c")


@query("SELECT row % 20 AS r, col % 25 AS c, arg_min(value, pixel_id) AS value FROM cover_pixels WHERE value <> 0 GROUP BY 1, 2", "cover_pixels")
def raster_mosaic_first(spark, d):
    df = relation(spark, d, "cover_pixels").select(F.expr("row % 20").alias("r"), F.expr("col % 25").alias("c"), "value", "pixel_id")
    return raster.mosaic_first(df, "pixel_id", "r", "c")


@query(f"SELECT DISTINCT pixel_id {PAIRS.format('cover_pixels')}", "basins", "cover_pixels")
def tile_prune_semi(spark, d):
    return spatial.box_semi(shapes(spark, d, "cover_pixels"), shapes(spark, d, "basins"), CELL, "pixel_id").select("pixel_id")


@query("SELECT tile, count(*) AS cells, CAST(count(*) AS DOUBLE) AS area FROM cover_pixels WHERE value = 40 GROUP BY tile", "cover_pixels")
def polygonize_area(spark, d):
    regions = raster.polygonize(relation(spark, d, "cover_pixels"))
    traced = regions.select("tile", "cells", g.area(g.edges(F.col("rings"))).alias("area"))
    return traced.groupBy(F.col("tile").cast("int").alias("tile")).agg(F.sum("cells").alias("cells"), F.sum("area").alias("area"))


@query(f""", inside AS (SELECT DISTINCT pixel_id, value FROM cover_pixels a JOIN basins b ON {_CENTRE} WHERE value <> 0)
SELECT count(*) FILTER (WHERE value = 40) AS total_farmland_cells, count(*) AS total_valid_cells, round(count(*) FILTER (WHERE value = 40) * CAST(0.0001 AS DOUBLE), 6) AS total_farmland_area_km2,
  round(count(*) * CAST(0.0001 AS DOUBLE), 6) AS total_area_km2, round(count(*) FILTER (WHERE value = 40) / CAST(count(*) AS DOUBLE) * 100, 6) AS farmland_percentage FROM inside""", "basins", "cover_pixels")
def farmland_raster_area(spark, d):
    out = impact.farmland_raster(shapes(spark, d, "basins"), shapes(spark, d, "cover_pixels"), CELL, "pixel_id")
    return out.withColumns({c: F.round(c, 6) for c in ("total_farmland_area_km2", "total_area_km2", "farmland_percentage")})


# --- sets, tops and reports ------------------------------------------------------------------------------------------


@query("SELECT osm_id, building, CAST(NULL AS VARCHAR) AS highway FROM buildings UNION ALL SELECT osm_id, NULL, highway FROM roads", "buildings", "roads")
def union_schema_drift(spark, d):
    a = relation(spark, d, "buildings").select("osm_id", "building")
    return a.unionByName(relation(spark, d, "roads").select("osm_id", "highway"), allowMissingColumns=True)


@query("SELECT building, count(*) AS count FROM buildings WHERE building IS NOT NULL GROUP BY building ORDER BY count DESC, building LIMIT 5", "buildings")
def top_types(spark, d):
    return reports.top(relation(spark, d, "buildings"), "building", 5)


@query("SELECT highway, osm_id FROM (SELECT highway, osm_id, row_number() OVER (PARTITION BY highway ORDER BY osm_id) AS n FROM roads) WHERE n <= 3", "roads")
def layer_sample(spark, d):
    return reports.sample_by_layer(relation(spark, d, "roads").select("highway", "osm_id"), "highway", "osm_id", 3)


@query("""SELECT 'highway' AS "column", count(highway) AS non_null, count(*) - count(highway) AS nulls, count(DISTINCT highway) AS distinct_values FROM roads
UNION ALL SELECT 'railway', count(railway), count(*) - count(railway), count(DISTINCT railway) FROM roads""", "roads")
def column_profile(spark, d):
    return reports.profile(relation(spark, d, "roads").select("highway", "railway"))


@query("SELECT DISTINCT building FROM buildings WHERE building IS NOT NULL ORDER BY building LIMIT 50", "buildings")
def distinct_values(spark, d):
    return relation(spark, d, "buildings").where("building is not null").select("building").distinct().orderBy("building").limit(50)


_TAG = "CASE osm_id % 4 WHEN 0 THEN 'amenity' WHEN 1 THEN 'man_made' WHEN 2 THEN 'street_lamp' END"
_COMBINED = f""", tag AS (SELECT {_TAG} AS tag FROM buildings), c AS (SELECT count(*) FILTER (WHERE value = 40) AS n, count(*) AS m FROM cover_pixels)
SELECT 'POPULATION' AS Impact_Category, 'Total Population Affected' AS Metric, round(sum(value), 4) AS Value, 'people' AS Unit FROM pop_pixels WHERE value > 0 AND NOT isnan(value)
UNION ALL SELECT 'FARMLAND', 'Farmland Area Affected', round(n * 0.0001, 4), 'km²' FROM c UNION ALL SELECT 'FARMLAND', 'Total Basin Area Analyzed', round(m * 0.0001, 4), 'km²' FROM c
UNION ALL SELECT 'FARMLAND', 'Farmland Coverage', round(CAST(n AS DOUBLE) / m * 100, 4), '%' FROM c UNION ALL SELECT 'FARMLAND', 'Farmland Cells (10m pixels)', n, 'cells' FROM c
UNION ALL SELECT 'INFRASTRUCTURE', 'Total Features Affected', count(*), 'features' FROM tag
UNION ALL SELECT 'INFRASTRUCTURE', CASE tag WHEN 'amenity' THEN 'Amenities' WHEN 'man_made' THEN 'Man-made Structures' ELSE 'Street Lamp' END, count(*), 'features' FROM tag WHERE tag IS NOT NULL GROUP BY tag"""


@query(_COMBINED, "buildings", "cover_pixels", "pop_pixels")
def combined_report_long(spark, d):
    people = relation(spark, d, "pop_pixels").where(spatial.signal(F.col("value"))).agg(F.sum("value").alias("total_population"))
    cover = relation(spark, d, "cover_pixels")
    fields = cover.agg(
        (F.count_if(F.col("value") == 40) * 0.0001).alias("area_km2"), (F.count("*") * 0.0001).alias("total_area_km2"), F.count_if(F.col("value") == 40).alias("cells")
    )
    features = relation(spark, d, "buildings").select(F.expr(_TAG).alias("tag"))
    return reports.combined(people, fields, features).withColumn("Value", F.round("Value", 4))


_NAMES = ("amenity", "man_made", "public_transport", "street_lamp", "x")


@query("SELECT tag, CASE tag WHEN 'amenity' THEN 'Amenities' WHEN 'man_made' THEN 'Man-made Structures' WHEN 'public_transport' THEN 'Public Transport' WHEN 'street_lamp' THEN 'Street Lamp' ELSE 'X' END AS name FROM (SELECT unnest(['amenity', 'man_made', 'public_transport', 'street_lamp', 'x']) AS tag)")
def display_name_map(spark, d):
    return spark.createDataFrame([(n,) for n in _NAMES], "tag string").select("tag", text.display_name(F.col("tag")).alias("name"))


_LEDGER = "CASE n_nationkey % 4 WHEN 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status, n_nationkey * CAST(313.25 AS DOUBLE) AS seconds"


@query(f"""WITH l AS (SELECT n_name AS analysis, {_LEDGER}, CASE WHEN n_nationkey % 8 = 0 THEN 'lost' END AS error FROM nation)
SELECT analysis, status, CASE WHEN status = 'SUCCESS' THEN seconds ELSE 0 END AS duration_seconds,
  CASE WHEN status <> 'SUCCESS' THEN 'N/A' WHEN seconds < 60 THEN printf('%.1fs', seconds) WHEN seconds < 3600 THEN printf('%.1fm', seconds / 60) ELSE printf('%.1fh', seconds / 3600) END AS duration_formatted,
  CASE WHEN status <> 'SUCCESS' THEN coalesce(error, 'Unknown error') END AS error FROM l""")
def workflow_summary_duration(spark, d):
    ledger = spark.read.parquet(f"{d}/nation.parquet").selectExpr("n_name AS analysis", *_LEDGER.split(", "), "CASE WHEN n_nationkey % 8 = 0 THEN 'lost' END AS error")
    return reports.workflow_summary(ledger)


@query(f"WITH l AS (SELECT {_LEDGER} FROM nation) SELECT count(*) FILTER (WHERE status = 'SUCCESS') AS succeeded, count(*) FILTER (WHERE status <> 'SUCCESS') AS failed, sum(CASE WHEN status = 'SUCCESS' THEN seconds ELSE 0 END) AS total_seconds, sum(CASE WHEN status = 'SUCCESS' THEN seconds ELSE 0 END) / 1000 AS speedup FROM l")
def workflow_speedup(spark, d):
    return reports.speedup(spark.read.parquet(f"{d}/nation.parquet").selectExpr(*_LEDGER.split(", ")), 1000.0)


@query(f", {_LINES}, lay AS (SELECT CASE WHEN kind = 'railway' THEN 'railways' WHEN val = 'motorway' THEN 'motorways' ELSE 'highways' END AS layer FROM hit) SELECT 'Transportation' AS analysis, 'transportation_' || layer AS layer, 'vector' AS type, count(*) AS features FROM lay GROUP BY layer", "basins", "roads")
def layer_inventory(spark, d):
    lines = impact.affected_lines(shapes(spark, d, "basins"), shapes(spark, d, "roads"), CELL)
    return reports.inventory(lines, "Transportation", "layer")


@query("""SELECT 'Population' AS analysis, 'population_' || lower(n_name) AS layer_name, n_name || '.tif' AS raster_file, CAST(100 + n_nationkey AS INT) AS width, 50 AS height, 'EPSG:4326' AS crs,
  CAST(n_nationkey AS DOUBLE) AS bounds_minx, CAST(7.5 AS DOUBLE) AS bounds_miny, n_nationkey + (100 + n_nationkey) * CAST(0.25 AS DOUBLE) AS bounds_maxx, CAST(20.0 AS DOUBLE) AS bounds_maxy,
  n_nationkey + (100 + n_nationkey) * CAST(0.25 AS DOUBLE) / 2 AS center_x, CAST(13.75 AS DOUBLE) AS center_y, CAST(0.0 AS DOUBLE) AS nodata, 'float32' AS dtype, 1 AS count FROM nation""")
def raster_metadata(spark, d):
    tiles = spark.read.parquet(f"{d}/nation.parquet").select(
        F.concat("n_name", F.lit(".tif")).alias("name"), (F.col("n_nationkey") + 100).cast("int").alias("width"), F.lit(50).alias("height"), F.lit("EPSG:4326").alias("crs"),
        F.lit(0.0).alias("nodata"), F.lit("float32").alias("dtype"), F.lit(1).alias("bands"),
        F.array(F.col("n_nationkey").cast("double"), F.lit(0.25), F.lit(0.0), F.lit(20.0), F.lit(0.0), F.lit(-0.25)).alias("gt"),
    )
    return raster.metadata(tiles, "Population").withColumn("layer_name", F.lower("layer_name"))


@query("""SELECT 'Buildings' AS analysis, 'buildings_types' AS layer, building AS name, CAST(NULL AS BIGINT) AS linkno FROM (SELECT DISTINCT building FROM buildings WHERE building IS NOT NULL)
UNION ALL SELECT 'Farmland', 'farmland_zones', NULL, linkno FROM basins""", "buildings", "basins")
def consolidate_layers(spark, d):
    types = relation(spark, d, "buildings").where("building is not null").select(F.col("building").alias("name")).distinct()
    return reports.consolidate({("Buildings", "types"): types, ("Farmland", "zones"): relation(spark, d, "basins").select("linkno")})


@query("""SELECT CAST(NULL AS VARCHAR) AS layer_name, CASE WHEN event_id % 3 = 2 THEN NULL WHEN event_id % 3 = 0 THEN 1 ELSE 3 END AS geometry_type, 'EPSG:4326' AS crs, count(*) AS features,
  count(*) FILTER (WHERE event_id % 3 = 2) AS empty FROM events GROUP BY 2""")
def verify_geometries(spark, d):
    header = F.expr("CASE event_id % 3 WHEN 0 THEN '0101000000' WHEN 1 THEN '0000000003' END")
    return diagnostics.verify(spark.read.parquet(f"{d}/events.parquet").select(header.alias("geometry"), F.lit("EPSG:4326").alias("crs")))


@query("SELECT 'highway' AS tag, kind AS value, count(*) AS count FROM (SELECT CASE kind WHEN 'click' THEN 'primary' WHEN 'view' THEN 'residential' ELSE 'track' END AS kind FROM osm_tags) GROUP BY kind UNION ALL SELECT 'railway', kind, count(*) FROM (SELECT CASE kind WHEN 'purchase' THEN 'rail' ELSE 'abandoned' END AS kind FROM osm_tags) GROUP BY kind", "osm_tags")
def tag_values_report(spark, d):
    return diagnostics.tag_report(relation(spark, d, "osm_tags"), ("highway", "railway"))


@query("SELECT c_custkey, format('{:,.2f}', c_acctbal) AS balance, format('{:,}', c_custkey * 1000) AS number FROM customer")
def thousands_format(spark, d):
    rows = spark.read.parquet(f"{d}/customer.parquet")
    return rows.select("c_custkey", text.thousands(F.col("c_acctbal"), 2).alias("balance"), text.thousands(F.col("c_custkey") * 1000).alias("number"))


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def csv_round_trip(spark, d):
    first, last = new_folder(spark, "csv"), new_folder(spark, "csv")
    spark.read.parquet(f"{d}/nation.parquet").select("n_nationkey", "n_name", "n_regionkey").write.option("header", True).csv(first)
    files.copy(spark, first, last)
    files.rename(spark, last, last + "_renamed")
    files.remove(spark, first)
    return files.read_csv(spark, last + "_renamed", "n_nationkey long, n_name string, n_regionkey long")


@query(f", sums AS (SELECT b.linkno, round(coalesce(sum(CASE WHEN a.crop_id IS NOT NULL THEN {OVERLAP} END), 0), 6) AS area_km2 FROM basins b LEFT JOIN crops a ON {TOUCH} GROUP BY b.linkno), "
       "dealt AS (SELECT linkno, CAST(floor((row_number() OVER (ORDER BY sqrt(pow((minx + maxx) / 2, 2) + pow((miny + maxy) / 2, 2)), linkno) - 1) / 10.0) AS BIGINT) AS batch FROM basins) "
       "SELECT linkno, area_km2, batch FROM sums JOIN dealt USING (linkno)", "basins", "crops")
def farmland_in_batches(spark, d):
    zones, crops, folder = shapes(spark, d, "basins"), shapes(spark, d, "crops"), new_folder(spark, "batches")
    workflow.run_batches(spark, zones, lambda own: impact.farmland(own, crops, CELL, unit=1.0), folder, 10)
    return workflow.batch_results(spark, folder).select("linkno", F.round("area_km2", 6).alias("area_km2"), F.col("batch").cast("long").alias("batch"))
