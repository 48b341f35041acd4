"""A synthetic geography over the driver's tables, for queries and tests.

Planar units on a domain of about 80 by 80; every coordinate is a multiple of 1/8, so that sums are exact. The SQL runs
in Spark and, with plain double literals, in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions import geometry as g
from freshet.operators.spatial import with_box

RELATIONS = {
    "basins": (
        "nation",
        "SELECT CAST(n_nationkey AS BIGINT) AS linkno, 16.0D*(n_nationkey % 5) AS minx, 16.0D*floor(n_nationkey/5.0D) AS miny, "
        "16.0D*(n_nationkey % 5)+16.0D AS maxx, 16.0D*floor(n_nationkey/5.0D)+16.0D AS maxy FROM nation",
    ),
    "buildings": (
        "customer",
        "SELECT c_custkey AS osm_id, c_name AS name, ((c_custkey*37) % 640)/8.0D AS minx, ((c_custkey*91) % 640)/8.0D AS miny, "
        "((c_custkey*37) % 640)/8.0D + (1+c_custkey % 16)/8.0D AS maxx, ((c_custkey*91) % 640)/8.0D + (1+c_custkey % 24)/8.0D AS maxy, "
        "CASE c_custkey % 12 WHEN 0 THEN 'yes' WHEN 1 THEN 'house' WHEN 2 THEN 'apartments' WHEN 3 THEN 'school' WHEN 4 THEN 'hospital' "
        "WHEN 5 THEN 'retail' WHEN 6 THEN 'church' WHEN 7 THEN 'garage' WHEN 8 THEN 'policlinic' WHEN 9 THEN 'not_a_building' WHEN 11 THEN 'university' END AS building, "
        "CASE c_custkey % 7 WHEN 1 THEN 'hospital' WHEN 2 THEN 'cafe' WHEN 3 THEN 'police' WHEN 4 THEN 'bench' END AS amenity, "
        "CASE c_custkey % 19 WHEN 0 THEN 'runway' WHEN 1 THEN 'helipad' END AS aeroway, CASE c_custkey % 23 WHEN 0 THEN 'water_works' END AS man_made, "
        "CASE c_custkey % 29 WHEN 0 THEN 'base' END AS military, CASE c_custkey % 31 WHEN 0 THEN 'plant' END AS power, "
        "CASE c_custkey % 37 WHEN 0 THEN 'dam' END AS waterway FROM customer",
    ),
    "roads": (
        "orders",
        "SELECT o_orderkey AS osm_id, ((o_orderkey*29) % 640)/8.0D AS x1, ((o_orderkey*71) % 640)/8.0D AS y1, "
        "((o_orderkey*29) % 640)/8.0D + CASE WHEN o_orderkey % 2 = 0 THEN (1+o_orderkey % 64)/8.0D ELSE 0.0D END AS x2, "
        "((o_orderkey*71) % 640)/8.0D + CASE WHEN o_orderkey % 2 = 1 THEN (1+o_orderkey % 64)/8.0D ELSE 0.0D END AS y2, "
        "CASE o_orderkey % 10 WHEN 0 THEN 'motorway' WHEN 1 THEN 'primary' WHEN 2 THEN 'residential' WHEN 3 THEN 'footway' WHEN 4 THEN 'track' "
        "WHEN 8 THEN 'tertiary' WHEN 9 THEN 'track' END AS highway, "
        "CASE o_orderkey % 10 WHEN 6 THEN 'rail' WHEN 7 THEN 'tram' WHEN 8 THEN 'rail' WHEN 9 THEN 'rail' END AS railway FROM orders",
    ),
    "crops": (
        "part",
        "SELECT p_partkey AS crop_id, ((p_partkey*53) % 640)/8.0D AS minx, ((p_partkey*17) % 640)/8.0D AS miny, "
        "((p_partkey*53) % 640)/8.0D + (1+p_partkey % 32)/8.0D AS maxx, ((p_partkey*17) % 640)/8.0D + (1+p_partkey % 20)/8.0D AS maxy FROM part",
    ),
    "pop_pixels": (
        "customer",
        "SELECT c_custkey AS pixel_id, CAST(c_custkey % 40 AS INT) AS col, CAST(floor(c_custkey/40.0D) AS INT) AS row, 2.0D*(c_custkey % 40) AS minx, "
        "2.0D*floor(c_custkey/40.0D) AS miny, 2.0D*(c_custkey % 40)+2.0D AS maxx, 2.0D*floor(c_custkey/40.0D)+2.0D AS maxy, "
        "CASE WHEN c_custkey % 97 = 0 THEN CAST('NaN' AS DOUBLE) ELSE c_acctbal END AS value FROM customer",
    ),
    "cover_pixels": (
        "part",
        "SELECT p_partkey AS pixel_id, CAST(p_partkey % 4 AS INT) AS tile, CAST(p_partkey % 50 AS INT) AS col, CAST(floor(p_partkey/50.0D) AS INT) AS row, "
        "1.5D*(p_partkey % 50) AS minx, 1.5D*floor(p_partkey/50.0D) AS miny, 1.5D*(p_partkey % 50)+1.5D AS maxx, 1.5D*floor(p_partkey/50.0D)+1.5D AS maxy, "
        "CASE WHEN p_partkey % 3 = 0 THEN 40 WHEN p_partkey % 7 = 0 THEN 0 ELSE 10 END AS value FROM part",
    ),
    "osm_tags": (
        "events",
        "SELECT event_id AS osm_id, concat('\"highway\"=>\"', CASE event_type WHEN 'click' THEN 'primary' WHEN 'view' THEN 'residential' ELSE 'track' END, "
        "'\",\"railway\"=>\"', CASE event_type WHEN 'purchase' THEN 'rail' ELSE 'abandoned' END, '\",\"name\"=>\"', event_type, '\"') AS other_tags, "
        "event_type AS kind FROM events",
    ),
    "places": (
        "customer",
        "SELECT c_custkey AS place_id, CAST((c_custkey*7) % 2880 AS DOUBLE)/8.0D - 180.0D AS lon, CAST((c_custkey*11) % 1360 AS DOUBLE)/8.0D - 85.0D AS lat FROM customer",
    ),
}


def relation(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, sql = RELATIONS[name]
    return spark.sql(sql.replace(f"FROM {table}", "FROM {t}"), t=spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def shapes(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A relation with its geometry, edges and box."""
    df = relation(spark, sf_dir, name)
    rings = g.segment() if name == "roads" else g.rectangle()
    kept = [c for c in df.columns if c not in ("minx", "miny", "maxx", "maxy", "x1", "y1", "x2", "y2")]
    return with_box(df.select(*[F.col(c) for c in kept], rings.alias("rings")))


def duckdb(*names: str) -> str:
    """``WITH`` clause of the relations for DuckDB."""
    import re

    return "WITH " + ", ".join(f"{n} AS ({re.sub(r'(\d+\.\d+)D', r'CAST(\1 AS DOUBLE)', RELATIONS[n][1])})" for n in names)
