import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from freshet.functions import geometry as g
from freshet.functions import projections as p
from freshet.functions import text, wkb
from freshet.operators import raster, reports, spatial, tags
from freshet.plans import impact, workflow
from freshet.sources import files
from freshet.vocabulary import BUILDING, CRITICAL, HIGHWAY, RAILWAY, STRUCTURES

RINGS = "array<array<struct<x:double,y:double>>>"


def shape(*rings):
    return [[{"x": float(x), "y": float(y)} for x, y in r] for r in rings]


def square(x, y, s, clockwise=False):
    ring = [(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)]
    return ring[::-1] if clockwise else ring


def table(spark, rows, key="fid", extra=""):
    return spatial.with_box(spark.createDataFrame(rows, f"{key} long, rings {RINGS}{extra}"))


def one(spark, expr, a, b=None):
    df = spark.createDataFrame([(a, b)], f"a {RINGS}, b {RINGS}").select(g.edges(F.col("a")).alias("a"), g.edges(F.col("b")).alias("b"), F.col("a").alias("ra"))
    return df.select(expr.alias("v")).first()["v"]


def test_vocabularies():
    assert (len(BUILDING), len(HIGHWAY), len(RAILWAY)) == (104, 15, 5)
    assert [len(STRUCTURES[k]) for k in ("aeroway", "amenity", "building")] == [12, 95, 92]
    assert [len(v) for v in CRITICAL.values()] == [1, 7, 7, 2, 2, 1, 1]
    assert all(len(set(v)) == len(v) for v in (BUILDING, *STRUCTURES.values()))


def star():
    pts = [((5 if i % 2 else 2) * math.cos(math.pi * i / 5), (5 if i % 2 else 2) * math.sin(math.pi * i / 5)) for i in range(10)]
    return [*pts, pts[0]]


def clip_area(subject, clip):
    """Sutherland-Hodgman for a convex counter-clockwise clip."""
    out = subject[:-1]
    for a, b in zip(clip[:-1], clip[1:]):
        side = lambda q: (b[0] - a[0]) * (q[1] - a[1]) - (b[1] - a[1]) * (q[0] - a[0])
        new = []
        for u, v in zip(out, out[1:] + out[:1]):
            su, sv = side(u), side(v)
            if su >= 0:
                new.append(u)
            if su * sv < 0:
                k = su / (su - sv)
                new.append((u[0] + k * (v[0] - u[0]), u[1] + k * (v[1] - u[1])))
        out = new
    return abs(sum(u[0] * v[1] - u[1] * v[0] for u, v in zip(out, out[1:] + out[:1]))) / 2


def test_intersection_area_of_a_star_with_a_hole(spark):
    quad = [(-1.0, -2.0), (3.5, -1.0), (4.0, 2.5), (0.5, 3.0), (-1.0, -2.0)]
    hole = square(0.25, 0.25, 0.5, clockwise=True)
    got = one(spark, g.intersection_area(F.col("a"), F.col("b")), shape(star(), hole), shape(quad))
    assert got == pytest.approx(clip_area(star(), quad) - 0.25, abs=1e-9)


def test_shared_edges_have_no_area(spark):
    assert one(spark, g.intersection_area(F.col("a"), F.col("b")), shape(square(0, 0, 2)), shape(square(2, 0, 2))) == 0


def test_intersects(spark):
    meets = g.intersects(F.col("a"), F.col("b"))
    assert one(spark, meets, shape(square(0, 0, 2)), shape(square(2, 2, 2)))  # a corner
    assert one(spark, meets, shape(square(0, 0, 9)), shape(square(3, 3, 1)))  # inside
    assert one(spark, meets, shape(square(3, 3, 1)), shape(square(0, 0, 9)))
    assert not one(spark, meets, shape(square(0, 0, 9), square(2, 2, 5, True)), shape(square(3, 3, 1)))  # in the hole
    assert not one(spark, meets, shape(square(0, 0, 1)), shape(square(1.5, 0, 1)))


def test_clipped_length_in_a_concave_polygon(spark):
    u = [(0, 0), (6, 0), (6, 4), (4, 4), (4, 2), (2, 2), (2, 4), (0, 4), (0, 0)]
    clip = g.clipped_length(F.col("a"), F.col("b"))
    assert one(spark, clip, shape([(-1, 3), (7, 3)]), shape(u)) == pytest.approx(4)
    assert one(spark, clip, shape([(-1, 4), (7, 4)]), shape(u)) == pytest.approx(4)  # along the border
    assert one(spark, clip, shape([(0, 0), (3, 4), (3, 9)]), shape(u)) == pytest.approx(10 / 3)  # leaves at the notch
    assert one(spark, clip, shape([(3, 3), (3, 3)]), shape(u)) == 0


def test_measures(spark):
    ring = shape(square(0, 0, 4), square(1, 1, 2, True))
    assert one(spark, g.area(F.col("a")), ring) == 12
    c = one(spark, g.centroid(F.col("a"), F.col("ra")), shape(square(0, 0, 4)))
    assert (c.x, c.y) == (2, 2)
    line = one(spark, g.centroid(F.col("a"), F.col("ra")), shape([(0, 0), (4, 0), (4, 2)]))
    assert (line.x, line.y) == pytest.approx((16 / 6, 2 / 6))
    assert one(spark, g.length(F.col("a")), shape([(0, 0), (3, 4)])) == 5


def test_projections(spark):
    row = spark.range(1).select(
        p.cea_forward(F.lit(180.0), F.lit(90.0)).alias("c"), p.utm_forward(F.lit(-87.0), F.lit(15.0)).alias("u"), p.utm_forward(F.lit(-84.0), F.lit(-10.0), F.lit(16)).alias("w"),
        p.mollweide_forward(F.lit(180.0), F.lit(0.0)).alias("m"), p.mollweide_forward(F.lit(10.0), F.lit(90.0)).alias("n"),
    ).first()
    assert (row.c.x, row.c.y) == pytest.approx((20037508.3428, 6363885.3319), abs=1e-3)
    assert row.u.x == pytest.approx(500000) and row.u.y == pytest.approx(1658325.996, abs=0.01)
    assert row.w.x > 800000 and 8800000 < row.w.y < 8900000
    assert row.m.x == pytest.approx(18040095.696, abs=0.01) and row.m.y == 0
    assert row.n.x == pytest.approx(0, abs=1e-6) and row.n.y == pytest.approx(math.sqrt(2) * p.A)


def test_lengths_and_areas_in_projections(spark):
    assert p.estimate_utm(-90, 10, -84.5, 20) == "utm:16" and p.estimate_utm(-90, -20, -84.5, 10) == "utm:-16"
    across = spark.createDataFrame([(1, shape([(-90.01, 15.0), (-89.99, 15.0)]))], f"fid long, rings {RINGS}")  # a zone's border
    metres = spatial.with_box(across, crs="utm:16").select(g.length(F.col("edges"))).first()[0]
    assert metres == pytest.approx(0.02 * 111320 * math.cos(math.radians(15)), rel=2e-3)
    cell = spark.createDataFrame([(1, shape(square(-87, 15, 1)))], f"fid long, rings {RINGS}")
    assert spatial.with_box(cell, crs="cea").select(g.area(F.col("edges"))).first()[0] == pytest.approx(1.1866e10, rel=5e-3)


@pytest.mark.parametrize("size", [1.0, 3.0, 50.0])
def test_join_does_not_depend_on_the_grid(spark, size):
    left = table(spark, [(i, shape(square(i * 1.5, (i * 7) % 11, 2))) for i in range(12)])
    right = table(spark, [(i, shape(square(i * 4, 0, 4))) for i in range(5)] + [(9, None)])
    pairs = {(r.l_fid, r.r_fid) for r in spatial.spatial_join(left, right, size).collect()}
    want = {(i, j) for i in range(12) for j in range(5) if i * 1.5 <= j * 4 + 4 and j * 4 <= i * 1.5 + 2 and (i * 7) % 11 <= 4}
    assert pairs == want
    assert spatial.spatial_join(left, right, size).count() == len(want)


def test_area_over_a_tiling_is_the_area(spark):
    zones = spatial.with_box(spark.createDataFrame([(i, shape(square(i % 3 * 4, i // 3 * 4, 4))) for i in range(9)], f"linkno long, rings {RINGS}"))
    thing = table(spark, [(1, shape([(x + 6, y + 6) for x, y in star()]))])
    total = spatial.overlay_area(thing, zones, 4.0).agg(F.sum("area")).first()[0]
    assert total == pytest.approx(thing.select(g.area(F.col("edges"))).first()[0])


def test_tags(spark):
    df = spark.createDataFrame([("primary", "rail"), (None, "rail"), ("track", None), ("track", "tram"), (None, None)], "highway string, railway string")
    got = tags.classify(df, {"highway": HIGHWAY, "railway": RAILWAY}, "k", "v").select("k", "v").collect()
    assert sorted(map(tuple, got)) == [("highway", "primary"), ("railway", "rail"), ("railway", "tram")]
    assert df.where(tags.matches(df.drop("railway"), {"highway": HIGHWAY, "railway": RAILWAY})).count() == 1
    with pytest.raises(ValueError, match="building"):
        tags.require(df, "building")
    assert tags.tag_columns(spark.createDataFrame([(1, 2, 3)], "`tag.a` int, `addr:street` int, b int")) == ["tag.a", "addr:street"]


def test_reports_over_nothing(spark):
    zones = spatial.with_box(spark.createDataFrame([(1, shape(square(0, 0, 4)))], f"linkno long, rings {RINGS}"))
    none = table(spark, [], extra=", building string, highway string, railway string")
    assert [tuple(r) for r in impact.buildings(zones, none, 4.0).collect()] == [("TOTAL", "All Buildings", 0)]
    assert [tuple(r) for r in impact.transportation(zones, none, 4.0).collect()] == [("TOTAL", "All Transportation", 0.0)]
    assert [tuple(r) for r in impact.critical_infrastructure(zones, none, 4.0).collect()] == [("TOTAL", "All Critical Infrastructure", 0)]
    crops = none.withColumnRenamed("fid", "crop_id")
    assert [tuple(r) for r in impact.farmland(zones, crops, 4.0).collect()] == [(1, 0.0)]
    pixels = none.withColumn("value", F.lit(1.0))
    assert impact.population(zones, pixels, 4.0, "fid").first()[0] == 0


def test_population_counts_a_pixel_once_and_no_nan(spark):
    zones = spatial.with_box(spark.createDataFrame([(1, shape(square(0, 0, 4))), (2, shape(square(4, 0, 4)))], f"linkno long, rings {RINGS}"))
    rows = [(1, shape(square(3, 1, 2)), 5.0), (2, shape(square(5, 1, 1)), float("nan")), (3, shape(square(1, 1, 1)), -9.0), (4, shape(square(9, 9, 1)), 7.0)]
    pixels = table(spark, rows, extra=", value double")
    assert impact.population(zones, pixels, 4.0, "fid").first()[0] == 5
    assert {tuple(r) for r in impact.population_by_zone(zones, pixels, 4.0).collect()} == {(1, 5.0), (2, 5.0)}  # its centre is on the border


def test_regions_and_outlines():
    mask = np.array([[1, 1, 0, 1], [1, 0, 0, 1], [0, 1, 0, 1], [1, 1, 1, 1], [0, 0, 1, 0]], dtype=bool)
    labels = raster.label_regions(mask)
    assert labels.max() == 2 and (labels > 0).tolist() == mask.tolist()
    ring = np.ones((3, 3), dtype=bool)
    ring[1, 1] = False
    assert len(raster.outline(ring)) == 2
    rng = np.random.default_rng(0)
    for _ in range(20):
        mask = rng.random((9, 11)) < 0.55
        labels = raster.label_regions(mask)
        area = 0.0
        for k in range(1, labels.max() + 1):
            for r in raster.outline(labels == k):
                area += sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r[:-1], r[1:])) / 2
        assert area == mask.sum()
        seen = {}
        for r in range(9):
            for c in range(11):
                for dr, dc in ((0, 1), (1, 0)):
                    if r + dr < 9 and c + dc < 11 and mask[r, c] and mask[r + dr, c + dc]:
                        assert labels[r, c] == labels[r + dr, c + dc]
                seen.setdefault(labels[r, c], 0)


def test_polygonize_a_ring(spark):
    cells = [(1, r, c, 40 if (r, c) != (1, 1) else 10) for r in range(3) for c in range(3)] + [(1, 5, 5, 40), (2, 0, 0, 40), (2, 0, 1, 40)]
    got = raster.polygonize(spark.createDataFrame(cells, "tile long, row int, col int, value int"))
    areas = got.select("tile", "cells", F.size("rings").alias("n"), g.area(g.edges(F.col("rings"))).alias("a")).collect()
    assert sorted(map(tuple, areas)) == [(1, 1, 1, 1.0), (1, 8, 2, 8.0), (2, 2, 1, 2.0)]


def test_text_and_ledger(spark, tmp_path):
    row = spark.range(1).select(text.all_label(F.lit("man_made")).alias("a"), text.duration(F.lit(59.94)).alias("b"), text.duration(F.lit(90.0)).alias("c"), text.none_to_null(F.lit("None")).alias("d")).first()
    assert tuple(row) == ("All Man_made", "59.9s", "1.5m", None)

    def broken():
        raise OSError("no basins")

    ledger = workflow.run(spark, {"Good": lambda: spark.range(3), "Bad": broken}, f"file://{tmp_path}")
    assert {(r.analysis, r.status, r.error) for r in ledger.collect()} == {("Good", "SUCCESS", None), ("Bad", "FAILED", "no basins")}
    rows, speed = workflow.summary(ledger, 2.0)
    assert {r.duration_formatted for r in rows.where("analysis = 'Bad'").collect()} == {"N/A"}
    assert speed.first().succeeded == 1
    assert reports.speedup(ledger.limit(0), 1.0).first().total_seconds == 0


def test_borders_at_general_coordinates(spark):
    """Turned unit squares that share an edge: no area in common, and a line along the edge lies in both."""
    rng = random.Random(3)
    left, right, lines = [], [], []
    for i in range(120):
        x, y, turn = rng.uniform(-50, 50), rng.uniform(-50, 50), rng.uniform(0, math.pi)
        c, s = math.cos(turn), math.sin(turn)
        at = lambda a, b: (x + a * c - b * s, y + a * s + b * c)  # noqa: B023, E731
        square = lambda a: [[at(a, 0), at(a + 1, 0), at(a + 1, 1), at(a, 1), at(a, 0)]]  # noqa: B023, E731
        left.append((i, square(0)))
        right.append((i, square(1)))
        lines.append((i, [[at(1, 0.25), at(1, 0.75)]]))
    schema = "id long, rings array<array<struct<x: double, y: double>>>"
    a, b, line = (spatial.with_box(spark.createDataFrame(rows, schema)) for rows in (left, right, lines))
    same = F.col("l_id") == F.col("r_id")
    assert spatial.overlay_area(a, b, 4.0).where(same).count() == 0
    assert spatial.spatial_join(a, b, 4.0).where(same).count() == 120
    for zones in (a, b):
        found = spatial.overlay_length(line, zones, 4.0).where(same).collect()
        assert len(found) == 120 and all(abs(r.length - 0.5) < 1e-9 for r in found)
    touching = spatial.overlay_length(line, b, 4.0).where(same).select(F.size("parts").alias("n"), F.col("parts")[0][0]["x"].alias("x"), F.col("l_minx"), F.col("l_maxx")).collect()
    assert all(r.n >= 1 and r.l_minx - 1e-9 <= r.x <= r.l_maxx + 1e-9 for r in touching)


def test_formats_and_codes(spark):
    row = spark.range(1).select(text.thousands(F.lit(1234567.891), 2).alias("a"), text.thousands(F.lit(None).cast("double")).alias("b"), text.stamp(F.lit("2024-05-01 13:00:00").cast("timestamp")).alias("c")).first()
    assert tuple(row) == ("1,234,567.89", None, "2024-05-01 13:00:00")
    names = ("geographic", "utm:16", "utm:-21", "EPSG:32616", "epsg:4269", "cea")
    assert [p.epsg(n) for n in names] == [4326, 32616, 32721, 32616, 4269, None]
    assert [p.is_geographic(n) for n in names] == [True, False, False, False, True, False]
    with pytest.raises(ValueError):
        p.epsg("flat")


def test_zones_by_distance_in_any_unit(spark):
    rows = [(i, float(i % 40), 0.0) for i in range(400)]
    for unit in (1e-3, 1e6):
        zones = spark.createDataFrame([(i, x * unit, y, (x + 1) * unit, y + unit) for i, x, y in rows], "linkno long, minx double, miny double, maxx double, maxy double")
        zones = spatial.with_box(zones.select("linkno", g.rectangle().alias("rings")))
        got = {r.linkno: r.batch for r in impact.zones_by_distance(zones, 7).collect()}
        assert got == {i: n // 7 for n, i in enumerate(sorted(range(400), key=lambda i: (i % 40, i)))}
    assert impact.zones_by_distance(zones.limit(0)).count() == 0
    bare = zones.limit(3).unionByName(zones.limit(1).withColumn("linkno", F.lit(-1).cast("long")).withColumns({c: F.lit(None).cast(zones.schema[c].dataType) for c in ("rings", "edges")}))
    assert [(r.linkno, r.batch) for r in impact.zones_by_distance(bare, 3).where("distance is null").collect()] == [(-1, 1)]


def test_batches_fail_alone_and_go_on(spark, tmp_path):
    zones = spatial.with_box(spark.createDataFrame([(i, float(i), 0.0, i + 1.0, 1.0) for i in range(5)], "linkno long, minx double, miny double, maxx double, maxy double").select("linkno", g.rectangle().alias("rings")))
    folder, made = f"file://{tmp_path}/out", []

    def make(own):
        made.append(sorted(r.linkno for r in own.select("linkno").collect()))
        if len(made) == 2:
            raise OSError("lost")
        return own.select("linkno")

    assert [(r.status, r.error) for r in workflow.run_batches(spark, zones, make, folder, 2).collect()] == [("SUCCESS", None), ("FAILED", "lost"), ("SUCCESS", None)]
    assert [r.status for r in workflow.run_batches(spark, zones, make, folder, 2).collect()] == ["SUCCESS"] * 3
    assert made == [[0, 1], [2, 3], [4], [2, 3]]
    assert sorted(map(tuple, workflow.batch_results(spark, folder).collect())) == [(0, 0), (1, 0), (2, 1), (3, 1), (4, 2)]
    assert workflow.run_batches(spark, zones.limit(0), make, f"{folder}-none", 2).count() == 0


def test_runner(spark, tmp_path):
    from freshet import __main__ as runner

    boxed = lambda df: df.withColumn("geometry", wkb.encoded(F.lit(3), g.rectangle())).drop("minx", "miny", "maxx", "maxy")
    corners = "minx double, miny double, maxx double, maxy double"
    keys = "building string, highway string, railway string, " + ", ".join(f"{k} string" for k in sorted({*CRITICAL, *STRUCTURES} - {"building", "highway", "railway"}))
    width = len(keys.split(", "))
    boxed(spark.createDataFrame([(7, 0.0, 0.0, 1.0, 1.0)], f"linkno long, {corners}")).write.parquet(f"{tmp_path}/basins.parquet")
    building = BUILDING[0]
    boxed(spark.createDataFrame([(1, building, *[None] * (width - 1), 0.2, 0.2, 0.3, 0.3)], f"osm_id long, {keys}, {corners}")).write.parquet(f"{tmp_path}/osm.parquet")
    boxed(spark.createDataFrame([(0.0, 0.0, 0.5, 1.0)], corners)).write.parquet(f"{tmp_path}/crops.parquet")
    out = f"{tmp_path}/out"
    arguments = ["--zones", f"{tmp_path}/basins.parquet", "--features", f"{tmp_path}/osm.parquet", "--crops", f"{tmp_path}/crops.parquet", "--output", out, "--workers", "2"]
    assert runner.main(arguments, spark) == 0
    assert sorted(map(tuple, files.read_csv(spark, f"{out}/buildings_statistics", "category string, building_type string, count long").collect())) == sorted([("TOTAL", "All Buildings", 1), ("DETAIL", building, 1)])
    assert abs(files.read_csv(spark, f"{out}/farmland_statistics").first().area_km2 / (111.32 * 110.57 / 2) - 1) < 1e-3
    assert files.read_csv(spark, f"{out}/workflow_summary").count() == 5
    assert runner.main([*arguments, "--population", f"{tmp_path}/osm.parquet"], spark) == 1
