import io
import json
import sqlite3
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from freshet.functions import wkb
from freshet.sources import files, geotiff, osmpbf, vector

SQUARE = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0), (0.0, 0.0)]
HOLE = [(0.5, 0.5), (0.5, 1.0), (1.0, 1.0), (1.0, 0.5), (0.5, 0.5)]
FAR = [(x + 9, y) for x, y in SQUARE]


@pytest.mark.parametrize("kind, parts", [
    (1, [[(1.0, 2.0)]]), (2, [[(0.0, 0.0), (1.0, 1.0)]]), (3, [SQUARE, HOLE]), (4, [[(1.0, 2.0)], [(3.0, 4.0)]]),
    (5, [[(0.0, 0.0), (1.0, 1.0)], [(2.0, 2.0), (3.0, 3.0)]]), (6, [SQUARE, HOLE, FAR]),
])
def test_wkb_round_trip(spark, kind, parts):
    raw = wkb.encode(kind, parts)
    assert wkb.decode(raw) == (kind, parts)
    df = spark.createDataFrame([(bytearray(raw),), (None,)], "geometry binary")
    both = [wkb.decoded(df).collect(), wkb.decoded(df.select(F.hex("geometry").alias("geometry"))).collect()]
    for rows in both:
        assert rows[0].geometry_type == kind and [[(p.x, p.y) for p in r] for r in rows[0].rings] == parts
        assert rows[1].geometry_type is None and rows[1].rings is None
    back = wkb.decoded(df).select(wkb.encoded(F.col("geometry_type"), F.col("rings")).alias("g")).collect()
    assert bytes(back[0].g) == raw and back[1].g is None


def test_wkb_big_endian_and_dimensions():
    raw = struct.pack(">BIddd", 0, 1001, 1.0, 2.0, 3.0)
    assert wkb.decode(raw) == (1, [[(1.0, 2.0)]])
    raw = struct.pack("<BIIdd", 1, 0x20000001, 4326, 1.0, 2.0)
    assert wkb.decode(raw) == (1, [[(1.0, 2.0)]])


def test_geojson(spark, tmp_path):
    features = [
        {"type": "Feature", "properties": {"name": "a"}, "geometry": {"type": "Polygon", "coordinates": [SQUARE[::-1]]}},
        {"type": "Feature", "properties": {"name": "b"}, "geometry": None},
    ]
    path = tmp_path / "x.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    rows = {r.name: r.geometry for r in vector.read_vector(spark, str(path)).collect()}
    assert wkb.decode(bytes(rows["a"])) == (3, [SQUARE]) and rows["b"] is None
    df = spark.createDataFrame([("a", bytearray(wkb.encode(6, [SQUARE, HOLE, FAR])))], "name string, geometry binary")
    vector.write_geojson(df, f"file://{tmp_path}/out", note="n")
    line = json.loads(spark.read.text(f"file://{tmp_path}/out").first()[0])
    assert line["properties"] == {"name": "a", "note": "n"} and len(line["geometry"]["coordinates"]) == 2
    with pytest.raises(ValueError, match="unsupported"):
        vector.read_vector(spark, "x.kml")


def test_geopackage(spark, tmp_path):
    path = str(tmp_path / "x.gpkg")
    lines = spark.createDataFrame([(1, "a", bytearray(wkb.encode(2, [[(0.0, 0.0), (1.0, 1.0)]])))], "osm_id long, name string, geometry binary")
    areas = spark.createDataFrame([(7, bytearray(wkb.encode(6, [SQUARE]))), (8, None)], "kind long, geometry binary")
    vector.write_gpkg({"lines": lines, "areas": areas, "none": areas.limit(0)}, path)
    assert [x[0] for x in vector.gpkg_layers(path)] == ["areas", "lines", "none"]
    rows = vector.read_vector(spark, path).collect()
    assert {(r.layer_name, r.geometry_type, r.name, r.kind, r.crs) for r in rows} == {("lines", "LineString", "a", None, "EPSG:4326"), ("areas", "MultiPolygon", None, "7", "EPSG:4326"), ("areas", None, None, "8", "EPSG:4326")}
    assert vector.read_gpkg(spark, path, "LineString").count() == 1
    with sqlite3.connect(path) as db:
        assert db.execute("SELECT count(*) FROM areas").fetchone() == (2,)


def test_shapefile(spark, tmp_path):
    df = spark.createDataFrame([("church", "x", 1.0, 2.0), ("school", None, 3.0, 4.0)], "building_type string, building_typo string, x double, y double")
    vector.write_point_shapefile(df, str(tmp_path / "b.shp"))
    rows = vector.read_vector(spark, f"{tmp_path}/b.shp").collect()
    assert [(r.building_t, r["building_1"], wkb.decode(bytes(r.geometry))[1][0][0]) for r in rows] == [("church", "x", (1.0, 2.0)), ("school", None, (3.0, 4.0))]


def test_shapefile_content_stays_off_the_driver(spark, tmp_path, monkeypatch):
    """the first ``.dbf`` came to the driver whole, for its column names. Many records, two files, and a path that
    only Spark opens; lines and polygons as before."""
    from pyspark.sql.classic.dataframe import DataFrame

    df = spark.range(25_000).selectExpr("id", "id % 360 - 180D AS x", "id % 90 + 0D AS y")
    for name in ("a", "b"):
        vector.write_point_shapefile(df, str(tmp_path / f"{name}.shp"))

    def fails(*_):
        raise AssertionError("rows came to the driver")

    for path in (f"{tmp_path}/*.shp", f"viewfs://shapes{tmp_path}/*.shp"):
        spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.shapes.linkFallback", "file:///")
        with monkeypatch.context() as m:
            for how in ("first", "head", "take", "collect"):
                m.setattr(DataFrame, how, fails)
            got = vector.read_shapefile(spark, path)
        assert got.columns == ["id", "geometry"]
        assert tuple(got.selectExpr("count(*)", "sum(id)", "count(DISTINCT id)", "count(geometry)").first()) == (50_000, 2 * sum(range(25_000)), 25_000, 50_000)
    row = got.where("id = 24999").first()
    assert wkb.decode(bytes(row.geometry)) == (1, [[(24999 % 360 - 180.0, 24999 % 90 + 0.0)]])
    with pytest.raises(FileNotFoundError):
        vector.read_shapefile(spark, str(tmp_path / "none.shp"))
    corners = struct.pack("<4d2i3i", 0, 0, 2, 2, 2, 8, 0, 5, 0)[:-4] + b"".join(struct.pack("<2d", *p) for p in [*SQUARE[::-1], *SQUARE[:3]])
    body = struct.pack("<i", 5) + corners
    shp = io.BytesIO(b"\0" * 100 + struct.pack(">2i", 1, len(body) // 2) + body + struct.pack(">2i", 2, 2) + struct.pack("<i", 0))
    assert list(vector.shp_records(shp)) == [wkb.encode(6, [SQUARE, SQUARE[:3][::-1]]), None]


def test_text_types(spark):
    df = spark.createDataFrame([(1, "None", None)], "a long, b string, geometry binary")
    assert tuple(vector.normalise_types(df).first()) == ("1", None, None)


@pytest.mark.parametrize("dtype", ["uint8", "int16", "float32"])
def test_geotiff(spark, tmp_path, dtype):
    a = (np.arange(300 * 20).reshape(20, 300) % 101).astype(dtype)
    (tmp_path / "t.tif").write_bytes(geotiff.encode(a, [10.0, 0.5, 0.0, 50.0, 0.0, -0.5]))
    head = geotiff.read_headers(spark, f"{tmp_path}").first()
    assert (head.width, head.height, head.crs, head.nodata, head.dtype, head.gt[0]) == (300, 20, "EPSG:4326", 0.0, dtype, 10.0)
    got = geotiff.read_pixels(spark, f"{tmp_path}")
    assert got.count() == a.size and got.agg(F.sum("value")).first()[0] == a.sum()
    p = got.where("row = 3 and col = 280").first()
    assert (p.value, p.minx, p.maxy) == (a[3, 280], 150.0, 48.5)


def test_lzw_and_strips():
    # codes of 9 bits: clear, 7, 7 7 (new), end
    bits = "".join(f"{c:09b}" for c in (256, 7, 258, 257))
    assert geotiff._lzw(int(bits.ljust(40, "0"), 2).to_bytes(5, "big")) == b"\x07\x07\x07"


def varint(n):
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def field(k, v):
    return varint(k << 3) + varint(v) if isinstance(v, int) else varint(k << 3 | 2) + varint(len(v)) + v


def zigzag(values):
    last, out = 0, b""
    for v in values:
        d, last = v - last, v
        out += varint(d << 1 if d >= 0 else (-d << 1) - 1)
    return out


def pbf(tmp_path):
    strings = ["", "highway", "primary", "building", "yes", "type", "multipolygon", "outer", "inner", "name", "x"]
    table = b"".join(field(1, s.encode()) for s in strings)
    at = {1: (0, 0), 2: (4, 0), 3: (4, 4), 4: (0, 4), 5: (1, 1), 6: (2, 1), 7: (2, 2)}
    ids = sorted(at)
    dense = field(1, zigzag(ids)) + field(8, zigzag([at[i][1] * 10**7 for i in ids])) + field(9, zigzag([at[i][0] * 10**7 for i in ids]))
    dense += field(10, varint(9) + varint(10) + varint(0) + b"\0" * 6)

    def way(i, refs, *tags):
        return field(3, field(1, i) + field(2, bytes(t for t, _ in tags)) + field(3, bytes(v for _, v in tags)) + field(8, zigzag(refs)))

    ways = way(10, [1, 2, 3], (1, 2)) + way(11, [1, 2, 3, 4, 1], (3, 4)) + way(12, [3, 4, 1]) + way(13, [5, 6, 7, 5]) + way(14, [1, 99], (1, 2))
    relation = field(4, field(1, 20) + field(2, bytes([5])) + field(3, bytes([6])) + field(8, bytes([7, 7, 8])) + field(9, zigzag([10, 12, 13])) + field(10, bytes([1, 1, 1])))
    block = field(1, table) + field(2, field(2, dense)) + field(2, ways) + field(2, relation)
    blob = field(2, len(block)) + field(3, zlib.compress(block))
    head = field(1, b"OSMData") + field(3, len(blob))
    first = field(1, b"OSMHeader") + field(3, 4)
    path = tmp_path / "x.osm.pbf"
    path.write_bytes(struct.pack(">I", len(first)) + first + field(1, b"\0\0") + struct.pack(">I", len(head)) + head + blob)
    return str(path)


def test_osm_pbf(spark, tmp_path):
    path = pbf(tmp_path)
    rows = {(r.osm_type, r.osm_id): r for r in osmpbf.read_pbf(spark, path, path).collect()}
    assert {k for k in rows if k[0] == "node"} == {("node", i) for i in range(1, 8)}
    assert {k for k in rows if k[0] == "way"} == {("way", i) for i in (10, 11, 12, 13)}  # 14 has one located node
    assert {k for k in rows if k[0] == "area"} == {("area", 11), ("area", 20)}
    assert rows["node", 1].name == "x" and json.loads(rows["way", 10].tags_json) == {"highway": "primary"}
    kind, rings = wkb.decode(bytes(rows["area", 20].geometry))
    assert kind == 6 and len(rings) == 2 and wkb._signed_area(rings[0]) == pytest.approx(16) and wkb._signed_area(rings[1]) == pytest.approx(-0.5)
    assert osmpbf.read_pbf(spark, path, box=(3.5, 3.5, 9, 9)).where("osm_type = 'node'").count() == 1
    assert {(r.osm_type, r.features) for r in osmpbf.counts_by_kind(osmpbf.read_pbf(spark, path)).collect()} == {(t, sum(k[0] == t for k in rows)) for t in {k[0] for k in rows}}
    done = osmpbf.convert(spark, [path, str(tmp_path / "none.pbf")], f"file://{tmp_path}/out").collect()
    assert sorted((r.status[:6], r.features_extracted) for r in done) == [("FAILED", 0), ("SUCCES", 13)]


def test_discovery_and_verification(spark, tmp_path):
    from freshet import diagnostics

    path = pbf(tmp_path)
    (tmp_path / "y.pbf").write_bytes(b"x")
    found = diagnostics.discover(spark, str(tmp_path), "*.osm.pbf", "*.pbf")
    assert [p.rsplit("/", 1)[-1] for p in found] == ["x.osm.pbf", "y.pbf"]
    with pytest.raises(FileNotFoundError):
        diagnostics.discover(spark, str(tmp_path), "*.tif")
    rows = diagnostics.verify(osmpbf.read_pbf(spark, path)).collect()
    assert {(r.geometry_type, r.features, r.empty) for r in rows} == {(1, 7, 0), (2, 4, 0), (3, 1, 0), (6, 1, 0)}


def test_files(spark, tmp_path):
    at = f"file://{tmp_path}"
    spark.range(3).write.option("header", True).csv(f"{at}/a")
    assert files.publish(spark, {"Roads": f"{at}/a"}, f"{at}/all") == [f"{at}/all/roads_a"]
    files.rename(spark, f"{at}/all/roads_a", f"{at}/b")
    files.copy(spark, f"{at}/a", f"{at}/b")
    assert files.read_csv(spark, f"{at}/b").agg({"id": "sum"}).first()[0] == 3
    assert files.remove(spark, f"{at}/b") and not files.remove(spark, f"{at}/b")
    for action in (lambda: files.read_csv(spark, f"{at}/b"), lambda: files.copy(spark, f"{at}/b", f"{at}/c"), lambda: geotiff.read_headers(spark, f"{at}/a")):
        with pytest.raises(FileNotFoundError):
            action()
    (tmp_path / "file").write_text("x")
    with pytest.raises(NotADirectoryError):
        files.require(spark, f"{at}/file", folder=True)


def test_gpkg_goes_on_without_a_broken_layer(spark, tmp_path):
    path = str(tmp_path / "two.gpkg")
    one = spark.createDataFrame([(1, wkb.encode(1, [[(1.0, 2.0)]]))], "id long, geometry binary")
    vector.write_gpkg({"good": one, "gone": one}, path)
    with sqlite3.connect(path) as db:
        db.execute("DROP TABLE gone")
    with pytest.warns(UserWarning, match="gone"):
        got = vector.read_gpkg(spark, path)
    assert [r.layer_name for r in got.collect()] == ["good"]
