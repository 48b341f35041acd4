"""Vector files: WKB Parquet, GeoJSON, GeoPackage and shapefiles.

Formats that are one file each (GeoPackage, shapefile) are read where they lie by one task for each file; Parquet and
line-wise GeoJSON are split as Spark splits them.
"""

from __future__ import annotations

import io
import json
import math
import os
import sqlite3
import struct
import tempfile
import warnings
from collections.abc import Iterator, Sequence
from itertools import islice
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions import geometry as g
from freshet.functions import wkb
from freshet.session import ensure_importable

TYPES = {"Point": 1, "LineString": 2, "Polygon": 3, "MultiPoint": 4, "MultiLineString": 5, "MultiPolygon": 6}
NAMES = {v: k for k, v in TYPES.items()}


def read_vector(spark: SparkSession, path: str, keys: Sequence[int] | None = None, key: str = "linkno") -> DataFrame:
    """A table with ``geometry`` (WKB) by the suffix of ``path``; ``keys`` are pushed to a Parquet scan."""
    suffix = os.path.splitext(path.rstrip("/"))[1].lower()
    if suffix == ".parquet":
        out = spark.read.parquet(path)
    elif suffix in (".geojson", ".json"):
        out = read_geojson(spark, path)
    elif suffix == ".gpkg":
        out = read_gpkg(spark, path)
    elif suffix == ".shp":
        out = read_shapefile(spark, path)
    else:
        raise ValueError(f"unsupported vector format: {suffix or path}")
    return out if keys is None else out.where(F.col(key).isin(*keys))


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """Properties and WKB geometry of the features of feature collections, or of files with one feature a line."""
    ensure_importable(spark)
    raw = spark.read.option("multiLine", not _is_feature(spark.read.text(path).where("trim(value) <> ''").first())).json(path)
    flat = raw.select(F.explode("features").alias("f")) if "features" in raw.columns else raw.select(F.struct("*").alias("f"))
    text = flat.select(F.to_json("f.geometry").alias("_g"), "f.properties.*")

    @F.pandas_udf("binary")
    def to_wkb(shape: pd.Series) -> pd.Series:
        return shape.map(lambda s: None if not s else from_geojson(json.loads(s)))

    return text.withColumn("geometry", to_wkb("_g")).drop("_g")


def _is_feature(line) -> bool:
    """Whether a line of text is a whole feature."""
    try:
        shape = json.loads(line[0]) if line else None
    except ValueError:
        return False
    return isinstance(shape, dict) and shape.get("type") == "Feature"


def _parts(kind: str, c) -> list:
    if kind == "Point":
        return [[tuple(c[:2])]]
    if kind == "LineString":
        return [[tuple(p[:2]) for p in c]]
    if kind == "MultiPoint":
        return [[tuple(p[:2])] for p in c]
    if kind == "Polygon":
        return wkb.orient([[tuple(p[:2]) for p in r] for r in c])
    if kind == "MultiLineString":
        return [[tuple(p[:2]) for p in r] for r in c]
    return [r for q in c for r in wkb.orient([[tuple(p[:2]) for p in ring] for ring in q])]


def _coordinates(text):
    # a column of mixed nesting comes out of JSON inference as text
    return [_coordinates(x) for x in text] if isinstance(text, list) else json.loads(text) if isinstance(text, str) else text


def from_geojson(shape: dict) -> bytes | None:
    if shape.get("type") not in TYPES or shape.get("coordinates") is None:
        return None
    return wkb.encode(TYPES[shape["type"]], _parts(shape["type"], _coordinates(shape["coordinates"])))


def to_geojson(kind: int, parts: list) -> dict:
    rings = [[list(p) for p in r] for r in parts]
    if kind == 1:
        c = rings[0][0]
    elif kind == 2:
        c = rings[0]
    elif kind == 4:
        c = [r[0] for r in rings]
    elif kind == 6:
        c = []
        for r, raw in zip(rings, parts):
            if not c or wkb._signed_area(raw) >= 0:
                c.append([])
            c[-1].append(r)
    else:
        c = rings
    return {"type": NAMES[kind], "coordinates": c}


def write_geojson(df: DataFrame, path: str, note: str | None = None) -> None:
    """One feature a line; a reader takes the lines as they are or wraps them in a collection. ``df`` has WKB
    ``geometry``; every other column is a property."""
    ensure_importable(df.sparkSession)

    @F.pandas_udf("string")
    def shape(raw: pd.Series) -> pd.Series:
        return raw.map(lambda b: "null" if b is None else json.dumps(to_geojson(*wkb.decode(bytes(b)))))

    names = [c for c in df.columns if c != "geometry"]
    extra = [F.lit(note).alias("note")] if note else []
    properties = F.to_json(F.struct(*names, *extra))
    line = F.concat(F.lit('{"type":"Feature","properties":'), properties, F.lit(',"geometry":'), shape("geometry"), F.lit("}"))
    df.select(line.alias("value")).write.mode("overwrite").text(path)


# --- GeoPackage ------------------------------------------------------------------------------------------------------


def _gpkg_wkb(blob: bytes | None) -> bytes | None:
    """WKB behind a GeoPackage header."""
    if blob is None or blob[:2] != b"GP":
        return blob
    envelope = (0, 32, 48, 48, 64)[blob[3] >> 1 & 7]
    return bytes(blob[8 + envelope :])


def gpkg_layers(path: str) -> list[tuple[str, str, int]]:
    """``(layer, geometry column, srid)`` of a GeoPackage."""
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        return db.execute("SELECT table_name, column_name, srs_id FROM gpkg_geometry_columns ORDER BY table_name").fetchall()


def read_gpkg(spark: SparkSession, path: str, geometry_type: str | None = None, layers: Sequence[str] | None = None) -> DataFrame:
    """All layers of a GeoPackage one under another, columns by name, with ``layer_name, geometry_type, crs`` and WKB
    ``geometry``. Values of other columns are text, as layers disagree about their types. Empty layers give nothing.
    ``geometry_type`` keeps one type alone. A layer that can't be opened is left out with a warning."""
    ensure_importable(spark)
    out: DataFrame | None = None
    for layer, column, srid in gpkg_layers(path):
        if layers is not None and layer not in layers:
            continue
        try:
            with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
                names = [r[0] for r in db.execute(f'SELECT * FROM "{layer}" LIMIT 0').description if r[0] != column]
                db.execute(f'SELECT "{column}" FROM "{layer}" LIMIT 1').fetchall()
        except sqlite3.Error as error:
            warnings.warn(f"{path}, layer {layer}: {error}", stacklevel=2)
            continue

        def rows(batches: Iterator[pd.DataFrame], layer=layer, column=column, srid=srid, names=names) -> Iterator[pd.DataFrame]:
            for _ in batches:
                with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
                    picked = ", ".join(f'"{n}"' for n in (*names, column))
                    cursor = db.execute(f'SELECT {picked} FROM "{layer}"')
                    while part := cursor.fetchmany(10_000):
                        pdf = pd.DataFrame([[None if x is None else str(x) for x in r[:-1]] for r in part], columns=names, dtype=object)
                        yield pdf.assign(layer_name=layer, crs=f"EPSG:{srid}", geometry=[_gpkg_wkb(r[-1]) for r in part])

        schema = ", ".join(f"`{n}` string" for n in names) + (", " if names else "") + "layer_name string, crs string, geometry binary"
        one = spark.range(1).mapInPandas(rows, schema)
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    if out is None:
        raise ValueError(f"no layers in {path}")
    code = g.wkb_type(F.col("geometry"))
    named = F.element_at(F.create_map(*[F.lit(x) for pair in NAMES.items() for x in pair]), code)
    out = out.withColumn("geometry_type", named)
    return out if geometry_type is None else out.where(F.col("geometry_type") == geometry_type)


def write_gpkg(layers: dict[str, DataFrame], path: str, srid: int = 4326) -> None:
    """A GeoPackage of the given layers, each with WKB ``geometry``. The file is one on the driver's disk; rows come to
    it one partition at a time."""
    fd, own = tempfile.mkstemp(suffix=".gpkg", dir=os.path.dirname(os.path.abspath(path)))
    os.close(fd)
    db = sqlite3.connect(own)
    db.executescript(
        "PRAGMA application_id = 1196444487; PRAGMA user_version = 10300;"
        "CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT NOT NULL, srs_id INTEGER PRIMARY KEY, organization TEXT NOT NULL, organization_coordsys_id INTEGER NOT NULL, definition TEXT NOT NULL, description TEXT);"
        "CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT NOT NULL, identifier TEXT, description TEXT DEFAULT '', last_change TEXT, min_x DOUBLE, min_y DOUBLE, max_x DOUBLE, max_y DOUBLE, srs_id INTEGER);"
        "CREATE TABLE gpkg_geometry_columns (table_name TEXT NOT NULL, column_name TEXT NOT NULL, geometry_type_name TEXT NOT NULL, srs_id INTEGER NOT NULL, z TINYINT NOT NULL, m TINYINT NOT NULL, PRIMARY KEY (table_name, column_name));"
    )
    for name, code in (("Undefined cartesian SRS", -1), ("Undefined geographic SRS", 0)):
        db.execute("INSERT INTO gpkg_spatial_ref_sys VALUES (?, ?, 'NONE', ?, 'undefined', NULL)", (name, code, code))
    db.execute("INSERT INTO gpkg_spatial_ref_sys VALUES (?, ?, 'EPSG', ?, 'undefined', NULL)", (f"EPSG:{srid}", srid, srid))
    types = {"bigint": "INTEGER", "int": "INTEGER", "double": "REAL", "float": "REAL", "binary": "BLOB"}
    for layer, df in layers.items():
        names = [c for c in df.columns if c != "geometry"]
        kinds = dict(df.dtypes)
        db.execute(f'CREATE TABLE "{layer}" (fid INTEGER PRIMARY KEY, {"".join(f"{chr(34)}{n}{chr(34)} {types.get(kinds[n], "TEXT")}, " for n in names)}geometry BLOB)')
        db.execute("INSERT INTO gpkg_contents (table_name, data_type, identifier, srs_id) VALUES (?, 'features', ?, ?)", (layer, layer, srid))
        db.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geometry', 'GEOMETRY', ?, 0, 0)", (layer, srid))
        head = b"GP\x00\x01" + struct.pack("<i", srid)
        marks = ", ".join("?" * (len(names) + 2))
        box = [math.inf, math.inf, -math.inf, -math.inf]
        for i, row in enumerate(df.select(*names, "geometry").toLocalIterator()):
            db.execute(f'INSERT INTO "{layer}" VALUES ({marks})', (i + 1, *row[:-1], None if row[-1] is None else head + bytes(row[-1])))
            for px, py in (p for ring in (wkb.decode(bytes(row[-1]))[1] if row[-1] else ()) for p in ring):
                box = [min(box[0], px), min(box[1], py), max(box[2], px), max(box[3], py)]
        if box[0] <= box[2]:
            db.execute("UPDATE gpkg_contents SET min_x = ?, min_y = ?, max_x = ?, max_y = ? WHERE table_name = ?", (*box, layer))
    db.commit()
    db.close()
    os.replace(own, path)


def normalise_types(df: DataFrame) -> DataFrame:
    """Columns other than geometry as text, ``None`` written out as null."""
    from freshet.functions.text import none_to_null

    return df.select(*[F.col(c) if c == "geometry" else none_to_null(F.col(f"`{c}`")).alias(c) for c in df.columns])


# --- shapefile -------------------------------------------------------------------------------------------------------

_SHAPES = {1: 1, 3: 5, 5: 6, 8: 4, 11: 1, 13: 5, 15: 6, 18: 4}


def shp_records(shp: BinaryIO) -> Iterator[bytes | None]:
    """WKB of each record of an open ``.shp``, read one by one; null shapes give None. Z and M are left out."""
    shp.read(100)
    while len(head := shp.read(8)) == 8:
        data = shp.read(struct.unpack_from(">i", head, 4)[0] * 2)
        kind = _SHAPES.get(struct.unpack_from("<i", data)[0])
        if kind is None:
            yield None
        elif kind == 1:
            yield wkb.encode(1, [[struct.unpack_from("<dd", data, 4)]])
        elif kind == 4:
            n = struct.unpack_from("<i", data, 36)[0]
            yield wkb.encode(4, [[struct.unpack_from("<dd", data, 40 + 16 * i)] for i in range(n)])
        else:
            parts, n = struct.unpack_from("<ii", data, 36)
            starts = [*struct.unpack_from(f"<{parts}i", data, 44), n]
            base = 44 + 4 * parts
            rings = [[struct.unpack_from("<dd", data, base + 16 * i) for i in range(a, b)] for a, b in zip(starts[:-1], starts[1:])]
            # shapefile shells run clockwise
            yield wkb.encode(kind, [r[::-1] for r in rings] if kind == 6 else rings)


def dbf_fields(head: bytes) -> list[tuple[str, int]]:
    """Names and widths of the fields that a ``.dbf`` header tells."""
    out, at = [], 32
    while head[at] != 0x0D:
        out.append((head[at : at + 11].split(b"\0")[0].decode("latin-1"), head[at + 16]))
        at += 32
    return out


def dbf_records(dbf: BinaryIO, rows: int = 10_000) -> Iterator[pd.DataFrame]:
    """Records of an open ``.dbf`` as text, ``rows`` at a time."""
    first = dbf.read(32)
    n, head, width = struct.unpack_from("<IHH", first, 4)
    fields = dbf_fields(first + dbf.read(head - 32))
    for lo in range(0, n, rows):
        data, out = dbf.read(min(rows, n - lo) * width), []
        for i in range(min(rows, n - lo)):
            place, row = i * width + 1, []
            for _, size in fields:
                text = data[place : place + size].decode("utf-8", "replace").strip().strip("\0")
                row.append(text or None)
                place += size
            out.append(row)
        yield pd.DataFrame(out, columns=[f[0] for f in fields], dtype=object)


def _features(shp: BinaryIO, dbf: BinaryIO) -> Iterator[pd.DataFrame]:
    shapes = shp_records(shp)
    for part in dbf_records(dbf):
        yield part.assign(geometry=list(islice(shapes, len(part))))
    if next(shapes, b"") != b"":
        raise ValueError("a .shp has more records than its .dbf")


def read_shapefile(spark: SparkSession, path: str) -> DataFrame:
    """Attributes (text) and WKB geometry of a shapefile, or of all that a pattern names, with the first one's columns.
    One task a file: on a file system, which all machines then have to mount, it reads record by record, and from other
    stores Spark gives it the whole ``.shp`` and ``.dbf``. The driver reads the header of the first ``.dbf`` alone."""
    ensure_importable(spark)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [x.getPath() for x in store.globStatus(target) or ()]
    if not found:
        raise FileNotFoundError(path)
    stems = [os.path.splitext(x.toString())[0] for x in found]
    stream = store.open(spark._jvm.org.apache.hadoop.fs.Path(stems[0] + ".dbf"))
    try:
        take = spark._jvm.org.apache.commons.io.IOUtils.toByteArray
        first = bytes(take(stream, 32))
        names = [n for n, _ in dbf_fields(first + bytes(take(stream, struct.unpack_from("<H", first, 8)[0] - 32)))]
    finally:
        stream.close()
    schema = ", ".join(f"`{n}` string" for n in names) + ", geometry binary"

    if store.getUri().getScheme() == "file":

        def opened(batches):
            for pdf in batches:
                for at in pdf["at"]:
                    with open(at + ".shp", "rb") as shp, open(at + ".dbf", "rb") as dbf:
                        yield from _features(shp, dbf)

        at = [(os.path.splitext(x.toUri().getPath())[0],) for x in found]
        return spark.createDataFrame(at, "at string").repartition(len(at)).mapInPandas(opened, schema)

    stem = F.regexp_replace("path", r"\.[^.]*$", "").alias("stem")
    table = spark.read.format("binaryFile").load([x + ".dbf" for x in stems]).select(stem, F.col("content").alias("dbf"))
    both = spark.read.format("binaryFile").load([x.toString() for x in found]).select(stem, F.col("content").alias("shp")).join(table, "stem")

    def rows(batches):
        for pdf in batches:
            for shp, dbf in zip(pdf["shp"], pdf["dbf"]):
                yield from _features(io.BytesIO(shp), io.BytesIO(dbf))

    return both.mapInPandas(rows, schema)


def write_point_shapefile(df: DataFrame, path: str, x: str = "x", y: str = "y") -> None:
    """Points with text attributes; names are cut to ten characters, as the format has it. One file on the driver's
    disk, for exports; rows come to it one partition at a time and go to it one by one. Values longer than the 254 bytes
    that the format allows are cut between characters."""
    names = [c for c in df.columns if c not in (x, y)]
    shorts, taken = [], set()
    for n in names:
        s, k = n[:10], 1
        while s in taken:
            s, k = f"{n[:8]}_{k}", k + 1
        taken.add(s)
        shorts.append(s)
    base, width = os.path.splitext(path)[0], 254
    count, box = 0, [math.inf, math.inf, -math.inf, -math.inf]

    def field(value) -> bytes:
        return ("" if value is None else str(value)).encode()[:width].decode("utf-8", "ignore").encode().ljust(width)

    def header(words: int) -> bytes:
        return struct.pack(">7i", 9994, 0, 0, 0, 0, 0, words) + struct.pack("<2i8d", 1000, 1, *(box if count else [0.0] * 4), 0, 0, 0, 0)

    with open(base + ".shp", "wb") as shp, open(base + ".shx", "wb") as index, open(base + ".dbf", "wb") as dbf:
        for f in (shp, index):
            f.write(b"\0" * 100)  # headers need the count and the box, which the last row completes
        dbf.write(b"\0" * 32)
        for s in shorts:
            dbf.write(struct.pack("<11sc4xBB14x", s.encode("latin-1", "replace"), b"C", width, 0))
        dbf.write(b"\x0d")
        for row in df.toLocalIterator():
            a, b = row[x], row[y]
            shp.write(struct.pack(">2i", count + 1, 10) + struct.pack("<i2d", 1, a, b))
            index.write(struct.pack(">2i", 50 + 14 * count, 10))
            dbf.write(b" " + b"".join(field(row[c]) for c in names))
            box = [min(box[0], a), min(box[1], b), max(box[2], a), max(box[3], b)]
            count += 1
        dbf.write(b"\x1a")
        for f, words in ((shp, 14), (index, 4)):
            f.seek(0)
            f.write(header(50 + words * count))
        dbf.seek(0)
        dbf.write(struct.pack("<4BIHH20x", 3, 126, 1, 1, count, 33 + 32 * len(names), 1 + width * len(names)))
