"""OSM PBF extracts: blobs are found on the driver, decoded in parallel, and ways and areas joined to their nodes.

A blob is the unit of work; no task needs more than one. Node locations reach ways by a join on node id, so an extract
of any size spills instead of filling a memory map.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions import geometry as g
from freshet.functions import wkb
from freshet.session import ensure_importable

ELEMENTS = "kind string, id long, lon double, lat double, refs array<struct<pos:int,ref:long,role:string>>, tags map<string,string>"


def _varint(data: bytes, at: int) -> tuple[int, int]:
    shift = value = 0
    while True:
        b = data[at]
        at += 1
        value |= (b & 127) << shift
        if b < 128:
            return value, at
        shift += 7


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        wire = key & 7
        if wire == 0:
            value, at = _varint(data, at)
        elif wire == 2:
            n, at = _varint(data, at)
            value = data[at : at + n]
            at += n
        else:
            n = 8 if wire == 1 else 4
            value = data[at : at + n]
            at += n
        yield key >> 3, value


def _packed(data: bytes) -> list[int]:
    out, at = [], 0
    while at < len(data):
        v, at = _varint(data, at)
        out.append(v)
    return out


def _zigzag(v: int) -> int:
    return (v >> 1) ^ -(v & 1)


def _deltas(values: list[int]) -> list[int]:
    total, out = 0, []
    for v in values:
        total += _zigzag(v)
        out.append(total)
    return out


def split_blobs(data: bytes) -> Iterator[tuple[str, bytes]]:
    """(type, compressed message) of each blob."""
    at = 0
    while at < len(data):
        n = struct.unpack_from(">I", data, at)[0]
        head = dict(_fields(data[at + 4 : at + 4 + n]))
        at += 4 + n
        yield head[1].decode(), data[at : at + head[3]]
        at += head[3]


def inflate(blob: bytes) -> bytes:
    f = dict(_fields(blob))
    if 1 in f:
        return f[1]
    if 3 in f:
        return zlib.decompress(f[3])
    raise ValueError("only plain and zlib blobs are supported")


def elements(block: bytes) -> Iterator[tuple]:
    """(kind, id, lon, lat, refs, tags) of a primitive block."""
    strings: list[str] = []
    groups, granularity, lat0, lon0 = [], 100, 0, 0
    for k, v in _fields(block):
        if k == 1:
            strings = [s.decode("utf-8", "replace") for _, s in _fields(v)]
        elif k == 2:
            groups.append(v)
        elif k == 17:
            granularity = v
        elif k == 19:
            lat0 = v - (1 << 64) if v >> 63 else v
        elif k == 20:
            lon0 = v - (1 << 64) if v >> 63 else v

    def degrees(v: int, base: int) -> float:
        return (base + granularity * v) * 1e-9

    def tags(keys: bytes, values: bytes) -> dict[str, str]:
        return {strings[a]: strings[b] for a, b in zip(_packed(keys), _packed(values))}

    for group in groups:
        for k, v in _fields(group):
            if k == 1:
                f = dict(_fields(v))
                yield "node", _zigzag(f[1]), degrees(_zigzag(f[9]), lon0), degrees(_zigzag(f[8]), lat0), None, tags(f.get(2, b""), f.get(3, b""))
            elif k == 2:
                f = dict(_fields(v))
                ids, lats, lons = (_deltas(_packed(f.get(i, b""))) for i in (1, 8, 9))
                pairs = iter(_packed(f.get(10, b"")))
                for i, lat, lon in zip(ids, lats, lons):
                    own = {}
                    for a in pairs:
                        if a == 0:
                            break
                        own[strings[a]] = strings[next(pairs)]
                    yield "node", i, degrees(lon, lon0), degrees(lat, lat0), None, own
            elif k == 3:
                f = dict(_fields(v))
                yield "way", f[1], None, None, [(j, r, "") for j, r in enumerate(_deltas(_packed(f.get(8, b""))))], tags(f.get(2, b""), f.get(3, b""))
            elif k == 4:
                f = dict(_fields(v))
                kinds = _packed(f.get(10, b""))
                members = zip(_deltas(_packed(f.get(9, b""))), _packed(f.get(8, b"")), kinds)
                yield "relation", f[1], None, None, [(j, r, strings[s]) for j, (r, s, t) in enumerate(members) if t == 1], tags(f.get(2, b""), f.get(3, b""))


def read_elements(spark: SparkSession, *paths: str) -> DataFrame:
    """Nodes, ways and relations. A path that several patterns name is read once."""
    ensure_importable(spark)
    files = spark.read.format("binaryFile").load(sorted(set(paths))).select("path", "content").dropDuplicates(["path"])

    def cut(batches):
        for pdf in batches:
            for data in pdf["content"]:
                blobs = [b for kind, b in split_blobs(bytes(data)) if kind == "OSMData"]
                for at in range(0, len(blobs), 32):
                    yield pd.DataFrame({"blob": blobs[at : at + 32]})

    def decode(batches):
        for pdf in batches:
            for blob in pdf["blob"]:
                rows = list(elements(inflate(bytes(blob))))
                yield pd.DataFrame(
                    [(k, i, x, y, r and [{"pos": a, "ref": b, "role": c} for a, b, c in r], t) for k, i, x, y, r, t in rows],
                    columns=["kind", "id", "lon", "lat", "refs", "tags"],
                )

    blobs = files.mapInPandas(cut, "blob binary")
    return blobs.repartition(spark.sparkContext.defaultParallelism).mapInPandas(decode, ELEMENTS)


def read_pbf(spark: SparkSession, *paths: str, box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """``geometry`` (WKB), ``osm_id, osm_type, tags, tags_json, name, feature_class``.

    Nodes are points, ways of two located nodes or more are lines; every closed way with tags, none of them ``area=no``, is an
    area besides, as are multipolygon relations. ``box`` keeps nodes in it and ways and areas with a vertex in it.
    """
    parts = read_elements(spark, *paths)
    nodes = parts.where("kind = 'node' and lon is not null")
    place = nodes.select(F.col("id").alias("ref"), g.point("lon", "lat").alias("p"))
    ways = parts.where("kind = 'way'").select("id", "tags", F.explode("refs").alias("r"))
    located = ways.select("id", "tags", F.col("r.pos").alias("pos"), F.col("r.ref").alias("ref")).join(place, "ref")
    lines = located.groupBy("id").agg(F.any_value("tags").alias("tags"), F.array_sort(F.collect_list(F.struct("pos", "p"))).alias("c"))
    lines = lines.select("id", "tags", F.transform("c", lambda c: c["p"]).alias("points")).where(F.size("points") >= 2)

    def is_area() -> Column:
        closed = (F.size("points") >= 4) & (F.element_at("points", 1) == F.element_at("points", -1))
        return closed & (F.size(F.map_keys("tags")) > 0) & (F.coalesce(F.col("tags")["area"], F.lit("")) != "no")

    members = parts.where("kind = 'relation' and tags['type'] = 'multipolygon'").select("id", "tags", F.explode("refs").alias("m"))
    rings = members.select("id", "tags", F.col("m.pos").alias("pos"), F.col("m.role").alias("role"), F.col("m.ref").alias("way"))
    rings = rings.join(lines.select(F.col("id").alias("way"), "points"), "way")
    relations = rings.groupBy("id").agg(F.any_value("tags").alias("tags"), F.array_sort(F.collect_list(F.struct("pos", "role", "points"))).alias("m"))

    @F.arrow_udf(f"kind int, rings {wkb.RINGS}")
    def assemble(m: pa.Array) -> pa.Array:
        """Member ways joined end to end into closed rings, outer ones before the inner ones they hold."""
        shapes = []
        for parts_ in m.to_pylist():
            done = {"outer": [], "inner": []}
            for role in done:
                left = [[(p["x"], p["y"]) for p in w["points"]] for w in parts_ if (w["role"] or "outer") == role]
                while left:
                    ring = left.pop(0)
                    while ring[0] != ring[-1]:
                        k = next((i for i, w in enumerate(left) if ring[-1] in (w[0], w[-1])), None)
                        if k is None:
                            break
                        w = left.pop(k)
                        ring += (w if w[0] == ring[-1] else w[::-1])[1:]
                    if ring[0] == ring[-1] and len(ring) >= 4:
                        done[role].append(ring)
            out = []
            for shell in done["outer"]:
                mine = [h for h in done["inner"] if _within(h[0], shell)]
                out += wkb.orient([shell, *mine])
            shapes.append(wkb.shape_row(6, out or None))
        return pa.array(shapes, wkb.ARROW_SHAPE)

    shape = lambda points: F.array(points)
    every = (
        nodes.select("id", F.lit("node").alias("osm_type"), "tags", F.lit(1).alias("kind"), F.array(F.array(g.point("lon", "lat"))).alias("rings"))
        .unionByName(lines.select("id", F.lit("way").alias("osm_type"), "tags", F.lit(2).alias("kind"), shape(F.col("points")).alias("rings")))
        .unionByName(lines.where(is_area()).select("id", F.lit("area").alias("osm_type"), "tags", F.lit(3).alias("kind"), shape(F.col("points")).alias("rings")))
        .unionByName(relations.withColumn("a", assemble("m")).where("a.rings is not null").select("id", F.lit("area").alias("osm_type"), "tags", "a.kind", "a.rings"))
    )
    every = every.where(g.any_in_box(F.flatten("rings"), box))
    return every.select(
        wkb.encoded(F.col("kind"), F.col("rings")).alias("geometry"), F.col("id").alias("osm_id"), "osm_type", "tags", F.to_json("tags").alias("tags_json"),
        F.coalesce(F.col("tags")["name"], F.lit("")).alias("name"), F.col("osm_type").alias("feature_class"),
    )


def _within(p: tuple[float, float], ring: list[tuple[float, float]]) -> bool:
    odd = False
    for (x1, y1), (x2, y2) in zip(ring[:-1], ring[1:]):
        if (y1 > p[1]) != (y2 > p[1]) and p[0] < (x2 - x1) * (p[1] - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


def counts_by_kind(elements: DataFrame) -> DataFrame:
    """``osm_type, features`` of what :func:`read_pbf` or a conversion gives: nodes, ways and areas."""
    return elements.groupBy("osm_type").agg(F.count(F.lit(1)).alias("features"))


def convert(spark: SparkSession, paths: list[str], folder: str) -> DataFrame:
    """Each extract as Parquet under ``folder``; ``input_file, output_file, features_extracted, status`` for each, a
    failed one on its own."""
    rows = []
    for path in sorted(set(paths)):
        name = path.rstrip("/").rsplit("/", 1)[-1]
        target = f"{folder}/{name.removesuffix('.pbf').removesuffix('.osm')}.parquet"
        try:
            read_pbf(spark, path).drop("tags").write.mode("overwrite").parquet(target)
            rows.append((path, target, spark.read.parquet(target).count(), "SUCCESS"))
        except Exception as error:  # noqa: BLE001  the summary tells it
            rows.append((path, target, 0, f"FAILED: {str(error).splitlines()[0]}"))
    return spark.createDataFrame(rows, "input_file string, output_file string, features_extracted long, status string")
