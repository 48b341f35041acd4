"""Well-known binary: decoding to rings, encoding from them."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.session import ensure_importable

POINT, LINE, POLYGON, MULTIPOINT, MULTILINE, MULTIPOLYGON, COLLECTION = range(1, 8)
RINGS = "array<array<struct<x:double,y:double>>>"
Ring = list[tuple[float, float]]
ARROW_RINGS = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))
ARROW_SHAPE = pa.struct([("kind", pa.int32()), ("rings", ARROW_RINGS)])


def shape_row(kind: int | None, parts: list[Ring] | None) -> dict:
    return {"kind": kind, "rings": parts and [[{"x": x, "y": y} for x, y in r] for r in parts]}


def _signed_area(ring: Ring) -> float:
    a = np.asarray(ring)
    return float(np.dot(a[:-1, 0], a[1:, 1]) - np.dot(a[1:, 0], a[:-1, 1])) / 2 if len(a) > 2 else 0.0


def orient(rings: list[Ring]) -> list[Ring]:
    """A polygon's rings with the shell counter-clockwise and holes clockwise."""
    return [r[::-1] if r and (_signed_area(r) < 0) == (i == 0) and _signed_area(r) != 0 else r for i, r in enumerate(rings)]


def decode(data: bytes) -> tuple[int, list[Ring]]:
    """Type code (without Z/M flags) and parts: a point's or line's coordinates, or all rings of all polygons."""
    at = 0

    def take(fmt: str):
        nonlocal at
        out = struct.unpack_from(fmt, data, at)
        at += struct.calcsize(fmt)
        return out

    def geometry() -> tuple[int, list[Ring]]:
        order = "<" if take("B")[0] == 1 else ">"
        code = take(order + "I")[0]
        if code & 0x20000000:  # an SRID follows
            take(order + "I")
        flags = code >> 30
        code &= 0x0FFFFFFF
        size = 2 + max((0, 1, 1, 2)[code // 1000 % 4], (flags & 1) + (flags >> 1 & 1))
        kind = code % 1000

        def points(n: int) -> Ring:
            values = take(f"{order}{n * size}d")
            return [(values[i], values[i + 1]) for i in range(0, n * size, size)]

        if kind == POINT:
            return kind, [points(1)]
        n = take(order + "I")[0]
        if kind == LINE:
            return kind, [points(n)]
        if kind == POLYGON:
            return kind, orient([points(take(order + "I")[0]) for _ in range(n)])
        return kind, [part for _ in range(n) for part in geometry()[1]]

    return geometry()


def encode(kind: int, parts: list[Ring]) -> bytes:
    """Little-endian WKB. A multipolygon's shells are its counter-clockwise rings, each with the holes behind it."""

    def head(k: int) -> bytes:
        return struct.pack("<BI", 1, k)

    def points(p: Ring) -> bytes:
        return struct.pack("<I", len(p)) + b"".join(struct.pack("<dd", *c) for c in p)

    if kind == POINT:
        return head(kind) + struct.pack("<dd", *parts[0][0])
    if kind == LINE:
        return head(kind) + points(parts[0])
    if kind == POLYGON:
        return head(kind) + struct.pack("<I", len(parts)) + b"".join(map(points, parts))
    if kind == MULTIPOINT:
        return head(kind) + struct.pack("<I", len(parts)) + b"".join(encode(POINT, [p]) for p in parts)
    if kind == MULTILINE:
        return head(kind) + struct.pack("<I", len(parts)) + b"".join(encode(LINE, [p]) for p in parts)
    if kind == MULTIPOLYGON:
        polygons: list[list[Ring]] = []
        for ring in parts:
            if not polygons or _signed_area(ring) >= 0:
                polygons.append([])
            polygons[-1].append(ring)
        return head(kind) + struct.pack("<I", len(polygons)) + b"".join(encode(POLYGON, p) for p in polygons)
    raise ValueError(f"no WKB for type {kind}")


def as_binary(df: DataFrame, column: str = "geometry") -> Column:
    """Geometry bytes of a WKB column, or of a hex text one."""
    return F.unhex(column) if dict(df.dtypes)[column] == "string" else F.col(column)


def decoded(df: DataFrame, column: str = "geometry", kind: str = "geometry_type", rings: str = "rings") -> DataFrame:
    """Adds the type code and ``rings`` of a WKB column, binary or hex; null or empty geometry gives nulls."""
    ensure_importable(df.sparkSession)

    @F.arrow_udf(f"kind int, rings {RINGS}")
    def parse(raw: pa.Array) -> pa.Array:
        return pa.array([shape_row(*(decode(b) if b else (None, None))) for b in raw.to_pylist()], ARROW_SHAPE)

    out = df.withColumn("_g", parse(as_binary(df, column)))
    return out.withColumns({kind: F.col("_g.kind"), rings: F.col("_g.rings")}).drop("_g")


def encoded(kind: Column, rings: Column, hexadecimal: bool = False) -> Column:
    """WKB of ``rings``; upper-case hex text if asked. Null stays null."""

    @F.arrow_udf("binary")
    def write(kinds: pa.Array, shapes: pa.Array) -> pa.Array:
        both = zip(kinds.to_pylist(), shapes.to_pylist())
        return pa.array([None if s is None else encode(k, [[(p["x"], p["y"]) for p in r] for r in s]) for k, s in both], pa.binary())

    out = write(kind, rings)
    return F.hex(out) if hexadecimal else out
