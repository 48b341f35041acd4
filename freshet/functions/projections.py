"""Map projections as Column expressions on degrees (WGS84)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

A = 6378137.0
FLATTENING = 1 / 298.257223563
E2 = FLATTENING * (2 - FLATTENING)
E = math.sqrt(E2)


def _q(s: Column) -> Column:
    return (1 - E2) * (s / (1 - E2 * s * s) - F.log((1 - E * s) / (1 + E * s)) / (2 * E))


_QP = (1 - E2) * (1 / (1 - E2) - math.log((1 - E) / (1 + E)) / (2 * E))


def cea_forward(lon: Column, lat: Column) -> Column:
    """Cylindrical equal area, true at the equator."""
    return F.struct((F.radians(lon) * A).alias("x"), (_q(F.sin(F.radians(lat))) * (A / 2)).alias("y"))


def cea_inverse(x: Column, y: Column) -> Column:
    """By the series from authalic latitude."""
    beta = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), 2 * y / (A * _QP))))
    e4, e6 = E2 * E2, E2**3
    lat = (
        beta + (E2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) * F.sin(2 * beta)
        + (23 * e4 / 360 + 251 * e6 / 3780) * F.sin(4 * beta) + 761 * e6 / 45360 * F.sin(6 * beta)
    )
    return F.struct(F.degrees(x / A).alias("lon"), F.degrees(lat).alias("lat"))


def mollweide_forward(lon: Column, lat: Column) -> Column:
    """World Mollweide on the sphere of the major axis: twelve Newton steps for its angle, the poles apart."""
    phi = F.radians(lat)
    target = F.sin(phi) * math.pi
    theta = F.aggregate(
        F.sequence(F.lit(1), F.lit(12)), phi * 0.95,
        lambda t, _: t - (2 * t + F.sin(2 * t) - target) / (2 + 2 * F.cos(2 * t)),
    )
    theta = F.when(F.abs(lat) >= 90, F.signum(lat) * (math.pi / 2)).otherwise(theta)
    root = math.sqrt(2)
    return F.struct((F.radians(lon) * F.cos(theta) * (2 * root / math.pi * A)).alias("x"), (F.sin(theta) * (root * A)).alias("y"))


def utm_zone(lon: Column) -> Column:
    return (F.pmod(F.floor((lon + 180) / 6), F.lit(60)) + 1).cast("int")


def utm_epsg(lon: Column, lat: Column) -> Column:
    return utm_zone(lon) + F.when(lat < 0, 32700).otherwise(32600)


def utm_forward(lon: Column, lat: Column, zone: Column | None = None, south: Column | None = None) -> Column:
    """Universal transverse Mercator by Krueger's series to third order (millimetres inside a zone). Zone and hemisphere
    are the point's own unless given."""
    zone = utm_zone(lon) if zone is None else zone
    south = lat < 0 if south is None else south
    n = FLATTENING / (2 - FLATTENING)
    radius = A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    phi, lam = F.radians(lat), F.radians(lon - (zone * 6 - 183))
    c = 2 * math.sqrt(n) / (1 + n)
    t = F.sinh(F.atanh(F.sin(phi)) - c * F.atanh(c * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(alpha, 1):
        x = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    k = 0.9996 * radius
    return F.struct((x * k + 500000.0).alias("x"), (y * k + F.when(south, 10000000.0).otherwise(0.0)).alias("y"))


FORWARD = {"cea": cea_forward, "mollweide": mollweide_forward}


def estimate_utm(minx: float, miny: float, maxx: float, maxy: float) -> str:
    """``utm:16`` or, south of the equator, ``utm:-16``: the zone of the middle of the bounds, for :func:`reproject`."""
    zone = int((minx + maxx + 360) / 12) % 60 + 1
    return f"utm:{-zone if miny + maxy < 0 else zone}"


def epsg(crs: str) -> int | None:
    """The EPSG code of a projection named here or as ``EPSG:<code>``; None for ``cea`` and ``mollweide``, which have
    none. Anything else is a ``ValueError``."""
    if crs.upper().startswith("EPSG:"):
        return int(crs[5:])
    if crs == "geographic":
        return 4326
    if crs.startswith("utm:"):
        zone = int(crs[4:])
        return (32600 if zone > 0 else 32700) + abs(zone)
    if crs in FORWARD:
        return None
    raise ValueError(f"unknown projection: {crs}")


#: Geographic coordinate systems that read files may name: WGS84, ETRS89, NAD83, NAD27, and WGS72.
GEOGRAPHIC = (4326, 4258, 4269, 4267, 4322)


def is_geographic(crs: str) -> bool:
    """Whether coordinates are degrees."""
    return epsg(crs) in GEOGRAPHIC


def reproject(rings: Column, crs: str) -> Column:
    """Every point of ``rings`` (degrees) in the named projection: ``cea``, ``mollweide``, or ``utm:`` with one zone for
    all points, negative in the south. ``geographic`` leaves them as they are."""
    if crs == "geographic":
        return rings
    if crs.startswith("utm:"):
        zone = int(crs[4:])
        return F.transform(rings, lambda r: F.transform(r, lambda p: utm_forward(p["x"], p["y"], F.lit(abs(zone)), F.lit(zone < 0))))
    return F.transform(rings, lambda r: F.transform(r, lambda p: FORWARD[crs](p["x"], p["y"])))
