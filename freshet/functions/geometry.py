"""Planar geometry as Column expressions.

A geometry in a plan is ``rings: array<array<struct<x, y>>>``: the rings of a polygon (shells counter-clockwise, holes
clockwise; a multipolygon's rings one after another), or the parts of a line. ``edges`` flattens it to an array of
``struct<x1, y1, x2, y2>``, on which all measures and predicates work inside the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _zero() -> Column:
    return F.lit(0.0).cast("double")


def point(x, y) -> Column:
    return F.struct(F.col(x).alias("x") if isinstance(x, str) else x.alias("x"), F.col(y).alias("y") if isinstance(y, str) else y.alias("y"))


def rectangle(minx: str = "minx", miny: str = "miny", maxx: str = "maxx", maxy: str = "maxy") -> Column:
    """A closed counter-clockwise ring."""
    return F.array(F.array(point(minx, miny), point(maxx, miny), point(maxx, maxy), point(minx, maxy), point(minx, miny)))


def segment(x1: str = "x1", y1: str = "y1", x2: str = "x2", y2: str = "y2") -> Column:
    return F.array(F.array(point(x1, y1), point(x2, y2)))


def edges(rings: Column) -> Column:
    return F.flatten(F.transform(rings, lambda r: F.when(F.size(r) > 1, F.transform(
        F.sequence(F.lit(0), F.size(r) - 2),
        lambda i: F.struct(r[i]["x"].alias("x1"), r[i]["y"].alias("y1"), r[i + 1]["x"].alias("x2"), r[i + 1]["y"].alias("y2")),
    )).otherwise(F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>"))))


def _sum(array: Column, term) -> Column:
    return F.aggregate(array, _zero(), lambda acc, e: acc + term(e))


def area(e: Column) -> Column:
    """Shoelace area of edges; holes run clockwise and subtract."""
    return F.abs(_sum(e, lambda s: s["x1"] * s["y2"] - s["x2"] * s["y1"])) / 2


def length(e: Column) -> Column:
    return _sum(e, lambda s: F.hypot(s["x2"] - s["x1"], s["y2"] - s["y1"]))


def bbox(rings: Column) -> Column:
    points = F.flatten(rings)
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"), F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy"))


def centroid(e: Column, rings: Column) -> Column:
    """Area-weighted for rings (parts that end where they begin), length-weighted for lines, else the mean of points."""
    rung = F.forall(rings, lambda r: (F.size(r) > 3) & (F.element_at(r, 1) == F.element_at(r, -1)))
    cross = lambda s: s["x1"] * s["y2"] - s["x2"] * s["y1"]
    twice = _sum(e, cross)
    total = length(e)
    points = F.flatten(rings)
    n = F.size(points)
    span = lambda s: F.hypot(s["x2"] - s["x1"], s["y2"] - s["y1"])

    def along(a: str, b: str, axis: str) -> Column:
        weighted = _sum(e, lambda s: (s[a] + s[b]) * cross(s)) / (twice * 3)
        on_line = _sum(e, lambda s: (s[a] + s[b]) / 2 * span(s)) / total
        mean = F.aggregate(points, _zero(), lambda acc, p: acc + p[axis]) / n
        return F.when(rung & (twice != 0), weighted).when(total > 0, on_line).otherwise(mean)

    return F.struct(along("x1", "x2", "x").alias("x"), along("y1", "y2", "y").alias("y"))


def _cross(ax, ay, bx, by) -> Column:
    return ax * by - ay * bx


#: Distances under this share of the coordinates are rounding: some thousand times the error of a double.
NEAR = 1e-12


def _near(cross: Column, span: Column, *coordinates: Column) -> Column:
    """Whether a cross product is that of points on one line: their distance is rounding beside the coordinates."""
    return F.abs(cross) <= span * NEAR * F.greatest(*(F.abs(c) for c in coordinates))


def on_edges(x: Column, y: Column, e: Column) -> Column:
    """Point on an edge, up to rounding."""

    def on(s: Column) -> Column:
        dx, dy = s["x2"] - s["x1"], s["y2"] - s["y1"]
        slack = F.greatest(F.abs(x), F.abs(y)) * NEAR
        return (
            _near(_cross(dx, dy, x - s["x1"], y - s["y1"]), F.abs(dx) + F.abs(dy), x, y, s["x1"], s["y1"])
            & x.between(F.least(s["x1"], s["x2"]) - slack, F.greatest(s["x1"], s["x2"]) + slack)
            & y.between(F.least(s["y1"], s["y2"]) - slack, F.greatest(s["y1"], s["y2"]) + slack)
        )

    return F.exists(e, on)


def inside(x: Column, y: Column, e: Column) -> Column:
    """Even-odd point in polygon; the border may fall on either side."""
    hits = F.filter(e, lambda s: ((s["y1"] > y) != (s["y2"] > y)) & (x < (s["x2"] - s["x1"]) * (y - s["y1"]) / F.nullif(s["y2"] - s["y1"], F.lit(0.0)) + s["x1"]))
    return F.size(hits) % 2 == 1


def covers(x: Column, y: Column, e: Column) -> Column:
    """Point in the closed polygon."""
    return inside(x, y, e) | on_edges(x, y, e)


def _touch(a: Column, b: Column) -> Column:
    """Two closed segments have a point in common."""
    d1 = _cross(a["x2"] - a["x1"], a["y2"] - a["y1"], b["x1"] - a["x1"], b["y1"] - a["y1"])
    d2 = _cross(a["x2"] - a["x1"], a["y2"] - a["y1"], b["x2"] - a["x1"], b["y2"] - a["y1"])
    d3 = _cross(b["x2"] - b["x1"], b["y2"] - b["y1"], a["x1"] - b["x1"], a["y1"] - b["y1"])
    d4 = _cross(b["x2"] - b["x1"], b["y2"] - b["y1"], a["x2"] - b["x1"], a["y2"] - b["y1"])
    apart = (
        (F.greatest(a["x1"], a["x2"]) < F.least(b["x1"], b["x2"])) | (F.greatest(b["x1"], b["x2"]) < F.least(a["x1"], a["x2"]))
        | (F.greatest(a["y1"], a["y2"]) < F.least(b["y1"], b["y2"])) | (F.greatest(b["y1"], b["y2"]) < F.least(a["y1"], a["y2"]))
    )
    return ~apart & (F.signum(d1) * F.signum(d2) <= 0) & (F.signum(d3) * F.signum(d4) <= 0)


def intersects(a: Column, b: Column, a_area: bool = True, b_area: bool = True) -> Column:
    """Closed intersection of two edge arrays; ``a_area`` and ``b_area`` say which of them bound areas."""
    out = F.exists(a, lambda s: F.exists(b, lambda t: _touch(s, t)))
    if b_area:
        out = out | inside(a[0]["x1"], a[0]["y1"], b)
    if a_area:
        out = out | inside(b[0]["x1"], b[0]["y1"], a)
    return out


def intersection_area(a: Column, b: Column) -> Column:
    """Area of the intersection of two polygons, holes included, without constructing it.

    Under each pair of non-vertical edges lies the region under both; counted with the product of the edges' signs (an
    edge that runs to smaller x bounds from above) these regions add up to the intersection.
    """
    low = F.least(
        F.array_min(F.transform(a, lambda s: F.least(s["y1"], s["y2"]))), F.array_min(F.transform(b, lambda s: F.least(s["y1"], s["y2"])))
    )

    def term(s: Column, t: Column, base: Column) -> Column:
        lo = F.greatest(F.least(s["x1"], s["x2"]), F.least(t["x1"], t["x2"]))
        hi = F.least(F.greatest(s["x1"], s["x2"]), F.greatest(t["x1"], t["x2"]))
        at = lambda e, x: e["y1"] + (x - e["x1"]) * (e["y2"] - e["y1"]) / (e["x2"] - e["x1"])
        sl, sh, tl, th = at(s, lo), at(s, hi), at(t, lo), at(t, hi)
        dl, dh = sl - tl, sh - th
        k = dl / (dl - dh)
        ends = F.least(sl, tl) + F.least(sh, th) - 2 * base
        middle = sl + k * (sh - sl) - base
        crossed = (k * (F.least(sl, tl) - base + middle) + (1 - k) * (F.least(sh, th) - base + middle)) / 2
        sign = F.when((s["x2"] < s["x1"]) == (t["x2"] < t["x1"]), 1.0).otherwise(-1.0)
        return F.when((s["x1"] == s["x2"]) | (t["x1"] == t["x2"]) | (hi <= lo), 0.0).otherwise(
            sign * (hi - lo) * F.when(dl * dh < 0, crossed).otherwise(ends / 2)
        )

    # ``low`` is bound as a variable, lest it be evaluated for every pair of edges
    return F.transform(F.array(low), lambda base: _sum(a, lambda s: F.aggregate(b, _zero(), lambda acc, t: acc + term(s, t, base))))[0]


def clipped(lines: Column, polygon: Column) -> Column:
    """Runs of line edges inside the closed polygon as ``struct<len, x1, y1, x2, y2>``, in the line's order; a run along
    the border, up to rounding, counts."""

    def cuts(s: Column, t: Column) -> Column:
        rx, ry = s["x2"] - s["x1"], s["y2"] - s["y1"]
        sx, sy = t["x2"] - t["x1"], t["y2"] - t["y1"]
        qx, qy = t["x1"] - s["x1"], t["y1"] - s["y1"]
        d, off = _cross(rx, ry, sx, sy), _cross(qx, qy, rx, ry)
        reach = F.abs(rx) + F.abs(ry)
        parallel = F.abs(d) <= reach * (F.abs(sx) + F.abs(sy)) * NEAR
        u = _cross(qx, qy, rx, ry) / F.nullif(d, F.lit(0.0))
        k = _cross(qx, qy, sx, sy) / F.nullif(d, F.lit(0.0))
        rr = F.nullif(rx * rx + ry * ry, F.lit(0.0))
        along = F.array((qx * rx + qy * ry) / rr, ((qx + sx) * rx + (qy + sy) * ry) / rr)
        same = _near(off, reach, s["x1"], s["y1"], t["x1"], t["y1"])
        return F.when(~parallel & u.between(-NEAR, 1 + NEAR), F.array(k)).when(parallel & same, along)

    def cut(s: Column) -> Column:
        each = F.filter(F.transform(polygon, lambda t: cuts(s, t)), lambda c: c.isNotNull())
        found = F.filter(F.flatten(each), lambda k: (k > 0) & (k < 1))
        return F.struct(s.alias("s"), F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0), F.lit(1.0)), found))).alias("marks"))

    def runs(m: Column) -> Column:
        """Runs between marks as their share of the edge and their middle."""
        s, marks = m["s"], m["marks"]
        return F.transform(F.sequence(F.lit(0), F.size(marks) - 2), lambda i: F.struct(
            ((marks[i + 1] - marks[i]) * F.hypot(s["x2"] - s["x1"], s["y2"] - s["y1"])).alias("len"),
            *((s[f"{c}1"] + (s[f"{c}2"] - s[f"{c}1"]) * marks[i + j - 1]).alias(f"{c}{j}") for j in (1, 2) for c in "xy"),
            (s["x1"] + (s["x2"] - s["x1"]) * (marks[i] + marks[i + 1]) / 2).alias("x"),
            (s["y1"] + (s["y2"] - s["y1"]) * (marks[i] + marks[i + 1]) / 2).alias("y"),
        ))

    # every step is an array of its own: a lambda's variable is evaluated once, an inlined expression at each mention
    every = F.flatten(F.transform(F.transform(lines, cut), runs))
    kept = F.filter(every, lambda r: covers(r["x"], r["y"], polygon))
    return F.transform(kept, lambda r: F.struct(*(r[n].alias(n) for n in ("len", "x1", "y1", "x2", "y2"))))


def runs_length(runs: Column) -> Column:
    return _sum(runs, lambda r: r["len"])


def clipped_length(lines: Column, polygon: Column) -> Column:
    """Length of line edges inside the closed polygon; a run along the border counts."""
    return runs_length(clipped(lines, polygon))


def runs_parts(runs: Column) -> Column:
    """The runs as the parts of a line, of two points each."""
    return F.transform(runs, lambda r: F.array(F.struct(r["x1"].alias("x"), r["y1"].alias("y")), F.struct(r["x2"].alias("x"), r["y2"].alias("y"))))


def in_box(x: Column, y: Column, box: tuple[float, float, float, float] | None) -> Column:
    """Closed box test; without a box everything is in it."""
    if box is None:
        return F.lit(True)
    return x.between(F.lit(box[0]), F.lit(box[2])) & y.between(F.lit(box[1]), F.lit(box[3]))


def any_in_box(points: Column, box: tuple[float, float, float, float] | None) -> Column:
    return F.exists(points, lambda p: in_box(p["x"], p["y"], box)) if box is not None else F.lit(True)


def valid_points(points: Column) -> Column:
    """Points with both coordinates finite; what has fewer than two of them is no line."""
    return F.filter(points, lambda p: p["x"].isNotNull() & p["y"].isNotNull() & ~F.isnan(p["x"]) & ~F.isnan(p["y"]))


def wkb_type(wkb: Column) -> Column:
    """Type code in a WKB header of either byte order, without the Z/M and SRID flags."""
    little = F.hex(F.substring(wkb, 1, 1)) == "01"
    code = F.when(little, F.concat(F.hex(F.substring(wkb, 3, 1)), F.hex(F.substring(wkb, 2, 1)))).otherwise(F.hex(F.substring(wkb, 4, 2)))
    return F.conv(code, 16, 10).cast("int") % 1000
