"""A planar geometry kernel of Columns: no polygons of buffers are ever built, no Python runs per row.

A geometry is `geom`: an array of parts, each an array of vertices struct<x, y>; metres. A straight piece is four doubles
(ax, ay, bx, by). Polygons are arrays of rings, of vertices; the even-odd rule decides what is inside.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

GEOM = "array<array<struct<x:double,y:double>>>"
PIECES = "array<struct<part:int,piece:int,ax:double,ay:double,bx:double,by:double>>"


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def line(*points: Column) -> Column:
    """A geometry of one part."""
    return F.array(F.array(*points))


def hypot(dx: Column, dy: Column) -> Column:
    return F.sqrt(dx * dx + dy * dy)


def _legs(part: Column) -> Column:
    """Straight pieces of a part as structs a, b."""
    return F.zip_with(F.slice(part, 1, F.greatest(F.size(part) - 1, F.lit(0))), F.slice(part, 2, F.greatest(F.size(part) - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def part_length(part: Column) -> Column:
    return F.aggregate(_legs(part), F.lit(0.0), lambda s, l: s + hypot(l["b"]["x"] - l["a"]["x"], l["b"]["y"] - l["a"]["y"]))


def length(geom: Column) -> Column:
    """Metres; 0 for an empty geometry, null for null."""
    return F.aggregate(geom, F.lit(0.0), lambda s, p: s + part_length(p))


def pieces(geom: Column) -> Column:
    """All straight pieces of some length, numbered by part and place: array<struct<part, piece, ax, ay, bx, by>>."""
    of = lambda p, k: F.transform(_legs(p), lambda l, i: F.struct(k.alias("part"), i.alias("piece"), l["a"]["x"].alias("ax"), l["a"]["y"].alias("ay"), l["b"]["x"].alias("bx"), l["b"]["y"].alias("by")))
    return F.filter(F.flatten(F.transform(geom, of)), lambda q: (q["ax"] != q["bx"]) | (q["ay"] != q["by"]))


def first_point(geom: Column) -> Column:
    return F.get(F.get(geom, 0), 0)


def last_point(geom: Column) -> Column:
    return F.try_element_at(F.try_element_at(geom, F.lit(-1)), F.lit(-1))


def _bearing(dx: Column, dy: Column) -> Column:
    return F.pmod(F.degrees(F.atan2(dy, dx)), F.lit(360.0))


def bearing(geom: Column) -> Column:
    """Degrees in [0, 360) from the first point of the first part to the last of the last."""
    a, b = first_point(geom), last_point(geom)
    return _bearing(b["x"] - a["x"], b["y"] - a["y"])


def bearing_mean(geom: Column) -> Column:
    """Degrees in (-180, 180]: the plain mean of the parts' bearings."""
    angles = F.transform(geom, lambda p: F.degrees(F.atan2(F.try_element_at(p, F.lit(-1))["y"] - F.get(p, 0)["y"], F.try_element_at(p, F.lit(-1))["x"] - F.get(p, 0)["x"])))
    return F.aggregate(angles, F.lit(0.0), lambda s, a: s + a) / F.nullif(F.size(geom), F.lit(0))


def angle_difference(a: Column, b: Column) -> Column:
    """Degrees between directions, in [0, 180]."""
    d = F.abs(a - b)
    return F.least(d, 360 - d)


def fold90(d: Column) -> Column:
    """Degrees between undirected lines, in [0, 90]."""
    d = F.abs(d)
    d = F.when(d > 180, 360 - d).otherwise(d)
    return F.when(d > 90, 180 - d).otherwise(d)


def direction(difference: Column) -> Column:
    """0 along, 1 against."""
    return F.when(difference < 90, 0).otherwise(1)


def bounds(geom: Column) -> Column:
    """struct<xmin, ymin, xmax, ymax>."""
    all_ = F.flatten(geom)
    xs, ys = F.transform(all_, lambda p: p["x"]), F.transform(all_, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"), F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


def left_of(ax: Column, ay: Column, bx: Column, by: Column, px: Column, py: Column) -> Column:
    """Whether p lies left of the line a-b."""
    return (bx - ax) * (py - ay) - (by - ay) * (px - ax) > 0


def interpolate(part: Column, distance: Column) -> Column:
    """The point that far along a part; before its start or past its end: that end."""
    start = F.struct(F.greatest(distance, F.lit(0.0)).alias("left"), F.get(part, 0)["x"].alias("x"), F.get(part, 0)["y"].alias("y"))
    return F.aggregate(_legs(part), start, _step, lambda s: F.struct(s["x"].alias("x"), s["y"].alias("y")))


def _step(s: Column, l: Column) -> Column:
    n = hypot(l["b"]["x"] - l["a"]["x"], l["b"]["y"] - l["a"]["y"])
    go = F.when(n > 0, F.least(s["left"] / F.nullif(n, F.lit(0.0)), F.lit(1.0))).otherwise(0.0)
    on = s["left"] > 0
    x = F.when(on, l["a"]["x"] + go * (l["b"]["x"] - l["a"]["x"])).otherwise(s["x"])
    y = F.when(on, l["a"]["y"] + go * (l["b"]["y"] - l["a"]["y"])).otherwise(s["y"])
    return F.struct(F.greatest(s["left"] - n, F.lit(0.0)).alias("left"), x.alias("x"), y.alias("y"))


def let(value: Column, f) -> Column:
    """f of a value that is computed once, however often f uses it: plain Columns would repeat its expression at each use."""
    return F.get(F.transform(F.array(value), f), 0)


def point_piece_square(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """The square of the distance from a point to a straight piece of some length: plain arithmetic, which compiles."""
    dx, dy, ex, ey = bx - ax, by - ay, px - ax, py - ay
    dot, own, cross = ex * dx + ey * dy, dx * dx + dy * dy, ex * dy - ey * dx
    fx, fy = px - bx, py - by
    return F.when(dot <= 0, ex * ex + ey * ey).when(dot >= own, fx * fx + fy * fy).otherwise(cross * cross / own)


def point_piece_distance(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return F.sqrt(point_piece_square(px, py, ax, ay, bx, by))


def piece_distance(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Between straight pieces: 0 if they cross, else the least distance of an end to the other piece."""
    ax, ay, bx, by = a
    cx, cy, dx, dy = b
    side = lambda px, py, qx, qy, rx, ry: (qx - px) * (ry - py) - (qy - py) * (rx - px)
    crossing = (side(ax, ay, bx, by, cx, cy) * side(ax, ay, bx, by, dx, dy) < 0) & (side(cx, cy, dx, dy, ax, ay) * side(cx, cy, dx, dy, bx, by) < 0)
    return F.when(crossing, 0.0).otherwise(F.sqrt(F.least(*[point_piece_square(*p, *q) for p, q in ((a[:2], b), (a[2:], b), (b[:2], a), (b[2:], a))])))


def _clip(lo: Column, hi: Column) -> Column:
    """struct<lo, hi> within [0, 1], or null if nothing of it is."""
    return let(F.struct(F.greatest(lo, F.lit(0.0)).alias("lo"), F.least(hi, F.lit(1.0)).alias("hi")), lambda i: F.when(i["lo"] < i["hi"], i))


def disc_interval(t: tuple[Column, ...], cx: Column, cy: Column, r: float) -> Column:
    """The share of the piece t (as parameters from 0 to 1) within r of c; null if none."""
    ax, ay, bx, by = t
    dx, dy, ex, ey = bx - ax, by - ay, ax - cx, ay - cy
    q = F.struct((dx * dx + dy * dy).alias("a"), (ex * dx + ey * dy).alias("b"), (ex * ex + ey * ey - r * r).alias("c"))
    ends = lambda q, s: _clip((-q["b"] - s) / q["a"], (-q["b"] + s) / q["a"])
    return let(q, lambda q: let(q["b"] * q["b"] - q["a"] * q["c"], lambda root: F.when(root > 0, let(F.sqrt(root), lambda s: ends(q, s)))))


def slab_interval(t: tuple[Column, ...], n: tuple[Column, ...], r: float) -> Column:
    """The share of the piece t in the rectangle that spans the piece n and r to both sides; null if none."""
    ax, ay, bx, by = t
    cx, cy, ex, ey = n

    def axes(u: Column) -> Column:
        """Start and change of t along and across n."""
        return F.struct(
            ((ax - cx) * u["x"] + (ay - cy) * u["y"]).alias("s1"),
            ((bx - ax) * u["x"] + (by - ay) * u["y"]).alias("m1"),
            ((ay - cy) * u["x"] - (ax - cx) * u["y"]).alias("s2"),
            ((by - ay) * u["x"] - (bx - ax) * u["y"]).alias("m2"),
            u["n"].alias("n"),
        )

    def between(start: Column, move: Column, least: Column, most: Column) -> Column:
        """Parameters at which start + t * move lies between the bounds; null if never."""
        ends = F.struct(((least - start) / move).alias("p"), ((most - start) / move).alias("q"))
        moving = let(ends, lambda e: F.struct(F.least(e["p"], e["q"]).alias("lo"), F.greatest(e["p"], e["q"]).alias("hi")))
        always = F.when((start >= least) & (start <= most), F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi")))
        return F.when(F.abs(move) < 1e-12, always).otherwise(moving)

    def both(s: Column) -> Column:
        two = F.struct(between(s["s1"], s["m1"], F.lit(0.0), s["n"]).alias("i"), between(s["s2"], s["m2"], F.lit(-float(r)), F.lit(float(r))).alias("j"))
        return let(two, lambda k: F.when(k["i"].isNotNull() & k["j"].isNotNull(), _clip(F.greatest(k["i"]["lo"], k["j"]["lo"]), F.least(k["i"]["hi"], k["j"]["hi"]))))

    unit = let(hypot(ex - cx, ey - cy), lambda n: F.struct(((ex - cx) / n).alias("x"), ((ey - cy) / n).alias("y"), n.alias("n")))
    return let(unit, lambda u: let(axes(u), both))


def hull(*intervals: Column) -> Column:
    """The least interval over all given; null if all are."""
    span = lambda v: F.when(F.size(v) > 0, F.struct(F.array_min(F.transform(v, lambda i: i["lo"])).alias("lo"), F.array_max(F.transform(v, lambda i: i["hi"])).alias("hi")))
    return let(F.filter(F.array(*intervals), lambda i: i.isNotNull()), span)


def union_length(intervals: Column) -> Column:
    """The total length of the union of array<struct<lo, hi>>."""
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(float("-inf")).alias("end"))
    step = lambda s, i: F.struct((s["sum"] + F.greatest(F.lit(0.0), i["hi"] - F.greatest(i["lo"], s["end"]))).alias("sum"), F.greatest(s["end"], i["hi"]).alias("end"))
    return F.aggregate(F.array_sort(intervals), start, step)["sum"]


def polygon_legs(rings: Column) -> Column:
    """All sides of a polygon (array<ring>, a ring being a closed array of vertices): array<struct<a, b>>."""
    return F.flatten(F.transform(rings, _legs))


def in_polygon(px: Column, py: Column, legs: Column) -> Column:
    """Even-odd test of a point against polygon_legs(). Sides hold their lower end."""
    hit = lambda l: ((l["a"]["y"] > py) != (l["b"]["y"] > py)) & (px < (l["b"]["x"] - l["a"]["x"]) * (py - l["a"]["y"]) / F.nullif(l["b"]["y"] - l["a"]["y"], F.lit(0.0)) + l["a"]["x"])
    return F.size(F.filter(legs, lambda l: F.coalesce(hit(l), F.lit(False)))) % 2 == 1


def crossings(t: tuple[Column, ...], legs: Column) -> Column:
    """Where the piece t crosses the polygon's sides: its parameters in order, with 0 and 1."""
    ax, ay, bx, by = t
    dx, dy = bx - ax, by - ay

    def crossing(l: Column) -> Column:
        ex, ey = l["b"]["x"] - l["a"]["x"], l["b"]["y"] - l["a"]["y"]
        det = dx * ey - dy * ex
        s = ((l["a"]["x"] - ax) * ey - (l["a"]["y"] - ay) * ex) / F.nullif(det, F.lit(0.0))
        u = ((l["a"]["x"] - ax) * dy - (l["a"]["y"] - ay) * dx) / F.nullif(det, F.lit(0.0))
        return F.when((u >= 0) & (u <= 1) & (s > 0) & (s < 1), s)

    return F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0), F.lit(1.0)), F.filter(F.transform(legs, crossing), lambda c: c.isNotNull()))))


def inside_intervals(t: tuple[Column, ...], at: Column, legs: Column) -> Column:
    """Where the piece t lies inside a polygon: array<struct<lo, hi>>, between its crossings `at`."""
    ax, ay, bx, by = t
    spans = F.zip_with(F.slice(at, 1, F.size(at) - 1), F.slice(at, 2, F.size(at) - 1), lambda lo, hi: F.struct(lo.alias("lo"), hi.alias("hi")))
    return F.filter(spans, lambda i: in_polygon(ax + (i["lo"] + i["hi"]) / 2 * (bx - ax), ay + (i["lo"] + i["hi"]) / 2 * (by - ay), legs))


def merge_intervals(intervals: Column) -> Column:
    """array<struct<lo, hi>> with touching and overlapping ones joined, in order."""
    kind = "array<struct<lo:double,hi:double>>"

    def add(out: Column, i: Column) -> Column:
        last = F.try_element_at(out, F.lit(-1))
        joined = F.concat(F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))), F.array(F.struct(last["lo"].alias("lo"), F.greatest(last["hi"], i["hi"]).alias("hi"))))
        return F.when((F.size(out) > 0) & (i["lo"] <= last["hi"] + 1e-12), joined).otherwise(F.concat(out, F.array(i)))

    return F.aggregate(F.array_sort(intervals), F.array().cast(kind), add)


def join_pieces(ordered: Column) -> Column:
    """Straight pieces (structs with ax, ay, bx, by, in order) as a geometry: pieces that follow on make one part.

    The places where a part begins are listed first; each part then is one slice, so the work is linear in the pieces."""

    def parts(q: Column) -> Column:
        follows = lambda i: (F.get(q, i - 1)["bx"] == F.get(q, i)["ax"]) & (F.get(q, i - 1)["by"] == F.get(q, i)["ay"])
        begins = F.filter(F.when(F.size(q) > 0, F.sequence(F.lit(0), F.size(q) - 1)).otherwise(F.array().cast("array<int>")), lambda i: (i == 0) | ~follows(i))

        def line(begins: Column) -> Column:
            end = lambda k: F.coalesce(F.get(begins, k + 1), F.size(q))
            own = lambda s, k: F.slice(q, s + 1, end(k) - s)
            return F.transform(begins, lambda s, k: F.concat(F.array(point(F.get(q, s)["ax"], F.get(q, s)["ay"])), F.transform(own(s, k), lambda p: point(p["bx"], p["by"]))))

        return let(begins, line)

    return let(ordered, parts).cast(GEOM)


def utm33_to_wgs84(x: Column, y: Column) -> Column:
    """EPSG:25833 to longitude and latitude, by the Krueger series of the transverse Mercator on GRS80 (third order)."""
    a, f, k0, east, lon0 = 6378137.0, 1 / 298.257222101, 0.9996, 500000.0, math.radians(15.0)
    n = f / (2 - f)
    radius = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480)
    delta = (2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15)
    xi, eta = y / (k0 * radius), (x - east) / (k0 * radius)
    xi1, eta1 = xi, eta
    for j, b in enumerate(beta, 1):
        xi1 = xi1 - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta1 = eta1 - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi1) / F.cosh(eta1))
    lat = chi
    for j, d in enumerate(delta, 1):
        lat = lat + d * F.sin(2 * j * chi)
    lon = lon0 + F.atan2(F.sinh(eta1), F.cos(xi1))
    return F.struct(F.degrees(lon).alias("x"), F.degrees(lat).alias("y"))


def wgs84_to_utm33(lon: Column, lat: Column) -> Column:
    """Longitude and latitude to EPSG:25833; the inverse of utm33_to_wgs84()."""
    a, f, k0, east, lon0 = 6378137.0, 1 / 298.257222101, 0.9996, 500000.0, math.radians(15.0)
    n = f / (2 - f)
    radius = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    e = 2 * math.sqrt(n) / (1 + n)
    s = F.sin(F.radians(lat))
    t = F.sinh(F.atanh(s) - e * F.atanh(e * s))
    d = F.radians(lon) - lon0
    xi1, eta1 = F.atan2(t, F.cos(d)), F.atanh(F.sin(d) / F.sqrt(1 + t * t))
    x, y = eta1, xi1
    for j, c in enumerate(alpha, 1):
        x = x + c * F.cos(2 * j * xi1) * F.sinh(2 * j * eta1)
        y = y + c * F.sin(2 * j * xi1) * F.cosh(2 * j * eta1)
    return F.struct((east + k0 * radius * x).alias("x"), (k0 * radius * y).alias("y"))
