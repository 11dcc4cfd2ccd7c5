"""The kernel, near joins, coverage, clipping and crossing ways against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from velonet.functions import geometry as G
from velonet.operators import districts, matching, near

SCHEMA = "id long, geom array<array<struct<x:double,y:double>>>"


def random_lines(n, seed, span=400.0, size=60.0):
    r = random.Random(seed)
    out = []
    for i in range(n):
        parts = []
        for _ in range(r.randint(1, 2)):
            x, y = r.uniform(0, span), r.uniform(0, span)
            p = [(x, y)]
            for _ in range(r.randint(1, 4)):
                x, y = x + r.uniform(-size, size), y + r.uniform(-size, size)
                p.append((x, y))
            parts.append(p)
        out.append((i, parts))
    return out


def pieces(parts):
    return [(*a, *b) for p in parts for a, b in zip(p, p[1:], strict=False) if a != b]


def point_piece(px, py, q):
    ax, ay, bx, by = q
    t = np.clip(((px - ax) * (bx - ax) + (py - ay) * (by - ay)) / ((bx - ax) ** 2 + (by - ay) ** 2), 0, 1)
    return np.hypot(px - ax - t * (bx - ax), py - ay - t * (by - ay))


def piece_piece(p, q):
    side = lambda s, x, y: (s[2] - s[0]) * (y - s[1]) - (s[3] - s[1]) * (x - s[0])
    if side(p, *q[:2]) * side(p, *q[2:]) < 0 and side(q, *p[:2]) * side(q, *p[2:]) < 0:
        return 0.0
    return min(point_piece(*p[:2], q), point_piece(*p[2:], q), point_piece(*q[:2], p), point_piece(*q[2:], p))


@pytest.mark.parametrize("size", [60.0, 900.0])
def test_near_join(spark, size):
    a, b = random_lines(40, 1, size=size), random_lines(40, 2)
    want = {(i, j): d for i, p in a for j, q in b if (d := min(piece_piece(x, y) for x in pieces(p) for y in pieces(q))) <= 25}
    left, right = spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA.replace("id", "other", 1))
    got = {(r.id, r.other): r.distance for r in near.near_join(left, right, 25.0, "id", "other").collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)
    every = near.near_join(left, right, 25.0, "id", "other", "left")
    assert {r.id for r in every.collect()} == set(range(40))


def test_a_pair_at_exactly_the_radius_is_near(spark):
    """25 m: the cross product is 325, the square of the other's length 169, and 325 * 325 / 169 = 625."""
    a = spark.createDataFrame([(1, [[(14180.0, 681.0), (14185.0, 693.0)]])], SCHEMA)
    b = spark.createDataFrame([(2, [[(14160.0, 698.0), (14132.0, 722.0)]])], SCHEMA.replace("id", "way"))
    assert [tuple(r) for r in near.near_join(a, b, 25.0, "id", "way").collect()] == [(1, 2, 25.0)]
    assert near.near_join(a, b, 24.999999999, "id", "way").isEmpty()


@pytest.mark.parametrize("flat", [False, True])
def test_coverage(spark, flat):
    a, b = random_lines(25, 3), random_lines(8, 4)
    t = (np.arange(4000) + 0.5) / 4000
    got = {r.id: r.fraction for r in near.coverage(spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA), 25.0, "id", flat).collect()}
    for i, parts in a:
        hit = total = 0.0
        for ax, ay, bx, by in pieces(parts):
            px, py, long = ax + t * (bx - ax), ay + t * (by - ay), math.hypot(bx - ax, by - ay)
            inside = np.zeros(len(t), bool)
            for _, other in b:
                for p in other:
                    for k, (q0, q1) in enumerate(zip(p, p[1:], strict=False)):
                        q = (*q0, *q1)
                        if not flat:
                            inside |= point_piece(px, py, q) <= 25
                            continue
                        n = math.hypot(q[2] - q[0], q[3] - q[1])
                        along = ((px - q[0]) * (q[2] - q[0]) + (py - q[1]) * (q[3] - q[1])) / n
                        across = ((py - q[1]) * (q[2] - q[0]) - (px - q[0]) * (q[3] - q[1])) / n
                        inside |= (along >= 0) & (along <= n) & (np.abs(across) <= 25)
                        if k:
                            inside |= np.hypot(px - q[0], py - q[1]) <= 25
            hit, total = hit + inside.mean() * long, total + long
        assert abs(got[i] - hit / total) < 2e-3, i


def test_kernel(spark):
    df = spark.createDataFrame([(1, [[(0.0, 0.0), (3.0, 4.0), (3.0, 10.0)], [(3.0, 10.0), (0.0, 10.0)]])], SCHEMA)
    g = F.col("geom")
    r = df.select(G.length(g).alias("l"), G.bearing(g).alias("b"), G.bearing_mean(g).alias("m"), G.bounds(g).alias("x"), G.interpolate(g[0], F.lit(8.0)).alias("p"), G.interpolate(g[0], F.lit(99.0)).alias("e"), G.first_point(g).alias("f"), G.last_point(g).alias("z")).first()
    assert r.l == 14 and abs(r.b - 90) < 1e-9 and abs(r.m - (math.degrees(math.atan2(10, 3)) + 180) / 2) < 1e-9
    assert (r.p.x, r.p.y, r.e.x, r.e.y) == (3, 7, 3, 10) and (r.f.x, r.z.y) == (0, 10) and tuple(r.x) == (0, 0, 3, 10)
    cut = near.cut_lines(df, "id", 2.5).collect()
    assert len(cut) == math.ceil(11 / 2.5) + math.ceil(3 / 2.5)
    step = near.cut_lines(df, "id", 5.0, equal=False).collect()
    assert len(step) == 3 + 1
    assert df.select(G.join_pieces(G.pieces(g)).alias("j")).first().j == [[(0, 0), (3, 4), (3, 10), (0, 10)]]


def test_reprojection_of_known_place(spark):
    """A place on the central meridian lies at 500 km; there and back again is the same."""
    df = spark.createDataFrame([(15.0, 52.0), (13.4, 52.5)], "lon double, lat double").withColumn("p", G.wgs84_to_utm33(F.col("lon"), F.col("lat")))
    rows = df.withColumn("q", G.utm33_to_wgs84(F.col("p.x"), F.col("p.y"))).collect()
    assert abs(rows[0].p.x - 500000) < 1e-6 and 5.75e6 < rows[0].p.y < 5.77e6
    assert all(abs(r.q.x - r.lon) < 1e-8 and abs(r.q.y - r.lat) < 1e-8 for r in rows)  # a millimetre


def test_districts(spark):
    ring = lambda x0, y0, x1, y1: [[(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]]
    d = spark.createDataFrame([("1101", ring(0.0, 0.0, 10.0, 10.0)), ("1102", ring(10.0, 0.0, 20.0, 10.0))], "gem string, rings array<array<struct<x:double,y:double>>>")
    lines = spark.createDataFrame([(1, [[(4.0, 5.0), (14.0, 5.0)]]), (2, [[(8.0, 5.0), (18.0, 5.0)]]), (3, [[(5.0, 5.0), (15.0, 5.0)]]), (4, [[(30.0, 5.0), (40.0, 5.0)]]), (5, [[(-5.0, 5.0), (25.0, 5.0)]])], SCHEMA)
    got = {r.id: r.Bezirksnummer for r in districts.district_by_length(lines, d, "id").collect()}
    assert got == {1: "01", 2: "02", 3: "01", 4: None, 5: "01"}
    clipped = {r.id: r.geom for r in districts.clip_lines(lines, d, "id").collect()}
    assert clipped.keys() == {1, 2, 3, 5} and clipped[5] == [[(0.0, 5.0), (20.0, 5.0)]]  # the shared border doesn't split
    assert districts.clip_lines(lines, None, "id").count() == 5
    twice = d.unionByName(d.where("gem = '1102'")).unionByName(spark.createDataFrame([("1102", ring(100.0, 0.0, 101.0, 1.0))], d.schema))
    assert {r.id: r.Bezirksnummer for r in districts.district_by_length(lines, twice, "id").collect()} == got


@pytest.mark.parametrize("kind", ["equal", "nearest", "steps"])
def test_cut_lines_as_a_plain_walk(spark, kind):
    """Chords over many short legs, of lines with equal neighbours, of one leg, of no length and of one vertex."""
    import math
    import random

    r = random.Random(6)
    lines = [[(float(r.randint(0, 9)), float(r.randint(0, 9))) for _ in range(r.randint(2, 12))] for _ in range(40)]
    lines += [[(0.0, 0.0), (0.0, 0.0), (3.0, 0.0), (3.0, 0.0), (3.0, 4.0)], [(1.0, 1.0), (1.0, 1.0)], [(2.0, 2.0)], [(0.0, 0.0), (1000.0, 0.0)]]
    df = spark.createDataFrame([(k, [x]) for k, x in enumerate(lines)], SCHEMA)
    got = {}
    for x in near.cut_lines(df, "id", 2.5, equal=kind != "steps", nearest=kind == "nearest").collect():
        got.setdefault(x.id, []).append((x.piece, x.ax, x.ay, x.bx, x.by))

    def at(line, d):
        for (ax, ay), (bx, by) in zip(line, line[1:], strict=False):
            n = math.dist((ax, ay), (bx, by))
            if d <= n and n:
                return ax + (bx - ax) * d / n, ay + (by - ay) * d / n
            d -= n
        return line[-1]

    for k, line in enumerate(lines):
        total = sum(math.dist(p, q) for p, q in zip(line, line[1:], strict=False))
        n = max(1, round(total / 2.5) if kind == "nearest" else math.ceil(total / 2.5))
        ends = [min(i * 2.5, total) if kind == "steps" else total * i / n for i in range(n + 1)]
        want = [(i, *at(line, ends[i]), *at(line, ends[i + 1])) for i in range(n)] if len(line) > 1 else []
        want = [w for w in want if kind != "steps" or w[1:3] != w[3:5]]
        mine = sorted(got.get(k, []))
        assert [m[0] for m in mine] == [w[0] for w in want]
        assert all(abs(a - b) < 1e-9 for m, w in zip(mine, want, strict=True) for a, b in zip(m, w, strict=True)), (k, mine, want)
    short = near.cut_lines(df, "id", 2.5, nearest=True, least=1.0)
    assert short.where("sqrt(pow(bx - ax, 2) + pow(by - ay, 2)) < 1").isEmpty()
    middle = {x.id: x.piece for x in near.middle_pieces(near.cut_lines(df, "id", 2.5), "id").collect()}
    assert all(middle[k] == max(1, math.ceil(sum(math.dist(p, q) for p, q in zip(x, x[1:], strict=False)) / 2.5)) // 2 for k, x in enumerate(lines) if len(x) > 1)


def test_crossing_ways(spark):
    """A short way across a straight edge goes; one along it stays; one at a bend that runs along one leg stays."""
    net = spark.createDataFrame([(1, [[(0.0, 0.0), (200.0, 0.0)]]), (2, [[(500.0, 0.0), (500.0, 60.0), (560.0, 60.0)]])], SCHEMA)
    ways = spark.createDataFrame([(1, [[(100.0, -10.0), (100.0, 10.0)]]), (2, [[(100.0, 5.0), (120.0, 6.0)]]), (3, [[(505.0, 52.0), (525.0, 52.0)]]), (4, [[(100.0, -80.0), (100.0, 80.0)]])], SCHEMA)
    got = {r.id: r.removed for r in matching.crossing_short_ways(ways, net, "id").collect()}
    assert got == {1: True, 2: False, 3: False}


def test_registered_crossing_ways_as_all_pairs(spark):
    """orthogonal_removed and orthogonal_complex_kept: every short way against every chord of the network."""
    from velonet.plans.bindings import network, other_ways
    from velonet.plans.queries import QUERIES

    sf, o = "/root/testdata/sf0.001", matching.MatchOptions()
    tup = lambda df: {r.id: [(p.x, p.y) for p in r.geom[0]] for r in df.select("id", "geom").collect()}
    fold = lambda d: min(abs(d) % 180, 180 - abs(d) % 180)
    turn = lambda a, b: math.degrees(math.atan2(b[1] - a[1], b[0] - a[0]))
    chords = []  # (edge, place, from, to); edges are straight here
    for e, (a, b) in tup(network(spark, sf)).items():
        n = math.dist(a, b)
        stops = [min(k * o.short_step, n) / n for k in range(math.ceil(n / o.short_step) + 1)]
        at = [(a[0] + (b[0] - a[0]) * t, a[1] + (b[1] - a[1]) * t) for t in stops]
        chords += [(e, k, p, q) for k, (p, q) in enumerate(zip(at, at[1:], strict=False)) if p != q]
    box = np.array([[min(p[0], q[0]), min(p[1], q[1]), max(p[0], q[0]), max(p[1], q[1])] for _, _, p, q in chords])
    removed, kept = {}, {}
    for w, (a, b) in tup(other_ways(spark, sf)).items():
        if math.dist(a, b) >= o.short:
            continue
        r = o.short_buffer
        near_ = np.flatnonzero((box[:, 0] <= max(a[0], b[0]) + r) & (box[:, 2] >= min(a[0], b[0]) - r) & (box[:, 1] <= max(a[1], b[1]) + r) & (box[:, 3] >= min(a[1], b[1]) - r))
        close = [chords[i] for i in near_ if piece_piece((*a, *b), (*chords[i][2], *chords[i][3])) <= r]
        if not close:
            continue
        runs = []
        for c in sorted(close):
            if runs and runs[-1][-1][0] == c[0] and runs[-1][-1][1] + 1 == c[1]:
                runs[-1].append(c)
            else:
                runs.append([c])
        longest = max(runs, key=lambda x: (round(sum(math.dist(c[2], c[3]) for c in x), 9), -x[0][0]))
        own, bearings = turn(a, b), [turn(c[2], c[3]) for c in close]
        angle, spread = fold(own - turn(longest[0][2], longest[-1][3])), max(bearings) - min(bearings)
        spread, parallel = min(spread, 360 - spread), min(fold(own - x) for x in bearings)
        if angle > o.max_angle and not (spread > o.spread and parallel < o.parallel):
            removed[w] = angle
        elif angle > 50:
            kept[w] = (spread, parallel)
    got = {r.id: r.angle for r in QUERIES["orthogonal_removed"](spark, sf).collect()}
    assert got.keys() == removed.keys() and got and all(abs(got[k] - removed[k]) < 1e-3 for k in got)
    also = {r.id: (r.spread, r.parallel) for r in QUERIES["orthogonal_complex_kept"](spark, sf).collect()}
    assert also.keys() == kept.keys() and all(abs(x - y) < 1e-3 for k in also for x, y in zip(also[k], kept[k], strict=True))


def test_thresholds(spark):
    """Shares at the bounds: 70 % inside stays, 69 % doesn't; under 80 % parallel stays."""
    net = spark.createDataFrame([(1, [[(0.0, 0.0), (1000.0, 0.0)]])], SCHEMA)
    ways = spark.createDataFrame([(k, [[(1000.0 - k + 15.0, 0.0), (1015.0 + 100.0 - k, 0.0)]]) for k in (69, 70, 71)], SCHEMA)
    assert sorted(r.id for r in matching.within_fraction(ways, net, 15.0, 0.6999999, "id").collect()) == [70, 71]
    flat = spark.createDataFrame([(k, [[(1000.0 - k, 5.0), (1100.0 - k, 5.0)]]) for k in (79, 81)], SCHEMA)
    assert [r.id for r in matching.without_parallel(flat, net, "id").collect()] == [79]
