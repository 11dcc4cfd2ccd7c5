"""Noding against a plain version in fractions; merged geometries of groups."""

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tests.test_merge_gpkg import LINE, plain, shape
from velonet.functions import geometry as G
from velonet.operators import edges, merge, noding, snapping


def plain_nodes(lines):
    """All straight pieces between places where lines meet, each once."""
    pieces = [(a, b) for line in lines for a, b in zip(line, line[1:], strict=False) if a != b]
    side = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    out = set()
    for a, b in pieces:
        stops = {a, b}
        for c, d in pieces:
            for p in (c, d):
                if side(a, b, p) == 0 and min(a, b) < p < max(a, b):
                    stops.add(p)
            u, v = side(c, d, a), side(c, d, b)
            if u * v < 0 and side(a, b, c) * side(a, b, d) < 0:
                stops.add(tuple(x + (y - x) * Fraction(u, u - v) for x, y in zip(a, b, strict=True)))
        along = sorted(stops, key=lambda p: (p[0] - a[0]) * (b[0] - a[0]) + (p[1] - a[1]) * (b[1] - a[1]))
        out |= {tuple(sorted(q)) for q in zip(along, along[1:], strict=False)}
    return out


def rounded(p):
    """Coarser than the operator's own rounding."""
    return tuple(round(float(v) + 0.0013, 2) for v in p)


def frame(spark, lines):
    return spark.createDataFrame([(i, [[(float(x), float(y)) for x, y in line]]) for i, line in enumerate(lines)], f"id long, {LINE}").repartition(3)


@pytest.mark.parametrize(("seed", "span", "step"), [(0, 40, 1), (1, 12, 4), (2, 3000, 100)])
def test_noded_as_plain(spark, seed, span, step):
    """Crossings, touching ends, lines on lines, lines that cross themselves, doubled lines; the last ones span many cells."""
    r = random.Random(seed)
    at = lambda: (r.randrange(0, span, step), r.randrange(0, span, step))
    lines = [[at() for _ in range(r.randint(2, 5))] for _ in range(18)]
    lines += [lines[0], lines[1][::-1], [(0, 0), (span, 0)], [(span // 2, 0), (span * 2, 0)], [(1, 1), (1, 1)]]
    want = plain_nodes(lines)
    got = [((p.ax, p.ay), (p.bx, p.by)) for p in noding.noded_pieces(frame(spark, lines), "id").collect()]
    assert len(got) == len({tuple(sorted(p)) for p in got})
    assert sorted(tuple(sorted(map(rounded, p))) for p in got) == sorted(tuple(sorted(map(rounded, p))) for p in want)
    chains = [[rounded((v.x, v.y)) for v in line] for g in merge.merge_network(frame(spark, lines)).collect() for line in g.geom]
    assert sorted(map(shape, chains)) == sorted(map(shape, plain([[rounded(a), rounded(b)] for a, b in want])))


def test_three_lines_at_one_place(spark):
    """Their crossings are computed in pairs, and are one place."""
    lines = [[(0, 0), (3, 7)], [(0, 7), (3, 0)], [(0, 3.5), (3, 3.5)], [(5, 5), (6, 6)]]
    got = noding.noded_pieces(frame(spark, lines), "id").collect()
    assert len(got) == 7 and len({(p.bx, p.by) for p in got if p.sub == 0 and p.id < 3}) == 1
    assert noding.node_lines(frame(spark, []), "id").isEmpty()


def test_a_crossing_beside_an_end_is_the_end(spark):
    lines = [[(0, 0), (10, 0)], [(5, -5), (5, 1e-7)]]
    got = [(p.id, p.ax, p.bx) for p in noding.noded_pieces(frame(spark, lines), "id").collect()]
    assert sorted(got) == [(0, 0.0, 5.0), (0, 5.0, 10.0), (1, 5.0, 5.0)]


def tup(geom):
    return [[(p.x, p.y) for p in part] for part in geom]


def test_segments_of_one_edge_merge_across_lines(spark):
    """Lines of one number, reversed and out of order, a loop back to its own vertex, and an end that meets a run's middle."""
    def row(number, fuehr, part, piece, a, b):
        return (number, 0, fuehr, part, piece, *map(float, (*a, *b)))

    rows = [row("E", "x", 0, k, (k, 0), (k + 1, 0)) for k in range(3)] + [row("E", "x", 1, k, (6 - k, 0), (5 - k, 0)) for k in range(3)]
    rows += [row("E", "y", 2, k, (k, 5), (k + 1, 5)) for k in range(4)] + [row("E", "y", 3, 0, (2, 9), (2, 5))]
    loop = [(0, 20), (1, 20), (2, 20), (2, 21), (1, 21), (1, 20), (1, 19)]
    rows += [row("E", "z", 4, k, *q) for k, q in enumerate(zip(loop, loop[1:], strict=False))]
    rows += [row("F", "x", 0, 0, (0, 0), (1, 0)), row("F", "x", 0, 1, (1, 0), (2, 0)), row("F", "x", 0, 5, (5, 0), (6, 0))]
    df = spark.createDataFrame(rows, "element_nr string, ri int, fuehr string, part int, piece int, ax double, ay double, bx double, by double")
    got = {(r.element_nr, r.fuehr): r for r in snapping.merge_segments(df, ["part", "piece"]).collect()}
    assert tup(got["E", "x"].geom) == [[(float(k), 0.0) for k in range(7)]] and got["E", "x"]["Länge"] == 6
    assert sorted(map(shape, tup(got["E", "y"].geom))) == sorted(map(shape, [[(0.0, 5.0), (1.0, 5.0), (2.0, 5.0)], [(2.0, 5.0), (3.0, 5.0), (4.0, 5.0)], [(2.0, 9.0), (2.0, 5.0)]]))
    pieces = [[tuple(map(float, p)) for p in q] for q in zip(loop, loop[1:], strict=False)]
    assert sorted(map(shape, tup(got["E", "z"].geom))) == sorted(map(shape, plain(pieces)))
    assert tup(got["F", "x"].geom) == [[(0.0, 0.0), (1.0, 0.0), (2.0, 0.0)], [(5.0, 0.0), (6.0, 0.0)]]


def test_aggregated_edges_are_merged(spark):
    """Sections in any order and direction; ends count, not vertices within; a single section stays as it is."""
    p = [(float(k), 0.0) for k in range(8)]
    rows = [("A", 0, 1, [p[4:6]]), ("A", 0, 2, [p[2:5][::-1]]), ("A", 0, 3, [p[0:3], [(2.5, 9.0), (3.0, 0.0)]]), ("B", 0, 1, [p[0:2], p[1:3]]), ("C", 0, 1, None), ("C", 0, 2, [p[0:2]])]
    df = spark.createDataFrame([(e, r, "f", 1.0, s, g) for e, r, s, g in rows], f"element_nr string, ri int, fuehr string, length double, seq int, {LINE}")
    got = {r.element_nr: tup(r.geom) for r in edges.aggregate_edges(df, geom="geom").collect()}
    assert sorted(map(shape, got["A"])) == sorted(map(shape, [p[0:6], [(2.5, 9.0), (3.0, 0.0)]]))
    assert got["B"] == [p[0:2], p[1:3]] and got["C"] == [p[0:2]]


def test_join_pieces_of_many(spark):
    """Linear in the pieces."""
    q = F.transform(F.sequence(F.lit(0), F.lit(99999)), lambda i: F.struct(i.cast("double").alias("ax"), F.lit(0.0).alias("ay"), (i + F.when(i % 1000 == 999, 0.5).otherwise(1.0)).alias("bx"), F.lit(0.0).alias("by")))
    parts = spark.range(1).select(G.join_pieces(q).alias("g")).select(F.transform("g", F.size).alias("n")).first().n
    assert parts == [1001] * 100
