"""Snapping, edge aggregation, graphs, sources and the town from end to end."""

import json
import math
import random
from collections import defaultdict, deque

import pytest
from pyspark.sql import functions as F

from velonet.operators import edges, expectations, graph, matching, sets, snapping
from velonet.operators.translate import MIXED, ONE_WAY, one_sided_streets
from velonet.sources import layers

LINE = "geom array<array<struct<x:double,y:double>>>"
TWO_WAY = "Zweirichtungsverkehr"


def town(spark):
    net = [("E1", [[(0.0, 0.0), (100.0, 0.0)]]), ("E2", [[(0.0, 300.0), (100.0, 300.0)]]), ("E3", [[(0.0, 600.0), (100.0, 600.0)]]), ("E4", [[(0.0, 900.0), (10.0, 900.0)]])]
    net = [(k, e, "a", "b", g) for k, (e, g) in enumerate(net)]
    ways = [
        (1, [[(0.0, 5.0), (100.0, 5.0)]], "Radweg", TWO_WAY, "footAndCyclewayShared", None, 2.0, "t1"),
        (2, [[(112.0, -3.0), (112.0, 3.0)]], "Radweg", TWO_WAY, "bicycleRoad", None, 9.9, "t2"),  # beyond the end of E1
        (3, [[(0.0, 305.0), (100.0, 305.0)]], "Radweg", ONE_WAY, "cycleway", "yes", 1.5, "t3"),
        (4, [[(100.0, 295.0), (0.0, 295.0)]], "Radfahrstreifen", ONE_WAY, "cycleway", "yes", 1.2, "t4"),
        (5, [[(100.0, 604.0), (0.0, 604.0)]], MIXED, ONE_WAY, "sharedMotorVehicleLane", "yes", 3.0, "t5"),
    ]
    schema = f"way_id long, {LINE}, fuehr string, verkehrsri string, tilda_category string, tilda_oneway string, breite double, tilda_id string"
    return spark.createDataFrame(net, f"seq int, element_nr string, beginnt_bei_vp string, endet_bei_vp string, {LINE}"), spark.createDataFrame(ways, schema)


def test_snap_town(spark):
    net, ways = town(spark)
    got = {(r.element_nr, r.ri): r for r in snapping.snap(net, ways).collect()}
    assert set(got) == {("E1", 0), ("E1", 1), ("E2", 0), ("E2", 1), ("E3", 1), ("E4", 0), ("E4", 1)}
    assert got["E1", 0].fuehr == "Radweg" and got["E1", 0]["Länge"] == 100 and got["E1", 0].tilda_id == "t1"  # t2 lies beyond the end
    assert (got["E2", 0].tilda_id, got["E2", 1].tilda_id) == ("t3", "t4")
    assert got["E3", 1].fuehr == MIXED and got["E3", 1].breite is None
    assert got["E4", 0].fuehr == snapping.NOTHING and got["E4", 1].tilda_id is None
    assert sorted(r.sfid for r in got.values()) == list(range(1, 8))
    loose = snapping.snap(net, ways, opts=snapping.SnapOptions(strict_box=False)).where("element_nr = 'E1'").collect()
    assert {r.tilda_id for r in loose} == {"t1", "t2"}


def test_snap_needs_node_columns(spark):
    net, ways = town(spark)
    with pytest.raises(ValueError, match="beginnt_bei_vp"):
        snapping.snap(net.drop("beginnt_bei_vp"), ways)


def test_equal_stretches_apart_are_merged(spark):
    rows = [("E", 0, float(k), 0.0, k + 1.0, 0.0, "A" if k != 2 else "B", 0, float(k)) for k in range(5)]
    df = spark.createDataFrame(rows, "element_nr string, part int, ax double, ay double, bx double, by double, fuehr string, ri int, piece double")
    got = {r.fuehr: r for r in snapping.merge_segments(df, ["part", "piece"]).collect()}
    assert got["A"].geom == [[(0, 0), (1, 0), (2, 0)], [(3, 0), (4, 0), (5, 0)]] and got["A"]["Länge"] == 4 and got["B"]["Länge"] == 1


def test_aggregate_rules(spark):
    rows = [
        ("E", 0, 1, 60.0, "A", True, 2.0, "ja", "keine", "x", "S1"),
        ("E", 0, 2, 40.0, "B", True, 1.5, "nein", None, "y", "S2"),
        ("E", 0, 3, 20.0, "B", False, None, "entfällt", "neu", "nan", "S3"),
        ("E", 1, 4, 9.6, None, None, None, None, None, "", "S4"),
        (None, 0, 5, 9.0, "A", True, 1.0, "ja", "keine", "z", "S5"),
    ]
    df = spark.createDataFrame(rows, "element_nr string, ri int, seq int, length double, fuehr string, pflicht boolean, breite double, trennstreifen string, nutz_beschr string, tilda_id string, strassenname string")
    for part in (df, df.orderBy(F.desc("seq")).repartition(3)):  # the order of rows doesn't matter
        got = {(r.element_nr, r.ri): r.asDict() for r in edges.aggregate_edges(part).collect()}
        assert got.keys() == {("E", 0), ("E", 1)}
        e = got["E", 0]
        assert (e["fuehr"], e["pflicht"], e["breite"], e["trennstreifen"], e["nutz_beschr"], e["tilda_id"], e["strassenname"], e["Länge"]) == ("A", True, 1.5, "nein", "keine", "x;y", "S1", 120)
        assert got["E", 1]["tilda_id"] == "" and got["E", 1]["Länge"] == 10  # a single row passes as it is
    assert edges.significant_changes(df, least=30.0).collect()[0].attributes == "pflicht,nutz_beschr,fuehr,trennstreifen,breite"
    out = edges.finish(edges.aggregate_edges(df).withColumn("okstra_id", F.lit(1)))
    assert out.columns[:2] == ["afid", "element_nr"] and "okstra_id" not in out.columns
    assert {k: v.count() for k, v in edges.split_directions(out).items()} == {"hinrichtung": 1, "gegenrichtung": 1}
    assert list(edges.split_directions(df.drop("ri"))) == ["all"]


def test_components_and_clusters(spark):
    r = random.Random(5)
    pairs = [(r.randrange(300), r.randrange(300)) for _ in range(230)] + [(400 + k, 401 + k) for k in range(60)]
    parent = list(range(500))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    nodes = spark.range(500).withColumnRenamed("id", "k")
    got = {x.k: x.component for x in graph.components(nodes, spark.createDataFrame(pairs, "src long, dst long"), "k").collect()}
    assert got == {k: root(k) for k in range(500)}
    pts = spark.createDataFrame([(1, 0.0, 0.0), (2, 30.0, 0.0), (3, 60.0, 0.0), (4, 200.0, 0.0), (5, 0.0, 0.0)], "id long, x double, y double")
    c = graph.clusters(pts, 35.0, "id")
    assert {x.id: x.cluster for x in c.collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 1}
    assert {x.cluster: (x.n, x.x) for x in graph.centroids(pts, c, "id").collect()} == {1: (3, 30.0), 4: (1, 200.0)}


def plain_walk(lines, at, own, start, closed=(), limit=50):
    """(segments, node) by the rule, without a queue: every place's ring and way come from relaxation over the open segments, then all
    meetings are listed in the order of rings and ways, and the first that leads to a node ends the list."""
    beside = defaultdict(dict)  # place -> the place beyond -> (order, segment): the first of parallel segments orders, the last is walked
    for k in sorted(lines):
        for p, q in (lines[k], lines[k][::-1]):
            beside[p][q] = (beside[p].get(q, (k, k))[0], k)
    open_ = {p: sorted((order, k, q) for q, (order, k) in to.items() if k != own and k not in closed) for p, to in beside.items()}
    way = {start: ()}  # orders of the segments to a place; shorter ways first, then by order
    changed = True
    while changed:
        changed = False
        for p in list(way):
            for order, _, q in open_.get(p, []):
                new = (*way[p], order)
                if q not in at and len(new) < limit and (q not in way or (len(new), new) < (len(way[q]), way[q])):
                    way[q], changed = new, True
    segments = []
    for p in sorted(way, key=lambda p: (len(way[p]), way[p])):
        if len(segments) >= limit:
            break
        for _, k, q in open_.get(p, []):
            if q in at:
                return segments, at[q]
            if k not in segments:
                segments.append(k)
    return segments, None


def plain_numbers(lines, nodes, limit=50):
    """Segments in order; each takes what its two walks took."""
    at = {(x, y): n for n, x, y in nodes}
    done, lost = {}, 0
    for k in sorted(lines):
        if k in done:
            continue
        walks = [([], at[p]) if p in at else plain_walk(lines, at, k, p, done, limit) for p in lines[k]]
        b, e = walks[0][1], walks[1][1]
        lost += b is None and e is None
        nr = f"{b or 'UNKNOWN'}_{e or 'UNKNOWN'}.01" if b or e else f"UNKNOWN_UNKNOWN_{lost:03d}.01"
        done |= dict.fromkeys([k, *walks[0][0], *walks[1][0]], (b, e, nr))
    return done


def test_walks_by_hand(spark):
    """A street of four segments to a node; a fork whose nearer node comes second; a ring; a closed segment; parallel segments."""
    rows = [(1, "a", "b"), (2, "b", "c"), (3, "c", "d"), (4, "d", "N"), (10, "f", "g"), (11, "g", "h"), (12, "h", "M"), (13, "g", "O"), (20, "r", "s"), (21, "s", "t"), (22, "t", "r"), (30, "u", "v"), (31, "v", "u"), (32, "v", "w")]
    edges = spark.createDataFrame(rows, "segment long, src string, dst string")
    stops = spark.createDataFrame([("N", "n"), ("M", "m"), ("O", "o")], "at string, node string")
    starts = spark.createDataFrame([("street", "b", 1), ("fork", "f", None), ("ring", "s", 20), ("end", "a", 1), ("pair", "u", None), ("nowhere", "x", None)], "start string, at string, own long")
    got = {r.start: (r.segments, r.node) for r in graph.explore(edges, starts, stops).collect()}
    assert got == {"street": ([2, 3], "n"), "fork": ([10, 11], "o"), "ring": ([21, 22], None), "end": ([], None), "pair": ([31, 32], None), "nowhere": ([], None)}
    cut = {r.start: (r.segments, r.node) for r in graph.explore(edges, starts, stops, 2, edges.where("segment = 13")).collect()}
    assert cut["fork"] == ([10, 11], None) and cut["street"] == ([2, 3], None)
    assert graph.explore(edges, starts.limit(0), stops).count() == 0


@pytest.mark.parametrize("limit", [50, 4])
def test_walks_as_plain(spark, limit):
    r = random.Random(limit)
    lines = {k: tuple(sorted({(r.randrange(6), r.randrange(6)), (r.randrange(6), r.randrange(6))} | {(0, k)})[:2]) for k in range(70)}
    at = {(r.randrange(6), r.randrange(6)): f"n{k}" for k in range(4)}
    name = lambda p: f"{p[0]},{p[1]}"
    edges = spark.createDataFrame([(k, name(a), name(b)) for k, (a, b) in lines.items()], "segment long, src string, dst string")
    starts = [(f"{k}{e}", name(lines[k][e]), k) for k in lines for e in (0, 1)]
    closed = [3, 14, 15]
    found = graph.explore(edges, spark.createDataFrame(starts, "start string, at string, own long"), spark.createDataFrame([(name(p), n) for p, n in at.items()], "at string, node string"), limit, spark.createDataFrame([(k,) for k in closed], "segment long"))
    want = {f"{k}{e}": plain_walk(lines, at, k, lines[k][e], closed, limit) for k in lines for e in (0, 1)}
    assert {x.start: (x.segments, x.node) for x in found.collect()} == want and any(len(v[0]) > 3 for v in want.values())


def test_registered_walk_as_plain(spark):
    from velonet.plans.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    step = {0: (10, 0), 1: (0, 10)}
    rows = [(p.p_partkey, p.p_partkey % 40 * 10, p.p_partkey // 40 * 10, step[p.p_size % 2]) for p in spark.read.parquet(f"{sf}/part.parquet").collect()]
    lines = {k: ((x, y), (x + d[0], y + d[1])) for k, x, y, d in rows}
    at = {}
    for n in sorted(r.s_suppkey for r in spark.read.parquet(f"{sf}/supplier.parquet").collect()):
        at.setdefault((n * 7 % 41 * 10, n * 11 % 51 * 10), n)
    got = {r.start: (r.segments, r.node) for r in QUERIES["explore_from_open_ends"](spark, sf).collect()}
    want = {f"{k}:{e}": plain_walk(lines, at, k, p) for k, ends in lines.items() for e, p in zip("se", ends, strict=True) if p not in at}
    assert got == {k: (",".join(map(str, s)), n) for k, (s, n) in want.items()} and any(n for _, n in want.values())


def registered_grid(spark, sf):
    """Lines and nodes of the registered grid's tables."""
    step = {0: (10, 0), 1: (0, 10)}
    rows = [(p.p_partkey, p.p_partkey % 40 * 10, p.p_partkey // 40 * 10, step[p.p_size % 2]) for p in spark.read.parquet(f"{sf}/part.parquet").collect()]
    at = {}
    for n in sorted(r.s_suppkey for r in spark.read.parquet(f"{sf}/supplier.parquet").collect()):
        at.setdefault((n * 7 % 41 * 10, n * 11 % 51 * 10), n)
    return {k: ((x, y), (x + d[0], y + d[1])) for k, x, y, d in rows}, at


def test_registered_walk_has_no_limit(spark, tmp_path):
    """A street of 70 steps to the north with its only node near the south end, and a fork of 65 more: walks of more than 50 segments reach the node."""
    from velonet.plans.queries import QUERIES

    node = next(s for s in range(1, 2092) if (s * 7 % 41, s * 11 % 51) == (5, 3))
    parts = [(5 + 40 * y, 1) for y in range(70)] + [(6 + 40 * y, 1) for y in range(80, 145)] + [(7 + 40 * 90, 2)]
    spark.createDataFrame(parts, "p_partkey long, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(node,)], "s_suppkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    lines, at = registered_grid(spark, str(tmp_path))
    got = {r.start: (r.segments, r.node) for r in QUERIES["explore_from_open_ends"](spark, str(tmp_path)).collect()}
    want = {f"{k}:{e}": plain_walk(lines, at, k, p, limit=10**9) for k, ends in lines.items() for e, p in zip("se", ends, strict=True) if p not in at}
    assert got == {k: (",".join(map(str, s)), n) for k, (s, n) in want.items()}
    assert want[f"{5 + 40 * 69}:s"] == ([5 + 40 * y for y in range(68, 3, -1)], node) and len(want[f"{6 + 40 * 80}:e"][0]) == 64


@pytest.mark.parametrize("steps", [8192, 20])
def test_walks_without_limit_by_stretches_and_rings(spark, monkeypatch, steps):
    """All walked in tasks, or those of large stretches ring by ring: the same as the plain walk. Starts at a node, nowhere, and without an own segment."""
    monkeypatch.setattr(graph, "STEPS_A_STRETCH", steps)
    monkeypatch.setattr(graph, "WALK_SEGMENTS", 5)
    r = random.Random(3)
    lines = {k: ((x := r.randrange(30), y := r.randrange(3)), r.choice([(x + 1, y), (x, y + 1), (x, y)])) for k in range(90)} | {200 + k: ((100 + k, 0), (101 + k, 0)) for k in range(60)}
    at = {(r.randrange(30), r.randrange(3)): f"n{k}" for k in range(5)}
    name = lambda p: f"{p[0]},{p[1]}"
    edges = spark.createDataFrame([(k, name(a), name(b)) for k, (a, b) in lines.items()], "segment long, src string, dst string")
    starts = [(f"{k}{e}", name(lines[k][e]), k) for k in lines for e in (0, 1)] + [("free", name(lines[200][0]), None), ("nowhere", "x", None), ("null", None, 3)]
    found = graph.explore(edges, spark.createDataFrame(starts, "start string, at string, own long"), spark.createDataFrame([(name(p), n) for p, n in at.items()], "at string, node string"), None, spark.createDataFrame([(3,), (259,)], "segment long"))
    want = {f"{k}{e}": plain_walk(lines, at, k, lines[k][e], (3, 259), 10**9) for k in lines for e in (0, 1)}
    want |= {"free": (list(range(200, 259)), None), "nowhere": ([], None), "null": ([], None)}
    assert {x.start: (x.segments, x.node) for x in found.collect()} == want


def test_clusters_by_cells(spark):
    """Against all pairs; very many points at one place and in one cell give no pairs."""
    r = random.Random(4)
    pts = [(k, r.uniform(-90, 90), r.uniform(-90, 90)) for k in range(300)] + [(500 + k, 3.0 * k, 200.0) for k in range(40)] + [(700, 0.0, 203.0), (701, None, 1.0), (702, 1.0, None), (703, 300.0, 300.0), (704, 309.0, 300.0)]
    df = spark.createDataFrame(pts, "id long, x double, y double")
    for d in (3.0, 9.0, 14.0):
        least = {k: k for k, _, _ in pts}
        changed = True
        near = [(a[0], b[0]) for a in pts for b in pts if None not in (*a, *b) and math.hypot(a[1] - b[1], a[2] - b[2]) <= d]
        while changed:
            changed = False
            for a, b in near:
                if least[b] < least[a]:
                    least[a], changed = least[b], True
        assert {x.id: x.cluster for x in graph.clusters(df, d, "id").collect()} == least
    many = spark.range(300000).selectExpr("id", "cast(if(id % 3 = 0, 5.0, id % 1000 / 1000.0) as double) x", "0.5d y")
    assert graph.clusters(many, 20.0, "id").select("cluster").distinct().count() == 1


def test_element_numbers(spark):
    r = random.Random(9)
    lines = {}
    for k in range(120):
        x, y = r.randrange(9), r.randrange(9)
        dx, dy = r.choice([(1, 0), (0, 1)])
        lines[k] = ((x * 10.0, y * 10.0), ((x + dx) * 10.0, (y + dy) * 10.0))
    nodes = [(f"n{k}", r.randrange(10) * 10.0, r.randrange(10) * 10.0) for k in range(12)]
    nodes = list({(x, y): (n, x, y) for n, x, y in reversed(nodes)}.values())
    df = spark.createDataFrame([(k, [list(v)]) for k, v in lines.items()], f"id long, {LINE}")
    got = graph.element_numbers(df, spark.createDataFrame(nodes, "node string, x double, y double"), "id", "node").collect()
    assert {x.id: (x.beginnt_bei_vp, x.endet_bei_vp, x.element_nr) for x in got} == plain_numbers(lines, nodes)


def test_element_groups_end_at_nodes(spark):
    """One connected street with a node at each fifth place: groups are the stretches between nodes, numbers those of the walk."""
    lines = {k: ((k * 10.0, 0.0), (k * 10.0 + 10.0, 0.0)) for k in range(100)} | {100 + k: ((k * 10.0, 0.0), (k * 10.0, 10.0)) for k in range(0, 100, 7)}
    nodes = [(f"n{k}", k * 50.0, 0.0) for k in range(21)]
    at = {(x, y): n for n, x, y in nodes}
    rows = [(k, str(s), str(e), at.get(s), at.get(e)) for k, (s, e) in lines.items()]
    got = {r.id: r.component for r in graph.stretches(spark.createDataFrame(rows, "id long, s_at string, e_at string, s_node string, e_node string"), "id").collect()}
    assert len(got) == len(lines) and got[0] == got[4] != got[5] and max(list(got.values()).count(c) for c in got.values()) <= 7
    df = spark.createDataFrame([(k, [list(v)]) for k, v in lines.items()], f"id long, {LINE}")
    out = graph.element_numbers(df, spark.createDataFrame(nodes, "node string, x double, y double"), "id", "node").collect()
    assert {x.id: (x.beginnt_bei_vp, x.endet_bei_vp, x.element_nr) for x in out} == plain_numbers(lines, nodes)


def test_reach_from_every_node(spark):
    """The registered query, and a chain longer than the limit, against a breadth-first walk."""
    from velonet.plans.queries import QUERIES

    def plain(edges, limit=50):
        adj = defaultdict(set)
        for a, b in edges:
            adj[a].add(b)
            adj[b].add(a)
        out = set()
        for s in adj:
            hops, queue = {s: 0}, deque([s])
            while queue:
                p = queue.popleft()
                for q in adj[p] if hops[p] < limit else ():
                    if q not in hops:
                        hops[q] = hops[p] + 1
                        queue.append(q)
            out |= {(s, n, h) for n, h in hops.items()}
        return out

    sf = "/root/testdata/sf0.001"
    parts = [r.p_partkey for r in spark.read.parquet(f"{sf}/part.parquet").select("p_partkey").collect()]
    want = plain([(k, (k * 7 + 3) % (2 * len(parts))) for k in parts])
    got = [tuple(r) for r in QUERIES["chain_reachability_from_every_node"](spark, sf).select("start", "node", "hops").collect()]
    assert len(got) == len(want) and set(got) == want
    chain = [(k, k + 1) for k in range(53)] + [(60, 61), (61, 60), (62, 62)]
    e = spark.createDataFrame(chain, "src long, dst long")
    got = [tuple(r) for r in graph.reach(e, e.selectExpr("explode(array(src, dst)) start")).select("start", "node", "hops").collect()]
    assert set(got) == plain(chain) and (0, 50, 50) in got and len(got) == len(set(got))


def test_sets(spark):
    a = spark.createDataFrame([(1, 1, "x"), (2, 2, "y"), (2, 3, "z")], "id long, seq long, a string")
    b = spark.createDataFrame([(2, 1, 5), (3, 2, 6)], "id long, seq long, b int")
    got = {r.id: (r.data_source, r.a, r.b) for r in sets.combine([("A", a), ("B", b)], "id", "seq").collect()}
    assert got == {1: ("A", "x", None), 2: ("A", "y", None), 3: ("B", None, 6)}
    n = sets.number_rows(spark.range(1000).repartition(7), ["id"], "nr").collect()
    assert all(r.nr == r.id + 1 for r in n) and len(n) == 1000
    ids = lambda *v: spark.createDataFrame([(x,) for x in v], "id string")
    layer = a.withColumn("key", F.col("id").cast("string"))
    assert sets.apply_interventions(layer, layer, ids("1"), ids("2"), "key").count() == 3  # text keys match no number
    out = sets.apply_interventions(a.where("id = 1"), a, ids("1", "x"), ids("2"), "id").collect()
    assert sorted((r.id, r.manual_action) for r in out) == [(2, "included"), (2, "included")]


def test_one_sided(spark):
    df = spark.createDataFrame([(1, "separate_geometry", "data_no", "yes"), (2, "missing", "cycleway_adjoining", None), (3, "separate_geometry", "data_no", "yes_dual_carriageway"), (4, None, "data_no", None)], "id long, tilda_bikelane_left string, tilda_bikelane_right string, tilda_oneway string")
    assert {r.id: r.one_sided_bikelane_side for r in one_sided_streets(df).collect()} == {1: "left_separate", 2: "right_separate"}
    assert one_sided_streets(df.select("id")).count() == 0


def test_match_stage(spark):
    net = spark.createDataFrame([(0, [[(0.0, 0.0), (300.0, 0.0)]])], f"id long, {LINE}")
    rows = lambda k, y, ids: spark.createDataFrame([(k + i, f"w{j}", j, [[(0.0, y), (200.0, y)]], "separate_geometry" if i else "data_no", "data_no") for i, j in enumerate(ids)], f"seq long, tilda_id string, tilda_osm_id long, {LINE}, tilda_bikelane_left string, tilda_bikelane_right string")
    layers_ = {"bikelanes": rows(0, 5.0, [1]), "streets": rows(10, 6.0, [2, 3]), "paths": rows(20, 14.0, [4])}
    none = spark.createDataFrame([], "id string")
    out = matching.match(layers_, net, exclude=none, include=none)
    assert {r.tilda_id: r.data_source for r in out["matched"].collect()} == {"w1": "bikelanes", "w3": "streets"}
    assert out["streets_without_bikelanes"].count() == 0 and out["streets_one_sided"].count() == 1
    gone = spark.createDataFrame([("1",)], "id string")
    assert "w1" not in {r.tilda_id for r in matching.match(layers_, net, exclude=gone, include=none)["matched"].collect()}


def test_sources(spark, tmp_path):
    net, _ = town(spark)
    moved = net.withColumn("geom", F.transform("geom", lambda p: F.transform(p, lambda v: F.struct((v["x"] + 390000).alias("x"), (v["y"] + 5810000).alias("y")))))
    layers.export_geojson(moved, f"{tmp_path}/net.geojson")
    lines = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/net.geojson").collect()]
    assert {x["properties"]["element_nr"] for x in lines} == {"E1", "E2", "E3", "E4"} and all(13 < x["geometry"]["coordinates"][0][0] < 14 for x in lines)
    back = {r.properties["element_nr"]: r.geom for r in layers.read_layer(spark, f"{tmp_path}/net.geojson").collect()}
    assert abs(back["E1"][0][1].x - 390100) < 0.02 and abs(back["E1"][0][1].y - 5810000) < 0.02
    (tmp_path / "ids.txt").write_text("# head\n12 # x\n\n 13\nfoo\n12\n")
    assert sorted(r.id for r in layers.read_id_list(spark, f"{tmp_path}/ids.txt").collect()) == [12, 13]
    assert layers.read_id_list(spark, f"{tmp_path}/none.txt").count() == 0
    layers.write_id_list(net, "seq", f"{tmp_path}/out_ids")
    assert sorted(r.value for r in spark.read.text(f"{tmp_path}/out_ids").collect()) == ["0", "1", "2", "3"]
    agg = spark.createDataFrame([("E1", 0, 1), ("E1", 1, 2), ("E2", 7, 3)], "element_nr string, ri int, afid int")
    layers.write_directions(agg, f"{tmp_path}/agg.parquet")
    assert layers.read_layers(spark, f"{tmp_path}/agg.parquet", ["hinrichtung", "gegenrichtung"]).count() == 2
    assert layers.split_layer("a/b.parquet:x") == ("a/b.parquet", "x") and layers.split_layer("hdfs://h/p.parquet") == ("hdfs://h/p.parquet", None)
    with pytest.raises(ValueError, match="unknown file type"):
        layers.file_type("x.csv")


def test_expectations(spark):
    rows = [("E", "1", "A", True, 30.0), ("E", "2", "B", True, 0.5)]
    f = spark.createDataFrame(rows, "element_nr string, row string, fuehr string, pflicht boolean, length double")
    long = expectations.long_form(f, "element_nr", "row", ["fuehr", "pflicht"]).drop("length").join(f.select("row", "length"), "row")
    cases = [
        {"case": "any", "element_nr": "E", "mode": "any_segment", "attributes": {"fuehr": "B"}, "min_length": 20.0},  # by two different segments
        {"case": "all", "element_nr": "E", "attributes": {"pflicht": "ja"}},
        {"case": "not all", "element_nr": "E", "attributes": {"fuehr": "A"}},
        {"case": "absent", "element_nr": "E", "attributes": {"ofm": "x"}},
        {"case": "nowhere", "element_nr": "F", "attributes": {"fuehr": "A"}},
        {"case": "short", "element_nr": "E", "min_length": 1.0},
    ]
    e = expectations.expectations(cases, spark)
    got = {r["case"]: r.passed for r in expectations.check(e, long).collect()}
    assert got == {"any": True, "all": True, "not all": False, "absent": False, "nowhere": False, "short": False}
    assert expectations.summary(expectations.check(e, long)).first() == (6, 2, 4)
    assert {r["case"] for r in expectations.failures(e, long).collect()} >= {"not all", "absent", "nowhere"}


def test_enrich_keeps_one_of_each_unique_id(spark):
    schema = f"id long, unique_id string, {LINE}"
    line = lambda y, x1=100.0: [[(0.0, y), (x1, y)]]
    streets = spark.createDataFrame([(1, "a", line(0.0)), (2, "a", line(1.0)), (3, "b", line(2.0)), (4, "c", line(500.0))], schema)
    rvn = spark.createDataFrame([(10, "x", line(0.0)), (11, "b", line(900.0)), (12, "y", line(800.0)), (13, "y", line(801.0))], schema)
    got = matching.enrich(streets, rvn)
    assert sorted((r.id, r.edge_source) for r in got.collect()) == [(1, "detailnetz"), (3, "detailnetz"), (12, "rvn")] and "unique_id" not in got.columns


def test_removed_ways_are_all_of_the_id(spark):
    net = spark.createDataFrame([(1, [[(0.0, 0.0), (200.0, 0.0)]])], f"id long, {LINE}")
    layer = spark.createDataFrame([(1, 7, [[(100.0, -10.0), (100.0, 10.0)]]), (2, 7, [[(0.0, 5.0), (60.0, 5.0)]]), (3, 8, [[(20.0, 5.0), (60.0, 5.0)]])], f"seq long, tilda_osm_id long, {LINE}")
    assert sorted(r.seq for r in matching.removed_ways(layer, net, "seq", "tilda_osm_id").collect()) == [1, 2]


def test_report_and_exit_code(spark):
    rows = [{"case": "good", "element_nr": "1", "attributes": {"fuehr": "Radweg"}}, {"case": "bad", "element_nr": "2", "attributes": {"fuehr": "Radweg", "pflicht": True}}]
    f = spark.createDataFrame([("1", 1, "Radweg", "true"), ("2", 2, "Gehweg", "ja")], "element_nr string, row int, fuehr string, pflicht string")
    long = expectations.long_form(f, "element_nr", "row", ["fuehr", "pflicht"])
    out, code = expectations.report(expectations.expectations(rows, spark), long)
    got = {r.case: (r.passed, r.wrong and [tuple(w) for w in r.wrong]) for r in out.collect()}
    assert code == 1 and got["good"] == (True, None) and got["bad"][0] is False and (2, "fuehr", "Radweg", "Gehweg") in got["bad"][1]
    assert expectations.report(expectations.expectations(rows[:1], spark), long)[1] == 0
