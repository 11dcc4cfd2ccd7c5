"""What the operators do on larger tables: plans without self-joins, few pairs, code that the JVM compiles, bounds that rounding can't move."""

import random
import re

import pytest
from pyspark.sql import functions as F

from velonet.operators import near


def plan(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def test_middle_pieces_without_join(spark):
    """A line's pieces are sorted once: nothing is broadcast, so the driver holds no table of pieces."""
    df = spark.createDataFrame([(1, [[(0.0, 0.0), (7.2, 0.0)]]), (2, [[(0.0, 0.0), (2.0, 0.0)], [(9.0, 0.0), (9.0, 3.0)]])], "id long, geom array<array<struct<x:double,y:double>>>")
    m = near.middle_pieces(near.cut_lines(df, "id", 1.0, nearest=True), "id")
    assert {r.id: (r.part, r.piece) for r in m.collect()} == {1: (0, 3), 2: (1, 0)}
    assert "Join" not in plan(m)


def test_share_at_the_bound_as_in_sql(spark, tmp_path):
    """Ways of which exactly 80 % lie beside the network: three squares of the larger orders table, where a product with the length rounded."""
    duckdb = pytest.importorskip("duckdb")
    from velonet.plans.queries import QUERIES, SQL

    spark.read.parquet("/root/testdata/sf0.1/orders.parquet").where("o_orderkey div 1000 in (85, 95, 121)").write.parquet(f"{tmp_path}/orders.parquet")
    got = sorted(r.id for r in QUERIES["match_without_parallel"](spark, str(tmp_path)).collect())
    c = duckdb.connect()
    c.sql(f"create view orders as select * from '{tmp_path}/orders.parquet/*.parquet'")
    assert got == sorted(r[0] for r in c.sql(SQL["match_without_parallel"]).fetchall())


def test_nearest_of_dense_nodes_meets_few(spark, monkeypatch):
    """Nodes on every third place of a square, a radius over all of it, far points, points at one place: the same nearest, few pairs."""
    r = random.Random(5)
    nodes = [(k, float(k % 30 * 3), float(k // 30 * 3)) for k in range(900)] + [(900 + k, 30.0, 30.0) for k in range(5)]
    points = [(k, r.uniform(-40, 130), r.uniform(-40, 130)) for k in range(400)] + [(400 + k, 45.0, 45.0) for k in range(50)] + [(450, None, 1.0), (451, 500.0, 500.0)]
    pairs = []
    plain = near.near_points

    def counted(*a):
        df = plain(*a)
        pairs.append(df.count())
        return df

    monkeypatch.setattr(near, "near_points", counted)
    p, n = spark.createDataFrame(points, "id long, x double, y double"), spark.createDataFrame(nodes, "node long, x double, y double")
    got = {x.id: (x.node, x.distance) for x in near.nearest_point(p, n, 60.0, "id", "node").collect()}
    for k, x, y in points:
        best = min(((((x - a) ** 2 + (y - b) ** 2) ** 0.5, j) for j, a, b in nodes), default=None) if x is not None else (1e9, None)
        assert got[k][0] == (best[1] if best[0] <= 60 else None) and (best[0] > 60 or abs(got[k][1] - best[0]) < 1e-9)
    assert len(got) == len(points) and sum(pairs) < 401 * 100  # all pairs within the radius are some 200,000


def test_distance_of_pieces_compiles(spark):
    """The JVM doesn't compile methods above 8000 bytes; values are those of the plain formula."""
    from velonet.functions import geometry as G

    r = random.Random(6)
    rows = [tuple(float(r.randint(0, 60)) for _ in range(4)) for _ in range(60)]
    df = spark.createDataFrame([(k, *v) for k, v in enumerate(rows) if v[:2] != v[2:]], "id long, ax double, ay double, bx double, by double")
    pairs = near.near_pieces(df, df, 9.0)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else there is no code before a run
    try:
        assert 0 < max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", plan(pairs, "codegen")))) < 8000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    cols = [tuple(F.col(f"{p}_{c}") for c in ("ax", "ay", "bx", "by")) for p in "lr"]
    every = df.select(*[F.col(c).alias(f"l_{c}") for c in df.columns]).crossJoin(df.select(*[F.col(c).alias(f"r_{c}") for c in df.columns]))
    want = every.withColumn("d", G.piece_distance(*cols)).where("d <= 9").select("l_id", "r_id", "d")
    assert sorted(map(tuple, pairs.select("l_id", "r_id", "distance").collect())) == sorted(map(tuple, want.collect()))


def test_changes_combine_once(spark):
    """Counts of distinct values would expand each row once a column before the shuffle."""
    from velonet.operators import edges

    rows = [("1", 0, 40.0, "a", None, "x"), ("1", 0, 40.0, "b", "k", "x"), ("1", 0, 5.0, "b", "k", "y"), ("2", 1, 40.0, None, "k", None), ("2", 1, 40.0, None, "k", "z"), ("3", 0, 40.0, None, None, "q"), ("3", 0, 31.0, None, None, "r")]
    df = spark.createDataFrame(rows, "element_nr string, ri int, length double, pflicht string, nutz_beschr string, fuehr string")
    out = edges.significant_changes(df, least=30.0)
    assert {r.element_nr: r.attributes for r in out.collect()} == {"1": "pflicht", "3": "fuehr"}
    assert "Expand" not in plan(out)


def test_expectations_leave_other_edges_at_the_scan(spark):
    """Only edges that a case names reach the window: its semi-join stands below it in the plan."""
    from velonet.plans.queries import QUERIES

    text = QUERIES["expect_summary"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    lines = text.splitlines()
    at = [i for i, x in enumerate(lines) if x.lstrip(" :+-").startswith("Window")]
    assert all(any("LeftSemi" in y and depth(y) > depth(lines[i]) for y in lines[i + 1 :]) for i in at)
    assert text.count("LeftSemi") >= 2


def test_edge_numbers_fold_no_other_attribute(spark):
    """Running numbers need the edges and their lengths: one shuffle of attributes less, the same rows as the whole aggregation's."""
    from velonet.operators import edges
    from velonet.plans.attribute_queries import _lengths
    from velonet.plans.bindings import segments

    sf = "/root/testdata/sf0.001"
    few = _lengths(spark, sf)
    assert "Join" not in plan(few)
    whole = edges.aggregate_edges(segments(spark, sf), geom=None).select(*few.columns)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, whole.collect()))


def test_parts_that_meet_nowhere_are_merged_already(spark, monkeypatch):
    """Only rows in which two ends meet go to the merge: parts apart (all segments of a straight edge that others interrupt) stay as they are."""
    from velonet.operators import merge

    apart, meet = [[(0.0, 0.0), (1.0, 0.0)], [(2.0, 0.0), (3.0, 0.0)]], [[(1.0, 0.0), (0.0, 0.0)], [(1.0, 0.0), (2.0, 0.0)]]
    rows = [(1, apart), (2, meet), (3, [*apart, [(9.0, 9.0)]]), (4, apart[:1]), (5, None), (6, [*apart, [(5.0, 5.0), (3.0, 0.0)]])]
    df = spark.createDataFrame(rows, "id long, geom array<array<struct<x:double,y:double>>>")
    seen, plain = [], merge.merge_groups

    def counted(lines, key, by):
        seen.extend(r.id for r in lines.collect())
        return plain(lines, key, by)

    monkeypatch.setattr(merge, "merge_groups", counted)
    for pieces in (False, True):
        got = {r.id: r.geom and [[tuple(p) for p in line] for line in r.geom] for r in merge.merge_parts(df, ["id"], pieces=pieces).collect()}
        assert got == {1: apart, 2: [[(2.0, 0.0), (1.0, 0.0), (0.0, 0.0)]], 3: apart, 4: apart[:1], 5: None, 6: [apart[0], [(2.0, 0.0), (3.0, 0.0), (5.0, 5.0)]]}
        assert sorted(seen) == [2, 3, 6]
        seen.clear()


def test_walks_write_each_segment_once(spark, tmp_path, monkeypatch):
    """A round's rows hold what the round met, not the walk so far: on a path that is one segment, however long the walk."""
    from velonet.operators import graph

    monkeypatch.setattr(graph, "shared_folder", lambda s: str(tmp_path))
    edges = spark.createDataFrame([(k, f"p{k}", f"p{k + 1}") for k in range(7)], "segment long, src string, dst string")
    starts = spark.createDataFrame([("a", "p0", None), ("b", "p1", 0), ("c", "q", None)], "start string, at string, own long")
    stops = spark.createDataFrame([("p7", "n")], "at string, node string")
    got = {r.start: (r.segments, r.node) for r in graph.explore(edges, starts, stops).collect()}
    assert got == {"a": ([0, 1, 2, 3, 4, 5], "n"), "b": ([1, 2, 3, 4, 5], "n"), "c": ([], None)}
    rounds = spark.read.parquet(str(next(tmp_path.glob("explore-*"))))
    assert rounds.selectExpr("max(size(segments))").first()[0] == 1 and rounds.selectExpr("sum(size(segments))").first()[0] == 11


def test_noding_deals_its_pairs_out(spark):
    """A small file's pieces meet in cells that are shuffled, not in the file's few tasks beside a broadcast; a piece's cuts are one group without joins."""
    from velonet.operators import noding

    lines = [(1, [[(0.0, 0.0), (30.0, 0.0)]]), (2, [[(10.0, -5.0), (10.0, 5.0)]]), (3, [[(20.0, 0.0), (20.0, 9.0)], [(0.0, 0.0), (10.0, 0.0)]])]
    df = spark.createDataFrame(lines, "id long, geom array<array<struct<x:double,y:double>>>")
    p = noding.noded_pieces(df, "id")
    tree = p._jdf.queryExecution().executedPlan().toString()
    assert tree.count("SortMergeJoin") == 1 and "BroadcastHashJoin" not in tree
    assert sorted((r.id, r.part, r.ax, r.ay, r.bx, r.by) for r in p.collect()) == [(1, 0, 0.0, 0.0, 10.0, 0.0), (1, 0, 10.0, 0.0, 20.0, 0.0), (1, 0, 20.0, 0.0, 30.0, 0.0), (2, 0, 10.0, -5.0, 10.0, 0.0), (2, 0, 10.0, 0.0, 10.0, 5.0), (3, 0, 20.0, 0.0, 20.0, 9.0)]


def test_crossing_ways_are_dealt_out_once(spark):
    """Pairs of a way and a chord are shuffled by way alone: for their runs, for the longest one and for its angle."""
    from velonet.operators import matching

    geom = "id long, geom array<array<struct<x:double,y:double>>>"
    net = spark.createDataFrame([(1, [[(0.0, 0.0), (60.0, 0.0)]])], geom)
    ways = spark.createDataFrame([(1, [[(30.0, -10.0), (30.0, 0.0), (30.0, 10.0)]]), (2, [[(10.0, 3.0), (40.0, 4.0)]])], geom)
    found = matching.crossing_short_ways(ways, net, "id")
    tree = found._jdf.queryExecution().executedPlan().toString()
    assert tree.count("SortMergeJoin") + tree.count("BroadcastHashJoin") == 1
    assert tree.count("Exchange hashpartitioning(") == tree.count("Exchange hashpartitioning(cx") + 1
    assert {r.id: (round(r.angle, 6), r.removed) for r in found.collect()} == {1: (90.0, True), 2: (1.909152, False)}


def test_layers_are_judged_in_one_pass(spark, monkeypatch):
    """The network is cut into chords and dealt out once for all layers, not once a layer; keys that two layers share are told apart, and
    what the rest of the paths is compared with carries geometry alone."""
    from velonet.operators import matching

    layer = "seq long, tilda_id string, geom array<array<struct<x:double,y:double>>>, tilda_note string"
    line = lambda *p: [list(p)]
    along, across, far = line((10.0, 3.0), (40.0, 3.0)), line((30.0, -10.0), (30.0, 10.0)), line((60.0, 4.0), (90.0, 4.0))
    rows = {"bikelanes": [(1, "b1", along, "n")], "streets": [(1, "s1", across, "n"), (2, "s2", far, "n")], "paths": [(1, "p1", line((110.0, 5.0), (140.0, 5.0)), "n"), (2, "p2", across, "n")]}
    layers = {n: spark.createDataFrame(r, layer) for n, r in rows.items()}
    net = spark.createDataFrame([(1, line((0.0, 0.0), (200.0, 0.0)))], "id long, geom array<array<struct<x:double,y:double>>>")
    cut, met = [], []
    plain, plainer = matching.near.cut_lines, matching.without_parallel
    monkeypatch.setattr(matching.near, "cut_lines", lambda *a, **k: cut.append(1) or plain(*a, **k))
    monkeypatch.setattr(matching, "without_parallel", lambda w, other, *a: met.append(other.columns) or plainer(w, other, *a))
    out = matching.match(layers, net)
    assert len(cut) == 1 and "tilda_note" not in met[-1]
    assert {n: sorted(r.tilda_id for r in out[n].collect()) for n in rows} == {"bikelanes": ["b1"], "streets": ["s2"], "paths": ["p1"]}
    assert sorted((r.tilda_id, r.tilda_note) for r in out["matched"].collect()) == [("b1", "n"), ("p1", "n"), ("s2", "n")]
    assert {r.tilda_id for r in matching.remove_crossing(layers["streets"], layers["streets"], net, "seq", "tilda_id").collect()} == {"s2"}


def test_pairs_of_lines_are_dealt_out(spark, tmp_path):
    """Pieces and chords outnumber their small files: neither side of the cells is broadcast, in coverage and beside crossing ways."""
    from velonet.operators import matching

    geom = "id long, geom array<array<struct<x:double,y:double>>>"
    net = spark.createDataFrame([(1, [[(0.0, 0.0), (60.0, 0.0)]])], geom)
    ways = spark.createDataFrame([(1, [[(30.0, -10.0), (30.0, 10.0)]]), (2, [[(10.0, 3.0), (40.0, 4.0)]])], geom)
    net.write.parquet(f"{tmp_path}/net")
    ways.write.parquet(f"{tmp_path}/ways")
    net, ways = spark.read.parquet(f"{tmp_path}/net"), spark.read.parquet(f"{tmp_path}/ways")
    for df in (near.coverage(ways, net, 5.0, "id"), near.coverage(ways, net, 5.0, "id", flat=True), matching.crossing_short_ways(ways, net, "id")):
        cells = [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "[cx#" in x and "Join" in x]
        assert len(cells) == 1 and "SortMergeJoin" in cells[0]
    assert {r.id: round(r.fraction, 6) for r in near.coverage(ways, net, 5.0, "id").collect()} == {1: 0.5, 2: 1.0}


def test_edges_are_dealt_out_by_rows(spark, monkeypatch):
    """A task's rows don't grow with the table: tasks do. Order and folds find an edge's rows where they lie; only the join deals them again."""
    from velonet.operators import sets
    from velonet.plans.queries import QUERIES

    assert sets.dealt(spark.range(1001), "id", 100).rdd.getNumPartitions() == 11 and sets.dealt(spark.range(0), "id").count() == 0
    whole = sorted(map(repr, QUERIES["edge_aggregate"](spark, "/root/testdata/sf0.001").collect()))
    monkeypatch.setattr(sets.dealt, "__defaults__", (500,))
    many = QUERIES["edge_aggregate"](spark, "/root/testdata/sf0.001")
    tree = many._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"hashpartitioning\(l_orderkey#\d+L, 12\), REPARTITION_BY_NUM", tree)) == 2
    assert tree.count("Exchange hashpartitioning(") == 2  # so few edges are joined by a broadcast
    assert sorted(map(repr, many.collect())) == whole


def test_snapping_carries_no_lines(spark, monkeypatch):
    """Rows are numbered before they have lines, and only rows whose parts meet are written; segments reach the edge as places. Against
    merge_segments() of all segments: numbers that several edges share, lines of several parts and legs, a loop, edges without a number or a way."""
    from velonet.operators import merge, scratch, snapping

    tags, numbered, write, number = [], [], scratch.written, snapping.number_rows
    monkeypatch.setattr(merge, "written", lambda df, tag: tags.append(tag) or write(df, tag))
    monkeypatch.setattr(snapping, "number_rows", lambda df, *a: numbered.append(df.columns) or number(df, *a))
    r = random.Random(8)
    at = lambda: (r.randrange(0, 120) / 2, r.randrange(0, 120) / 2)
    net = [(k, f"E{k // 3}" if k != 7 else None, f"a{k}", "b", f"S{k}", [[at() for _ in range(r.randrange(1, 4))] for _ in range(r.randrange(1, 3))]) for k in range(24)]
    net += [(30, "loop", "a", "b", "S", [[(0.0, 0.0), (20.0, 0.0), (20.0, 10.0), (10.0, 10.0), (10.0, 0.0), (10.0, -10.0)]]), (31, "far", "a", "b", "S", [[(900.0, 0.0), (907.0, 0.0)]])]
    network = spark.createDataFrame(net, "seq int, element_nr string, beginnt_bei_vp string, endet_bei_vp string, strassenname string, geom array<array<struct<x:double,y:double>>>")
    rows = [(k, [[at(), at()]], r.choice(["Radweg", " Radweg", None]), r.choice(["Einrichtungsverkehr", "Zweirichtungsverkehr"]), r.choice([1.5, 1.52, None]), f"t{k}") for k in range(12)]
    ways = spark.createDataFrame(rows, "way_id int, geom array<array<struct<x:double,y:double>>>, fuehr string, verkehrsri string, breite double, tilda_id string")
    o = snapping.SnapOptions(radius=9.0, reuse=False)
    got = snapping.snap(network, ways, opts=o)
    assert len(numbered) == 1 and "geom" not in numbered[0] and tags[0] == "open" and "merged" not in tags
    seg = snapping.segmentize(network, "seq").withColumn("_seg", F.struct("seq", "part", "piece"))
    chosen = snapping.variants(seg, snapping.best_ways(seg, ways, "_seg", "way_id", o), "_seg", "way_id").drop("_seg", "bearing")
    full = chosen.join(ways.drop("geom"), "way_id", "left").join(network.drop("geom"), "seq").withColumn("fuehr", F.when(F.col("case") == 1, snapping.NOTHING).otherwise(F.col("fuehr")))
    want = snapping.merge_segments(full, ["seq", "part", "piece", "ri"])
    names = ["element_nr", "ri", "fuehr", "verkehrsri", "breite", "tilda_id", "strassenname", "beginnt_bei_vp", "Länge", "geom"]
    take = lambda df: sorted(map(str, df.select(*names).collect()))
    assert take(got) == take(want) and got.count() > 30
    order = [tuple(x) for x in want.select(F.col("_at.seq"), F.col("_at.part"), F.col("_at.piece"), F.col("_at.ri"), "element_nr", "ri").orderBy("_at").collect()]
    assert [tuple(x) for x in got.orderBy("sfid").select("element_nr", "ri").collect()] == [x[4:] for x in order] and got.where("pflicht is null and Kommentar is null").count() == got.count()
