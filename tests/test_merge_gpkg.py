"""Lines merged to chains against a plain version; GeoPackage files written by hand and read back."""

import random
import sqlite3
import struct

import pytest
from pyspark.sql import functions as F

from velonet.operators import merge
from velonet.sources import gpkg, layers

LINE = "geom array<array<struct<x:double,y:double>>>"


def plain(lines):
    """Joins two lines at any place with exactly two ends, until there is none."""
    lines = [list(x) for x in lines]
    while True:
        ends = {}
        for i, x in enumerate(lines):
            for p in (x[0], x[-1]):
                ends.setdefault(p, []).append(i)
        pair = next((v for v in ends.values() if len(v) == 2 and v[0] != v[1]), None)
        if pair is None:
            return lines
        p = next(k for k, v in ends.items() if v is pair)
        a, b = (lines[i] for i in pair)
        a = a if a[-1] == p else a[::-1]
        b = b if b[0] == p else b[::-1]
        lines = [x for i, x in enumerate(lines) if i not in pair] + [a + b[1:]]


def shape(line):
    """A line without its direction, a ring without its start."""
    if line[0] == line[-1]:
        legs = sorted(tuple(sorted(p)) for p in zip(line, line[1:], strict=False))
        return ("ring", *legs)
    return ("line", *min(line, line[::-1]))


@pytest.mark.parametrize("seed", range(3))
def test_chains_as_plain_merge(spark, seed):
    rnd = random.Random(seed)
    at = lambda: (float(rnd.randrange(7)), float(rnd.randrange(7)))
    lines = []
    for i in range(22):
        a, b = at(), at()
        lines.append([a, (i + 0.25, 50.0 + seed), b] if i % 3 else [a, (i + 0.5, 60.0), (i + 0.75, 61.0), a])
    rows = [(i // 2 * 2, "g" if i < 12 else None, [x]) for i, x in enumerate(lines)]  # keys repeat
    df = spark.createDataFrame(rows, f"id long, grp string, {LINE}")
    tup = lambda line: [(v.x, v.y) for v in line]
    got = [tup(r.line) for r in merge.chains(df, "id").collect()]
    assert sorted(map(shape, got)) == sorted(map(shape, plain(lines)))
    by = {r.grp: [tup(p) for p in r.geom] for r in merge.merge_groups(df, "id", ("grp",)).collect()}
    for g, own in (("g", lines[:12]), (None, lines[12:])):
        assert sorted(map(shape, by[g])) == sorted(map(shape, plain(own)))


def test_chain_directions(spark):
    p = [(float(k), 0.0) for k in range(5)]
    rows = [(1, [[p[1], p[0]]]), (2, [[p[1], p[2]]]), (3, [[p[2], p[3]]]), (7, [[(9.0, 9.0), (8.0, 8.0)]]), (8, [[]]), (9, None), (10, [[p[0]]])]
    got = {r.id: [(v.x, v.y) for v in r.geom[0]] for r in merge.merge_network(spark.createDataFrame(rows, f"id long, {LINE}")).collect()}
    assert got == {1: p[:4], 7: [(9.0, 9.0), (8.0, 8.0)]}
    even = {r.id: [(v.x, v.y) for v in r.geom[0]] for r in merge.merge_network(spark.createDataFrame(rows[:2], f"id long, {LINE}")).collect()}
    assert even == {1: [p[2], p[1], p[0]]}
    assert merge.merge_network(spark.createDataFrame([], f"id long, {LINE}")).count() == 0


def wkb(kind, value, order="<", dims=2):
    head = struct.pack(f"{order}BI", order == "<", kind + {2: 0, 3: 1000, 4: 3000}[dims])
    put = lambda pts: b"".join(struct.pack(f"{order}{dims}d", *p, *[7.0] * (dims - 2)) for p in pts)
    n = lambda v: struct.pack(f"{order}I", len(v))
    if kind == 1:
        return head + put([value])
    if kind == 2:
        return head + n(value) + put(value)
    if kind == 3:
        return head + n(value) + b"".join(n(r) + put(r) for r in value)
    return head + n(value) + b"".join(wkb(kind - 3, v, order, dims) for v in value)


def blob(body, envelope=0, empty=False):
    return b"GP\0" + bytes([1 | envelope << 1 | 16 * empty]) + struct.pack("<i", 25833) + b"\0" * (0, 32, 48, 48, 64)[envelope] + body


def make(path, srs=25833):
    db = sqlite3.connect(path)
    db.executescript(f"""
        CREATE TABLE gpkg_contents (table_name TEXT, data_type TEXT);
        CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT, geometry_type_name TEXT, srs_id INTEGER);
        CREATE TABLE gpkg_spatial_ref_sys (srs_id INTEGER, organization_coordsys_id INTEGER);
        INSERT INTO gpkg_contents VALUES ('notes', 'attributes'), ('a b', 'features'), ('other', 'features');
        INSERT INTO gpkg_geometry_columns VALUES ('a b', 'shape', 'GEOMETRY', 1), ('other', 'geom', 'POINT', 1);
        INSERT INTO gpkg_spatial_ref_sys VALUES (1, {srs});
        CREATE TABLE "a b" (fid INTEGER PRIMARY KEY, shape GEOMETRY, "element nr" TEXT(20), width DOUBLE, ok BOOLEAN, kind TEXT, lanes MEDIUMINT);
        CREATE TABLE other (fid INTEGER PRIMARY KEY, geom POINT, lanes INTEGER);
    """)
    p = [(0.5, 1.0), (2.0, 3.0), (4.0, -5.0)]
    own = [
        (1, blob(wkb(2, p)), "E1", 1.5, 1, "k", 2), (2, blob(wkb(5, [p, p[:2]], ">", 3), 1), None, None, 0, None, None), (5, blob(wkb(1, p[0], dims=4), 4), "E5", 2, None, "", 1),
        (6, blob(wkb(3, [[*p, p[0]], p])), "E6", 0.0, 1, "k", 0), (7, None, "E7", 1.0, 1, "k", 3), (9, blob(wkb(2, []), 0, True), "E9", 1.0, 1, "k", 3), (10, blob(wkb(6, [[p], [p, p]], "<"), 3), "", 1.0, 1, "k", 3),
    ]
    db.executemany('INSERT INTO "a b" VALUES (?, ?, ?, ?, ?, ?, ?)', own)
    db.execute("INSERT INTO other VALUES (1, ?, 4)", (blob(wkb(1, (13.0, 52.0))),))
    db.commit()
    db.close()
    return p


@pytest.mark.parametrize("rows", [2, 1000])
def test_gpkg(spark, tmp_path, rows):
    path = f"{tmp_path}/n %1.gpkg"
    p = make(path)
    assert gpkg.layer_names(path) == ["a b", "other"]
    df = gpkg.read_gpkg(spark, path, rows=rows)
    assert df.dtypes[:-1] == [("fid", "bigint"), ("element nr", "string"), ("width", "double"), ("ok", "boolean"), ("kind_", "string"), ("lanes", "bigint"), ("kind", "string")]
    got = {r.fid: r for r in df.collect()}
    geom = {k: None if r.geom is None else [[(v.x, v.y) for v in q] for q in r.geom] for k, r in got.items()}
    assert geom == {1: [p], 2: [p, p[:2]], 5: [[p[0]]], 6: [[*p, p[0]], p], 7: None, 9: [], 10: [p, p, p]}
    assert [got[k].kind for k in sorted(got)] == ["LineString", "MultiLineString", "Point", "Polygon", None, "LineString", "MultiPolygon"]
    assert tuple(got[1])[:6] == (1, "E1", 1.5, True, "k", 2) and tuple(got[2])[1:6] == (None, None, False, None, None)


def test_gpkg_layers(spark, tmp_path):
    path = f"{tmp_path}/net.gpkg"
    make(path)
    assert layers.read_layer(spark, f"{path}:other").select("lanes").first().lanes == 4 and layers.read_layer(spark, path).count() == 7
    both = layers.read_layers(spark, path, ["a b", "other"], ("fid",))
    assert both.columns[0] == "fid" and both.count() == 8 and both.where(F.col("kind") == "Point").count() == 2
    with pytest.raises(ValueError, match="no layer x"):
        layers.read_layer(spark, f"{path}:x")
    make(f"{tmp_path}/deg.gpkg", 4326)
    q = layers.read_layer(spark, f"{tmp_path}/deg.gpkg:other").first().geom[0][0]
    assert 362000 < q.x < 364000 and 5.7e6 < q.y < 5.8e6
    make(f"{tmp_path}/far.gpkg", 3857)
    with pytest.raises(ValueError, match="EPSG:3857"):
        layers.read_layer(spark, f"{tmp_path}/far.gpkg")
