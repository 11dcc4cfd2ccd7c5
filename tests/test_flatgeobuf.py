"""FlatGeobuf files, written by hand and read back."""

import random
import struct

import numpy as np
import pytest

from velonet.sources import flatgeobuf as fgb
from velonet.sources import layers


def table(buf, fields):
    """Puts a table: scalars by (code, value), text, bytes, vectors of numbers, tables and lists of tables. Returns its place."""
    vtable = len(buf)
    buf += bytes(4 + 2 * (max(fields, default=0) + 1))
    at, later = len(buf), []
    buf += struct.pack("<i", at - vtable)
    for k, v in fields.items():
        struct.pack_into("<H", buf, vtable + 4 + 2 * k, len(buf) - at)
        if isinstance(v, tuple):
            buf += struct.pack(f"<{v[0]}", v[1])
        else:
            later.append((len(buf), v))
            buf += bytes(4)
    struct.pack_into("<HH", buf, vtable, at - vtable, len(buf) - at)
    for place, v in later:
        if isinstance(v, dict):
            to = table(buf, v)
        else:
            to = len(buf)
            v = v.encode() if isinstance(v, str) else v
            buf += struct.pack("<I", v.size if isinstance(v, np.ndarray) else len(v))
            if isinstance(v, list):
                slots = len(buf)
                buf += bytes(4 * len(v))
                for i, x in enumerate(v):
                    p = table(buf, x)
                    struct.pack_into("<I", buf, slots + 4 * i, p - slots - 4 * i)
            else:
                buf += bytes(v) if isinstance(v, bytes) else v.tobytes()
        struct.pack_into("<I", buf, place, to - place)
    return at


def sized(fields):
    buf = bytearray(4)
    struct.pack_into("<I", buf, 0, table(buf, fields))
    return struct.pack("<I", len(buf)) + bytes(buf)


COLUMNS = [("nr", 7), ("name", 11), ("width", 10), ("ok", 2), ("small", 3), ("raw", 14), ("kind", 11)]


def feature(i, geometry, values):
    codes = {7: "q", 10: "d", 2: "?", 3: "h"}
    data = b""
    for k, v in enumerate(values):
        if v is not None:
            raw = v.encode() if isinstance(v, str) else v
            t = COLUMNS[k][1]
            data += struct.pack("<H", k) + (struct.pack(f"<{codes[t]}", v) if t in codes else struct.pack("<I", len(raw)) + raw)
    return sized(({0: geometry} if geometry else {}) | ({1: data} if data else {}))


def line(points, ends=None, kind=None):
    out = {1: np.array(points, "<f8")}
    return out | ({0: np.array(ends, "<u4")} if ends else {}) | ({6: ("B", kind)} if kind else {})


def write(path, features, bounds, node_size=16, kind=2, srs=25833):
    header = sized({0: "layer", 2: ("B", kind), 7: [{0: n, 1: ("B", t)} for n, t in COLUMNS], 8: ("Q", len(features)), 9: ("H", node_size), 10: {1: ("i", srs)}})
    tree = b""
    if node_size and features:
        offsets = np.cumsum([0, *map(len, features)])[:-1]
        sizes = fgb.levels(len(features), node_size)
        levels, total = [[(*b, int(o)) for b, o in zip(bounds, offsets, strict=True)]], sum(sizes)
        first = total - sizes[0]
        for _ in sizes[1:]:
            below = levels[-1]
            groups = [below[k : k + node_size] for k in range(0, len(below), node_size)]
            levels.append([(min(x[0] for x in g), min(x[1] for x in g), max(x[2] for x in g), max(x[3] for x in g), first + n * node_size) for n, g in enumerate(groups)])
            first -= len(levels[-1])
        tree = b"".join(np.array(v, fgb.NODE).tobytes() for v in reversed(levels))
    path.write_bytes(fgb.MAGIC + b"\0" + header + tree + b"".join(features))
    return len(header) + 8 + len(tree)


def tup(geom):
    return None if geom is None else [[(v.x, v.y) for v in p] for p in geom]


def test_kinds_and_attributes(spark, tmp_path):
    p = [(0.5, 1.0), (2.0, 3.0), (4.0, -5.0)]
    ring = [(0.0, 0.0), (9.0, 0.0), (9.0, 9.0), (0.0, 0.0)]
    shapes = [
        (line(p, kind=2), ("LineString", [p])),
        (line(p + p[:2], [3, 5], 5), ("MultiLineString", [p, p[:2]])),
        (line(p[:1], kind=1), ("Point", [p[:1]])),
        (line(p, kind=4), ("MultiPoint", [[v] for v in p])),
        (line(ring + p, [4, 7], 3), ("Polygon", [ring, p])),
        ({6: ("B", 6), 7: [line(ring, kind=3), line(ring + p, [4, 7], 3)]}, ("MultiPolygon", [ring, ring, p])),
        (line([], kind=2), ("LineString", [])),
        (None, (None, None)),
    ]
    values = [(2**40, "Straße", 1.5, True, -3, b"\0\1", "k"), (None,) * 7, (1, "", 0.0, False, 0, b"", ""), *[(n, None, None, None, None, None, "x") for n in range(5)]]
    want = sorted(zip(values, [s for _, s in shapes], strict=True), key=str)
    for node_size in (0, 4):
        path = tmp_path / f"a{node_size}.fgb"
        write(path, [feature(i, g, v) for i, ((g, _), v) in enumerate(zip(shapes, values, strict=True))], [(0, 0, 9, 9)] * len(shapes), node_size, 0)
        df = layers.read_layer(spark, str(path))
        assert df.columns == ["nr", "name", "width", "ok", "small", "raw", "kind_", "kind", "geom"]
        got = [((r.nr, r.name, r.width, r.ok, r.small, bytes(r.raw) if r.raw is not None else None, r.kind_), (r.kind, tup(r.geom))) for r in df.collect()]
        assert sorted(got, key=str) == want


@pytest.mark.parametrize(("n", "node_size"), [(1, 16), (16, 16), (300, 4), (1000, 16)])
def test_boxes_and_byte_ranges(spark, tmp_path, monkeypatch, n, node_size):
    r = random.Random(n)
    at = sorted((r.uniform(0, 1000), r.uniform(0, 1000)) for _ in range(n))
    rows = [[(x, y), (x + 5, y + r.uniform(-5, 5))] for x, y in at]
    bounds = [(min(x[0] for x in p), min(x[1] for x in p), max(x[0] for x in p), max(x[1] for x in p)) for p in rows]
    path = tmp_path / "b.fgb"
    write(path, [feature(i, line(p), (i, "n" * (i % 7), None, None, None, None, None)) for i, p in enumerate(rows)], bounds, node_size)
    got = fgb.read_fgb(spark, str(path), task_bytes=2000)
    assert sorted((x.nr, tup(x.geom)) for x in got.collect()) == [(i, [p]) for i, p in enumerate(rows)]
    assert got.rdd.getNumPartitions() == (1 if n < 20 else pytest.approx(path.stat().st_size / 2000, rel=0.5))
    for box in ((100.0, 100.0, 220.0, 400.0), (-10.0, -10.0, -6.0, -6.0), (0.0, 0.0, 2000.0, 2000.0)):
        want = [i for i, b in enumerate(bounds) if b[0] <= box[2] and b[2] >= box[0] and b[1] <= box[3] and b[3] >= box[1]]
        assert sorted(x.nr for x in fgb.read_fgb(spark, str(path), box, 2000).collect()) == want
    read, open_ = [0], fgb._open

    class Counted:
        def __init__(self, f):
            self.f = f

        def read(self, k):
            read[0] += k
            return self.f.read(k)

        def __getattr__(self, name):
            return getattr(self.f, name)

        def __enter__(self):
            return self

        def __exit__(self, *a):
            self.f.close()

    monkeypatch.setattr(fgb, "_open", lambda p: Counted(open_(p)))
    h = fgb.describe(str(path))
    size = {}
    for box in (None, (100.0, 100.0, 220.0, 300.0)):
        read[0] = 0
        reader = fgb.FlatGeobufReader(str(path), h, box, 2000)
        for part in reader.partitions():
            list(reader.read(part))
        size[box] = read[0]
    assert n < 100 or min(size.values()) == size[(100.0, 100.0, 220.0, 300.0)] < size[None] / 2


def test_other_files_are_errors(spark, tmp_path):
    (tmp_path / "x.fgb").write_bytes(b"no such file")
    with pytest.raises(ValueError, match="no FlatGeobuf"):
        layers.read_layer(spark, str(tmp_path / "x.fgb"))
    write(tmp_path / "y.fgb", [], [], srs=3857)
    with pytest.raises(ValueError, match="3857"):
        layers.read_layer(spark, str(tmp_path / "y.fgb"))
    write(tmp_path / "z.fgb", [], [])
    assert layers.read_layer(spark, str(tmp_path / "z.fgb")).count() == 0
    write(tmp_path / "w.fgb", [feature(0, line([(13.4, 52.5), (13.5, 52.5)]), (1,))], [(13.4, 52.5, 13.5, 52.5)], srs=4326)
    (x, y), _ = tup(layers.read_layer(spark, str(tmp_path / "w.fgb")).first().geom)[0]
    assert 391000 < x < 392000 and 5817000 < y < 5818000
