"""FlatGeobuf layers: features as flatbuffers behind a packed Hilbert R-tree, read by byte ranges, some of them a task.

A box leaves out what the tree keeps away from it: the driver descends the tree, reading only the nodes that the box meets, and the
tasks read the features found. Without a box, tasks get equal stretches of the file. Paths are those of Arrow's file systems
(local and shared folders, HDFS, S3). Attributes become bigint, double, boolean, binary or string columns (dates and JSON
are strings); the geometry becomes kind and geom as in gpkg. A feature without a geometry has null for both; heights and measures
are left out. Not read: columns that single features declare for themselves, curves.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from velonet.functions import geometry as G
from velonet.sources.gpkg import DEGREES, KINDS, METRES, geometry_columns

# Fixed values of the format -------------------------------------------------------------------------------------------
MAGIC = b"fgb\x03fgb"
#: Spark type and struct code of the column types 0 to 14; those without a code have a length and bytes.
COLUMN_TYPES = (("bigint", "b"), ("bigint", "B"), ("boolean", "?"), ("bigint", "h"), ("bigint", "H"), ("bigint", "i"), ("bigint", "I"), ("bigint", "q"), ("bigint", "Q"), ("double", "f"), ("double", "d"), ("string", ""), ("string", ""), ("string", ""), ("binary", ""))
NODE = np.dtype([("x0", "<f8"), ("y0", "<f8"), ("x1", "<f8"), ("y1", "<f8"), ("offset", "<u8")])
# ----------------------------------------------------------------------------------------------------------------------
_ARROW = {"bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}
TASK_BYTES = 16 << 20


class Table:
    """A flatbuffer's table: fields by their number."""

    def __init__(self, buf: bytes, at: int | None = None):
        self.buf = buf
        self.at = struct.unpack_from("<I", buf)[0] if at is None else at
        self.fields = self.at - struct.unpack_from("<i", buf, self.at)[0]
        self.size = struct.unpack_from("<H", buf, self.fields)[0]

    def _place(self, k: int) -> int | None:
        o = 4 + 2 * k
        off = struct.unpack_from("<H", self.buf, self.fields + o)[0] if o < self.size else 0
        return self.at + off if off else None

    def number(self, k: int, code: str, default=0):
        p = self._place(k)
        return default if p is None else struct.unpack_from(f"<{code}", self.buf, p)[0]

    def _vector(self, k: int) -> tuple[int, int] | None:
        p = self._place(k)
        if p is None:
            return None
        p += struct.unpack_from("<I", self.buf, p)[0]
        return p + 4, struct.unpack_from("<I", self.buf, p)[0]

    def numbers(self, k: int, kind: str) -> np.ndarray:
        v = self._vector(k)
        return np.zeros(0, kind) if v is None else np.frombuffer(self.buf, kind, v[1], v[0])

    def data(self, k: int) -> bytes:
        v = self._vector(k)
        return b"" if v is None else bytes(self.buf[v[0] : v[0] + v[1]])

    def table(self, k: int) -> Table | None:
        p = self._place(k)
        return None if p is None else Table(self.buf, p + struct.unpack_from("<I", self.buf, p)[0])

    def tables(self, k: int) -> list[Table]:
        v = self._vector(k)
        return [] if v is None else [Table(self.buf, p + struct.unpack_from("<I", self.buf, p)[0]) for p in range(v[0], v[0] + 4 * v[1], 4)]


@dataclass(frozen=True)
class Header:
    columns: tuple[tuple[str, int], ...]  # name, type
    kind: int
    srs: int
    count: int
    node_size: int
    tree: int  # where the tree begins
    features: int  # where the features begin

    @property
    def shown(self) -> list[tuple[str, str]]:
        """(name, Spark type) of the attributes as the table shows them."""
        return [(f"{n}_" if n.lower() in ("kind", "geom") else n, COLUMN_TYPES[t][0]) for n, t in self.columns]


def levels(count: int, node_size: int) -> list[int]:
    """Nodes of each level of the tree, the leaves first."""
    out = [count]
    while out[-1] > 1 or len(out) == 1:
        out.append(-(-out[-1] // node_size))
    return out


def _open(path: str) -> pa.NativeFile:
    fs, at = pyarrow.fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
    return fs.open_input_file(at)


def describe(path: str) -> Header:
    with _open(path) as f:
        head = f.read(12)
        if head[:7] != MAGIC:
            raise ValueError(f"{path} is no FlatGeobuf file of version 3")
        size = struct.unpack_from("<I", head, 8)[0]
        h = Table(f.read(size))
    columns = tuple((c.data(0).decode(), c.number(1, "B")) for c in h.tables(7))
    crs, count, node_size = h.table(10), h.number(8, "Q"), h.number(9, "H", 16)
    nodes = sum(levels(count, node_size)) if count and node_size else 0
    return Header(columns, h.number(2, "B"), crs.number(1, "i") if crs else 0, count, node_size if nodes else 0, 12 + size, 12 + size + nodes * NODE.itemsize)


def leaves(f: pa.NativeFile, h: Header, box: tuple[float, float, float, float] | None = None) -> np.ndarray:
    """The leaves that meet the box (all without one), in the file's order. Of the tree's other nodes only those that lead there are read."""
    sizes = levels(h.count, h.node_size)
    begin = np.cumsum([0, *sizes[::-1]])[:-1][::-1]  # of each level, the leaves' first: the root is stored first

    def nodes(first: int, n: int) -> np.ndarray:
        f.seek(h.tree + first * NODE.itemsize)
        return np.frombuffer(f.read(n * NODE.itemsize), NODE)

    if box is None:
        return nodes(int(begin[0]), h.count)
    meets = lambda v: (v["x0"] <= box[2]) & (v["x1"] >= box[0]) & (v["y0"] <= box[3]) & (v["y1"] >= box[1])
    at = np.zeros(1, np.int64)  # nodes of a level, by their place in it
    for level in range(len(sizes) - 1, -1, -1):
        own = [nodes(int(begin[level] + k), 1 + int(e - k)) for k, e in _stretches(at)]
        found = np.concatenate(own) if own else np.zeros(0, NODE)
        keep = meets(found)
        if level == 0:
            return found[keep]
        first = at[keep] * h.node_size
        at = np.concatenate([np.arange(k, min(k + h.node_size, sizes[level - 1])) for k in first.tolist()]) if len(first) else np.zeros(0, np.int64)
    return np.zeros(0, NODE)


def cuts(f: pa.NativeFile, h: Header, task_bytes: int) -> list[int]:
    """Where tasks begin, as offsets of features: those of some leaves, a task's bytes apart. Leaves lie in the order of their features;
    if those read show that they don't, all are read."""
    n = max(1, min(h.count, -(-(f.size() - h.features) // task_bytes)))
    first, some = sum(levels(h.count, h.node_size)) - h.count, []
    for k in range(n):
        f.seek(h.tree + (first + k * h.count // n) * NODE.itemsize)
        some.append(int(np.frombuffer(f.read(NODE.itemsize), NODE)["offset"][0]))
    if some[0] or any(x >= y for x, y in zip(some, some[1:], strict=False)):
        every = np.sort(leaves(f, h)["offset"].astype(np.int64))
        some = every[(np.arange(n) * h.count) // n].tolist()
    return some


def _stretches(at: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) of runs of consecutive places."""
    cut = np.flatnonzero(np.diff(at) != 1)
    return list(zip(at[np.r_[0, cut + 1]].tolist(), at[np.r_[cut, len(at) - 1]].tolist(), strict=True)) if len(at) else []


def _geometry(g: Table, kind: int) -> list[np.ndarray]:
    """The vertex lists of a geometry."""
    parts = g.tables(7)
    if parts:
        return [p for t in parts for p in _geometry(t, t.number(6, "B"))]
    xy, ends = g.numbers(1, "<f8").reshape(-1, 2), g.numbers(0, "<u4")
    if kind == 4:
        return list(xy[:, None])
    return [p for p in (np.split(xy, ends[:-1].astype(int)) if len(ends) > 1 else [xy]) if len(p)]


def decode(buf: bytes, h: Header) -> tuple[list, tuple[str, list[np.ndarray]] | None]:
    """(attributes, (kind, parts) or null) of a feature."""
    t = Table(buf)
    values: list = [None] * len(h.columns)
    data, at = t.data(1), 0
    while at < len(data):
        k = struct.unpack_from("<H", data, at)[0]
        spark, code = COLUMN_TYPES[h.columns[k][1]]
        at += 2
        if code:
            values[k] = struct.unpack_from(f"<{code}", data, at)[0]
            at += struct.calcsize(code)
        else:
            n = struct.unpack_from("<I", data, at)[0]
            raw, at = data[at + 4 : at + 4 + n], at + 4 + n
            values[k] = raw if spark == "binary" else raw.decode()
    g = t.table(0)
    kind = (g.number(6, "B") or h.kind) if g else 0
    return values, (KINDS[kind], _geometry(g, kind)) if g and kind in KINDS else None


@dataclass
class Stretch(InputPartition):
    """Runs of features (first byte, byte after the last) behind each other; an end of 0 is the file's."""

    runs: list[tuple[int, int]]


class FlatGeobufReader(DataSourceReader):
    def __init__(self, path: str, header: Header, box: tuple[float, float, float, float] | None, task_bytes: int):
        self.path, self.header, self.box, self.task_bytes = path, header, box, task_bytes

    def partitions(self) -> list[Stretch]:
        h = self.header
        with _open(self.path) as f:
            if not h.node_size:  # without a tree, lengths alone tell where features begin: one task walks them
                return [Stretch([(h.features, 0)])]
            if self.box is None:
                at = [h.features + k for k in cuts(f, h, self.task_bytes)]
                return [Stretch([r]) for r in zip(at, [*at[1:], f.size()], strict=True)]
            out, runs, held = [], [], 0
            for first in (np.sort(leaves(f, h, self.box)["offset"].astype(np.int64)) + h.features).tolist():
                f.seek(first)
                end = first + 4 + struct.unpack("<I", f.read(4))[0]
                if runs and runs[-1][1] == first:
                    runs[-1] = runs[-1][0], end
                else:
                    runs.append((first, end))
                held += end - first
                if held >= self.task_bytes:
                    out.append(Stretch(runs))
                    runs, held = [], 0
        return [*out, Stretch(runs)] if runs or not out else out

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        h, rows = self.header, []

        def batch() -> pa.RecordBatch:
            values, shapes = zip(*rows, strict=True)
            own = [pa.array([v[k] for v in values], _ARROW[t]) for k, (_, t) in enumerate(h.shown)]
            return pa.RecordBatch.from_arrays([*own, *geometry_columns(list(shapes))], names=[*[n for n, _ in h.shown], "kind", "geom"])

        with _open(self.path) as f:
            size = f.size()
            for first, end in partition.runs:
                f.seek(first)
                at = first
                while at < (end or size):
                    n = struct.unpack("<I", f.read(4))[0]
                    rows.append(decode(f.read(n), h))
                    at += 4 + n
                    if len(rows) >= 4096:
                        yield batch()
                        rows.clear()
        if rows:
            yield batch()


class FlatGeobuf(DataSource):
    """spark.read.format("flatgeobuf").option("box", "x0,y0,x1,y1").load(path), once registered. The box is in the file's own system."""

    @classmethod
    def name(cls) -> str:
        return "flatgeobuf"

    def schema(self) -> str:
        own = [f"`{n.replace('`', '``')}` {t}" for n, t in describe(self.options["path"]).shown]
        return ", ".join([*own, "kind string", f"geom {G.GEOM}"])

    def reader(self, schema: StructType) -> FlatGeobufReader:
        box = self.options.get("box")
        return FlatGeobufReader(self.options["path"], describe(self.options["path"]), tuple(map(float, box.split(","))) if box else None, int(self.options.get("bytes", TASK_BYTES)))


def read_fgb(spark: SparkSession, path: str, box: tuple[float, float, float, float] | None = None, task_bytes: int = TASK_BYTES) -> DataFrame:
    """A file's layer with geom in EPSG:25833; longitudes and latitudes are projected, other systems are an error. box: features whose
    bounds don't meet it are left out, if the file has a tree; it is in the file's own system."""
    srs = describe(path).srs
    if srs not in (METRES, DEGREES):
        raise ValueError(f"{path}: EPSG:{srs} isn't supported")
    spark.dataSource.register(FlatGeobuf)
    options = {"bytes": str(task_bytes)} | ({"box": ",".join(map(repr, box))} if box else {})
    df = spark.read.format("flatgeobuf").options(**options).load(path)
    if srs == DEGREES:
        df = df.withColumn("geom", F.transform("geom", lambda p: F.transform(p, lambda v: G.wgs84_to_utm33(v["x"], v["y"]))))
    return df
