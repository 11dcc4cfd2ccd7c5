"""GeoPackage layers: SQLite tables with binary geometries, read by ranges of row numbers, one range a task.

SQLite reads no object stores, so the file must be at one path for driver and executors (a shared mount). Attributes become
bigint, double, boolean, binary or string columns; the geometry becomes kind and geom. A null geometry stays null, an empty
one has no parts; heights and measures are left out. An attribute called kind or geom gets an underscore.
"""

from __future__ import annotations

import sqlite3
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from velonet.functions import geometry as G

KINDS = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon", 7: "GeometryCollection"}
METRES, DEGREES = 25833, 4326
ROWS = 50_000  # of a task
_SPARK = {"INTEGER": "bigint", "REAL": "double", "BOOLEAN": "boolean", "BLOB": "binary", "TEXT": "string"}
_ARROW = {"bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}


def _open(path: str) -> sqlite3.Connection:
    local = path.removeprefix("file://")
    return sqlite3.connect(f"file:{local.replace('%', '%25').replace('?', '%3f').replace('#', '%23')}?mode=ro", uri=True)


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def layer_names(path: str) -> list[str]:
    """The layers with geometries, in the file's order."""
    with _open(path) as db:
        return [n for (n,) in db.execute("SELECT c.table_name FROM gpkg_contents c JOIN gpkg_geometry_columns g USING (table_name) WHERE c.data_type = 'features' ORDER BY c.rowid")]


def _kind_of(declared: str) -> str:
    t = declared.upper().partition("(")[0].strip()
    if t in ("INTEGER", "INT", "MEDIUMINT", "SMALLINT", "TINYINT", "BIGINT"):
        return "INTEGER"
    return "REAL" if t in ("REAL", "DOUBLE", "FLOAT") else t if t in ("BOOLEAN", "BLOB") else "TEXT"


@dataclass(frozen=True)
class Layer:
    table: str
    geometry: str
    srs: int
    attributes: tuple[tuple[str, str], ...]  # name, kind

    @property
    def columns(self) -> list[tuple[str, str]]:
        """(name, Spark type) of the attributes as the table shows them."""
        return [(f"{n}_" if n.lower() in ("kind", "geom") else n, _SPARK[k]) for n, k in self.attributes]


def describe(path: str, layer: str | None = None) -> Layer:
    """A layer's columns and coordinate system; the file's first layer if none is named."""
    names = layer_names(path)
    if not names or (layer and layer not in names):
        raise ValueError(f"no layer {layer or 'with geometries'} in {path}")
    table = layer or names[0]
    with _open(path) as db:
        geometry, srs = db.execute("SELECT g.column_name, coalesce(s.organization_coordsys_id, g.srs_id) FROM gpkg_geometry_columns g LEFT JOIN gpkg_spatial_ref_sys s ON s.srs_id = g.srs_id WHERE g.table_name = ?", (table,)).fetchone()
        own = tuple((r[1], _kind_of(r[2] or "")) for r in db.execute(f"PRAGMA table_info({_quoted(table)})") if r[1] != geometry)
    return Layer(table, geometry, srs, own)


def _parts(wkb: bytes, at: int) -> tuple[list[np.ndarray], int]:
    """The vertex lists of a geometry that begins there, and where it ends."""
    order = "<" if wkb[at] else ">"
    code, n = struct.unpack_from(f"{order}I", wkb, at + 1)[0], 1
    kind, dims = code % 1000, (2, 3, 3, 4)[code // 1000]
    at += 5
    out: list[np.ndarray] = []
    if kind != 1:
        n, at = struct.unpack_from(f"{order}I", wkb, at)[0], at + 4
    if kind > 3:
        for _ in range(n):
            more, at = _parts(wkb, at)
            out += more
        return out, at
    for _ in range(n if kind == 3 else 1):
        count = n
        if kind == 3:
            count, at = struct.unpack_from(f"{order}I", wkb, at)[0], at + 4
        out.append(np.frombuffer(wkb, f"{order}f8", count * dims, at).reshape(count, dims)[:, :2])
        at += 8 * dims * count
    return out, at


def decode(blob: bytes | None) -> tuple[str, list[np.ndarray]] | None:
    """(kind, parts) of a binary geometry; null for null."""
    if blob is None:
        return None
    flags = blob[3]
    start = 8 + (0, 32, 48, 48, 64)[flags >> 1 & 7]
    code = struct.unpack_from("<I" if blob[start] else ">I", blob, start + 1)[0] % 1000
    return KINDS[code], [] if flags & 16 else [p for p in _parts(blob, start)[0] if len(p)]


def geometry_columns(found: list[tuple[str, list[np.ndarray]] | None]) -> tuple[pa.Array, pa.Array]:
    """Columns kind and geom of (kind, parts)."""
    parts = [p for f in found if f for p in f[1]]
    xy = np.concatenate(parts).astype("f8") if parts else np.zeros((0, 2))
    vertices = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(xy[:, k])) for k in (0, 1)], names=["x", "y"])
    lines = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]), pa.int32()), vertices)
    ends = np.cumsum([len(f[1]) if f else 0 for f in found]).tolist()
    starts = [None if f is None else e - len(f[1]) for f, e in zip(found, ends, strict=True)]
    return pa.array([f[0] if f else None for f in found], pa.string()), pa.ListArray.from_arrays(pa.array([*starts, ends[-1]], pa.int32()), lines)


@dataclass
class Range(InputPartition):
    """Row numbers of a task, both ends included."""

    first: int
    last: int


class GeoPackageReader(DataSourceReader):
    def __init__(self, path: str, layer: Layer, rows: int):
        self.path, self.layer, self.rows = path, layer, rows

    def partitions(self) -> list[Range]:
        with _open(self.path) as db:
            least, most = db.execute(f"SELECT min(rowid), max(rowid) FROM {_quoted(self.layer.table)}").fetchone()
        return [Range(1, 0)] if least is None else [Range(k, min(k + self.rows - 1, most)) for k in range(least, most + 1, self.rows)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        as_kind = {"INTEGER": "CAST({} AS INTEGER)", "REAL": "CAST({} AS REAL)", "BOOLEAN": "{} <> 0", "BLOB": "CAST({} AS BLOB)", "TEXT": "CAST({} AS TEXT)"}
        wanted = [as_kind[k].format(_quoted(n)) for n, k in self.layer.attributes] + [_quoted(self.layer.geometry)]
        types = [_ARROW[t] for _, t in self.layer.columns]
        names = [n for n, _ in self.layer.columns] + ["kind", "geom"]
        with _open(self.path) as db:
            rows = db.execute(f"SELECT {', '.join(wanted)} FROM {_quoted(self.layer.table)} WHERE rowid BETWEEN ? AND ?", (partition.first, partition.last))
            while some := rows.fetchmany(4096):
                *values, blobs = zip(*some, strict=True)
                own = [pa.array([None if v is None else bool(v) for v in c] if t == pa.bool_() else c, t) for c, t in zip(values, types, strict=True)]
                yield pa.RecordBatch.from_arrays([*own, *geometry_columns([decode(b) for b in blobs])], names=names)


class GeoPackage(DataSource):
    """spark.read.format("geopackage").option("layer", ...).load(path), once registered."""

    @classmethod
    def name(cls) -> str:
        return "geopackage"

    def _layer(self) -> Layer:
        return describe(self.options["path"], self.options.get("layer"))

    def schema(self) -> str:
        own = [f"`{n.replace('`', '``')}` {t}" for n, t in self._layer().columns]
        return ", ".join([*own, "kind string", f"geom {G.GEOM}"])

    def reader(self, schema: StructType) -> GeoPackageReader:
        return GeoPackageReader(self.options["path"], self._layer(), int(self.options.get("rows", ROWS)))


def read_gpkg(spark: SparkSession, path: str, layer: str | None = None, rows: int = ROWS) -> DataFrame:
    """A layer (the first if none is named) with geom in EPSG:25833; longitudes and latitudes are projected, other systems are an error."""
    srs = describe(path, layer).srs
    if srs not in (METRES, DEGREES):
        raise ValueError(f"{path}: EPSG:{srs} isn't supported")
    spark.dataSource.register(GeoPackage)
    options = {"rows": str(rows)} | ({"layer": layer} if layer else {})
    df = spark.read.format("geopackage").options(**options).load(path)
    if srs == DEGREES:
        df = df.withColumn("geom", F.transform("geom", lambda p: F.transform(p, lambda v: G.wgs84_to_utm33(v["x"], v["y"]))))
    return df
