"""Readers and writers: line layers as Parquet, GeoJSON, GeoPackage or FlatGeobuf (read only), id lists, test cases, exports.

The readers here take `path` or `path:layer`, the layer being a table of a GeoPackage, else a folder below the path; a FlatGeobuf
file has one layer, whatever its name.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velonet.functions import geometry as G
from velonet.operators.sets import common_columns
from velonet.sources.flatgeobuf import read_fgb
from velonet.sources.gpkg import read_gpkg

GEOJSON = "type string, id string, geometry struct<type:string,coordinates:string>, properties map<string,string>"


@dataclass(frozen=True)
class LayerSource:
    """A layer, where it is, and the radius of its buffer in metres."""

    name: str
    path: str
    buffer: float


def default_sources(folder: str, suffix: str = "") -> dict[str, LayerSource]:
    return {n: LayerSource(n, f"{folder}/{n}{suffix}.parquet", b) for n, b in (("bikelanes", 25.0), ("streets", 15.0), ("paths", 15.0))}


def output_name(path: str, clipped: bool) -> str:
    """The path with a suffix before its ending, for results cut to one district."""
    return re.sub(r"(\.\w+)?$", r"_clipped\1", path, count=1) if clipped else path


def split_layer(path: str) -> tuple[str, str | None]:
    """path[:layer]; a colon after a scheme or before a slash names no layer."""
    m = re.fullmatch(r"(.+?):([^:/\\]+)", path)
    return (m[1], m[2]) if m and not re.fullmatch(r"[a-z]\w*", m[1]) else (path, None)


def file_type(path: str) -> str:
    """'parquet', 'geojson', 'gpkg' or 'fgb' by the ending; others are an error."""
    end = split_layer(path)[0].rstrip("/").rpartition(".")[2].lower()
    if end in ("parquet", "gpkg", "fgb", "geojson", "geojsonl", "json"):
        return end if end in ("parquet", "gpkg", "fgb") else "geojson"
    raise ValueError(f"unknown file type {end!r}: {path}")


def _coordinates(kind: Column, text: Column) -> Column:
    """GeoJSON coordinates as geom: a point is a part of one vertex, a polygon its rings."""
    pair = "array<double>"
    multi = F.from_json(text, f"array<array<{pair}>>")
    single, one = F.from_json(text, f"array<{pair}>"), F.from_json(text, pair)
    parts = F.when(kind.isin("MultiLineString", "Polygon"), multi).when(kind.isin("LineString", "MultiPoint"), F.array(single)).when(kind == "Point", F.array(F.array(one)))
    return F.transform(parts, lambda p: F.transform(p, lambda v: F.struct(F.get(v, 0).alias("x"), F.get(v, 1).alias("y"))))


def read_geojson(spark: SparkSession, path: str, wgs84: bool = True, multiline: bool = False) -> DataFrame:
    """Features, one a line (or a collection, multiline): properties as text columns' map, kind, geom in EPSG:25833."""
    raw = spark.read.text(path, wholetext=multiline)
    if multiline:
        raw = raw.select(F.explode(F.from_json("value", "features array<string>")["features"]).alias("value"))
    f = raw.select(F.from_json("value", GEOJSON).alias("f")).where("f.geometry is not null")
    geom = _coordinates(F.col("f.geometry.type"), F.col("f.geometry.coordinates"))
    if wgs84:
        geom = F.transform(geom, lambda p: F.transform(p, lambda v: G.wgs84_to_utm33(v["x"], v["y"])))
    return f.select(F.col("f.id").alias("id"), F.col("f.properties").alias("properties"), F.col("f.geometry.type").alias("kind"), geom.alias("geom"))


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """A layer by its ending; path[:layer]."""
    base, layer = split_layer(path)
    if file_type(path) == "gpkg":
        return read_gpkg(spark, base, layer)
    if file_type(path) == "fgb":
        return read_fgb(spark, base)
    full = f"{base}/{layer}" if layer else base
    return spark.read.parquet(full) if file_type(path) == "parquet" else read_geojson(spark, full)


def read_layers(spark: SparkSession, path: str, layers: list[str], order: tuple[str, ...] = ("element_nr", "ri")) -> DataFrame:
    """Several layers of a folder or a GeoPackage as one table of their common columns, in order."""
    one = (lambda x: read_gpkg(spark, path, x)) if file_type(path) == "gpkg" else (lambda x: spark.read.parquet(f"{path}/{x}"))
    return common_columns([one(x) for x in layers], order)


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """(id) the distinct whole numbers of a text file, one a line; '#' begins a comment; other lines are left out.

    A missing file is an empty list."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not fs_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(fs_path):
        return spark.createDataFrame([], "id bigint")
    return parse_id_list(spark.read.text(path))


def parse_id_list(lines: DataFrame, column: str = "value") -> DataFrame:
    value = F.trim(F.substring_index(F.col(column), "#", 1))
    return lines.select(value.try_cast("bigint").alias("id")).where("id is not null").distinct()


def write_id_list(df: DataFrame, id_col: str, path: str) -> None:
    """The distinct ids, one a line."""
    df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("value")).distinct().write.mode("overwrite").text(path)


def write_layer(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_directions(df: DataFrame, path: str) -> None:
    """A folder for each direction below path; one table at path if there is no direction column."""
    from velonet.operators.edges import split_directions

    for name, part in split_directions(df).items():
        write_layer(part, path if name == "all" else f"{path}/{name}")


def to_geojson(df: DataFrame, wgs84: bool = True, geom: str = "geom") -> DataFrame:
    """(value) a GeoJSON feature for each row, in longitude and latitude with 7 decimals: LineString if it has one part."""
    g = F.col(geom)
    if wgs84:
        g = F.transform(g, lambda p: F.transform(p, lambda v: G.utm33_to_wgs84(v["x"], v["y"])))
    parts = F.transform(g, lambda p: F.transform(p, lambda v: F.array(F.round(v["x"], 7), F.round(v["y"], 7))))
    one = F.size(g) == 1
    shape = F.when(one, F.to_json(F.struct(F.lit("LineString").alias("type"), F.get(parts, 0).alias("coordinates")))).otherwise(F.to_json(F.struct(F.lit("MultiLineString").alias("type"), parts.alias("coordinates"))))
    properties = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != geom]), {"ignoreNullFields": "false"})
    return df.select(F.concat(F.lit('{"type":"Feature","properties":'), properties, F.lit(',"geometry":'), shape, F.lit("}")).alias("value"))


def export_geojson(df: DataFrame, path: str, wgs84: bool = True) -> None:
    """Line-delimited features, in parallel files."""
    to_geojson(df, wgs84).write.mode("overwrite").text(path)


def export_all(spark: SparkSession, paths: list[str], out: str) -> None:
    """Each layer to out/<its name>."""
    for p in paths:
        name = split_layer(p)[0].rstrip("/").rpartition("/")[2].rpartition(".")[0]
        export_geojson(read_layer(spark, p), f"{out}/{name}")


def read_cases(spark: SparkSession, path: str) -> list[dict]:
    """Test cases of a JSON file with an array of objects (a small file by its nature: it is read whole)."""
    import json

    text = spark.read.text(path, wholetext=True).first()
    return json.loads(text[0]) if text else []
