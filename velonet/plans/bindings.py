"""Deterministic inputs for the operators, made from the bundled tables: no bundled table is geographic.

Each binding is a Spark DataFrame and, as SQL, a common table expression of the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velonet.functions import geometry as G

DAMAGE = "Schadensschild/StVO Zusatzeichen (Straßenschäden, Gehwegschäden, Radwegschäden)"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _sql(v: str | None) -> str:
    return "null" if v is None else "'" + v.replace("'", "''") + "'"


def pick(values: list[str | None], key: str, step: int = 1) -> Column:
    """The value at (key div step) % n."""
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (F.expr(f"{key} div {step} % {len(values)}") + 1).cast("int"))


def pick_sql(values: list[str | None], key: str, step: int = 1) -> str:
    return f"([{', '.join(map(_sql, values))}])[({key} // {step}) % {len(values)} + 1]"


# B1: segments of edges, from lineitem -----------------------------------------------------------------------------------
STRIPS, LIMITS = ["nein", "ja", "entfällt"], ["Physische Sperre", DAMAGE, "keine", None]
_ORDER = "partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"


def segments(spark: SparkSession, sf_dir: str, of: Callable[[DataFrame, str], DataFrame] = lambda rows, edge: rows) -> DataFrame:
    """of: which edges' rows are read (rows, name of the edge's column); a filter above wouldn't pass the window of the places."""
    return of(read(spark, sf_dir, "lineitem"), "l_orderkey").select(
        F.col("l_orderkey").alias("element_nr"),
        (F.col("l_linenumber") % 2).alias("ri"),
        F.expr(f"row_number() over ({_ORDER})").alias("seq"),
        F.col("l_quantity").alias("length"),
        F.col("l_returnflag").alias("fuehr"),
        (F.col("l_linestatus") == "F").alias("pflicht"),
        F.col("l_tax").alias("breite"),
        pick(STRIPS, "l_partkey").alias("trennstreifen"),
        pick(LIMITS, "l_suppkey").alias("nutz_beschr"),
        F.col("l_suppkey").cast("string").alias("tilda_id"),
        F.concat(F.lit("S"), (F.col("l_partkey") % 7).cast("string")).alias("strassenname"),
    )


SEGMENTS = f"""b1 as (select l_orderkey element_nr, l_linenumber % 2 ri, cast(row_number() over ({_ORDER}) as integer) seq, l_quantity length, l_returnflag fuehr, l_linestatus = 'F' pflicht, l_tax breite,
 {pick_sql(STRIPS, 'l_partkey')} trennstreifen, {pick_sql(LIMITS, 'l_suppkey')} nutz_beschr, cast(l_suppkey as varchar) tilda_id, 'S' || cast(l_partkey % 7 as varchar) strassenname from lineitem)"""

# B2: raw features, from events ------------------------------------------------------------------------------------------
FIELDS: dict[str, tuple[list[str | None], int]] = {
    "category": (
        [
            "bicycleRoad",
            "bicycleRoad_vehicleDestination",
            "cycleway_adjoining",
            "cycleway_isolated",
            "cyclewaySeparated_adjoining",
            "cyclewayOnHighway_advisory",
            "cyclewayOnHighway_exclusive",
            "cyclewayOnHighway_advisoryOrExclusive",
            "cyclewayOnHighwayBetweenLanes",
            "cyclewayOnHighwayProtected",
            "footAndCyclewayShared_adjoining",
            "footAndCyclewayShared_adjoiningOrIsolated",
            "footAndCyclewaySegregated_adjoining",
            "footwayBicycleYes_adjoining",
            "pedestrianAreaBicycleYes",
            "sharedBusLaneBikeWithBus",
            "sharedBusLaneBusWithBike",
            "sharedMotorVehicleLane",
            "crossing",
            "needsClarification",
            "somethingElse",
            None,
            " bicycleRoad ",
            "cyclewayOnHighwayProtected ",
            "footAndCyclewayShared_adjoining\t",
            "BicycleRoad",
            " cyclewayOnHighwayProtected",
        ],
        1,
    ),
    "oneway": (["yes", "no", "implicit_yes", "assumed_no", "car_not_bike", "yes_dual_carriageway", "", None, " none ", "-1"], 3),
    "oneway_bicycle": (["no", "yes", None], 7),
    "traffic_sign": (["DE:240", "DE:237", "DE:239,1022-10", "DE:242.1,1022-10", "none", None, "DE:1022-10,Gehwegschäden", "241", "DE:2401", "", "DE:241, 1022-10", "nan", "Strassenschaeden", " none ", " DE:240 "], 5),
    "traffic_sign_forward": ([None, "DE:237", "none"], 11),
    "traffic_sign_backward": ([None, None, "DE:1,241"], 13),
    "surface": (["asphalt", " Sett ", "sett", "wood", None, "none", "concrete:plates", "", "gravel", "mosaic_sett", "small_sett", "unknownium", "cobblestone"], 2),
    "surface_color": (["red", "Green ", None, "blue"], 4),
    "separation": (["bollard", None, "no", "planter", "", " Bump"], 6),
    "separation_left": ([None, "bump", "", "kerb", " Bollard ", None], 9),
    "separation_right": (["vertical_panel", None, "guard_rail", "NO "], 12),
    "traffic_mode": ([None, "parking"], 30),
    "traffic_mode_left": (["parking", None, "motor_vehicle", " Parking"], 8),
    "traffic_mode_right": ([None, "parking", "Parking ", "foot"], 10),
    "marking": ([None, "barred_area", "Barred_Area;solid_line"], 31),
    "marking_left": ([None, "dashed_line", "barred_area", "Dashed_Line"], 14),
    "marking_right": (["solid_line;barred_area", None, "SOLID_LINE", ""], 15),
    "buffer_left": ([None, "0", "0.5"], 16),
    "buffer_right": (["0.6", None, "0", "x", "1.5", "nan", " 0.7 ", "0.59"], 17),
    "lifecycle": (["construction", None, "temporary", " Construction"], 18),
    "updated_by": (["fmc_anna", "someone", None], 19),
    "width": (["2.5 m", "3 meter", "3 metres", "2,5", "250 cm", "2.5;3", " 1.25 ", None, "0", "1.75m", "4", "0.15", "0.25 m", "2.35", "0.45", "1.05", "0 m", "3.65m;2", "-0.05", "12.95", "-2.25"], 20),
    "width_source": ([None, "survey"], 21),
    "mapillary": ([None, None, "123"], 22),
    "mapillary_left": ([None, None, None, "4"], 23),
    "mapillary_right": ([None, "5", None, None, None], 24),
    "mapillary_traffic_sign": ([None, "77"], 25),
    "bikelane_left": (["separate_geometry", "data_no", "missing", "cycleway_adjoining", None], 26),
    "bikelane_right": (["missing", "assumed_no", "cyclewayOnHighway_advisory", "not_expected", None, "data_no"], 27),
    "bikelane_self": (["data_no", "missing", None, "cycleway_adjoining"], 28),
    "road": (["residential", "primary", "service_road", "secondary", None], 29),
}
_UPDATED = "1700000000 + (event_id * 79190) % 100000000"


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("id"), F.col("user_id").alias("osm_id"), "event_type", F.expr(f"{_UPDATED} as updated_at"), *[pick(v, "event_id", step).alias(c) for c, (v, step) in FIELDS.items()])


FEATURES = f"b2 as (select event_id id, user_id osm_id, event_type, {_UPDATED} updated_at, {', '.join(f'{pick_sql(v, "event_id", step)} {c}' for c, (v, step) in FIELDS.items())} from events)"

# B3: polylines, from embeddings; a line has 32 vertices -----------------------------------------------------------------


def polylines(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.transform("embedding", lambda v: v.cast("double") * 100)
    vertices = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.struct(F.get(F.col("e"), 2 * i).alias("x"), F.get(F.col("e"), 2 * i + 1).alias("y")))
    return read(spark, sf_dir, "embeddings").select("vec_id", e.alias("e")).select("vec_id", F.array(vertices).alias("geom"))


POLYLINES = """b3 as (select vec_id, [{'x': cast(embedding[2 * i + 1] as double) * 100, 'y': cast(embedding[2 * i + 2] as double) * 100} for i in range(32)] v from embeddings),
b3s as (select vec_id, i, v[i].x ax, v[i].y ay, v[i + 1].x bx, v[i + 1].y by_ from b3, range(1, 32) r(i))"""

# B4: straight ways, from orders; every 1000 keys have a square of their own ----------------------------------------------
_WAY = "o_orderkey * 37 % 1000 + 1100 * (o_orderkey {div} 1000) ax, o_custkey * 53 % 1000 ay, o_orderkey * 37 % 1000 + 1100 * (o_orderkey {div} 1000) + o_orderkey % 61 - 30 bx, o_custkey * 53 % 1000 + o_custkey % 59 - 29 by_"
FACILITIES = ["Mischverkehr mit motorisiertem Verkehr", "Radweg", "Radfahrstreifen", None]
WAY_CATEGORIES = ["bicycleRoad", "cycleway_adjoining", "footAndCyclewayShared", "sharedMotorVehicleLane", None]
WAY_SIGNS = ["DE:240", None, "none"]
TRAFFIC = ["Einrichtungsverkehr", "Zweirichtungsverkehr", "Einrichtungsverkehr"]
WAY_ONEWAY = ["yes", None, "yes", "yes_dual_carriageway", "no"]
WIDTHS = ["1.5", "2.0", None]


def ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = read(spark, sf_dir, "orders").selectExpr("o_orderkey id", "o_orderstatus status", *_WAY.format(div="div").split(", "))
    w = w.where("ax <> bx or ay <> by_")
    return w.select(
        "id",
        "status",
        G.line(G.point(F.col("ax"), F.col("ay")), G.point(F.col("bx"), F.col("by_"))).alias("geom"),
        pick(FACILITIES, "id").alias("fuehr"),
        pick(TRAFFIC, "id", 2).alias("verkehrsri"),
        pick(WAY_CATEGORIES, "id", 3).alias("tilda_category"),
        pick(WAY_SIGNS, "id", 4).alias("tilda_traffic_sign"),
        pick(WAY_ONEWAY, "id", 5).alias("tilda_oneway"),
        pick(WIDTHS, "id", 7).try_cast("double").alias("breite"),
    )


def network(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ways(spark, sf_dir).where("status = 'P'").select("id", "geom")


def other_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ways(spark, sf_dir).where("status <> 'P'").drop("status")


WAYS = f"""w0 as (select o_orderkey id, o_orderstatus status, {_WAY.format(div='//')}, o_orderkey oid from orders),
b4 as (select id, status, cast(ax as double) ax, cast(ay as double) ay, cast(bx as double) bx, cast(by_ as double) by_, {pick_sql(FACILITIES, 'id')} fuehr, {pick_sql(TRAFFIC, 'id', 2)} verkehrsri,
 {pick_sql(WAY_CATEGORIES, 'id', 3)} tilda_category, {pick_sql(WAY_SIGNS, 'id', 4)} tilda_traffic_sign, {pick_sql(WAY_ONEWAY, 'id', 5)} tilda_oneway, try_cast({pick_sql(WIDTHS, 'id', 7)} as double) breite
 from w0 where ax <> bx or ay <> by_),
net as (select id, ax, ay, bx, by_ from b4 where status = 'P'), wy as (select * from b4 where status <> 'P')"""

# B5: districts, squares of 200 m from nation; B6: points from customer and supplier --------------------------------------


def districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation").selectExpr("n_nationkey k", "cast(200 * (n_nationkey % 5) as double) x", "cast(200 * (n_nationkey div 5) as double) y")
    p = lambda dx, dy: G.point(F.col("x") + dx, F.col("y") + dy)
    return n.select("k", F.concat(F.lit("11"), F.lpad(F.col("k").cast("string"), 3, "0")).alias("gem"), F.array(F.array(p(0, 0), p(200, 0), p(200, 200), p(0, 200), p(0, 0))).alias("rings"))


DISTRICTS = "b5 as (select n_nationkey k, '11' || lpad(cast(n_nationkey as varchar), 3, '0') gem, cast(200 * (n_nationkey % 5) as double) x, cast(200 * (n_nationkey // 5) as double) y from nation)"


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").selectExpr("c_custkey id", "cast(c_custkey * 7919 % 1000 as double) x", "cast(c_custkey * 104729 % 997 as double) y")


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "supplier").selectExpr("s_suppkey id", "cast(s_suppkey * 7919 % 1000 as double) x", "cast(s_suppkey * 104729 % 997 as double) y")


POINTS = """cp as (select c_custkey id, cast(c_custkey * 7919 % 1000 as double) x, cast(c_custkey * 104729 % 997 as double) y from customer),
sp as (select s_suppkey id, cast(s_suppkey * 7919 % 1000 as double) x, cast(s_suppkey * 104729 % 997 as double) y from supplier)"""
