"""Text rules, translation and quality rules, with nulls and absent columns."""

import pytest
from pyspark.sql import functions as F

from velonet.functions import text as T
from velonet.operators import quality_rules, translate


def one(spark, column, **values):
    schema = ", ".join(f"`{k}` {'bigint' if isinstance(v, int) and not isinstance(v, bool) else 'string'}" for k, v in values.items()) or "x string"
    df = spark.createDataFrame([tuple(values.values()) or (None,)], schema)
    return df.select(column(df).alias("v")).first().v


@pytest.mark.parametrize(("text", "want"), [("2.5 m", 2.5), ("3 meter", 3.0), ("2.5m", 2.5), ("2.5;3", 2.5), ("3 metres", None), ("3 meters", None), ("3 metre", None), ("250 cm", None), ("2,5", None), ("0", 0.0), ("", None), (None, None), (" 1.25 ", 1.2), ("2.5d", None), ("0 m", 0.0), ("0.15", 0.1), ("nan", None)])
def test_width(spark, text, want):
    assert one(spark, lambda d: T.parse_width(F.col("w")), w=text) == want


def test_width_of_numbers(spark):
    df = spark.createDataFrame([(0.0,), (2.25,), (float("nan"),), (None,)], "w double")
    assert [r.v for r in df.select(T.parse_width(F.col("w"), "double").alias("v")).collect()] == [None, 2.2, None, None]


def test_one_decimal_is_that_of_the_number(spark):
    """As round(x, 1) of Python: of the double's exact value, halves to the even."""
    import random

    r = random.Random(2)
    values = [k / 100 for k in range(-100, 1000)] + [k / 20 for k in range(300)] + [r.uniform(-1e6, 1e6) for _ in range(500)] + [round(r.uniform(0, 1e9), 2) for _ in range(500)] + [1e300, 0.05, 1e-300, 123456789012345.25]
    df = spark.createDataFrame([(v,) for v in values], "x double").coalesce(1)
    assert [r.v for r in df.select(T.round1(F.col("x")).alias("v")).collect()] == [round(v, 1) for v in values]


@pytest.mark.parametrize(("value", "sign", "want"), [("DE:240", "240", True), ("DE:2401", "240", True), ("DE:242.1", "242", True), ("DE:1,240", "240", True), ("240", "240", False), ("DE:1, 240", "240", True), (None, "240", False), ("", "240", False)])
def test_sign(spark, value, sign, want):
    assert one(spark, lambda d: T.has_traffic_sign(F.col("v0"), sign), v0=value) is want


@pytest.mark.parametrize(("a", "b", "want"), [("true", "ja", True), ("false", "0", True), ("true", "nein", False), ("8", "08", True), ("2.50", "2.5", True), ("x", "x", True), ("x", "X", False), (None, "x", False)])
def test_same_value(spark, a, b, want):
    assert one(spark, lambda d: T.same_value(F.col("a"), F.col("b")), a=a, b=b) is want


def test_null_text_decides_missing_or_wrong(spark):
    f = lambda n: one(spark, lambda d: translate.verkehrsri(d, "bikelanes", n), oneway=None)
    assert f("None") == translate.MISSING_VALUE and f("nan") == translate.WRONG_VALUE
    assert one(spark, lambda d: translate.verkehrsri(d, "bikelanes"), other="x") == translate.MISSING_VALUE
    s = lambda n: one(spark, lambda d: translate.ofm(d, n), surface=None)
    assert s("None") == "[TODO] Oberfläche Fehlt" and s("nan") == "NICHT-GEFUNDEN"
    c = lambda n: one(spark, lambda d: translate.fuehrung(d, "bikelanes", n), category="cycleway_adjoining", traffic_sign=None)
    assert c("None") == "Radweg" and c("nan") == translate.OTHER_WAYS


def test_bicycle_road_of_sett(spark):
    """The first golden case's attributes."""
    df = spark.createDataFrame([(1, "bicycleRoad", "sett", "yes", None, 1)], "id long, category string, surface string, oneway string, traffic_sign string, lit int")
    df = df.withColumn("geom", F.expr("array(array(named_struct('x', 0d, 'y', 0d), named_struct('x', 3d, 'y', 4d), named_struct('x', 3d, 'y', 4.5d)))"))
    r = translate.translate(df, "bikelanes").first().asDict()
    want = {"verkehrsri": "Einrichtungsverkehr", "fuehr": "Fahrradstraße /-zone (Z 244)", "pflicht": False, "ofm": "Kopfsteinpflaster / Großstein", "farbe": False, "protek": "Ohne", "trennstreifen": "nein", "nutz_beschr": "keine", "Länge": 6, "tilda_id": 1, "Kommentar": None, "breite": None}
    assert {k: r[k] for k in want} == want and "tilda_lit" not in r and list(r)[-1] == "geom" and list(r)[:-1] == sorted(list(r)[:-1])


@pytest.mark.parametrize(
    ("tags", "want"),
    [
        ({"category": "x"}, "Ohne"),
        ({"category": "cyclewayOnHighwayProtected"}, "[TODO] Protektionstyp fehlt"),
        ({"category": "cyclewayOnHighwayProtected", "separation": "no", "separation_left": ""}, "Ohne"),
        ({"category": "cyclewayOnHighwayProtected", "separation_right": "bump"}, "Schwellen (auf Sperrfläche)"),
        ({"category": "cyclewayOnHighwayProtected", "traffic_mode_right": "parking", "marking_right": "barred_area", "separation_left": "kerb"}, "Ruhender Verkehr (mit Sperrfläche)"),
        ({"category": " cyclewayOnHighwayProtected", "separation": "Bollard "}, "Poller (auf Sperrfläche)"),
        ({"category": "cyclewayOnHighwayProtected", "traffic_mode_left": " Parking", "marking": "Barred_Area"}, "Ruhender Verkehr (mit Sperrfläche)"),
        ({"category": "cyclewayOnHighwayProtected", "traffic_mode": "parking", "marking": "barred_area"}, "[TODO] Protektionstyp fehlt"),
    ],
)
def test_protection(spark, tags, want):
    assert one(spark, translate.protek, **tags) == want


@pytest.mark.parametrize(
    ("tags", "want"),
    [
        ({"category": "bicycleRoad", "traffic_mode_left": "Parking ", "marking_left": " Dashed_line"}, "ja"),
        ({"category": " BicycleRoad", "traffic_mode_left": "foot"}, "nein"),
        ({"category": "x", "traffic_mode_right": "PARKING", "buffer_right": "nan"}, "nein"),
        ({"category": "x", "traffic_mode_right": "parking", "buffer_right": " 0.6 "}, "ja"),
        ({"category": "x", "traffic_mode_right": "parking", "buffer_right": "1d"}, "nein"),
        ({"category": "x", "traffic_mode_left": "parking"}, "entfällt"),
    ],
)
def test_safety_strip(spark, tags, want):
    assert one(spark, translate.trennstreifen, **tags) == want


def test_facility_of_padded_tags(spark):
    assert one(spark, lambda d: translate.fuehrung(d, "bikelanes"), category="bicycleRoad ", traffic_sign=None) == "Fahrradstraße /-zone (Z 244)"
    assert one(spark, lambda d: translate.fuehrung(d, "bikelanes"), category="cycleway_adjoining", traffic_sign=" none ") == translate.OTHER_WAYS


@pytest.mark.parametrize(("tags", "want"), [({"lifecycle": " Construction", "updated_at": "86400.9"}, "Derzeit Baustelle (Stand 02.01.1970)"), ({"lifecycle": "construction", "updated_at": 0}, "Derzeit Baustelle (Stand unbekannt)"), ({"lifecycle": "construction", "updated_at": "soon"}, "Derzeit Baustelle (Stand unbekannt)"), ({"lifecycle": "construction", "updated_at": 86400}, "Derzeit Baustelle (Stand 02.01.1970)"), ({"lifecycle": "construction"}, "Derzeit Baustelle (Stand unbekannt)"), ({"lifecycle": None}, None)])
def test_comment(spark, tags, want):
    assert one(spark, translate.kommentar, **tags) == want


def test_quality_rules_on_empty_features(spark):
    """A feature without tags, and one whose columns are absent, get the same labels."""
    null = spark.createDataFrame([(None,) * 4], "category string, oneway string, traffic_sign string, updated_by string")
    absent = spark.createDataFrame([(1,)], "id long")
    for name, rule in quality_rules.RULES.items():
        assert null.select(rule(null)).first()[0] == absent.select(rule(absent)).first()[0] is not None, name
    assert quality_rules.classify(null, "bikelanes").first().qa_update_source is None
    assert quality_rules.classify(null, "paths").first().qa_update_source == "other_old"


def test_streams_get_what_batches_get(spark, tmp_path):
    from velonet.streaming import classify_stream, write_stream

    df = spark.createDataFrame([(1, "sett"), (2, None)], "id long, surface string")
    df.write.parquet(f"{tmp_path}/in")
    stream = classify_stream(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"), "paths")
    write_stream(stream, f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
    got = {r.id: r.qa_surface_sett for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {1: "generic", 2: "other"}
