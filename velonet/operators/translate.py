"""Raw map tags to the official attribute scheme: one projection of CASE chains for each layer."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velonet.functions.geometry import length
from velonet.functions.text import NULL_TEXT, among, contains_any, epoch_day, has_traffic_sign, lookup, low, number, opt, parse_width, starts_with_any, strip, txt, whole

LAYERS = ("bikelanes", "streets", "paths")

# Fixed values ---------------------------------------------------------------------------------------------------------
ONE_WAY, TWO_WAY = "Einrichtungsverkehr", "Zweirichtungsverkehr"
MISSING_VALUE, WRONG_VALUE = "[TODO] Fehlender Wert", "[TODO] Fehlerhafter Wert"
MIXED = "Mischverkehr mit motorisiertem Verkehr"
OTHER_WAYS = "Sonstige Wege (Gehwege, Wege durch Grünflächen, Plätze)"
SURFACES = {
    "asphalt": "Asphalt",
    "concrete": "Beton (Platte etc.)",
    "concrete:plates": "Beton (Platte etc.)",
    "concrete:lanes": "Beton (Platte etc.)",
    "paving_stones": "Gepflastert (Berliner Platte, Mosaik, Kleinstein...)",
    "mosaic_sett": "Gepflastert (Berliner Platte, Mosaik, Kleinstein...)",
    "small_sett": "Gepflastert (Berliner Platte, Mosaik, Kleinstein...)",
    "large_sett": "Gepflastert (Berliner Platte, Mosaik, Kleinstein...)",
    "sett": "Kopfsteinpflaster / Großstein",
    "cobblestone": "Kopfsteinpflaster / Großstein",
    "bricks": "Kopfsteinpflaster / Großstein",
    "stone": "Kopfsteinpflaster / Großstein",
    "unpaved": "Ungebunden",
    "ground": "Ungebunden",
    "grass": "Ungebunden",
    "sand": "Ungebunden",
    "compacted": "Ungebunden",
    "fine_gravel": "Ungebunden",
    "pebblestone": "Ungebunden",
    "gravel": "Ungebunden",
}
UNCLEAR_SURFACES = ("grass_paver", "wood", "metal", "paved")
SEPARATIONS = {
    "bollard": "Poller (auf Sperrfläche)",
    "bump": "Schwellen (auf Sperrfläche)",
    "vertical_panel": "Leitboys (flexibel, auf Breitstrich, ohne Sperrfläche)",
    "planter": "Sonstige (z.B. Pflanzkübel, Leitplanke)",
    "guard_rail": "Sonstige (z.B. Pflanzkübel, Leitplanke)",
    "no": "Ohne",
}
OBLIGATORY_SIGNS = ("237", "240", "241")
DAMAGE_SIGNS = ("Gehwegschäden", "Radwegschäden", "Geh- und Radwegschäden")
DAMAGE = "Schadensschild/StVO Zusatzeichen (Straßenschäden, Gehwegschäden, Radwegschäden)"
DROPPED_TAGS = (
    "lit",
    "description",
    "maxspeed_name_ref",
    "maxspeed_confidence",
    "maxspeed_conditional",
    "maxspeed_source",
    "mapillary_coverage",
    "bridge",
    "tunnel",
    "todos",
    "updated_age",
    "updated_at",
    "width_source",
    "surface_confidence",
    "surface_source",
    "smoothness_confidence",
    "smoothness_source",
    "length",
    "offset",
    "_parent_highway",
)
DERIVED = ("pflicht", "breite", "ofm", "farbe", "protek", "trennstreifen", "nutz_beschr", "fuehr", "verkehrsri", "Länge", "Kommentar")
# ----------------------------------------------------------------------------------------------------------------------


def verkehrsri(df: DataFrame, layer: str, null_text: str = NULL_TEXT) -> Column:
    """Direction of traffic."""
    oneway = strip(txt(df, "oneway", null_text))
    if layer == "bikelanes":
        return (
            F.when(oneway.isin("yes", "implicit_yes"), ONE_WAY)
            .when(oneway.isin("no", "car_not_bike", "assumed_no"), TWO_WAY)
            .when(oneway.isin("", "None", "none"), MISSING_VALUE)
            .otherwise(WRONG_VALUE)
        )
    return (
        F.when(oneway.isin("", "None", "none", "nil"), TWO_WAY)
        .when(strip(txt(df, "oneway_bicycle", null_text)) == "no", TWO_WAY)
        .when(oneway.isin("yes", "yes_dual_carriageway"), ONE_WAY)
        .when(oneway == "no", TWO_WAY)
        .otherwise(WRONG_VALUE)
    )


def fuehrung(df: DataFrame, layer: str, null_text: str = NULL_TEXT) -> Column:
    """Kind of facility."""
    if layer == "streets":
        return F.lit(MIXED)
    if layer == "paths":
        return F.lit(OTHER_WAYS)
    category, sign = strip(txt(df, "category", null_text)), strip(txt(df, "traffic_sign", null_text))
    free = has_traffic_sign(sign, "1022-10")
    beside = starts_with_any(category, ("footAndCyclewayShared", "footAndCyclewaySegregated", "cyclewaySeparated", "cycleway_adjoining"))
    yes_walk = category.startswith("footwayBicycleYes")
    return (
        F.when(category.isin("cyclewayOnHighway_exclusive", "cyclewayOnHighwayBetweenLanes"), "Radfahrstreifen")
        .when(category == "sharedBusLaneBikeWithBus", "Radfahrstreifen mit Linienverkehr frei (Z237 mit Z1026-32)")
        .when(category == "cyclewayOnHighwayProtected", "Geschützter Radfahrstreifen")
        .when(category == "cyclewayOnHighway_advisory", "Schutzstreifen")
        .when(category.isin("bicycleRoad", "bicycleRoad_vehicleDestination"), "Fahrradstraße /-zone (Z 244)")
        .when(beside & category.startswith("footAndCyclewayShared") & has_traffic_sign(sign, "240"), "Gemeinsamer Geh- und Radweg mit Z240")
        .when(beside & sign.isin("none", "nan", ""), OTHER_WAYS)
        .when(beside | (category == "cycleway_isolated"), "Radweg")
        .when(yes_walk & has_traffic_sign(sign, "239") & free, 'Gehweg mit Zusatzzeichen "Radverkehr frei" (Z239 mit Z1022-10)')
        .when(yes_walk, OTHER_WAYS)
        .when((category == "pedestrianAreaBicycleYes") & (has_traffic_sign(sign, "242") | has_traffic_sign(sign, "242.1")) & free, 'Fußgängerzone "Radverkehr frei" (Z242 mit Z1022-10)')
        .when(category == "sharedMotorVehicleLane", MIXED)
        .when(category == "pedestrianAreaBicycleYes", OTHER_WAYS)
        .when(category == "crossing", "Kreuzungsweg")
        .when(category == "needsClarification", "[TODO] Klärung notwendig")
        .otherwise("[TODO] Führung fehlt")
    )


def pflicht(df: DataFrame, layer: str, null_text: str = NULL_TEXT) -> Column:
    """Whether the facility must be used: a blue sign in any direction."""
    if layer == "streets":
        return F.lit(False)
    return reduce(or_, [has_traffic_sign(txt(df, c, null_text), s) for c in ("traffic_sign", "traffic_sign_forward", "traffic_sign_backward") for s in OBLIGATORY_SIGNS])


def ofm(df: DataFrame, null_text: str = NULL_TEXT) -> Column:
    """Surface material."""
    s = low(txt(df, "surface", null_text))
    return F.when(s.isin(*UNCLEAR_SURFACES), "[TODO] Nicht zuordenbar").when(s == "none", "[TODO] Oberfläche Fehlt").otherwise(lookup(s, SURFACES, F.lit("NICHT-GEFUNDEN")))


def farbe(df: DataFrame, null_text: str = NULL_TEXT) -> Column:
    """Whether the surface is coloured."""
    return low(txt(df, "surface_color", null_text)).isin("red", "green")


def protek(df: DataFrame, null_text: str = NULL_TEXT) -> Column:
    """Physical protection: the left side's, then the right side's. Separation and marking may be given for both sides at once,
    parking beside the lane for its side only."""
    out = F.when(strip(txt(df, "category", null_text)) != "cyclewayOnHighwayProtected", "Ohne")
    for side in ("left", "right"):
        either = lambda tag, s=side: low(F.coalesce(F.nullif(opt(df, f"{tag}_{s}").cast("string"), F.lit("")), opt(df, tag).cast("string"), F.lit("")))
        parked = low(txt(df, f"traffic_mode_{side}", null_text)) == "parking"
        out = out.when(parked & either("marking").contains("barred_area"), "Ruhender Verkehr (mit Sperrfläche)")
        out = out.when(either("separation").isin(*SEPARATIONS), lookup(either("separation"), SEPARATIONS, F.lit(None)))
    return out.otherwise("[TODO] Protektionstyp fehlt")


def trennstreifen(df: DataFrame, null_text: str = NULL_TEXT) -> Column:
    """Safety strip beside parked cars."""
    parked = {s: low(txt(df, f"traffic_mode_{s}", null_text)) == "parking" for s in ("left", "right")}
    lined = {s: contains_any(low(txt(df, f"marking_{s}", null_text)), ("dashed_line", "solid_line")) for s in parked}
    road = low(txt(df, "category", null_text)).startswith("bicycleroad")
    wide = F.coalesce(number(opt(df, "buffer_right")) >= 0.6, F.lit(False))
    return (
        F.when(road & ((parked["left"] & lined["left"]) | (parked["right"] & lined["right"])), "ja")
        .when(road & ~parked["left"] & ~parked["right"], "nein")
        .when(road | ~parked["right"], "entfällt")
        .when(wide, "ja")
        .otherwise("nein")
    )


def nutz_beschr(df: DataFrame, fuehr: Column, null_text: str = NULL_TEXT) -> Column:
    """Restriction of use."""
    return F.when(fuehr == MIXED, "keine").when(contains_any(txt(df, "traffic_sign", null_text), DAMAGE_SIGNS), DAMAGE).otherwise("keine")


def kommentar(df: DataFrame, null_text: str = NULL_TEXT) -> Column:
    """Note on building sites. A date of zero in a column of numbers isn't known."""
    seconds = number(opt(df, "updated_at"))
    if dict(df.dtypes).get("updated_at", "string") != "string":
        seconds = F.nullif(seconds, F.lit(0.0))
    day = epoch_day(seconds.cast("bigint"))
    return F.when(low(txt(df, "lifecycle", null_text)) == "construction", F.concat(F.lit("Derzeit Baustelle (Stand "), F.coalesce(day, F.lit("unbekannt")), F.lit(")")))


def derived_columns(df: DataFrame, layer: str, null_text: str = NULL_TEXT) -> dict[str, Column]:
    """All attributes but the length, by name."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    fuehr = fuehrung(df, layer, null_text)
    return {
        "verkehrsri": verkehrsri(df, layer, null_text),
        "fuehr": fuehr,
        "pflicht": pflicht(df, layer, null_text),
        "breite": parse_width(opt(df, "width"), dict(df.dtypes).get("width", "string")),
        "ofm": ofm(df, null_text),
        "farbe": farbe(df, null_text),
        "protek": protek(df, null_text),
        "trennstreifen": trennstreifen(df, null_text),
        "nutz_beschr": nutz_beschr(df, fuehr, null_text),
        "Kommentar": kommentar(df, null_text),
    }


def prefix_columns(df: DataFrame, keep: tuple[str, ...] = (*DERIVED, "geom"), prefix: str = "tilda_") -> DataFrame:
    """Drops the tags nobody needs and prefixes every other raw column."""
    df = df.drop(*[c for c in DROPPED_TAGS if c in df.columns])
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in df.columns if c not in keep})


def sort_columns(df: DataFrame, last: str = "geom") -> DataFrame:
    """Columns by code point, the geometry last."""
    return df.select(*[F.col(f"`{c}`") for c in [*sorted(c for c in df.columns if c != last), *([last] if last in df.columns else [])]])


def translate(df: DataFrame, layer: str, null_text: str = NULL_TEXT) -> DataFrame:
    """A raw layer with its derived attributes; all else prefixed. One select, so Catalyst sees one projection."""
    new = derived_columns(df, layer, null_text)
    if "geom" in df.columns:
        new["Länge"] = whole(length(F.col("geom")))
    return sort_columns(prefix_columns(df.withColumns(new)))


def unmapped_counts(df: DataFrame, columns: tuple[str, ...] = ("ofm", "protek", "fuehr", "verkehrsri")) -> DataFrame:
    """How often each attribute couldn't be mapped, in long form (attribute, todo, not_found)."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("attribute"), F.col(c).alias("v")) for c in columns if c in df.columns])).alias("x")
    x = df.select(pairs).select("x.attribute", "x.v")
    return x.groupBy("attribute").agg(F.count_if(F.col("v").startswith("[TODO]")).alias("todo"), F.count_if(F.col("v") == "NICHT-GEFUNDEN").alias("not_found"))


def one_sided_streets(df: DataFrame, prefix: str = "tilda_") -> DataFrame:
    """Streets with own cycling infrastructure on one side and none on the other, marked with side and kind.

    Dual carriageways don't count; without the side columns there are none."""
    left, right = (opt(df, f"{prefix}bikelane_{s}") for s in ("left", "right"))
    dual = F.coalesce(opt(df, f"{prefix}oneway") == "yes_dual_carriageway", F.lit(False))
    on_left = among(left, SEPARATE_SIDE) & among(right, NO_SIDE) & ~dual
    on_right = among(right, SEPARATE_SIDE) & among(left, NO_SIDE) & ~dual
    return df.where(on_left | on_right).withColumns(
        {
            "has_one_sided_bikelane": F.lit(True),
            "one_sided_bikelane_side": F.when(on_right, "right_separate").otherwise("left_separate"),
            "separate_infrastructure_type": F.when(on_right, right).otherwise(left),
            "mixed_traffic_side": F.when(on_right, "left").otherwise("right"),
        }
    )


# What a side's tag says about its infrastructure.
SEPARATE_SIDE = (
    "separate_geometry",
    "cycleway_adjoining",
    "cyclewayOnHighwayProtected",
    "cyclewayOnHighway_advisoryOrExclusive",
    "cyclewayOnHighway_advisory",
    "footAndCyclewaySegregated_adjoining",
    "footAndCyclewayShared_adjoining",
    "footwayBicycleYes_adjoining",
    "sharedBusLaneBikeWithBus",
    "sharedMotorVehicleLane",
)
NO_SIDE = ("data_no", "not_expected", "missing", "assumed_no")
