"""Data-quality rules: each labels a raw feature; the first case that holds decides. Nulls and absent columns are 'not given'."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velonet.functions.text import among, contains_any, opt

#: Edits from this day on count as fresh.
CUTOFF = int(datetime(2025, 7, 1, tzinfo=UTC).timestamp())
BICYCLE_ROADS = ("bicycleRoad", "bicycleRoad_vehicleDestination")
ADVISORY = "cyclewayOnHighway_advisory"


def _eq(df: DataFrame, name: str, value) -> Column:
    return F.coalesce(opt(df, name) == value, F.lit(False))


def _given(df: DataFrame, *names: str) -> Column:
    out = F.lit(True)
    for n in names:
        out = out & opt(df, n).isNotNull()
    return out


def _fresh(df: DataFrame) -> Column:
    return F.coalesce(opt(df, "updated_at", "bigint") >= CUTOFF, F.lit(False))


def age(df: DataFrame) -> Column:
    return F.when(_fresh(df), "fresh").otherwise("old")


def buffer_marking(df: DataFrame) -> Column:
    road, advisory = among(opt(df, "category"), BICYCLE_ROADS), _eq(df, "category", ADVISORY)
    left, right, mark_left, mark_right = (_given(df, c) for c in ("buffer_left", "buffer_right", "marking_left", "marking_right"))
    park_left, park_right = _eq(df, "traffic_mode_left", "parking"), _eq(df, "traffic_mode_right", "parking")
    none_left, none_right = (F.coalesce(opt(df, c).try_cast("double") == 0, F.lit(False)) for c in ("buffer_left", "buffer_right"))
    return (
        F.when(advisory & ((park_right & right) | (none_left & none_right)), "correct")
        .when(road & ((mark_left & mark_right) | (left & right)), "correct")
        .when(road & ~mark_left & ~mark_right, "error")
        .when(road & ((park_left & ~left) | (park_right & ~right)), "error")
        .when(advisory & ((left & ~none_left) | park_left), "check")
        .when(advisory & ~right & (mark_right | park_right), "error")
        .when(advisory | road, "other")
        .otherwise("default")
    )


def category(df: DataFrame) -> Column:
    return F.when(contains_any(opt(df, "category"), ("_advisoryOrExclusive", "_adjoiningOrIsolated")), "imprecise").otherwise("precise")


def mapillary(df: DataFrame) -> Column:
    signed = _given(df, "traffic_sign") & ~_eq(df, "traffic_sign", "none")
    return F.when(signed & ~_given(df, "mapillary_traffic_sign"), "missing_sign").when(_given(df, "mapillary") | _given(df, "mapillary_left") | _given(df, "mapillary_right"), "present").otherwise("missing")


def oneway_bikelane(df: DataFrame) -> Column:
    c = opt(df, "category")
    implied = _eq(df, "oneway", "implicit_yes") & among(c, (ADVISORY, "cyclewayOnHighway_exclusive", "cyclewayOnHighwayProtected", "footAndCyclewayShared_adjoining"))
    assumed = _eq(df, "oneway", "assumed_no") & among(c, ("bicycleRoad_vehicleDestination", "pedestrianAreaBicycleYes"))
    return F.when(implied | _eq(df, "oneway", "yes"), "yes").when(assumed | among(opt(df, "oneway"), ("no", "car_not_bike")), "no").otherwise("missing")


def oneway_road(df: DataFrame) -> Column:
    yes = _eq(df, "oneway", "yes")
    return F.when(yes & _given(df, "oneway_bicycle"), "complete").when(yes, "missing").otherwise("neutral")


def surface_color(df: DataFrame) -> Column:
    unexpected = ("bicycleRoad_vehicleDestination", "sharedBusLaneBusWithBike", "pedestrianAreaBicycleYes", "footAndCyclewayShared_adjoining", "footAndCyclewayShared_isolated", "footAndCyclewayShared_adjoiningOrIsolated")
    return F.when(among(opt(df, "category"), unexpected), "not_expected").when(_given(df, "surface_color"), "present").otherwise("missing")


def surface_sett(df: DataFrame) -> Column:
    return F.when(_eq(df, "surface", "sett"), "generic").when(among(opt(df, "surface"), ("mosaic_sett", "small_sett", "large_sett")), "specific").otherwise("other")


def traffic_sign(df: DataFrame) -> Column:
    damaged = contains_any(opt(df, "traffic_sign"), ("schäden", "Schäden", "schaeden", "Schaeden"))
    return F.when(_eq(df, "traffic_sign", "none"), "none").when(damaged, "damage").when(_given(df, "traffic_sign"), "present").otherwise("missing")


def update_source(df: DataFrame) -> Column:
    return F.when(contains_any(opt(df, "updated_by"), ("fmc_",)), "own").when(_fresh(df), "other_recent").otherwise("other_old")


def width(df: DataFrame) -> Column:
    low = among(opt(df, "category"), ("sharedBusLaneBusWithBike", "sharedBusLaneBikeWithBus", *BICYCLE_ROADS))
    return F.when(low, "low_priority").when(~_given(df, "width"), "missing").when(~_given(df, "width_source"), "source_missing").otherwise("complete")


def cycleway_no(df: DataFrame) -> Column:
    sides = ("bikelane_left", "bikelane_right", "bikelane_self")
    missing = _eq(df, sides[0], "missing") | _eq(df, sides[1], "missing") | _eq(df, sides[2], "missing")
    return F.when(~_given(df, *sides), "undefined").when(missing, "missing").otherwise("present")


def dual_carriageway(df: DataFrame) -> Column:
    small = among(opt(df, "road"), ("residential", "service_road", "living_street", "bicycle_road", "motorway", "motorway_link"))
    return F.when(_eq(df, "oneway", "yes_dual_carriageway"), "present").when(_eq(df, "oneway", "yes") & ~small, "candidate").otherwise("none")


RULES: dict[str, Callable[[DataFrame], Column]] = {f.__name__: f for f in (age, buffer_marking, category, mapillary, oneway_bikelane, oneway_road, surface_color, surface_sett, traffic_sign, update_source, width, cycleway_no, dual_carriageway)}

#: Which rules a layer is checked by.
LAYER_RULES = {
    "bikelanes": ("age", "buffer_marking", "category", "mapillary", "oneway_bikelane", "surface_color", "surface_sett", "traffic_sign", "update_source", "width"),
    "roads": ("age", "oneway_road", "surface_sett", "update_source", "cycleway_no", "dual_carriageway"),
    "paths": ("age", "oneway_bikelane", "surface_sett", "update_source"),
}
#: Layers whose features without an editor are left out of update_source.
NEEDS_EDITOR = ("bikelanes", "roads")


def classify(df: DataFrame, layer: str, rules: tuple[str, ...] | None = None) -> DataFrame:
    """df with a column qa_<rule> for each rule of the layer; qa_update_source is null where the layer needs an editor and none is given."""
    new = {}
    for r in rules or LAYER_RULES[layer]:
        label = RULES[r](df)
        new[f"qa_{r}"] = F.when(_given(df, "updated_by"), label) if r == "update_source" and layer in NEEDS_EDITOR else label
    return df.withColumns(new)


def property_table(df: DataFrame, id_col: str = "id") -> DataFrame:
    """(id, key, value) of every given property, the id first, then keys in order: what an inspector shows."""
    keys = [id_col, *sorted(c for c in df.columns if c != id_col)]
    rows = F.array(*[F.struct(F.lit(k).alias("position"), F.lit(c).alias("key"), F.col(f"`{c}`").cast("string").alias("value")) for k, c in enumerate(keys)])
    return df.select(F.col(id_col), F.explode(rows).alias("p")).select(id_col, "p.position", "p.key", "p.value").where("value is not null")
