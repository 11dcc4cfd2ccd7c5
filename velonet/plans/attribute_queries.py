"""Queries of the attribute operators: edge aggregation, translation rules, quality rules, unions and id sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from velonet.functions.text import has_traffic_sign, parse_width
from velonet.operators import edges, expectations, quality_rules, sets, snapping, translate
from velonet.operators.translate import DAMAGE, MIXED, OTHER_WAYS, SEPARATIONS, SURFACES
from velonet.plans.bindings import FEATURES, FIELDS, SEGMENTS, features, read, segments
from velonet.plans.registry import QUERIES, SQL, query
from velonet.sources.layers import parse_id_list

KEYS = ["element_nr", "ri"]

# Edge aggregation ---------------------------------------------------------------------------------------------------------


def _longest_sql(c: str) -> str:
    return f"l_{c} as (select element_nr, ri, arg_max({c}, row(mm, -s)) {c} from (select element_nr, ri, {c}, sum(cast(round_even(length * 1000, 0) as bigint)) mm, min(seq) s from b1 where {c} is not null group by 1, 2, 3) group by 1, 2)"


_WORST_STRIP = "case min(case trennstreifen when 'nein' then 1 when 'ja' then 2 when 'entfällt' then 3 end) when 1 then 'nein' when 2 then 'ja' when 3 then 'entfällt' end"
_WORST_USE = f"case min(case nutz_beschr when 'Physische Sperre' then 1 when '{DAMAGE}' then 2 when 'keine' then 3 end) when 1 then 'Physische Sperre' when 2 then '{DAMAGE}' when 3 then 'keine' end"
_AGG = f"""{SEGMENTS}, {_longest_sql('fuehr')}, {_longest_sql('pflicht')},
g as (select element_nr, ri, min(breite) breite, {_WORST_STRIP} trennstreifen, {_WORST_USE} nutz_beschr, string_agg(distinct tilda_id, ';' order by tilda_id) tilda_id, arg_min(strassenname, seq) strassenname, cast(round_even(sum(length), 0) as integer) "Länge" from b1 group by 1, 2),
agg as (select g.element_nr, g.ri, l_fuehr.fuehr, l_pflicht.pflicht, breite, trennstreifen, nutz_beschr, tilda_id, strassenname, "Länge" from g join l_fuehr using (element_nr, ri) join l_pflicht using (element_nr, ri))"""


@query(f"with {_AGG} select * from agg")
def edge_aggregate(spark, sf_dir):
    """Rows are dealt out by edge once, for the order of segments and for all that is folded after it."""
    return edges.aggregate_edges(segments(spark, sf_dir, sets.dealt), geom=None)


@query(f"with {SEGMENTS}, {_longest_sql('fuehr')} select * from l_fuehr")
def edge_longest_section(spark, sf_dir):
    return edges.longest_value(segments(spark, sf_dir), KEYS, "fuehr")


@query(f"with {SEGMENTS} select element_nr, ri, min(breite) breite, {_WORST_STRIP} trennstreifen, {_WORST_USE} nutz_beschr from b1 group by 1, 2")
def edge_worst_case(spark, sf_dir):
    s = segments(spark, sf_dir)
    return s.groupBy(*KEYS).agg(edges.least_number(F.col("breite")).alias("breite"), edges.worst_of(F.col("trennstreifen"), edges.STRIP_ORDER, F.col("seq")).alias("trennstreifen"), edges.worst_of(F.col("nutz_beschr"), edges.RESTRICTION_ORDER, F.col("seq")).alias("nutz_beschr"))


@query(f"with {SEGMENTS} select element_nr, ri, string_agg(distinct tilda_id, ';' order by tilda_id) tilda_ids from b1 group by 1, 2")
def edge_distinct_join(spark, sf_dir):
    return segments(spark, sf_dir).groupBy(*KEYS).agg(edges.joined_distinct(F.col("tilda_id")).alias("tilda_ids"))


@query(f"with {SEGMENTS} select element_nr, ri, arg_min(strassenname, seq) strassenname, first_nutz nutz_beschr from b1 join (select element_nr, ri, nutz_beschr first_nutz from b1 qualify row_number() over (partition by element_nr, ri order by seq) = 1) using (element_nr, ri) group by element_nr, ri, first_nutz")
def edge_first_carry(spark, sf_dir):
    first = sets.keep_first(segments(spark, sf_dir), KEYS, ["seq"])
    return first.select(*KEYS, "strassenname", "nutz_beschr")


@query(f"""with {SEGMENTS}, s as (select element_nr, ri, count(distinct pflicht) > 1 p, count(distinct nutz_beschr) > 1 n, count(distinct fuehr) filter (length >= 30) > 1 f, count(distinct trennstreifen) filter (length >= 30) > 1 t, coalesce(round(max(breite) filter (length >= 30) - min(breite) filter (length >= 30), 9) > 0.05, false) b from b1 group by 1, 2)
select element_nr, ri, array_to_string(list_filter([case when p then 'pflicht' end, case when n then 'nutz_beschr' end, case when f then 'fuehr' end, case when t then 'trennstreifen' end, case when b then 'breite' end], lambda x: x is not null), ',') attributes from s where p or n or f or t or b""")
def edge_significant_changes(spark, sf_dir):
    return edges.significant_changes(segments(spark, sf_dir), least=30.0, width=0.05)


def _lengths(spark, sf_dir):
    """Edges with their lengths alone: no other attribute is folded, joined or written for numbers."""
    return edges.aggregate_edges(segments(spark, sf_dir), longest=(), geom=None).select(*KEYS, "Länge")


@query(f"with {_AGG}, n as (select *, cast(row_number() over (partition by ri order by element_nr) as integer) afid from agg) select afid, element_nr, ri, \"Länge\" from n")
def edge_afid_by_direction(spark, sf_dir):
    parts = edges.split_directions(edges.finish(_lengths(spark, sf_dir)))
    return parts["hinrichtung"].unionByName(parts["gegenrichtung"]).select("afid", *KEYS, "Länge")


@query(f"with {_AGG} select cast(row_number() over (order by element_nr, ri) as integer) afid, element_nr, ri from agg")
def edge_afid(spark, sf_dir):
    return edges.finish(_lengths(spark, sf_dir)).select("afid", *KEYS)


@query(f"with {_AGG} select case ri when 0 then 'hinrichtung' when 1 then 'gegenrichtung' end direction, count(*) n, cast(sum(\"Länge\") as bigint) total from agg where ri in (0, 1) group by 1")
def edge_direction_split(spark, sf_dir):
    agg = edges.aggregate_edges(segments(spark, sf_dir), geom=None)
    parts = [agg.where(F.col("ri") == ri).withColumn("direction", F.lit(name)) for ri, name in edges.DIRECTIONS.items()]
    return parts[0].unionByName(parts[1]).groupBy("direction").agg(F.count("*").alias("n"), F.sum("Länge").alias("total"))


@query(f"with {SEGMENTS} select fuehr, ri, count(*) n, sum(length) total, round(avg(length), 4) mean from b1 group by 1, 2")
def edge_length_stats(spark, sf_dir):
    return edges.length_stats(segments(spark, sf_dir), ["fuehr", "ri"]).withColumn("mean", F.round("mean", 4))


@query(f"with {SEGMENTS} select a.attribute, a.\"value\" as \"value\", count(*) n from b1, lateral (values ('fuehr', fuehr), ('trennstreifen', trennstreifen), ('nutz_beschr', nutz_beschr), ('ri', cast(ri as varchar))) a(attribute, \"value\") group by 1, 2")
def edge_value_counts(spark, sf_dir):
    return snapping.attribute_stats(segments(spark, sf_dir), ("fuehr", "trennstreifen", "nutz_beschr", "ri"))


# Translation rules ----------------------------------------------------------------------------------------------------------


def _t(c: str) -> str:
    return f"coalesce({c}, 'None')"


def _strip(c: str) -> str:
    return rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


def _sign(v: str, sign: str) -> str:
    return f"(contains({v}, 'DE:{sign}') or (contains({v}, 'DE:') and list_contains([trim(x) for x in string_split({v}, ',')], '{sign}')))"


def _case(table: dict[str, str], c: str) -> str:
    return f"case {c} {' '.join(f'when {chr(39)}{k}{chr(39)} then {chr(39)}{v}{chr(39)}' for k, v in table.items())} end"


_ONE, _TWO = "'Einrichtungsverkehr'", "'Zweirichtungsverkehr'"
_O = _strip(_t("oneway"))
_VERKEHRSRI = f"""case when {_O} in ('yes', 'implicit_yes') then {_ONE} when {_O} in ('no', 'car_not_bike', 'assumed_no') then {_TWO} when {_O} in ('', 'None', 'none') then '[TODO] Fehlender Wert' else '[TODO] Fehlerhafter Wert' end"""
_VERKEHRSRI_ROAD = f"""case when {_O} in ('', 'None', 'none', 'nil') then {_TWO} when {_strip(_t('oneway_bicycle'))} = 'no' then {_TWO} when {_O} in ('yes', 'yes_dual_carriageway') then {_ONE} when {_O} = 'no' then {_TWO} else '[TODO] Fehlerhafter Wert' end"""
_C, _S = _strip(_t("category")), _strip(_t("traffic_sign"))
_LOW = lambda c: f"lower({_strip(_t(c))})"
_FREE = _sign(_S, "1022-10")
_FUEHR = f"""case when {_C} in ('cyclewayOnHighway_exclusive', 'cyclewayOnHighwayBetweenLanes') then 'Radfahrstreifen'
 when {_C} = 'sharedBusLaneBikeWithBus' then 'Radfahrstreifen mit Linienverkehr frei (Z237 mit Z1026-32)'
 when {_C} = 'cyclewayOnHighwayProtected' then 'Geschützter Radfahrstreifen' when {_C} = 'cyclewayOnHighway_advisory' then 'Schutzstreifen'
 when {_C} in ('bicycleRoad', 'bicycleRoad_vehicleDestination') then 'Fahrradstraße /-zone (Z 244)'
 when {_C} like 'footAndCyclewayShared%' and {_sign(_S, '240')} then 'Gemeinsamer Geh- und Radweg mit Z240'
 when ({_C} like 'footAndCyclewayShared%' or {_C} like 'footAndCyclewaySegregated%' or {_C} like 'cyclewaySeparated%' or starts_with({_C}, 'cycleway_adjoining')) and {_S} in ('none', 'nan', '') then '{OTHER_WAYS}'
 when {_C} like 'footAndCyclewayShared%' or {_C} like 'footAndCyclewaySegregated%' or {_C} like 'cyclewaySeparated%' or starts_with({_C}, 'cycleway_adjoining') or {_C} = 'cycleway_isolated' then 'Radweg'
 when starts_with({_C}, 'footwayBicycleYes') then case when {_sign(_S, '239')} and {_FREE} then 'Gehweg mit Zusatzzeichen "Radverkehr frei" (Z239 mit Z1022-10)' else '{OTHER_WAYS}' end
 when {_C} = 'pedestrianAreaBicycleYes' and ({_sign(_S, '242')} or {_sign(_S, '242.1')}) and {_FREE} then 'Fußgängerzone "Radverkehr frei" (Z242 mit Z1022-10)'
 when {_C} = 'sharedMotorVehicleLane' then '{MIXED}' when {_C} = 'pedestrianAreaBicycleYes' then '{OTHER_WAYS}' when {_C} = 'crossing' then 'Kreuzungsweg'
 when {_C} = 'needsClarification' then '[TODO] Klärung notwendig' else '[TODO] Führung fehlt' end"""
_PFLICHT = " or ".join(_sign(_t(c), s) for c in ("traffic_sign", "traffic_sign_forward", "traffic_sign_backward") for s in ("237", "240", "241"))
_SURF = f"lower({_strip(_t('surface'))})"
_OFM = f"case when {_SURF} in ('grass_paver', 'wood', 'metal', 'paved') then '[TODO] Nicht zuordenbar' when {_SURF} = 'none' then '[TODO] Oberfläche Fehlt' else coalesce({_case(SURFACES, _SURF)}, 'NICHT-GEFUNDEN') end"
_FARBE = f"lower({_strip(_t('surface_color'))}) in ('red', 'green')"


def _protek_side(s: str) -> str:
    either = lambda tag: f"lower({_strip(f'coalesce(nullif({tag}_{s}, {chr(39) * 2}), {tag}, {chr(39) * 2})')})"
    sep, mark = either("separation"), either("marking")
    return f"when {_LOW(f'traffic_mode_{s}')} = 'parking' and contains({mark}, 'barred_area') then 'Ruhender Verkehr (mit Sperrfläche)' when {_case(SEPARATIONS, sep)} is not null then {_case(SEPARATIONS, sep)}"


_PROTEK = f"case when {_C} <> 'cyclewayOnHighwayProtected' then 'Ohne' {_protek_side('left')} {_protek_side('right')} else '[TODO] Protektionstyp fehlt' end"
_LINED = {s: f"(contains({_LOW(f'marking_{s}')}, 'dashed_line') or contains({_LOW(f'marking_{s}')}, 'solid_line'))" for s in ("left", "right")}
_PARK = {s: f"({_LOW(f'traffic_mode_{s}')} = 'parking')" for s in ("left", "right")}
_BUFFER = "try_cast(buffer_right as double)"
_TRENN = f"""case when lower({_C}) like 'bicycleroad%' then case when ({_PARK['left']} and {_LINED['left']}) or ({_PARK['right']} and {_LINED['right']}) then 'ja' when not {_PARK['left']} and not {_PARK['right']} then 'nein' else 'entfällt' end
 when not {_PARK['right']} then 'entfällt' when coalesce({_BUFFER} >= 0.6 and not isnan({_BUFFER}), false) then 'ja' else 'nein' end"""
_NUTZ = f"case when {_FUEHR} = '{MIXED}' then 'keine' when contains({_t("traffic_sign")}, 'Gehwegschäden') or contains({_t("traffic_sign")}, 'Radwegschäden') then '{DAMAGE}' else 'keine' end"
_KOMM = f"case when {_LOW('lifecycle')} = 'construction' then 'Derzeit Baustelle (Stand ' || strftime(make_timestamp(updated_at * 1000000), '%d.%m.%Y') || ')' end"
_W = r"regexp_replace(string_split(replace(replace(replace(lower(regexp_replace(width, '^\s+|\s+$', '', 'g')), 'm', ''), 'eter', ''), 'tres', ''), ';')[1], '^\s+|\s+$', '', 'g')"
# printf rounds the number itself, halves to the even, as the source rule does
_BREITE = rf"case when regexp_full_match({_W}, '[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?') then cast(printf('%.1f', cast({_W} as double)) as double) end"

_RULES = {
    "verkehrsri": (_VERKEHRSRI, lambda d: translate.verkehrsri(d, "bikelanes")),
    "verkehrsri_street": (_VERKEHRSRI_ROAD, lambda d: translate.verkehrsri(d, "streets")),
    "fuehrung": (_FUEHR, lambda d: translate.fuehrung(d, "bikelanes")),
    "pflicht": (_PFLICHT, lambda d: translate.pflicht(d, "bikelanes")),
    "width": (_BREITE, lambda d: parse_width(F.col("width"))),
    "ofm": (_OFM, translate.ofm),
    "farbe": (_FARBE, translate.farbe),
    "protek": (_PROTEK, translate.protek),
    "trennstreifen": (_TRENN, translate.trennstreifen),
    "nutz_beschr": (_NUTZ, lambda d: translate.nutz_beschr(d, translate.fuehrung(d, "bikelanes"))),
    "kommentar": (_KOMM, translate.kommentar),
}


def _rule_query(rule: str) -> None:
    sql, column = _RULES[rule]
    QUERIES[f"tr_{rule}"] = lambda spark, sf_dir: (lambda d: d.select("id", column(d).alias(rule)))(features(spark, sf_dir))
    SQL[f"tr_{rule}"] = f"with {FEATURES} select id, {sql} {rule} from b2"


for _r in _RULES:
    _rule_query(_r)

_ALL = {"verkehrsri": _VERKEHRSRI, "fuehr": _FUEHR, "pflicht": _PFLICHT, "breite": _BREITE, "ofm": _OFM, "farbe": _FARBE, "protek": _PROTEK, "trennstreifen": _TRENN, "nutz_beschr": _NUTZ, "Kommentar": _KOMM}


@query(f"with {FEATURES} select {', '.join(f'{s} {c}' for c, s in _ALL.items())}, id tilda_id, osm_id tilda_osm_id, event_type tilda_event_type, {', '.join(f'{c} tilda_{c}' for c in sorted(FIELDS) if c not in translate.DROPPED_TAGS)} from b2")
def tr_prefix_columns(spark, sf_dir):
    return translate.translate(features(spark, sf_dir), "bikelanes")


@query(f"""with {FEATURES}, t as (select {_OFM} ofm, {_PROTEK} protek, {_FUEHR} fuehr, {_VERKEHRSRI} verkehrsri from b2)
select a.attribute, count(*) filter (starts_with(a.v, '[TODO]')) todo, count(*) filter (a.v = 'NICHT-GEFUNDEN') not_found from t, lateral (values ('ofm', ofm), ('protek', protek), ('fuehr', fuehr), ('verkehrsri', verkehrsri)) a(attribute, v) group by 1""")
def tr_unmapped_counts(spark, sf_dir):
    return translate.unmapped_counts(translate.translate(features(spark, sf_dir), "bikelanes"))


@query(f"with {FEATURES} select id, {', '.join(f'{_sign("traffic_sign", s)} s_{s.replace(chr(46), chr(95)).replace(chr(45), chr(95))}' for s in ('237', '240', '242.1', '1022-10'))} from b2 where traffic_sign is not null union all select id, false, false, false, false from b2 where traffic_sign is null")
def traffic_sign_match(spark, sf_dir):
    d = features(spark, sf_dir)
    return d.select("id", *[has_traffic_sign(F.col("traffic_sign"), s).alias(f"s_{s.replace('.', '_').replace('-', '_')}") for s in ("237", "240", "242.1", "1022-10")])


_SIDES = ", ".join(f"'{v}'" for v in translate.SEPARATE_SIDE)
_NONE = ", ".join(f"'{v}'" for v in translate.NO_SIDE)


@query(f"""with {FEATURES}, s as (select id, bikelane_left l, bikelane_right r, coalesce(bikelane_left in ({_SIDES}) and bikelane_right in ({_NONE}), false) ol, coalesce(bikelane_right in ({_SIDES}) and bikelane_left in ({_NONE}), false) orr from b2 where coalesce(oneway, '') <> 'yes_dual_carriageway')
select id, case when orr then 'right_separate' else 'left_separate' end one_sided_bikelane_side, case when orr then r else l end separate_infrastructure_type, case when orr then 'left' else 'right' end mixed_traffic_side, true has_one_sided_bikelane from s where ol or orr""")
def one_sided_streets(spark, sf_dir):
    return translate.one_sided_streets(features(spark, sf_dir), prefix="").select("id", "one_sided_bikelane_side", "separate_infrastructure_type", "mixed_traffic_side", "has_one_sided_bikelane")


_PRIO = f"greatest(0, case when {_sign(_t("traffic_sign"), '237')} or {_sign(_t("traffic_sign"), '240')} or {_sign(_t("traffic_sign"), '241')} then 3 else 0 end, case when starts_with({_t("category")}, 'bicycleRoad') or starts_with({_t("category")}, 'cycleway') then 6 when starts_with({_t("category")}, 'footAndCycleway') then 5 when starts_with({_t("category")}, 'footwayBicycle') then 4 when {_t("category")} = 'sharedBusLaneBikeWithBus' then 3 when {_t("category")} in ('sharedBusLaneBusWithBike', 'pedestrianAreaBicycleYes') then 2 when {_t("category")} = 'sharedMotorVehicleLane' then 1 else 0 end)"


@query(f"with {FEATURES} select id, {_PRIO} priority from b2")
def osm_priority(spark, sf_dir):
    return features(spark, sf_dir).select("id", snapping.priority(F.col("category"), F.col("traffic_sign")).alias("priority"))


# Quality rules --------------------------------------------------------------------------------------------------------------

_ROADCAT = "coalesce(category in ('bicycleRoad', 'bicycleRoad_vehicleDestination'), false)"
_ADV = "coalesce(category = 'cyclewayOnHighway_advisory', false)"
_PL, _PR = "coalesce(traffic_mode_left = 'parking', false)", "coalesce(traffic_mode_right = 'parking', false)"
_ZL, _ZR = "coalesce(try_cast(buffer_left as double) = 0, false)", "coalesce(try_cast(buffer_right as double) = 0, false)"
_BL, _BR, _ML, _MR = "buffer_left is not null", "buffer_right is not null", "marking_left is not null", "marking_right is not null"
_CUT = quality_rules.CUTOFF
_QA = {
    "age": f"case when updated_at >= {_CUT} then 'fresh' else 'old' end",
    "buffer_marking": f"""case when {_ADV} and {_PR} and {_BR} then 'correct' when {_ADV} and {_ZL} and {_ZR} then 'correct' when {_ROADCAT} and {_ML} and {_MR} then 'correct' when {_ROADCAT} and {_BL} and {_BR} then 'correct'
 when {_ROADCAT} and not ({_ML}) and not ({_MR}) then 'error' when {_ROADCAT} and {_PL} and not ({_BL}) then 'error' when {_ROADCAT} and {_PR} and not ({_BR}) then 'error'
 when {_ADV} and (({_BL} and not {_ZL}) or {_PL}) then 'check' when {_ADV} and {_MR} and not ({_BR}) then 'error' when {_ADV} and {_PR} and not ({_BR}) then 'error' when {_ADV} or {_ROADCAT} then 'other' else 'default' end""",
    "category": "case when contains(category, '_advisoryOrExclusive') or contains(category, '_adjoiningOrIsolated') then 'imprecise' else 'precise' end",
    "mapillary": "case when traffic_sign is not null and traffic_sign <> 'none' and mapillary_traffic_sign is null then 'missing_sign' when mapillary is not null or mapillary_left is not null or mapillary_right is not null then 'present' else 'missing' end",
    "oneway_bikelane": "case when oneway = 'implicit_yes' and category in ('cyclewayOnHighway_advisory', 'cyclewayOnHighway_exclusive', 'cyclewayOnHighwayProtected', 'footAndCyclewayShared_adjoining') then 'yes' when oneway = 'assumed_no' and category in ('bicycleRoad_vehicleDestination', 'pedestrianAreaBicycleYes') then 'no' when oneway = 'yes' then 'yes' when oneway in ('no', 'car_not_bike') then 'no' else 'missing' end",
    "oneway_road": "case when oneway = 'yes' and oneway_bicycle is not null then 'complete' when oneway = 'yes' then 'missing' else 'neutral' end",
    "surface_color": "case when category in ('bicycleRoad_vehicleDestination', 'sharedBusLaneBusWithBike', 'pedestrianAreaBicycleYes', 'footAndCyclewayShared_adjoining', 'footAndCyclewayShared_isolated', 'footAndCyclewayShared_adjoiningOrIsolated') then 'not_expected' when surface_color is not null then 'present' else 'missing' end",
    "surface_sett": "case surface when 'sett' then 'generic' when 'mosaic_sett' then 'specific' when 'small_sett' then 'specific' when 'large_sett' then 'specific' else 'other' end",
    "traffic_sign": "case when traffic_sign = 'none' then 'none' when contains(traffic_sign, 'schäden') or contains(traffic_sign, 'Schäden') or contains(traffic_sign, 'schaeden') or contains(traffic_sign, 'Schaeden') then 'damage' when traffic_sign is not null then 'present' else 'missing' end",
    "update_source": f"case when contains(updated_by, 'fmc_') then 'own' when updated_at >= {_CUT} then 'other_recent' else 'other_old' end",
    "width": "case when category in ('sharedBusLaneBusWithBike', 'sharedBusLaneBikeWithBus', 'bicycleRoad', 'bicycleRoad_vehicleDestination') then 'low_priority' when width is null then 'missing' when width_source is null then 'source_missing' else 'complete' end",
    "cycleway_no": "case when bikelane_left is null or bikelane_right is null or bikelane_self is null then 'undefined' when bikelane_left = 'missing' or bikelane_right = 'missing' or bikelane_self = 'missing' then 'missing' else 'present' end",
    "dual_carriageway": "case when oneway = 'yes_dual_carriageway' then 'present' when oneway = 'yes' and coalesce(road not in ('residential', 'service_road', 'living_street', 'bicycle_road', 'motorway', 'motorway_link'), true) then 'candidate' else 'none' end",
}


def _qa_query(rule: str) -> None:
    QUERIES[f"qa_{rule}"] = lambda spark, sf_dir: (lambda d: d.select("id", quality_rules.RULES[rule](d).alias("label")))(features(spark, sf_dir))
    SQL[f"qa_{rule}"] = f"with {FEATURES} select id, {_QA[rule]} label from b2"


for _r in quality_rules.RULES:
    _qa_query(_r)


def _layer_query(layer: str) -> None:
    rules = quality_rules.LAYER_RULES[layer]
    QUERIES[f"qa_layer_{layer}"] = lambda spark, sf_dir: quality_rules.classify(features(spark, sf_dir), layer).select("id", *[f"qa_{r}" for r in rules])
    label = lambda r: f"case when updated_by is not null then {_QA[r]} end" if r == "update_source" and layer in quality_rules.NEEDS_EDITOR else _QA[r]
    SQL[f"qa_layer_{layer}"] = f"with {FEATURES} select id, {', '.join(f'{label(r)} qa_{r}' for r in rules)} from b2"


for _l in quality_rules.LAYER_RULES:
    _layer_query(_l)


@query(f"""with {FEATURES} select id, p.position, p.key, p."value" as "value" from (select id, updated_by, road, oneway from b2), lateral (values (0, 'id', cast(id as varchar)), (1, 'oneway', oneway), (2, 'road', road), (3, 'updated_by', updated_by)) p(position, key, "value") where p."value" is not null""")
def qa_property_table(spark, sf_dir):
    return quality_rules.property_table(features(spark, sf_dir).select("id", "updated_by", "road", "oneway"))


# Unions, ids ------------------------------------------------------------------------------------------------------------------


def _tables(spark, sf_dir):
    c = read(spark, sf_dir, "customer").selectExpr("c_custkey id", "c_custkey seq", "c_name name", "c_mktsegment segment")
    s = read(spark, sf_dir, "supplier").selectExpr("s_suppkey * 3 id", "s_suppkey seq", "s_name name", "s_acctbal balance")
    p = read(spark, sf_dir, "part").selectExpr("p_partkey % 900 id", "p_partkey seq", "p_name name", "p_size size")
    return [("customer", c), ("supplier", s), ("part", p)]


_UNION = """u as (select c_custkey id, c_custkey seq, c_name name, c_mktsegment segment, cast(null as double) balance, cast(null as integer) size, 'customer' data_source, 0 prio from customer
union all select s_suppkey * 3, s_suppkey, s_name, null, s_acctbal, null, 'supplier', 1 from supplier union all select p_partkey % 900, p_partkey, p_name, null, null, p_size, 'part', 2 from part)"""


@query(f"with {_UNION} select balance, data_source, id, name, segment, seq, size from u")
def union_harmonised(spark, sf_dir):
    return sets.union_harmonised(_tables(spark, sf_dir))


@query(f"with {_UNION} select balance, data_source, id, name, segment, seq, size from u qualify row_number() over (partition by id order by prio, seq) = 1")
def dedup_keep_first(spark, sf_dir):
    return sets.combine(_tables(spark, sf_dir), "id", "seq")


@query("select cast(p_partkey as varchar) || '_' || p_brand unique_id, p_name, cast(p_size as varchar) p_size from part")
def concat_unique_id(spark, sf_dir):
    return sets.unique_id(read(spark, sf_dir, "part"), "p_partkey", "p_brand", ["p_name", "p_size"])


@query(f"with {_UNION} select id, seq, name from u")
def common_columns_merge(spark, sf_dir):
    return sets.common_columns([t for _, t in _tables(spark, sf_dir)], ["id", "seq"])


@query("""with m as (select l_partkey, count(*) n from lineitem where l_quantity > 40 group by 1), inc as (select p_partkey from part where p_size <= 3), exc as (select p_partkey from part where p_size >= 48)
select l_partkey, n, cast(null as varchar) manual_action from m where l_partkey not in (select p_partkey from exc) union all select p_partkey, null, 'included' from part where p_partkey in (select p_partkey from inc) and p_partkey not in (select l_partkey from m)""")
def manual_include_exclude(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    matched = read(spark, sf_dir, "lineitem").where("l_quantity > 40").groupBy("l_partkey").agg(F.count("*").alias("n"))
    lists = [part.where(w).select(F.col("p_partkey").alias("id")) for w in ("p_size >= 48", "p_size <= 3")]
    return sets.apply_interventions(matched, part.select(F.col("p_partkey").alias("l_partkey")), *lists, "l_partkey")


@query("select p_partkey, p_name from part where p_partkey not in (select l_partkey from lineitem where l_quantity >= 50)")
def id_denylist(spark, sf_dir):
    deny = read(spark, sf_dir, "lineitem").where("l_quantity >= 50").select(F.col("l_partkey").alias("id"))
    return sets.without_ids(read(spark, sf_dir, "part").select("p_partkey", "p_name"), deny, "p_partkey")


@query("select p_partkey, p_name from part where p_partkey in (select l_partkey from lineitem where l_quantity >= 50)")
def id_allowlist(spark, sf_dir):
    allow = read(spark, sf_dir, "lineitem").where("l_quantity >= 50").select(F.col("l_partkey").alias("id"))
    return sets.with_ids(read(spark, sf_dir, "part").select("p_partkey", "p_name"), allow, "p_partkey")


@query("select distinct l_partkey id from lineitem except select p_partkey from part where p_size > 25")
def id_set_difference(spark, sf_dir):
    return sets.id_difference(read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("id")), read(spark, sf_dir, "part").where("p_size > 25").select(F.col("p_partkey").alias("id")))


@query("select distinct l_suppkey id from lineitem")
def distinct_ids(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("id")).distinct()


@query("select distinct try_cast(trim(string_split(line, '#')[1]) as bigint) id from (select case event_id % 4 when 0 then cast(user_id as varchar) || ' # ' || event_type when 1 then '# ' || cast(user_id as varchar) when 2 then event_type else ' ' || cast(event_id as varchar) end line from events) where try_cast(trim(string_split(line, '#')[1]) as bigint) is not null")
def id_list_lines(spark, sf_dir):
    line = F.expr("case event_id % 4 when 0 then concat(user_id, ' # ', event_type) when 1 then concat('# ', user_id) when 2 then event_type else concat(' ', event_id) end as value")
    return parse_id_list(read(spark, sf_dir, "events").select(line))


# Expectations -----------------------------------------------------------------------------------------------------------------

_CASES = [
    {"case": "a", "element_nr": "7", "mode": "all_features", "attributes": {"fuehr": "N", "pflicht": True}},
    {"case": "b", "element_nr": "7", "mode": "any_segment", "attributes": {"fuehr": "N", "pflicht": "ja"}, "min_length": 10.0},
    {"case": "c", "element_nr": "11", "mode": "any_segment", "attributes": {"breite": "0.02"}, "min_length": 49.5},
    {"case": "d", "element_nr": "-1", "mode": "all_features", "attributes": {"fuehr": "A"}},
    {"case": "e", "element_nr": "20", "mode": "all_features", "attributes": {"trennstreifen": "nein"}},
    {"case": "f", "element_nr": "20", "mode": "some_mode", "attributes": {"trennstreifen": "nein"}},
]


def _segments_long(spark, sf_dir, expected):
    s = segments(spark, sf_dir, lambda rows, edge: expectations.named(rows, edge, expected)).withColumn("row", F.concat_ws("-", "element_nr", "seq"))
    return expectations.long_form(s, "element_nr", "row", ["fuehr", "pflicht", "breite", "trennstreifen"], measured="length")


def _checked(spark, sf_dir):
    cases = expectations.expectations(_CASES, spark)
    return expectations.check(cases, _segments_long(spark, sf_dir, cases))


_EXPECT = f"""with {SEGMENTS}, e("case", nr, mode, f, p, b, t, ml) as (values ('a', 7, 'all_features', 'N', true, null, null, null), ('b', 7, 'any_segment', 'N', true, null, null, 10.0), ('c', 11, 'any_segment', null, null, 0.02, null, 49.5), ('d', -1, 'all_features', 'A', null, null, null, null), ('e', 20, 'all_features', null, null, null, 'nein', null)),
j as (select e.*, seq, coalesce((f is null or f = fuehr) and (p is null or p = pflicht) and (b is null or b = breite) and (t is null or t = trennstreifen), false) and seq is not null a, (ml is null or coalesce(length >= ml, false)) and seq is not null g from e left join b1 on e.nr = b1.element_nr)
select "case", mode, count(seq) features, case mode when 'all_features' then bool_and(a) else bool_or(a) end attributes_ok, case mode when 'all_features' then bool_and(g) else bool_or(g) end geometry_ok, (case mode when 'all_features' then bool_and(a) else bool_or(a) end) and (case mode when 'all_features' then bool_and(g) else bool_or(g) end) passed from j group by 1, 2"""


def _expect(mode):
    def run(spark, sf_dir):
        return _checked(spark, sf_dir).where(F.col("mode") == mode)

    return run


for _m in ("all_features", "any_segment"):
    QUERIES[f"expect_{_m}"] = _expect(_m)
    SQL[f"expect_{_m}"] = f"select * from ({_EXPECT}) where mode = '{_m}'"


@query(f"select count(*) cases, count(*) filter (passed) passed, count(*) filter (not passed) failed from ({_EXPECT})")
def expect_summary(spark, sf_dir):
    return expectations.summary(_checked(spark, sf_dir))
