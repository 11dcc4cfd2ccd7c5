"""Queries of the geometric operators: kernel functions, near joins, coverage, snapping, districts, graphs."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from velonet.functions import geometry as G
from velonet.operators import districts as D
from velonet.operators import edges, graph, matching, merge, near, noding, snapping
from velonet.operators.translate import MIXED, ONE_WAY
from velonet.plans.bindings import DISTRICTS, POINTS, POLYLINES, WAYS, customers, districts, network, other_ways, polylines, read, suppliers, ways
from velonet.plans.registry import query
from velonet.sources.layers import to_geojson

R4 = lambda c: F.round(c, 4)

# Kernel -------------------------------------------------------------------------------------------------------------------


@query(f"with {POLYLINES} select vec_id, round(sum(sqrt((bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay))), 4) length from b3s group by 1")
def geom_length(spark, sf_dir):
    return polylines(spark, sf_dir).select("vec_id", R4(G.length(F.col("geom"))).alias("length"))


_DEG = "(degrees(atan2({dy}, {dx})) + 360) % 360"


@query(f"with {WAYS} select id, round({_DEG.format(dy='by_ - ay', dx='bx - ax')}, 4) bearing, round(degrees(atan2(by_ - ay, bx - ax)), 4) signed from b4")
def geom_bearing(spark, sf_dir):
    return ways(spark, sf_dir).select("id", R4(G.bearing(F.col("geom"))).alias("bearing"), R4(G.bearing_mean(F.col("geom"))).alias("signed"))


@query(f"with {POLYLINES} select vec_id, round((degrees(atan2(v[16].y - v[1].y, v[16].x - v[1].x)) + degrees(atan2(v[32].y - v[17].y, v[32].x - v[17].x))) / 2, 4) mean from b3")
def geom_bearing_mean(spark, sf_dir):
    p = polylines(spark, sf_dir)
    two = F.array(F.slice(F.col("geom")[0], 1, 16), F.slice(F.col("geom")[0], 17, 16))
    return p.select("vec_id", R4(G.bearing_mean(two)).alias("mean"))


@query(f"with {POLYLINES} select vec_id, v[1].x sx, v[1].y sy, v[32].x ex, v[32].y ey from b3")
def geom_endpoints(spark, sf_dir):
    return graph.endpoints(polylines(spark, sf_dir), "vec_id")


@query(f"with {POLYLINES} select vec_id, min(p.x) xmin, min(p.y) ymin, max(p.x) xmax, max(p.y) ymax from (select vec_id, unnest(v) p from b3) group by 1")
def geom_bbox(spark, sf_dir):
    return polylines(spark, sf_dir).select("vec_id", G.bounds(F.col("geom")).alias("b")).select("vec_id", "b.*")


_WALK = """l as (select *, sqrt((bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay)) n from b3s), c as (select *, sum(n) over (partition by vec_id order by i) - n s, sum(n) over (partition by vec_id) total from l)"""


@query(f"with {POLYLINES}, {_WALK} select vec_id, round(arg_max(ax + (bx - ax) * least(1, (total / 3 - s) / n), i), 4) x, round(arg_max(ay + (by_ - ay) * least(1, (total / 3 - s) / n), i), 4) y from c where s < total / 3 group by vec_id")
def geom_interpolate(spark, sf_dir):
    g = F.col("geom")[0]
    return polylines(spark, sf_dir).select("vec_id", G.interpolate(g, G.part_length(g) / 3).alias("p")).select("vec_id", R4(F.col("p.x")).alias("x"), R4(F.col("p.y")).alias("y"))


_LEN = "sqrt((bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay))"
_SEGS = f"seg as (select id, cast(k as integer) piece, case when k = 0 then ax else ax + (bx - ax) * (l * k / n) / l end ax, case when k = 0 then ay else ay + (by_ - ay) * (l * k / n) / l end ay, case when k + 1 = n then bx else ax + (bx - ax) * (l * (k + 1) / n) / l end bx, case when k + 1 = n then by_ else ay + (by_ - ay) * (l * (k + 1) / n) / l end by_ from (select *, unnest(range(0, n)) k from (select *, {_LEN} l, greatest(1, cast(ceil({_LEN} / 2.5) as bigint)) n from net)))"


@query(f"with {WAYS}, {_SEGS} select id, piece, round(ax, 4) ax, round(ay, 4) ay, round(bx, 4) bx, round(by_, 4) \"by\" from seg")
def geom_segmentize_chord(spark, sf_dir):
    s = snapping.segmentize(network(spark, sf_dir), "id")
    return s.select("id", "piece", *[R4(F.col(c)).alias(c) for c in ("ax", "ay", "bx", "by")])


@query(f"with {WAYS} select id, cast(k as integer) piece, round(least((k + 1) * 5.0, l) - k * 5.0, 4) length from (select *, unnest(range(0, greatest(1, cast(ceil(l / 5) as bigint)))) k from (select id, {_LEN} l from net)) where least((k + 1) * 5.0, l) - k * 5.0 > 0")
def geom_segmentize_step(spark, sf_dir):
    p = near.cut_lines(network(spark, sf_dir), "id", 5.0, equal=False)
    return p.select("id", "piece", R4(G.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"))).alias("length"))


@query(f"with {WAYS} select id from wy where {_LEN} < 20")
def geom_short_ways(spark, sf_dir):
    return matching.short_ways(other_ways(spark, sf_dir), 20.0).select("id")


_A, _B = "(id * 7 % 3600) / 10.0", "(id * 13 % 3600) / 10.0"
_DIFF = f"least(abs({_A} - {_B}), 360 - abs({_A} - {_B}))"


@query(f"select id, round({_DIFF}, 4) difference, round(case when {_DIFF} > 90 then 180 - {_DIFF} else {_DIFF} end, 4) folded, cast(case when {_DIFF} < 90 then 0 else 1 end as integer) direction from (select event_id id from events)")
def geom_angle_diff(spark, sf_dir):
    e = read(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.expr("event_id * 7 % 3600 / 10.0d").alias("a"), F.expr("event_id * 13 % 3600 / 10.0d").alias("b"))
    d = G.angle_difference(F.col("a"), F.col("b"))
    return e.select("id", R4(d).alias("difference"), R4(G.fold90(F.col("a") - F.col("b"))).alias("folded"), G.direction(d).alias("direction"))


@query(f"with {WAYS} select id, (bx - ax) * (500 - ay) - (by_ - ay) * (500 - ax) > 0 is_left from b4")
def geom_left_of(spark, sf_dir):
    w = graph.endpoints(ways(spark, sf_dir), "id")
    return w.select("id", G.left_of(F.col("sx"), F.col("sy"), F.col("ex"), F.col("ey"), F.lit(500.0), F.lit(500.0)).alias("is_left"))


@query()
def geom_reproject(spark, sf_dir):
    """There and back again, with the error in millimetres: under one."""
    e = graph.endpoints(ways(spark, sf_dir), "id").select("id", (F.col("sx") + 390000).alias("x"), (F.col("sy") + 5810000).alias("y"))
    p = e.withColumn("ll", G.utm33_to_wgs84(F.col("x"), F.col("y"))).withColumn("back", G.wgs84_to_utm33(F.col("ll.x"), F.col("ll.y")))
    return p.select("id", F.round("ll.x", 6).alias("lon"), F.round("ll.y", 6).alias("lat"), F.round(G.hypot(F.col("back.x") - F.col("x"), F.col("back.y") - F.col("y")) * 1000, 1).alias("error_mm"))


@query()
def geojson_export(spark, sf_dir):
    return to_geojson(network(spark, sf_dir))


# Near joins and coverage ----------------------------------------------------------------------------------------------------


def _pd(px: str, py: str, a: str) -> str:
    dx, dy, ex, ey = f"({a}.bx - {a}.ax)", f"({a}.by_ - {a}.ay)", f"({px} - {a}.ax)", f"({py} - {a}.ay)"
    dot, own, cross = f"({ex} * {dx} + {ey} * {dy})", f"({dx} * {dx} + {dy} * {dy})", f"({ex} * {dy} - {ey} * {dx})"
    end = f"(({px} - {a}.bx) * ({px} - {a}.bx) + ({py} - {a}.by_) * ({py} - {a}.by_))"
    return f"sqrt(case when {dot} <= 0 then {ex} * {ex} + {ey} * {ey} when {dot} >= {own} then {end} else {cross} * {cross} / {own} end)"


def _side(a: str, x: str, y: str) -> str:
    return f"(({a}.bx - {a}.ax) * ({y} - {a}.ay) - ({a}.by_ - {a}.ay) * ({x} - {a}.ax))"


def _dist(a: str, b: str) -> str:
    cross = f"{_side(a, f'{b}.ax', f'{b}.ay')} * {_side(a, f'{b}.bx', f'{b}.by_')} < 0 and {_side(b, f'{a}.ax', f'{a}.ay')} * {_side(b, f'{a}.bx', f'{a}.by_')} < 0"
    return f"case when {cross} then 0 else least({_pd(f'{a}.ax', f'{a}.ay', b)}, {_pd(f'{a}.bx', f'{a}.by_', b)}, {_pd(f'{b}.ax', f'{b}.ay', a)}, {_pd(f'{b}.bx', f'{b}.by_', a)}) end"


def _meet(a: str, b: str, r: float) -> str:
    return f"least({a}.ax, {a}.bx) <= greatest({b}.ax, {b}.bx) + {r} and greatest({a}.ax, {a}.bx) >= least({b}.ax, {b}.bx) - {r} and least({a}.ay, {a}.by_) <= greatest({b}.ay, {b}.by_) + {r} and greatest({a}.ay, {a}.by_) >= least({b}.ay, {b}.by_) - {r}"


_NEAR = f"near as (select n.id net_id, w.id, {_dist('n', 'w')} d from net n join wy w on {_meet('n', 'w', 25)})"


@query(f"with {WAYS}, {_NEAR} select net_id, id, round(d, 4) distance from near where d <= 25")
def near_join_25m(spark, sf_dir):
    n = network(spark, sf_dir).withColumnRenamed("id", "net_id")
    return near.near_join(n, other_ways(spark, sf_dir), 25.0, "net_id", "id").withColumn("distance", R4(F.col("distance")))


@query(f"with {WAYS}, {_NEAR} select w.id, count(d) partners, round(min(d), 4) nearest from wy w left join (select * from near where d <= 25) n on w.id = n.id group by 1")
def near_join_left(spark, sf_dir):
    n = network(spark, sf_dir).withColumnRenamed("id", "net_id")
    j = near.near_join(other_ways(spark, sf_dir), n, 25.0, "id", "net_id", "left")
    return j.groupBy("id").agg(F.count("distance").alias("partners"), R4(F.min("distance")).alias("nearest"))


def _interval_ctes(r: float, flat: bool, target: str = "wy", network: str = "net", tag: str = "") -> str:
    """Shares of target ways within r of the network, as DuckDB reads it: an interval for each cap and rectangle."""
    out = _interval_text(r, flat, target, network)
    return re.sub(r"\b(pr|raw|clipped|iv|mx|cov)\b", rf"\g<1>{tag}", out)


def _interval_text(r: float, flat: bool, target: str, network: str) -> str:
    disc = lambda p: f"(select * from (select k.id, k.net_id, (-b - sqrt(b * b - a * c)) / a lo, (-b + sqrt(b * b - a * c)) / a hi from (select id, net_id, tdx * tdx + tdy * tdy a, (tax - n{p}x) * tdx + (tay - n{p}y) * tdy b, pow(tax - n{p}x, 2) + pow(tay - n{p}y, 2) - {r * r} c from pr) k where b * b - a * c > 0))"
    rng = lambda s, m, lo, hi, w: f"case when abs({m}) < 1e-12 then {'0' if w == 'lo' else '1'} else {'least' if w == 'lo' else 'greatest'}(({lo} - {s}) / {m}, ({hi} - {s}) / {m}) end"
    slab = f"""(select id, net_id, greatest(0, {rng('s1', 'm1', '0', 'span', 'lo')}, {rng('s2', 'm2', -r, r, 'lo')}) lo, least(1, {rng('s1', 'm1', '0', 'span', 'hi')}, {rng('s2', 'm2', -r, r, 'hi')}) hi from (select id, net_id, span, (tax - nax) * ux + (tay - nay) * uy s1, tdx * ux + tdy * uy m1, (tay - nay) * ux - (tax - nax) * uy s2, tdy * ux - tdx * uy m2 from (select *, (nbx - nax) / span ux, (nby - nay) / span uy from pr))
 where (abs(m1) >= 1e-12 or (s1 >= 0 and s1 <= span)) and (abs(m2) >= 1e-12 or (s2 >= {-r} and s2 <= {r})))"""
    every = f"select * from {slab}" + ("" if flat else f" union all select * from {disc('a')} union all select * from {disc('b')}")
    one = "select id, net_id, min(lo) lo, max(hi) hi from clipped group by 1, 2"
    return f"""pr as (select w.id, n.id net_id, w.ax tax, w.ay tay, w.bx - w.ax tdx, w.by_ - w.ay tdy, n.ax nax, n.ay nay, n.bx nbx, n.by_ nby, sqrt(pow(n.bx - n.ax, 2) + pow(n.by_ - n.ay, 2)) span from {target} w join {network} n on {_meet('w', 'n', r)}),
raw as ({every}), clipped as (select id, net_id, greatest(lo, 0) lo, least(hi, 1) hi from raw where greatest(lo, 0) < least(hi, 1)), iv as ({one}),
mx as (select id, lo, hi, coalesce(max(hi) over (partition by id order by lo, hi rows between unbounded preceding and 1 preceding), -1) before from iv),
cov as (select w.id, coalesce(s, 0) fraction from {target} w left join (select id, sum(greatest(0, hi - greatest(lo, before))) s from mx group by 1) using (id))"""


@query(f"with {WAYS}, {_interval_ctes(25.0, False)} select id, round(least(1, fraction), 4) fraction from cov")
def coverage_fraction_round(spark, sf_dir):
    return near.coverage(other_ways(spark, sf_dir), network(spark, sf_dir), 25.0, "id").withColumn("fraction", R4(F.col("fraction")))


@query(f"with {WAYS}, {_interval_ctes(10.0, True)} select id, round(least(1, fraction), 4) fraction from cov")
def coverage_difference_flat(spark, sf_dir):
    return near.coverage(other_ways(spark, sf_dir), network(spark, sf_dir), 10.0, "id", flat=True).withColumn("fraction", R4(F.col("fraction")))


@query(f"with {WAYS}, {_interval_ctes(15.0, False)} select id from cov where fraction >= 0.7")
def match_within_fraction(spark, sf_dir):
    return matching.within_fraction(other_ways(spark, sf_dir), network(spark, sf_dir), 15.0, 0.7, "id").select("id")


@query(f"with {WAYS}, {_interval_ctes(10.0, True)} select id from cov where fraction < 0.8")
def match_without_parallel(spark, sf_dir):
    return matching.without_parallel(other_ways(spark, sf_dir), network(spark, sf_dir), "id").select("id")


@query(f"with {WAYS}, {_interval_ctes(15.0, False)} select id from cov where fraction >= 1 - 1e-9")
def coverage_contained(spark, sf_dir):
    return matching.contained(other_ways(spark, sf_dir), network(spark, sf_dir), 15.0, "id").where("contained").select("id")


@query(f"with {WAYS}, {_interval_ctes(15.0, False)} select id from cov where not fraction >= 1 - 1e-9")
def coverage_gaps(spark, sf_dir):
    return matching.contained(other_ways(spark, sf_dir), network(spark, sf_dir), 15.0, "id").where("not contained").select("id")


@query(f"with {WAYS}, {_interval_ctes(15.0, False)}, ok as (select wy.* from wy join cov using (id) where fraction >= 1 - 1e-9), {_interval_ctes(15.0, False, 'net', 'ok', '2')} select id, 'detailnetz' edge_source from ok union all select id, 'rvn' from cov2 where not fraction >= 1 - 1e-9")
def enrich_network(spark, sf_dir):
    return matching.enrich(other_ways(spark, sf_dir).select("id", "geom"), network(spark, sf_dir), 15.0).select("id", "edge_source")


_PN = "select c.id, s.id node, sqrt(pow(c.x - s.x, 2) + pow(c.y - s.y, 2)) d from cp c join sp s on abs(c.x - s.x) <= {r} and abs(c.y - s.y) <= {r}"


@query(f"with {POINTS}, j as ({_PN.format(r=30)}) select c.id, n.node, round(n.d, 4) distance from cp c left join (select id, arg_min(node, row(d, node)) node, min(d) d from j where d <= 30 group by 1) n using (id)")
def nearest_node(spark, sf_dir):
    s = suppliers(spark, sf_dir).withColumnRenamed("id", "node")
    return near.nearest_point(customers(spark, sf_dir), s, 30.0, "id", "node").withColumn("distance", R4(F.col("distance")))


@query(f"with {POINTS}, j as ({_PN.format(r=1)}) select c.id, n.node from cp c left join (select id, arg_min(node, row(d, node)) node from j where d <= 1 group by 1) n using (id)")
def nearest_node_1m(spark, sf_dir):
    s = suppliers(spark, sf_dir).withColumnRenamed("id", "node")
    return near.nearest_point(customers(spark, sf_dir), s, 1.0, "id", "node").drop("distance")


@query(f"with {POINTS}, {WAYS} select distinct c.id from cp c join net n on c.x between least(n.ax, n.bx) - 10 and greatest(n.ax, n.bx) + 10 and c.y between least(n.ay, n.by_) - 10 and greatest(n.ay, n.by_) + 10 where {_pd('c.x', 'c.y', 'n')} <= 10")
def points_near_network(spark, sf_dir):
    """Points within 10 m of the network."""
    c = customers(spark, sf_dir)
    p = c.select("id", F.col("x").alias("ax"), F.col("y").alias("ay"), (F.col("x") + 1e-9).alias("bx"), F.col("y").alias("by"))
    n = near.explode_pieces(network(spark, sf_dir), "id").select(F.col("id").alias("net_id"), "ax", "ay", "bx", "by")
    return near.near_pieces(p, n, 10.0).select(F.col("l_id").alias("id")).distinct()


# Snapping -------------------------------------------------------------------------------------------------------------------

_PRIO = "greatest(0, case when tilda_traffic_sign = 'DE:240' then 3 else 0 end, case when starts_with(tilda_category, 'bicycleRoad') or starts_with(tilda_category, 'cycleway') then 6 when starts_with(tilda_category, 'footAndCycleway') then 5 when tilda_category = 'sharedMotorVehicleLane' then 1 else 0 end)"
_MID = _pd("(s.ax + s.bx) / 2", "(s.ay + s.by_) / 2", "w")
_SL = "sqrt(pow(s.bx - s.ax, 2) + pow(s.by_ - s.ay, 2))"
_GX, _GY = f"25 * abs(s.by_ - s.ay) / {_SL}", f"25 * abs(s.bx - s.ax) / {_SL}"
_BOX = f"least(w.ax, w.bx) <= greatest(s.ax, s.bx) + {_GX} and greatest(w.ax, w.bx) >= least(s.ax, s.bx) - {_GX} and least(w.ay, w.by_) <= greatest(s.ay, s.by_) + {_GY} and greatest(w.ay, w.by_) >= least(s.ay, s.by_) - {_GY}"
_SB, _WB = _DEG.format(dy="s.by_ - s.ay", dx="s.bx - s.ax"), _DEG.format(dy="w.by_ - w.ay", dx="w.bx - w.ax")
_ONE = f"coalesce(verkehrsri = '{ONE_WAY}', false)"
_CAND = f"""{WAYS}, {_SEGS},
sw as (select s.id net_id, s.piece, w.id way, {_dist('s', 'w')} d, {_MID} mid, least(abs({_SB} - {_WB}), 360 - abs({_SB} - {_WB})) angle, {_PRIO} prio, {_ONE} one_way, coalesce(fuehr = '{MIXED}', false) mixed, coalesce(tilda_oneway = 'yes_dual_carriageway', false) dual from seg s join wy w on {_meet('s', 'w', 25)} and {_BOX}),
c as (select *, case when angle < 90 then 0 else 1 end own from sw where d <= 25)"""
_RANK = "row(case when one_way then case when own = {ri} then -10 else 0 end else -1 end, -prio, mid, way)"
_BEST = f"""{_CAND}, best as (select net_id, piece, arg_min(way, {_RANK.format(ri=0)}) w0, arg_min(way, {_RANK.format(ri=1)}) w1, arg_min(way, row(case when one_way then 0 else -1 end, -prio, mid, way)) wa, arg_min(own, row(case when one_way then 0 else -1 end, -prio, mid, way)) oa, bool_and(one_way and mixed and not dual) single from c group by 1, 2),
v as (select s.id net_id, s.piece, r.ri, case when w0 is null then null when single then wa when r.ri = 0 then w0 else w1 end way, case when w0 is null then 1 when single then 2 else 4 end "case" from seg s left join best b on s.id = b.net_id and s.piece = b.piece, (values (0), (1)) r(ri) where not coalesce(single, false) or r.ri = oa)"""


def _snap_parts(spark, sf_dir):
    seg = snapping.segmentize(network(spark, sf_dir), "id").withColumn("_seg", F.struct("id", "piece"))
    w = other_ways(spark, sf_dir).withColumnRenamed("id", "way")
    return seg, w


@query(f"with {_CAND} select net_id, piece, count(*) candidates, round(min(d), 4) nearest, max(prio) prio from c group by 1, 2")
def snap_candidates(spark, sf_dir):
    seg, w = _snap_parts(spark, sf_dir)
    found = snapping.candidates(seg, w, "_seg", "way")
    prio = w.select("way", snapping.priority(F.col("tilda_category"), F.col("tilda_traffic_sign")).alias("prio"))
    return found.join(prio, "way").groupBy(F.col("_seg.id").alias("net_id"), F.col("_seg.piece").alias("piece")).agg(F.count("*").alias("candidates"), R4(F.min("distance")).alias("nearest"), F.max("prio").alias("prio"))


@query(f'with {_BEST} select net_id, piece, ri, way, "case" from v')
def snap_variants(spark, sf_dir):
    seg, w = _snap_parts(spark, sf_dir)
    return snapping.variants(seg, snapping.best_ways(seg, w, "_seg", "way"), "_seg", "way").select(F.col("_seg.id").alias("net_id"), F.col("_seg.piece").alias("piece"), "ri", "way", "case")


@query(f'with {_BEST} select net_id, piece, w0, w1 from best')
def snap_best_candidate(spark, sf_dir):
    best = snapping.best_ways(*_snap_parts(spark, sf_dir), "_seg", "way")
    return best.select(F.col("_seg.id").alias("net_id"), F.col("_seg.piece").alias("piece"), F.col("b0.way").alias("w0"), F.col("b1.way").alias("w1"))


_NOTHING = snapping.NOTHING
_ROWS = f"""{_BEST}, rows_ as (select v.net_id, v.piece, v.ri, case when "case" = 1 then '{_NOTHING}' else w.fuehr end fuehr, w.verkehrsri, w.breite from v left join wy w on v.way = w.id),
m as (select net_id, ri, fuehr, verkehrsri, breite, min(piece) first, sum(sl) len from (select r.*, sqrt(pow(s.bx - s.ax, 2) + pow(s.by_ - s.ay, 2)) sl from rows_ r join seg s on r.net_id = s.id and r.piece = s.piece) group by 1, 2, 3, 4, 5)"""


def _snapped(spark, sf_dir):
    n = network(spark, sf_dir).select("id", F.col("id").cast("string").alias("element_nr"), F.lit(None).cast("string").alias("beginnt_bei_vp"), F.lit(None).cast("string").alias("endet_bei_vp"), "geom")
    return snapping.snap(n, other_ways(spark, sf_dir).withColumnRenamed("id", "way_id"), "id")


_PARTS = """q as (select r.net_id, r.ri, r.fuehr, r.verkehrsri, r.breite, r.piece, s.ax, s.ay, s.bx, s.by_, r.piece - lag(r.piece) over (partition by r.net_id, r.ri, r.fuehr, r.verkehrsri, r.breite order by r.piece) step from rows_ r join seg s on r.net_id = s.id and r.piece = s.piece),
gm as (select net_id, ri, fuehr, verkehrsri, breite, cast(count(*) filter (step is null or step > 1) as integer) parts, cast(count(*) + count(*) filter (step is null or step > 1) as integer) vertices, round(arg_min(ax, piece), 4) sx, round(arg_min(ay, piece), 4) sy, round(arg_max(bx, piece), 4) ex, round(arg_max(by_, piece), 4) ey from q group by 1, 2, 3, 4, 5)"""


@query(
    f"with {_ROWS}, {_PARTS} select cast(net_id as varchar) element_nr, ri, m.fuehr, m.verkehrsri, case when m.fuehr = '{MIXED}' then null else m.breite end breite, cast(round_even(round(len, 6), 0) as integer) \"Länge\", parts, vertices, sx, sy, ex, ey "
    "from m join gm using (net_id, ri) where m.fuehr is not distinct from gm.fuehr and m.verkehrsri is not distinct from gm.verkehrsri and m.breite is not distinct from gm.breite"
)
def snap_merge_segments(spark, sf_dir):
    """With the merged geometry: its parts and vertices, where it begins and ends."""
    g = F.col("geom")
    first, last = G.first_point(g), G.last_point(g)
    shape = [F.size(g).alias("parts"), F.size(F.flatten(g)).alias("vertices"), *[R4(p[v]).alias(f"{c}{v}") for c, p in (("s", first), ("e", last)) for v in "xy"]]
    return _snapped(spark, sf_dir).select("element_nr", "ri", "fuehr", "verkehrsri", "breite", "Länge", *shape)


@query(f"with {_ROWS} select cast(row_number() over (order by net_id, first, ri) as integer) sfid, cast(net_id as varchar) element_nr, ri from m")
def snap_sfid(spark, sf_dir):
    return _snapped(spark, sf_dir).select("sfid", "element_nr", "ri")


@query()
def orthogonal_removed(spark, sf_dir):
    """Short ways that cross the network: angles of the longest run of chords decide. No SQL: a test compares with all pairs."""
    c = matching.crossing_short_ways(other_ways(spark, sf_dir), network(spark, sf_dir), "id")
    return c.where("removed").select("id", R4(F.col("angle")).alias("angle"))


@query()
def orthogonal_complex_kept(spark, sf_dir):
    """Ways across the longest run that stay, as the network bends beside them; compared with all pairs as well."""
    c = matching.crossing_short_ways(other_ways(spark, sf_dir), network(spark, sf_dir), "id")
    return c.where("not removed and angle > 50").select("id", R4(F.col("spread")).alias("spread"), R4(F.col("parallel")).alias("parallel"))


@query()
def match_layers(spark, sf_dir):
    """The whole matching stage, the orders' ways dealt out to three layers by key."""
    w = other_ways(spark, sf_dir).withColumn("tilda_id", F.col("id").cast("string")).withColumnRenamed("id", "seq").withColumn("tilda_bikelane_left", F.when(F.col("seq") % 5 == 0, "separate_geometry")).withColumn("tilda_bikelane_right", F.lit("data_no"))
    layers = {n: w.where(F.col("seq") % 3 == k) for k, n in enumerate(("bikelanes", "streets", "paths"))}
    return matching.match(layers, network(spark, sf_dir))["matched"].select("seq", "data_source", "tilda_id")


# Districts ------------------------------------------------------------------------------------------------------------------


@query(f"with {POINTS}, {DISTRICTS} select c.id, right(d.gem, 2) district from cp c left join b5 d on c.x >= d.x and c.x < d.x + 200 and c.y >= d.y and c.y < d.y + 200")
def district_of_point(spark, sf_dir):
    return D.district_of_point(customers(spark, sf_dir), districts(spark, sf_dir), "id", order="k")


def _rect(w: str) -> str:
    """Where the way w enters and leaves the square d, as parameters."""
    t = lambda s, m, lo: f"case when {m} = 0 then {{flat}} else {{f}}(({lo} - {s}) / {m}, ({lo} + 200 - {s}) / {m}) end"
    x, y = t(f"{w}.ax", f"({w}.bx - {w}.ax)", "d.x"), t(f"{w}.ay", f"({w}.by_ - {w}.ay)", "d.y")
    return f"greatest(0, {x.format(flat='0', f='least')}, {y.format(flat='0', f='least')}) lo, least(1, {x.format(flat='1', f='greatest')}, {y.format(flat='1', f='greatest')}) hi"


_INSIDE = f"""ins as (select w.id, d.k, d.gem, {_rect('w')}, {_LEN.replace('ax', 'w.ax').replace('bx', 'w.bx').replace('by_', 'w.by_').replace('ay', 'w.ay')} l from b4 w join b5 d on least(w.ax, w.bx) < d.x + 200 and greatest(w.ax, w.bx) > d.x and least(w.ay, w.by_) < d.y + 200 and greatest(w.ay, w.by_) > d.y
 where (w.ax <> w.bx or (w.ax > d.x and w.ax < d.x + 200)) and (w.ay <> w.by_ or (w.ay > d.y and w.ay < d.y + 200)))"""


@query(f"with {WAYS}, {DISTRICTS}, {_INSIDE}, s as (select id, k, gem, cast(round_even((hi - lo) * l * 1000, 0) as bigint) mm from ins where hi > lo) select w.id, right(b.gem, 2) \"Bezirksnummer\" from b4 w left join (select id, arg_min(gem, row(-mm, k)) gem from s where mm > 0 group by 1) b using (id)")
def district_largest_share(spark, sf_dir):
    return D.district_by_length(ways(spark, sf_dir), districts(spark, sf_dir), "id", order="k")


@query(f"with {WAYS}, {DISTRICTS}, {_INSIDE} select id, round(sum((hi - lo) * l), 3) length from ins where hi > lo and (hi - lo) * l > 1e-9 group by 1")
def clip_lines(spark, sf_dir):
    c = D.clip_lines(ways(spark, sf_dir), districts(spark, sf_dir), "id")
    return c.select("id", F.round(G.length(F.col("geom")), 3).alias("length"))


# Graphs ---------------------------------------------------------------------------------------------------------------------

_CHAIN = "ch as (select o_orderkey k, o_orderkey % 500 src, (o_orderkey * 3 + 1) % 500 dst from orders)"


@query(f"with {_CHAIN} select arg_max(k, k) k, least(src, dst) a, greatest(src, dst) b from ch group by 2, 3")
def graph_simple_edges(spark, sf_dir):
    e = read(spark, sf_dir, "orders").selectExpr("o_orderkey k", "o_orderkey % 500 src", "(o_orderkey * 3 + 1) % 500 dst")
    return graph.simple_edges(e, "src", "dst", "k").select("k", F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))


@query("with recursive e as (select distinct p_partkey src, (p_partkey * 7 + 3) % (select count(*) * 2 from part) dst from part), b as (select src, dst from e union select dst, src from e), r(start, node, hops) as (select p_partkey, p_partkey, 0 from part where p_size = 1 union select start, dst, hops + 1 from r join b on node = src where hops < 4) select start, node, min(hops) hops from r group by 1, 2")
def chain_reachability(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    n = p.count()
    e = p.select(F.col("p_partkey").alias("src"), F.expr(f"(p_partkey * 7 + 3) % {2 * n}").alias("dst"))
    return graph.reach(e, p.where("p_size = 1").select(F.col("p_partkey").alias("start")), 4)


@query()
def chain_reachability_from_every_node(spark, sf_dir):
    """The whole walk: from every node, to the operator's default depth of 50; tests compare with a breadth-first walk."""
    p = read(spark, sf_dir, "part")
    n = p.count()
    e = p.select(F.col("p_partkey").alias("src"), F.expr(f"(p_partkey * 7 + 3) % {2 * n}").alias("dst"))
    return graph.reach(e, e.select(F.explode(F.array("src", "dst")).alias("start")))


_CLUST = f"with recursive {POINTS}, b as (select a.id x, b.id y from sp a join sp b on pow(a.x - b.x, 2) + pow(a.y - b.y, 2) <= 60 * 60), r(id, c) as (select id, id from sp union select y, c from r join b on r.id = b.x), cl as (select id, min(c) \"cluster\" from r group by 1)"


@query(f"{_CLUST} select id, \"cluster\" as \"cluster\" from cl")
def cluster_components(spark, sf_dir):
    return graph.clusters(suppliers(spark, sf_dir), 60.0, "id")


@query(f"{_CLUST} select \"cluster\" as \"cluster\", count(*) n, round(avg(x), 4) x, round(avg(y), 4) y from (select distinct \"cluster\", x, y from cl join sp using (id)) group by 1")
def cluster_centroids(spark, sf_dir):
    s = suppliers(spark, sf_dir)
    return graph.centroids(s, graph.clusters(s, 60.0, "id"), "id").withColumn("x", R4(F.col("x"))).withColumn("y", R4(F.col("y")))


@query(f"with {POINTS}, {WAYS}, e as (select 0 o, id s, ax x, ay y, 'b' || id nid from b4 union all select 1, id, bx, by_, 'e' || id from b4), f as (select x, y, arg_min(nid, row(o, s)) nid from e group by 1, 2) select c.id, f.nid node_id from cp c left join f using (x, y)")
def node_ids_from_endpoints(spark, sf_dir):
    w = ways(spark, sf_dir).select("id", "geom", F.concat(F.lit("b"), "id").alias("begin_id"), F.concat(F.lit("e"), "id").alias("end_id"))
    return graph.node_ids(customers(spark, sf_dir), w, "id", "id").withColumnRenamed("node_id", "node_id")


def _grid(spark, sf_dir, steps=1):
    """Steps of a sparse grid, to the east or the north."""
    lines = read(spark, sf_dir, "part").selectExpr("p_partkey id", "p_partkey % 40 x", "p_partkey div 40 y", "p_size s")
    step = F.when(F.col("s") % 2 == 0, F.struct(F.lit(1).alias("x"), F.lit(0).alias("y"))).otherwise(F.struct(F.lit(0).alias("x"), F.lit(1).alias("y")))
    return lines.withColumn("d", step).select("id", G.line(G.point(F.col("x") * 10, F.col("y") * 10), G.point((F.col("x") + F.col("d.x") * steps) * 10, (F.col("y") + F.col("d.y") * steps) * 10)).alias("geom"))


@query()
def element_numbers(spark, sf_dir):
    """Edge numbers of chains between nodes on a grid: order-dependent within a component; tests compare with a plain walk."""
    lines = _grid(spark, sf_dir)
    nodes = read(spark, sf_dir, "supplier").selectExpr("s_suppkey node", "cast(s_suppkey * 7 % 41 * 10 as double) x", "cast(s_suppkey * 11 % 51 * 10 as double) y")
    return graph.element_numbers(lines, nodes, "id", "node")


@query()
def explore_from_open_ends(spark, sf_dir):
    """The whole walk from each end of the grid's steps that has no node, to the first node that it meets; tests compare with a plain walk."""
    place = lambda p: F.concat_ws(",", f"{p}x", f"{p}y")
    e = graph.endpoints(_grid(spark, sf_dir), "id").select("id", place("s").alias("src"), place("e").alias("dst"))
    stops = read(spark, sf_dir, "supplier").selectExpr("concat_ws(',', cast(s_suppkey * 7 % 41 * 10 as double), cast(s_suppkey * 11 % 51 * 10 as double)) at", "s_suppkey node").groupBy("at").agg(F.min("node").alias("node"))
    ends = e.select(F.col("id").alias("own"), F.explode(F.array(F.struct(F.lit("s").alias("end"), F.col("src").alias("at")), F.struct(F.lit("e").alias("end"), F.col("dst").alias("at")))).alias("p"))
    starts = ends.select(F.concat_ws(":", "own", "p.end").alias("start"), "own", "p.at").join(stops, "at", "left_anti")
    found = graph.explore(e.withColumnRenamed("id", "segment"), starts, stops, limit=None)
    return found.select("start", F.array_join(F.col("segments").cast("array<string>"), ",").alias("segments"), "node")


_STEPS = "st as (select p_partkey id, p_partkey % 40 * 10 ax, p_partkey // 40 * 10 ay, p_partkey % 40 * 10 + if(p_size % 2 = 0, 10, 0) bx, p_partkey // 40 * 10 + if(p_size % 2 = 0, 0, 10) by_ from part)"
_JOINTS = "en as (select id, ax x, ay y from st union all select id, bx, by_ from st), jo as (select min(id) a, max(id) b from en group by x, y having count(*) = 2 and min(id) <> max(id)), bo as (select a, b from jo union select b, a from jo)"


@query(f"with recursive {_STEPS}, {_JOINTS}, re(id, c) as (select id, id from st union select b, c from re join bo on id = a), ch as (select id, min(c) c from re group by 1), jn as (select c, count(*) joints from jo join ch on a = id group by 1) select ch.c id, 2 * count(*) - coalesce(any_value(joints), 0) vertices, cast(10 * count(*) as double) length from ch left join jn using (c) group by 1")
def network_chains(spark, sf_dir):
    """The network merged where two ends meet: vertices and length of each chain."""
    c = merge.merge_network(_grid(spark, sf_dir), noded=False)
    return c.select("id", F.size(F.get("geom", 0)).cast("bigint").alias("vertices"), G.length(F.col("geom")).alias("length"))


_CUTS = """pr as (select a.id i, b.id j, a.ax, a.ay, a.bx, a.by_, b.ax cx, b.ay cy, b.bx dx, b.by_ dy from net a join net b on a.id < b.id and least(a.ax, a.bx) <= greatest(b.ax, b.bx) and least(b.ax, b.bx) <= greatest(a.ax, a.bx) and least(a.ay, a.by_) <= greatest(b.ay, b.by_) and least(b.ay, b.by_) <= greatest(a.ay, a.by_)),
sd as (select *, (dx - cx) * (ay - cy) - (dy - cy) * (ax - cx) sa, (dx - cx) * (by_ - cy) - (dy - cy) * (bx - cx) sb, (bx - ax) * (cy - ay) - (by_ - ay) * (cx - ax) sc, (bx - ax) * (dy - ay) - (by_ - ay) * (dx - ax) sd from pr),
x0 as (select *, round(ax + (bx - ax) * sa / (sa - sb), 6) x, round(ay + (by_ - ay) * sa / (sa - sb), 6) y from sd where sa * sb < 0 and sc * sd < 0),
ct as (select i id, x, y from x0 union select j, x, y from x0 union select j, ax, ay from sd where sa = 0 and (ax - cx) * (ax - dx) + (ay - cy) * (ay - dy) < 0 union select j, bx, by_ from sd where sb = 0 and (bx - cx) * (bx - dx) + (by_ - cy) * (by_ - dy) < 0
 union select i, cx, cy from sd where sc = 0 and (cx - ax) * (cx - bx) + (cy - ay) * (cy - by_) < 0 union select i, dx, dy from sd where sd = 0 and (dx - ax) * (dx - bx) + (dy - ay) * (dy - by_) < 0),
st as (select id, ax x, ay y from net union select id, bx, by_ from net union select id, x, y from ct),
sp_ as (select id, row(x, y) a, lead(row(x, y)) over (partition by id order by (x - ax) * (bx - ax) + (y - ay) * (by_ - ay)) b from st join net using (id)),
nd as (select min(id) id, least(a, b) lo, greatest(a, b) hi from sp_ where b is not null group by 2, 3)"""


@query(f"with {WAYS}, {_CUTS} select id, count(*) pieces, round(sum(sqrt(pow(lo[1] - hi[1], 2) + pow(lo[2] - hi[2], 2))), 3) length from nd group by 1")
def network_noded(spark, sf_dir):
    """The network cut where its lines cross or touch; what lies twice belongs to the least line."""
    p = noding.noded_pieces(network(spark, sf_dir), "id")
    return p.groupBy("id").agg(F.count("*").alias("pieces"), F.round(F.sum(G.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"))), 3).alias("length"))


_LONG_STEPS = "net as (select p_partkey id, p_partkey % 40 * 10.0::double ax, p_partkey // 40 * 10.0::double ay, p_partkey % 40 * 10 + if(p_size % 2 = 0, 30.0::double, 0) bx, p_partkey // 40 * 10 + if(p_size % 2 = 0, 0, 30.0::double) by_ from part)"


@query(
    f"with recursive {_LONG_STEPS}, {_CUTS}, pc as (select row_number() over (order by lo, hi) p, * from nd), en as (select p, lo v from pc union all select p, hi from pc), jo as (select min(p) a, max(p) b from en group by v having count(*) = 2), bo as (select a, b from jo union select b, a from jo), "
    "re(p, c) as (select p, p from pc union select b, c from re join bo on p = a), ch as (select p, min(c) c from re group by 1), ln as (select c, count(*) pieces, sum(sqrt(pow(lo[1] - hi[1], 2) + pow(lo[2] - hi[2], 2))) l from ch join pc using (p) group by 1) select pieces, count(*) chains, round(sum(l), 2) length from ln group by 1"
)
def network_noded_chains(spark, sf_dir):
    """Steps of three units, which cross, touch and lie on each other: their chains between junctions, by their number of pieces."""
    g = merge.merge_network(_grid(spark, sf_dir, 3)).select(F.explode("geom").alias("line")).select((F.size("line") - 1).cast("bigint").alias("pieces"), G.length(F.array("line")).alias("l"))
    return g.groupBy("pieces").agg(F.count("*").alias("chains"), F.round(F.sum("l"), 2).alias("length"))


@query(
    "with recursive s as (select p_partkey % 23 e, p_partkey % 2 ri, p_partkey q, p_partkey % 40 * 10 ax, p_partkey // 40 * 10 ay, p_partkey % 40 * 10 + if(p_size % 2 = 0, 10, 0) bx, p_partkey // 40 * 10 + if(p_size % 2 = 0, 0, 10) by_ from part), "
    "en as (select e, ri, q, ax x, ay y from s union all select e, ri, q, bx, by_ from s), jo as (select min(q) a, max(q) b from en group by e, ri, x, y having count(*) = 2 and min(q) <> max(q)), bo as (select a, b from jo union select b, a from jo), "
    "re(q, c) as (select q, q from s union select b, c from re join bo on q = a), ch as (select q, min(c) c from re group by 1) select cast(e as varchar) element_nr, cast(ri as integer) ri, cast(count(distinct c) as integer) parts, cast(10 * count(*) as double) length from s join ch using (q) group by 1, 2"
)
def edge_merged_lines(spark, sf_dir):
    """Edges of the grid's steps, aggregated: the parts that are left once their sections are merged, and their length."""
    steps = _grid(spark, sf_dir).select(F.expr("cast(id % 23 as string)").alias("element_nr"), F.expr("cast(id % 2 as int)").alias("ri"), F.col("id").alias("seq"), F.lit(10.0).alias("length"), "geom")
    e = edges.aggregate_edges(steps, geom="geom")
    return e.select("element_nr", "ri", F.size("geom").alias("parts"), G.length(F.col("geom")).alias("length"))


@query("select count(*) segments, count(*) filter (b is not null and e is not null) \"both\", count(*) filter ((b is null) <> (e is null)) one, count(*) filter (b is null and e is null) \"none\" from (select case when o_orderkey % 3 > 0 then o_orderkey end b, case when o_custkey % 4 > 0 then o_custkey end e from orders)")
def node_coverage(spark, sf_dir):
    return graph.node_coverage(read(spark, sf_dir, "orders").selectExpr("if(o_orderkey % 3 > 0, o_orderkey, null) b", "if(o_custkey % 4 > 0, o_custkey, null) e"), "b", "e")


@query(f"with {WAYS} select id, cast(greatest(1, cast(round_even(l, 0) as bigint)) // 2 as integer) piece, round(l / greatest(1, round_even(l, 0)), 4) length from (select id, {_LEN} l from net)")
def geom_middle_metre(spark, sf_dir):
    """The middle one of each edge's pieces of about a metre."""
    m = near.middle_pieces(near.cut_lines(network(spark, sf_dir), "id", 1.0, nearest=True, least=0.01), "id")
    return m.select("id", "piece", R4(G.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"))).alias("length"))
