"""Attributes of ways onto short network segments, per direction, and merging of equal neighbours."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velonet.functions import geometry as G
from velonet.functions.text import has_traffic_sign, merge_key, opt, whole
from velonet.operators import near
from velonet.operators.merge import merge_parts
from velonet.operators.near import cut_lines
from velonet.operators.scratch import kept, written
from velonet.operators.sets import ROWS_A_TASK, number_rows
from velonet.operators.translate import MIXED, ONE_WAY

# Fixed values ---------------------------------------------------------------------------------------------------------
NOTHING = "Keine Radinfrastruktur vorhanden"
MERGE_ATTRIBUTES = ("fuehr", "ofm", "protek", "pflicht", "breite", "farbe", "ri", "verkehrsri", "trennstreifen", "nutz_beschr", "Kommentar")
EXTRA_ATTRIBUTES = ("data_source", "tilda_id", "tilda_name", "tilda_oneway", "tilda_category", "tilda_traffic_sign", "tilda_mapillary", "tilda_mapillary_traffic_sign", "tilda_mapillary_backward", "tilda_mapillary_forward")
EDGE_ATTRIBUTES = ("element_nr", "beginnt_bei_vp", "endet_bei_vp", "Bezirksnummer", "strassenname", "edge_source")
LEADING = ("sfid", "element_nr", "beginnt_bei_vp", "endet_bei_vp", "Länge", "ri", "verkehrsri", "Bezirksnummer", "strassenname", "fuehr", "pflicht", "breite", "ofm", "farbe", "protek", "trennstreifen", "nutz_beschr", "Kommentar")
SIGN_PRIORITY = {"237": 3, "240": 3, "241": 3}
CATEGORY_PREFIX_PRIORITY = {"bicycleRoad": 6, "cycleway": 6, "footAndCycleway": 5, "footwayBicycle": 4}
CATEGORY_PRIORITY = {"sharedBusLaneBikeWithBus": 3, "sharedBusLaneBusWithBike": 2, "pedestrianAreaBicycleYes": 2, "sharedMotorVehicleLane": 1}
# ----------------------------------------------------------------------------------------------------------------------


#: Rises with each change of how segments are cut: segments kept by older code aren't read.
SEGMENTS_VERSION = 2


@dataclass(frozen=True)
class SnapOptions:
    """Metres. strict_box: a way must also meet the box of the segment's flat-capped buffer, which leaves out ways beyond its ends.
    reuse: a network from files is cut once; later runs over the same files with the same step read its segments again."""

    radius: float = 25.0
    step: float = 2.5
    strict_box: bool = True
    reuse: bool = True


def priority(category: Column, sign: Column) -> Column:
    """How much a way is preferred: the most that its sign and category give; 0 for neither."""
    some = [F.when(has_traffic_sign(sign, s), p) for s, p in SIGN_PRIORITY.items()]
    some += [F.when(category.startswith(c), p) for c, p in CATEGORY_PREFIX_PRIORITY.items()]
    some += [F.when(category == c, p) for c, p in CATEGORY_PRIORITY.items()]
    return F.coalesce(F.greatest(F.lit(0), *some), F.lit(0))


def segmentize(network: DataFrame, edge_key: str, step: float = 2.5) -> DataFrame:
    """(edge_key, part, piece, ax, ay, bx, by, bearing): each part as equal chords of at most `step` metres."""
    return cut_lines(network, edge_key, step).withColumn("bearing", F.pmod(F.degrees(F.atan2(F.col("by") - F.col("ay"), F.col("bx") - F.col("ax"))), F.lit(360.0)))


def _near(segments: DataFrame, ways: DataFrame, seg_key: str, way_key: str, o: SnapOptions) -> DataFrame:
    """Pieces of ways near segments: (seg_key, way_key, distance, mid, angle, own, and what ranks the way). A way with several
    pieces near a segment has several rows.

    What ranks a way is a dozen numbers, which its pieces carry into the join of cells; attributes don't cross it."""
    box, c = G.bounds(F.col("geom")), F.col
    one_way = F.coalesce(opt(ways, "verkehrsri") == ONE_WAY, F.lit(False))
    rank = {
        "one_way": one_way,
        "single": one_way & F.coalesce(opt(ways, "fuehr") == MIXED, F.lit(False)) & ~F.coalesce(opt(ways, "tilda_oneway") == "yes_dual_carriageway", F.lit(False)),
        "prio": priority(opt(ways, "tilda_category"), opt(ways, "tilda_traffic_sign")),
        "bearing": G.bearing(F.col("geom")),
        **{v: box[v] for v in ("xmin", "ymin", "xmax", "ymax")},
    }
    w = ways.select(way_key, "geom", *[e.alias(n) for n, e in rank.items()])
    pieces = near.explode_pieces(w, way_key, "geom", 10 * near.cell_size(o.radius), tuple(rank)).drop("part", "piece", "sub", "at_start", "at_end")
    seg = segments.select(seg_key, "ax", "ay", "bx", "by", "bearing").where("ax <> bx or ay <> by")
    p = near.near_pieces(seg, pieces, o.radius)
    if o.strict_box:
        n = G.hypot(c("l_bx") - c("l_ax"), c("l_by") - c("l_ay"))
        gx, gy = o.radius * F.abs(c("l_by") - c("l_ay")) / n, o.radius * F.abs(c("l_bx") - c("l_ax")) / n
        p = p.where((c("r_xmin") <= F.greatest("l_ax", "l_bx") + gx) & (c("r_xmax") >= F.least("l_ax", "l_bx") - gx) & (c("r_ymin") <= F.greatest("l_ay", "l_by") + gy) & (c("r_ymax") >= F.least("l_ay", "l_by") - gy))
    mid = G.point_piece_distance((c("l_ax") + c("l_bx")) / 2, (c("l_ay") + c("l_by")) / 2, c("r_ax"), c("r_ay"), c("r_bx"), c("r_by"))
    angle = G.angle_difference(c("l_bearing"), c("r_bearing"))
    return p.select(c(f"l_{seg_key}").alias(seg_key), c(f"r_{way_key}").alias(way_key), "distance", mid.alias("mid"), angle.alias("angle"), G.direction(angle).alias("own"), *[c(f"r_{n}").alias(n) for n in ("one_way", "single", "prio")])


def candidates(segments: DataFrame, ways: DataFrame, seg_key: str, way_key: str, opts: SnapOptions | None = None) -> DataFrame:
    """(seg_key, way_key, distance, mid_distance, angle, own): ways near each segment, once each.

    segments: seg_key, ax, ay, bx, by, bearing."""
    p = _near(segments, ways, seg_key, way_key, opts or SnapOptions())
    return p.groupBy(seg_key, way_key).agg(F.min("distance").alias("distance"), F.min("mid").alias("mid_distance"), F.first("angle").alias("angle"), F.first("own").alias("own"))


def best_ways(segments: DataFrame, ways: DataFrame, seg_key: str, way_key: str, opts: SnapOptions | None = None) -> DataFrame:
    """(seg_key, b0, b1, any, single) of each segment with a candidate: the best way and its direction for direction 0, for 1 and for
    neither; whether all are one-way mixed traffic and none is part of a dual carriageway.

    Best is the most compatible, then the highest priority, then the nearest to the middle, then the least key: a least struct, which
    combines before the one shuffle of pairs."""
    best = _best(_near(segments, ways, seg_key, way_key, opts or SnapOptions()), seg_key, way_key)
    return best.select(seg_key, *[F.struct(F.col(f"{b}.way"), F.col(f"{b}.own")).alias(b) for b in ("b0", "b1", "any")], "single")


def _best(near_rows: DataFrame, seg_key: str, way_key: str, *also: Column) -> DataFrame:
    """best_ways() of _near(), and what else is asked of a segment's rows. A row without a distance is no candidate; b0, b1 and any are null without one."""
    rank = lambda ri: F.when(F.col("mid").isNotNull(), F.struct(-compatibility(F.col("one_way"), F.col("own"), ri), -F.col("prio"), F.col("mid"), F.col(way_key).alias("way"), F.col("own")))
    return near_rows.groupBy(seg_key).agg(F.min(rank(0)).alias("b0"), F.min(rank(1)).alias("b1"), F.min(rank(None)).alias("any"), F.bool_and("single").alias("single"), *also)


def compatibility(one_way: Column, own: Column, ri: int | None) -> Column:
    """One-way ways count 10 in their own direction and 0 in the other (or if none is asked for); others 1."""
    hit = F.lit(0) if ri is None else F.when(own == ri, 10).otherwise(0)
    return F.when(one_way, hit).otherwise(1)


def variants(segments: DataFrame, best: DataFrame, seg_key: str, way_key: str) -> DataFrame:
    """One or two rows for each segment: its columns, ri, way_key of the best candidate, case. best: best_ways().

    Case 1: no candidate, both directions, no way. Case 2: all candidates are one-way mixed traffic and none is part of a dual
    carriageway: one row, its direction that of the best way. Else (4) both directions, each with its best way."""
    own = [F.col(c) for c in segments.columns]
    d = segments.join(best, seg_key, "left")
    return d.select(*own, F.explode(_rows(d)).alias("v")).select(*own, "v.ri", F.col("v.way").alias(way_key), "v.case")


def _rows(best: DataFrame) -> Column:
    """variants() of one segment: array<struct<ri, way, case>>."""
    kind = best.schema["b0"].dataType["way"].dataType
    row = lambda ri, way, case: F.struct(ri.cast("int").alias("ri"), way.alias("way"), F.lit(case).alias("case"))
    none = F.array(*[row(F.lit(k), F.lit(None).cast(kind), 1) for k in (0, 1)])
    return F.when(F.col("b0").isNull(), none).when(F.col("single"), F.array(row(F.col("any.own"), F.col("any.way"), 2))).otherwise(F.array(row(F.lit(0), F.col("b0.way"), 4), row(F.lit(1), F.col("b1.way"), 4)))


def way_runs(segments: DataFrame, ways: DataFrame, edge_key: str, way_key: str, tasks: int, opts: SnapOptions | None = None) -> DataFrame:
    """(edge_key, ri, way_key, case, spans): the segments (_seg, edge_key, part, piece, ...) of an edge that one way has in one direction (variants()), as
    spans of pieces that follow on: array<struct<edge, part, first, last>>.

    No geometry crosses a shuffle but that of the cells. Each segment's place joins its candidates in their aggregation, so that none goes
    missing and none is joined back; then segments are dealt out by edge once, to so many tasks."""
    place = F.struct(F.col(edge_key).alias("edge"), "part", "piece").alias("_place")
    every = _near(segments, ways, "_seg", way_key, opts or SnapOptions()).unionByName(segments.select("_seg", place), allowMissingColumns=True)
    least = lambda b, *names: F.when(F.col(b).isNotNull(), F.struct(*[F.col(f"{b}.{n}") for n in names])).alias(b)
    best = _best(every, "_seg", way_key, F.max("_place").alias("_place"))
    best = best.select(F.col("_place.edge").alias(edge_key), "_place.part", "_place.piece", least("b0", "way"), least("b1", "way"), least("any", "way", "own"), "single").repartition(tasks, edge_key)
    chosen = best.select(edge_key, "part", "piece", F.explode(_rows(best)).alias("v")).select(edge_key, "part", "piece", "v.ri", F.col("v.way").alias(way_key), "v.case")
    runs = chosen.groupBy(edge_key, "ri", way_key, "case").agg(F.sort_array(F.collect_list(F.struct("part", "piece"))).alias("places"))
    return runs.select(edge_key, "ri", way_key, "case", _spans(F.col(edge_key), F.col("places")).alias("spans"))


def _spans(edge: Column, places: Column) -> Column:
    """Places (part, piece) of an edge, in order, as array<struct<edge, part, first, last>>."""

    def spans(q: Column) -> Column:
        follows = lambda i: (F.get(q, i - 1)["part"] == F.get(q, i)["part"]) & (F.get(q, i - 1)["piece"] + 1 == F.get(q, i)["piece"])
        begins = F.filter(F.sequence(F.lit(0), F.size(q) - 1), lambda i: (i == 0) | ~follows(i))

        def span(begins: Column) -> Column:
            last = lambda k: F.coalesce(F.get(begins, k + 1), F.size(q)) - 1
            return F.transform(begins, lambda s, k: F.struct(edge.alias("edge"), F.get(q, s)["part"].alias("part"), F.get(q, s)["piece"].alias("first"), F.get(q, last(k))["piece"].alias("last")))

        return G.let(begins, span)

    return G.let(places, spans)


def attributed(runs: DataFrame, ways: DataFrame, network: DataFrame, way_key: str, edge_key: str) -> DataFrame:
    """way_runs() of edges with a number: element_nr, ri, spans and the chosen way's attributes, as far as ways have them, and fuehr in any case."""
    carried = [c for c in _carried() if c in ways.columns]
    w = ways.select(F.col(way_key).alias("_way"), *[F.col(f"`{c}`") for c in carried])
    e = network.select(edge_key, "element_nr").where("element_nr is not null")
    out = runs.withColumnRenamed(way_key, "_way").join(e, edge_key).join(w, "_way", "left")
    fuehr = F.when(F.col("case") == 1, NOTHING).otherwise(F.col("fuehr") if "fuehr" in carried else F.lit(None).cast("string"))
    return out.select("element_nr", "ri", "spans", fuehr.alias("fuehr"), *[F.col(f"`{c}`") for c in carried if c != "fuehr"])


def _carried() -> list[str]:
    return [c for c in (*MERGE_ATTRIBUTES, *EXTRA_ATTRIBUTES) if c != "ri"]


def merge_spans(runs: DataFrame, tasks: int) -> DataFrame:
    """One row for all runs (attributed()) of an edge with equal attributes, as merge_segments() compares them: the first run's columns, its
    place _place and all spans in order. Runs are dealt out by edge as they are; what compares them is made after that."""
    kinds = dict(runs.dtypes)
    keep = [c for c in runs.columns if c not in ("element_nr", "spans")]
    own = [c for c in MERGE_ATTRIBUTES if c in keep]
    first = F.get("spans", 0)
    d = runs.repartition(tasks, "element_nr").withColumns({"_p": F.struct(first["edge"].alias("edge"), first["part"].alias("part"), first["first"].alias("piece"), "ri"), **{f"_k_{c}": merge_key(F.col(f"`{c}`"), kinds[c]) for c in own}})
    g = d.groupBy("element_nr", *[f"_k_{c}" for c in own]).agg(
        F.min_by(F.struct(*[F.col(f"`{c}`") for c in keep]), F.col("_p")).alias("_first"),
        F.min("_p").alias("_place"),
        F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"),
    )
    return g.select("element_nr", "_first.*", "_place", "spans")


def with_lines(rows: DataFrame, network: DataFrame, edge_key: str, step: float, tasks: int) -> DataFrame:
    """rows (element_nr, _place, spans, ...) with the geometry of their spans, its length and the other columns of the first one's edge.

    An edge's lines are cut where its rows are, so the network crosses a shuffle uncut, once."""
    others = [c for c in EDGE_ATTRIBUTES if c in network.columns and c not in (edge_key, "element_nr")]
    n = network.where("element_nr is not null").select(edge_key, "element_nr", F.struct(*others).alias("_own"), "geom").repartition(tasks, "element_nr")
    cut = cut_lines(n, edge_key, step, carry=("element_nr", "_own"))
    line = cut.groupBy("element_nr", F.col(edge_key).alias("edge"), "part").agg(F.first("_own").alias("own"), F.sort_array(F.collect_list(F.struct("piece", "ax", "ay", "bx", "by"))).alias("line"))
    lines = line.groupBy("element_nr").agg(F.collect_list(F.struct("edge", "part", "own", "line")).alias("_lines"))
    of = lambda test: F.get(F.filter("_lines", test), 0)
    pieces = F.flatten(F.transform("spans", lambda s: F.slice(of(lambda l: (l["edge"] == s["edge"]) & (l["part"] == s["part"]))["line"], s["first"] + 1, s["last"] - s["first"] + 1)))
    own = of(lambda l: l["edge"] == F.col("_place.edge"))["own"]
    # a generator, which no filter above passes: else each use of the geometry would make it anew
    g = rows.join(lines, "element_nr").select(*rows.columns, F.explode(F.array(F.struct(G.join_pieces(pieces).alias("geom"), own.alias("own")))).alias("_g"))
    # in micrometres first, so that the order of addition can't decide a half
    return g.select(*rows.columns, "_g.own.*", F.col("_g.geom").alias("geom")).withColumn("Länge", whole(F.round(G.length(F.col("geom")), 6)))


def merge_segments(rows: DataFrame, order: list[str], edge: str = "element_nr", attributes: tuple[str, ...] = MERGE_ATTRIBUTES) -> DataFrame:
    """One row for all segments of an edge with equal attributes, apart or not: the first row's columns, the merged geometry
    and its length. Numbers count as equal to one decimal, texts without outer blanks, nulls with nulls; edges need a number."""
    at = F.struct(*order).alias("at")
    return merge_runs(rows.withColumns({"at": at, "pieces": F.array(F.struct(at, "ax", "ay", "bx", "by"))}).drop("ax", "ay", "bx", "by"), edge, attributes)


def merge_runs(runs: DataFrame, edge: str = "element_nr", attributes: tuple[str, ...] = MERGE_ATTRIBUTES) -> DataFrame:
    """As merge_segments(), of rows that hold several pieces already: at (the first one's place) and pieces (at, ax, ay, bx, by)."""
    kinds = dict(runs.dtypes)
    own = [c for c in attributes if c in kinds]
    keep = [c for c in runs.columns if c not in (edge, "at", "pieces", "geom", "Länge")]
    d = runs.where(F.col(edge).isNotNull()).withColumns({f"_k_{c}": merge_key(F.col(f"`{c}`"), kinds[c]) for c in own})
    g = d.groupBy(edge, *[f"_k_{c}" for c in own]).agg(
        F.min_by(F.struct(*[F.col(f"`{c}`") for c in keep]), F.col("at")).alias("_first"),
        F.min("at").alias("_at"),
        F.sort_array(F.flatten(F.collect_list("pieces"))).alias("_pieces"),
    )
    g = g.select(edge, "_first.*", "_at", G.join_pieces(F.col("_pieces")).alias("geom"))
    # in micrometres first, so that the order of addition can't decide a half
    return merge_parts(g.withColumn("Länge", whole(F.round(G.length(F.col("geom")), 6))), [edge, "_at"], pieces=True)


def finish(merged: DataFrame) -> DataFrame:
    """Widths of mixed traffic go, columns in their order and others after them."""
    m = merged.withColumn("breite", F.when(F.col("fuehr") == MIXED, None).otherwise(F.col("breite"))) if "breite" in merged.columns else merged
    lead = [c for c in (*LEADING, *EXTRA_ATTRIBUTES[1:], "data_source", "edge_source") if c in m.columns]
    rest = [c for c in m.columns if c not in lead and c != "geom"]
    return m.select(*[F.col(f"`{c}`") for c in [*lead, *rest, "geom"]])


def snap(network: DataFrame, ways: DataFrame, edge_key: str = "seq", way_key: str = "way_id", opts: SnapOptions | None = None) -> DataFrame:
    """The whole stage: network (edge_key, element_nr, beginnt_bei_vp, endet_bei_vp, geom, ...) and matched ways (way_key, geom, attributes)."""
    missing = [c for c in ("element_nr", "beginnt_bei_vp", "endet_bei_vp") if c not in network.columns]
    if missing:
        raise ValueError(f"the network lacks {missing}")
    o = opts or SnapOptions()
    # written: the candidates and the places both read them, and each segment's number, which sorts faster than its place
    cut = segmentize(network, edge_key, o.step).withColumn("_seg", F.monotonically_increasing_id())
    seg = kept(cut, "segments", SEGMENTS_VERSION, edge_key, o.step, inputs=[network.select(edge_key, "geom")]) if o.reuse else written(cut, "segments")
    # what a task holds doesn't follow the table's size, so that its sorts needn't spill
    tasks = max(int(network.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(seg.count() / ROWS_A_TASK))
    # attributes belong to ways: the segments of an edge that one way has are one row before any is joined, and rows are numbered before they have lines
    runs = attributed(way_runs(seg, ways, edge_key, way_key, tasks, o), ways, network, way_key, edge_key)
    rows = number_rows(merge_spans(runs, tasks), ["_place"], "sfid")
    merged = merge_parts(with_lines(rows, network, edge_key, o.step, tasks), ["sfid"], pieces=True, once=False).drop("_place", "spans")
    return finish(merged.withColumns({c: F.lit(None).cast("string") for c in _carried() if c not in merged.columns}))


def attribute_stats(merged: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """(attribute, value, n): how often each value occurs."""
    pairs = [F.struct(F.lit(c).alias("attribute"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]
    return merged.select(F.explode(F.array(*pairs)).alias("x")).groupBy("x.attribute", "x.value").agg(F.count("*").alias("n"))
