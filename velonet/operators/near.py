"""Near joins and coverage on a grid: distance predicates become equi-joins of cells, so no join is quadratic.

Cells are at least twice the radius. Long pieces are split first, so no piece lies in many cells. A pair is tested in one cell
only: the one that holds the lower left corner of the common part of both boxes.

A pair at exactly the radius is near. Distances are square roots of squares (functions.geometry.point_piece_square), so that coordinates
in whole or half metres give the exact answer at the bound; a foot of the perpendicular, computed first, would be off by a rounding.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velonet.functions import geometry as G
from velonet.operators.scratch import written

#: Shares at or above this count as whole.
WHOLE = 1 - 1e-9


def cell_size(r: float) -> float:
    return max(2.0 * r, 50.0)


def explode_pieces(df: DataFrame, key: str, geom: str = "geom", longest: float = 500.0, carry: Sequence[str] = ()) -> DataFrame:
    """(key, carry, part, piece, sub, ax, ay, bx, by, at_start, at_end): straight pieces no longer than `longest`.

    at_start, at_end: whether the piece begins or ends its part. Keys and geometry alone are carried, and what `carry` names: a few
    numbers; join attributes back."""
    p = df.select(F.col(key), *carry, F.explode(G.pieces(F.col(geom))).alias("p"), F.transform(F.col(geom), lambda x: F.size(x) - 2).alias("last"))
    n = F.greatest(F.lit(1), F.ceil(G.hypot(F.col("p.bx") - F.col("p.ax"), F.col("p.by") - F.col("p.ay")) / longest).cast("int"))
    p = p.withColumn("n", n).select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("sub"))
    cut = lambda a, b, k: F.when(k == 0, a).when(k == F.col("n"), b).otherwise(a + (b - a) * k / F.col("n"))
    ends = [cut(F.col(f"p.a{v}"), F.col(f"p.b{v}"), F.col("sub") + e).alias(f"{c}{v}") for e, c in ((0, "a"), (1, "b")) for v in "xy"]
    return p.select(key, *carry, "p.part", "p.piece", "sub", *ends, ((F.col("p.piece") == 0) & (F.col("sub") == 0)).alias("at_start"), ((F.col("p.piece") == F.get("last", F.col("p.part"))) & (F.col("sub") == F.col("n") - 1)).alias("at_end"))


def cut_lines(df: DataFrame, key: str, step: float, equal: bool = True, geom: str = "geom", nearest: bool = False, least: float = 0.0, carry: Sequence[str] = ()) -> DataFrame:
    """(key, carry, part, piece, ax, ay, bx, by): each part in straight chords between points of it.

    equal: ceil(length / step) chords of equal length along the part (nearest: as many as round(length / step)), one at least; else
    one for every step and a shorter last one, none of length 0. Chords shorter than `least` are left out.

    A leg gives the chords that begin on it, so a chord's place is a product, whatever the length of its line; only one that
    goes past its leg's end looks further."""
    p = df.select(key, *carry, F.posexplode(F.col(geom)).alias("part", "line")).where(F.size("line") > 1)
    p = p.withColumn("legs", G._legs(F.col("line"))).withColumn("total", G.part_length(F.col("line")))
    # where each leg begins, and the whole length last
    begins = F.transform(F.sequence(F.lit(0), F.size("legs")), lambda i: G.part_length(F.slice(F.col("line"), 1, i + 1)))
    p = p.withColumn("begins", F.when(F.size("legs") == 1, F.array(F.lit(0.0), F.col("total"))).otherwise(begins))
    many = F.bround(F.col("total") / step) if nearest else F.ceil(F.col("total") / step)
    p = p.withColumn("n", F.greatest(many, F.lit(1)).cast("int")).select(key, *carry, "part", "line", "total", "begins", "n", F.posexplode("legs").alias("leg", "l"))
    begin, end = F.get("begins", F.col("leg")), F.get("begins", F.col("leg") + 1)
    rest = F.slice("line", F.col("leg") + 2, F.size("line"))
    last = F.col("leg") == F.size("begins") - 2
    p = p.select(key, *carry, "part", "total", "n", begin.alias("begin"), end.alias("end"), *[F.col(f"l.{e}.{v}").alias(f"{e}{v}") for e in "ab" for v in "xy"], F.when(~last, rest).alias("rest"), last.alias("last"), (F.col("leg") == 0).alias("first"), F.try_element_at("line", F.lit(-1)).alias("goal"))
    at = lambda k: F.col("total") * k / F.col("n") if equal else F.least(k * F.lit(float(step)), F.col("total"))
    number = lambda d: F.ceil(d * F.col("n") / F.nullif("total", F.lit(0.0)) if equal else d / step).cast("int")
    lo = F.when(F.col("first"), 0).otherwise(number(F.col("begin")))
    hi = F.when(F.col("last") | (F.col("total") == 0), F.col("n") - 1).otherwise(number(F.col("end")) - 1)
    p = p.withColumns({"lo": lo, "hi": hi}).where(F.col("lo") <= F.col("hi")).where(F.col("first") | (F.col("total") > 0))
    p = p.select("*", F.explode(F.sequence("lo", "hi")).alias("piece"))
    own = F.col("end") - F.col("begin")
    on = lambda d, v: F.when(own > 0, F.col(f"a{v}") + (F.col(f"b{v}") - F.col(f"a{v}")) * (d - F.col("begin")) / F.nullif(own, F.lit(0.0))).otherwise(F.col(f"a{v}"))
    here, there = at(F.col("piece")), at(F.col("piece") + 1)
    goal = F.col("piece") + 1 == F.col("n")
    further = F.when(~goal & (there > F.col("end")), G.interpolate(F.col("rest"), there - F.col("end")))
    p = p.select(key, *carry, "part", "piece", "goal", goal.alias("_goal"), *[F.when(F.col("piece") == 0, F.col(f"a{v}")).otherwise(on(here, v)).alias(f"_a{v}") for v in "xy"], *[on(there, v).alias(f"_b{v}") for v in "xy"], further.alias("further"))
    to = lambda v: F.when(F.col("_goal"), F.col(f"goal.{v}")).otherwise(F.coalesce(F.col(f"further.{v}"), F.col(f"_b{v}")))
    p = p.select(key, *carry, "part", "piece", F.col("_ax").alias("ax"), F.col("_ay").alias("ay"), to("x").alias("bx"), to("y").alias("by"))
    p = p if equal else p.where("ax <> bx or ay <> by")
    return p.where(G.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")) >= least) if least else p


def middle_pieces(cut: DataFrame, key: str) -> DataFrame:
    """Of cut_lines() the middle piece of each line: that with as many before as after it, or one more. A window, which spills: pieces
    are sorted by line once, and neither collected nor joined to themselves."""
    line = Window.partitionBy(key)
    d = cut.withColumns({"_at": F.row_number().over(line.orderBy("part", "piece")) - 1, "_n": F.count("*").over(line)})
    return d.where(F.expr("_at = _n div 2")).drop("_at", "_n")


def explode_cells(df: DataFrame, box: tuple[Column, Column, Column, Column], c: float) -> DataFrame:
    """df with a row for each cell (cx, cy) that the box meets."""
    x0, y0, x1, y1 = (F.floor(v / c) for v in box)
    return df.withColumn("cx", F.explode(F.sequence(x0, x1))).withColumn("cy", F.explode(F.sequence(y0, y1)))


def _box(prefix: str = "", grow: float = 0.0) -> tuple[Column, Column, Column, Column]:
    c = lambda n: F.col(f"{prefix}{n}")
    return F.least(c("ax"), c("bx")) - grow, F.least(c("ay"), c("by")) - grow, F.greatest(c("ax"), c("bx")) + grow, F.greatest(c("ay"), c("by")) + grow


def near_pieces(left: DataFrame, right: DataFrame, r: float, also: Column | None = None) -> DataFrame:
    """Pairs of pieces within r of each other, once each: all columns of left (prefix l_) and right (prefix r_), and distance.

    also: what else a pair must be. It is asked of pairs whose boxes meet; a filter above would come first, for every pair of a cell."""
    c = cell_size(r)
    l = explode_cells(left, _box(), c).select("cx", "cy", *[F.col(x).alias(f"l_{x}") for x in left.columns])
    r_ = explode_cells(right, _box(grow=r), c).select("cx", "cy", *[F.col(x).alias(f"r_{x}") for x in right.columns])
    lb, rb = _box("l_"), _box("r_", r)
    here = (F.floor(F.greatest(lb[0], rb[0]) / c) == F.col("cx")) & (F.floor(F.greatest(lb[1], rb[1]) / c) == F.col("cy"))
    meet = (lb[0] <= rb[2]) & (rb[0] <= lb[2]) & (lb[1] <= rb[3]) & (rb[1] <= lb[3])
    good = here & meet if also is None else here & meet & also
    return with_distance(l.join(r_, ["cx", "cy"]).where(good).drop("cx", "cy")).where(F.col("distance") <= r)


def with_distance(pairs: DataFrame) -> DataFrame:
    """Pairs of pieces (l_ax, ..., r_by) with their distance: as functions.geometry.piece_distance(), bit for bit.

    In steps, each an operator with a method of its own in the compiled plan: the JVM only interprets methods above 8000 bytes, and the
    whole formula in the join's condition is more. An exploded array of one keeps a filter of the distance out of that condition."""
    c = lambda n: F.col(f"_{n}")
    put = lambda df, of: df.select("*", *[F.coalesce(v, F.lit(float("nan"))).alias(f"_{n}") for n, v in of.items()])
    ends = {"a": "l_a", "b": "l_b", "c": "r_a", "d": "r_b"}
    p = put(pairs, {f"{s}{t}{v}": F.col(f"{ends[t]}{v}") - F.col(f"{ends[s]}{v}") for s, t in ("ab", "cd", "ac", "ad", "bc", "bd") for v in "xy"})
    dot = lambda s, t: c(f"{s}x") * c(f"{t}x") + c(f"{s}y") * c(f"{t}y")
    side = lambda s, t: c(f"{s}x") * c(f"{t}y") - c(f"{s}y") * c(f"{t}x")
    p = put(p, {k: dot(k, k) for k in ("ab", "cd", "ac", "ad", "bc", "bd")} | {f"{s}_{t}": side(s, t) for s, t in (("ab", "ac"), ("ab", "ad"), ("cd", "ac"), ("cd", "bc"))} | {"c": dot("ab", "ac"), "d": dot("ab", "ad"), "a": -dot("cd", "ac"), "b": -dot("cd", "bc")})
    foot = lambda e, own, near, far, cross: F.when(c(e) <= 0, c(near)).when(c(e) >= c(own), c(far)).otherwise(c(cross) * c(cross) / c(own))
    least = F.least(foot("a", "cd", "ac", "ad", "cd_ac"), foot("b", "cd", "bc", "bd", "cd_bc"), foot("c", "ab", "ac", "bc", "ab_ac"), foot("d", "ab", "ad", "bd", "ab_ad"))
    crossing = (c("ab_ac") * c("ab_ad") < 0) & (c("cd_ac") * c("cd_bc") < 0)
    return p.select(*pairs.columns, F.explode(F.array(F.when(crossing, 0.0).otherwise(F.sqrt(least)))).alias("distance"))


def near_join(left: DataFrame, right: DataFrame, r: float, left_key: str, right_key: str, how: str = "inner", geom: str = "geom") -> DataFrame:
    """(left_key, right_key, distance) of geometries within r. how='left' keeps left keys without a partner."""
    longest = 10 * cell_size(r)
    p = near_pieces(explode_pieces(left, left_key, geom, longest), explode_pieces(right, right_key, geom, longest), r)
    pairs = p.groupBy(F.col(f"l_{left_key}").alias(left_key), F.col(f"r_{right_key}").alias(right_key if right_key != left_key else f"right_{right_key}")).agg(F.min("distance").alias("distance"))
    return pairs if how == "inner" else left.select(left_key).join(pairs, left_key, "left")


def near_points(left: DataFrame, right: DataFrame, r: float, left_key: str, right_key: str) -> DataFrame:
    """(left_key, right_key, distance) of points (columns x, y) within r."""
    c = max(r, 1e-9)
    l = left.select(F.col(left_key).alias("lk"), F.col("x").alias("lx"), F.col("y").alias("ly"), F.floor(F.col("x") / c).alias("cx"), F.floor(F.col("y") / c).alias("cy"))
    around = F.flatten(F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda i: F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda j: F.struct((F.floor(F.col("x") / c) + i).alias("cx"), (F.floor(F.col("y") / c) + j).alias("cy")))))
    r_ = right.select(F.col(right_key).alias("rk"), F.col("x").alias("rx"), F.col("y").alias("ry"), F.explode(around).alias("cell")).select("rk", "rx", "ry", "cell.*")
    d = G.hypot(F.col("lx") - F.col("rx"), F.col("ly") - F.col("ry"))
    return l.join(r_, ["cx", "cy"]).withColumn("distance", d).where(F.col("distance") <= r).select(F.col("lk").alias(left_key), F.col("rk").alias(right_key if right_key != left_key else f"right_{right_key}"), "distance")


def nearest_point(points: DataFrame, nodes: DataFrame, r: float, key: str, node_key: str, order: str | None = None) -> DataFrame:
    """(key, node_key, distance): the nearest node within r of each point; the least `order` (or key) wins ties; null if none.

    Places are searched, not points: equal ones once. Where nodes are dense the search begins within a part of r (a cell then holds about
    two nodes) and goes on, four times as far a round, with the places that found none: the nearest within any radius is the nearest."""
    name = F.struct(F.col(order or node_key).alias("o"), F.col(node_key).alias("k"))
    sites = nodes.where("x is not null and y is not null").groupBy("x", "y").agg(F.min(name).alias("_node"))
    fine = _halvings(sites, r)
    place = F.struct("x", "y").alias("_place")
    rest = points.where("x is not null and y is not null").select("x", "y").distinct().select("x", "y", place)
    if fine:
        sites, rest = written(sites, "sites"), written(rest, "places")
    best = None
    for n in sorted({*range(fine, 0, -2), 0}, reverse=True):
        found = near_points(rest, sites, r / 2**n, "_place", "_node").groupBy("_place").agg(F.min(F.struct("distance", "_node")).alias("b"))
        if n:
            found = written(found, "nearest")
            rest = rest.join(found, "_place", "left_anti")
        best = found if best is None else best.unionByName(found)
    best = best.select(F.col("_place.x").alias("x"), F.col("_place.y").alias("y"), "b")
    return points.select(key, "x", "y").join(best, ["x", "y"], "left").select(key, F.col("b._node.k").alias(node_key), F.col("b.distance").alias("distance"))


def _halvings(sites: DataFrame, r: float, few: float = 2.0, most: int = 16) -> int:
    """How often r is halved until cells of that size that aren't empty hold no more than `few` sites on average. One row to the driver."""
    cell = lambda n: F.approx_count_distinct(F.struct(*[F.floor(F.col(v) / max(r / 2**n, 1e-9)) for v in "xy"])).alias(f"_{n}")
    n = sites.agg(F.count("*").alias("n"), *[cell(k) for k in range(most + 1)]).first()
    return next((k for k in range(most + 1) if n["n"] <= few * n[f"_{k}"]), most)


def covered_intervals(target: DataFrame, network: DataFrame, r: float, flat: bool = False) -> DataFrame:
    """(target's columns, lo, hi): stretches of target pieces within r of the network, as parameters; they may overlap.

    Round caps: a piece's buffer is a capsule, so it covers one interval. Flat caps: the rectangle, and a disc at every vertex
    inside a part, cover one each."""
    # both sides are dealt out by cell: a broadcast of pieces would leave all pairs to the few tasks of a small file
    near = near_pieces(target, network.hint("merge"), r)
    t, n = (tuple(F.col(f"{p}_{x}") for x in ("ax", "ay", "bx", "by")) for p in "lr")
    first, last, slab = G.disc_interval(t, n[0], n[1], r), G.disc_interval(t, n[2], n[3], r), G.slab_interval(t, n, r)
    own = [F.col(f"l_{c}").alias(c) for c in target.columns]
    if flat:
        found = near.select(*own, F.explode(F.array(slab, F.when(~F.col("r_at_start"), first), F.when(~F.col("r_at_end"), last))).alias("i"))
    else:
        found = near.select(*own, G.hull(slab, first, last).alias("i"))
    return found.where("i is not null").select(*target.columns, "i.lo", "i.hi")


def coverage(target: DataFrame, network: DataFrame, r: float, key: str, flat: bool = False, geom: str = "geom") -> DataFrame:
    """(key, fraction): the share of each target line within r of the network; 0 for empty lines and far ones.

    The network's own keys don't matter: it is one buffer. Intervals are dealt by line once; in the order of their beginnings, each
    adds what reaches past all before it on its piece. Parameters are
    weighted by the piece's share of its line, which is exactly 1 for a straight one: no rounding comes between them and a bound."""
    long = G.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"))
    t = explode_pieces(target.select(key, geom, G.length(F.col(geom)).alias("total")), key, geom, 10 * cell_size(r), ("total",)).withColumn("share", long / F.nullif("total", F.lit(0.0)))
    n = explode_pieces(network.select(F.lit(0).alias("_net"), F.col(geom).alias("geom")), "_net", "geom", 10 * cell_size(r)).drop("_net", "part", "piece", "sub")
    found = covered_intervals(t, n, r, flat).select(key, "part", "piece", "sub", "share", "lo", "hi").repartition(key)
    before = Window.partitionBy(key, "part", "piece", "sub").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    past = F.col("hi") - F.greatest("lo", F.max("hi").over(before))
    part = found.withColumn("more", F.greatest(past, F.lit(0.0)) * F.col("share")).groupBy(key).agg(F.sum("more").alias("covered"))
    return target.select(key).join(part, key, "left").select(key, F.least(F.lit(1.0), F.coalesce("covered", F.lit(0.0))).alias("fraction"))
