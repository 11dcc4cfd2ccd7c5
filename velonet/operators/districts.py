"""Districts of points and lines, and clipping: boxes meet by grid cells, then polygons are looked at."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velonet.functions import geometry as G
from velonet.functions.text import last_two
from velonet.operators import near

#: Metres of a grid cell.
CELL = 1000.0


def _boxed(polygons: DataFrame, key: str, order: str | None) -> DataFrame:
    """(code, seq, id, legs, bounds) of each different polygon: the table that is joined."""
    box = G.bounds(F.col("rings"))
    each = polygons.withColumn("_id", F.xxhash64("rings")).dropDuplicates(list({key, order or key, "_id"}))
    return each.select("_id", F.col(key).alias("_code"), F.col(order or key).alias("_seq"), G.polygon_legs(F.col("rings")).alias("_legs"), box["xmin"].alias("_x0"), box["ymin"].alias("_y0"), box["xmax"].alias("_x1"), box["ymax"].alias("_y1"))


def _meet(left: DataFrame, polygons: DataFrame, x0: str, y0: str, x1: str, y1: str, cell: float = CELL) -> DataFrame:
    """Rows of left with the polygons whose boxes they meet, once each: an equi-join by cells, of boxes alone; the polygons' sides
    are joined to the pairs that meet."""
    c = F.col
    l, boxes = near.explode_cells(left, (c(x0), c(y0), c(x1), c(y1)), cell), near.explode_cells(polygons.drop("_legs"), (c("_x0"), c("_y0"), c("_x1"), c("_y1")), cell)
    meets = (c(x0) <= c("_x1")) & (c(x1) >= c("_x0")) & (c(y0) <= c("_y1")) & (c(y1) >= c("_y0"))
    here = (F.floor(F.greatest(x0, "_x0") / cell) == c("cx")) & (F.floor(F.greatest(y0, "_y0") / cell) == c("cy"))
    pairs = l.join(boxes, ["cx", "cy"]).where(meets & here).drop("cx", "cy")
    return pairs.join(polygons.select("_id", "_code", "_seq", "_legs"), ["_id", "_code", "_seq"])


def district_of_point(points: DataFrame, polygons: DataFrame, key: str, code: str = "gem", order: str | None = None) -> DataFrame:
    """(key, district): the code's last two characters of the first polygon (by order) that holds the point (x, y); null if none."""
    m = _meet(points.select(key, "x", "y"), _boxed(polygons, code, order), "x", "y", "x", "y")
    hit = m.where(G.in_polygon(F.col("x"), F.col("y"), F.col("_legs"))).groupBy(key).agg(F.min_by("_code", "_seq").alias("c"))
    return points.select(key).join(hit, key, "left").select(key, last_two(F.col("c")).alias("district"))


def _inside(lines: DataFrame, polygons: DataFrame, key: str, code: str, order: str | None) -> DataFrame:
    """Pieces of lines and where they lie inside which polygon: a row (lo, hi) for each stretch."""
    p = near.explode_pieces(lines, key).select(key, "part", "piece", "sub", "ax", "ay", "bx", "by")
    p = p.withColumns({"_px0": F.least("ax", "bx"), "_py0": F.least("ay", "by"), "_px1": F.greatest("ax", "bx"), "_py1": F.greatest("ay", "by")})
    m = _meet(p, _boxed(polygons, code, order), "_px0", "_py0", "_px1", "_py1")
    t = tuple(F.col(c) for c in ("ax", "ay", "bx", "by"))
    m = m.withColumn("_at", G.crossings(t, F.col("_legs")))
    # explode_outer: a filter for empty arrays would be pushed into the join and run for every pair of boxes
    m = m.select(*p.columns, "_code", "_seq", F.explode_outer(G.inside_intervals(t, F.col("_at"), F.col("_legs"))).alias("i"))
    return m.where(F.col("i.lo").isNotNull()).drop("_px0", "_py0", "_px1", "_py1")


def district_by_length(lines: DataFrame, polygons: DataFrame, key: str, code: str = "gem", order: str | None = None, name: str = "Bezirksnummer") -> DataFrame:
    """(key, name): the district that holds most of a line; the first by order wins ties; null if none holds any.

    Lengths are compared in whole millimetres."""
    share = (F.col("i.hi") - F.col("i.lo")) * G.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"))
    per = _inside(lines, polygons, key, code, order).groupBy(key, "_code", "_seq").agg(F.bround(F.sum(share) * 1000).cast("long").alias("mm")).where("mm > 0")
    best = per.groupBy(key).agg(F.min_by("_code", F.struct(-F.col("mm"), F.col("_seq"))).alias("c"))
    return lines.select(key).join(best, key, "left").select(key, last_two(F.col("c")).alias(name))


def clip_lines(lines: DataFrame, polygons: DataFrame | None, key: str, carry: Sequence[str] = ()) -> DataFrame:
    """Lines cut to the polygons: (key, carry, geom); lines outside vanish, shared borders don't split. No polygons: unchanged."""
    if polygons is None:
        return lines.select(key, *carry, "geom")
    own = ["part", "piece", "sub", "ax", "ay", "bx", "by"]
    p = polygons.select("rings", F.lit(0).alias("_any"))
    cut = _inside(lines, p, key, "_any", "_any").groupBy(key, *own).agg(F.collect_list("i").alias("i"))
    cut = cut.withColumn("i", G.merge_intervals(F.col("i")))
    at = lambda a, b, t: F.when(t == 0, a).when(t == 1, b).otherwise(a + (b - a) * t)
    q = cut.select(key, *own, F.explode("i").alias("i")).select(key, F.struct("part", "piece", "sub", F.col("i.lo").alias("lo"), at(F.col("ax"), F.col("bx"), F.col("i.lo")).alias("ax"), at(F.col("ay"), F.col("by"), F.col("i.lo")).alias("ay"), at(F.col("ax"), F.col("bx"), F.col("i.hi")).alias("bx"), at(F.col("ay"), F.col("by"), F.col("i.hi")).alias("by")).alias("q"))
    g = q.groupBy(key).agg(F.array_sort(F.collect_list("q")).alias("qs")).select(key, G.join_pieces(F.col("qs")).alias("geom"))
    return g.join(lines.select(key, *carry), key) if carry else g
