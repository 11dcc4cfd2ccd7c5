"""Lines joined to chains where exactly two ends meet, whatever their direction and order: of a whole network, or by group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velonet.functions import geometry as G
from velonet.operators.graph import least_reachable
from velonet.operators.noding import noded_pieces
from velonet.operators.scratch import written


def _positions(t: pa.Table) -> pa.RecordBatch:
    """Where each member lies in its chain, and whether it is turned. Rows of whole chains (component, place and the ends' partners),
    sorted by component and place."""
    component, place = t["component"].to_numpy(), t["place"].to_numpy()
    by = np.argsort(place)
    to, side = [], []
    for end in ("s", "e"):
        other = pc.fill_null(t[f"{end}_place"], -1).to_numpy()
        row = by[np.searchsorted(place[by], np.maximum(other, place[by[0]]))]
        to.append(np.where(other < 0, -1, row).tolist())
        side.append(pc.fill_null(t[f"{end}_side"], 0).to_numpy().tolist())
    position, turned = np.zeros(len(place), np.int32), np.zeros(len(place), bool)
    first = np.flatnonzero(np.r_[True, component[1:] != component[:-1]])
    for s, e in zip(first.tolist(), [*first[1:].tolist(), len(place)], strict=True):
        # without a free end it is a ring: from the start of its first member
        i, at = next(((r, k) for r in range(s, e) for k in (0, 1) if to[k][r] < 0), (s, 0))
        for n in range(e - s):
            position[i], turned[i] = n, at == 1
            i, at = to[1 - at][i], side[1 - at][i]
        back = int(turned[s:e].sum())
        if 2 * back > e - s or (2 * back == e - s and turned[s]):
            position[s:e], turned[s:e] = e - s - 1 - position[s:e], ~turned[s:e]
    return pa.RecordBatch.from_arrays([pa.array(component), pa.array(place), pa.array(position), pa.array(turned)], names=["component", "place", "position", "turned"])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """_positions() of all chains that are whole in what has come so far."""
    rest: pa.Table | None = None
    for b in batches:
        t = pa.Table.from_batches([b]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([b])]).combine_chunks()
        if t.num_rows:
            c = t["component"].to_numpy()
            cut = int(np.searchsorted(c, c[-1]))
            if cut:
                yield _positions(t.slice(0, cut).combine_chunks())
            rest = t.slice(cut)
    if rest is not None:
        yield _positions(rest.combine_chunks())


def chains(lines: DataFrame, key: str, by: tuple[str, ...] = (), geom: str = "geom") -> DataFrame:
    """(*by, key, part, line): the parts of all lines (of each group of `by`) joined wherever exactly two ends meet.

    A chain has the key and part of its least member. It runs as most of its members do, as the least one if they are even; a ring
    begins at its least member's start. Parts without two vertices are left out. Ends meet if their coordinates are equal; lines
    that cross elsewhere don't meet: see node_lines(). Members are put in order by their ends' partners alone, many chains a batch;
    lines join them afterwards. A chain becomes one row, so its members, the lines between two junctions, are one group.
    """
    return _joined(lines.select(*by, key, F.posexplode(geom).alias("part", "line")).where(F.size("line") > 1), key, by)


def _joined(rows: DataFrame, key: str, by: tuple[str, ...] = ()) -> DataFrame:
    """chains() of rows (*by, key, part, line), part being of any type that sorts."""
    g = F.struct(*by) if by else F.lit(0)
    rows = rows.select(g.alias("g"), F.col(key).alias("k"), "part", "line")
    # sorted in ranges, so that places rise with (g, k, part)
    numbered = written(rows.select(F.struct("g", "k", "part").alias("p"), "line").orderBy("p").withColumn("place", F.monotonically_increasing_id()), "places")
    end = lambda side, v: F.struct(F.col("place").alias("place"), F.lit(side).alias("side"), v["x"].alias("x"), v["y"].alias("y"))
    ends = numbered.select(F.col("p.g").alias("g"), F.explode(F.array(end(0, F.get("line", 0)), end(1, F.element_at("line", -1)))).alias("e"))
    met = ends.groupBy("g", "e.x", "e.y").agg(F.count("*").alias("n"), F.min(F.struct("e.place", "e.side")).alias("lo"), F.max(F.struct("e.place", "e.side")).alias("hi"))
    joints = written(met.where("n = 2 and lo.place <> hi.place").select("lo", "hi"), "joints")
    both = joints.select(F.col("lo").alias("own"), F.col("hi").alias("other")).unionByName(joints.select(F.col("hi").alias("own"), F.col("lo").alias("other")))
    of = lambda side, c, name: F.max(F.when(F.col("own.side") == side, F.col(f"other.{c}"))).alias(name)
    partners = both.groupBy(F.col("own.place").alias("place")).agg(*[of(k, c, f"{e}_{c}") for k, e in enumerate("se") for c in ("place", "side")])
    found = least_reachable(joints.select(F.col("hi.place").alias("a"), F.col("lo.place").alias("b"))).withColumnRenamed("id", "place")
    members = partners.join(found, "place", "left").withColumn("component", F.coalesce("component", "place"))
    ordered = written(members.repartition("component").sortWithinPartitions("component", "place").mapInArrow(_walk, "component long, place long, position int, turned boolean"), "order")
    # a line that meets none is a chain of its own; the least member, whose place names the chain, has the least p
    m = F.struct(F.coalesce("position", F.lit(0)).alias("position"), F.when(F.col("turned"), F.reverse("line")).otherwise(F.col("line")).alias("line"))
    own = numbered.join(ordered, "place", "left").select(F.coalesce("component", "place").alias("component"), "p", m.alias("m"))
    whole = F.transform(F.sort_array("members"), lambda m, i: F.when(i == 0, m["line"]).otherwise(F.slice(m["line"], 2, F.size(m["line"]))))
    joined = own.groupBy("component").agg(F.min("p").alias("p"), F.collect_list("m").alias("members"))
    return joined.select(*[F.col(f"p.g.{c}").alias(c) for c in by], F.col("p.k").alias(key), F.col("p.part").alias("part"), F.flatten(whole).alias("line"))


def merge_network(network: DataFrame, key: str = "id", noded: bool = True) -> DataFrame:
    """(key, geom): the network's lines as chains between junctions. Several parts of one line may stay apart under its key.

    noded: lines are cut first where they cross or touch, and what lies twice stays once."""
    parts = (_joined(_pieces(network, key), key) if noded else chains(network, key)).groupBy(key).agg(F.sort_array(F.collect_list(F.struct("part", "line"))).alias("parts"))
    return parts.select(key, F.transform("parts", lambda p: p["line"]).cast(G.GEOM).alias("geom"))


def _pieces(network: DataFrame, key: str) -> DataFrame:
    """(key, part, line) of noded_pieces(), each a line in the place that it has in its own: no line is put together to be taken apart."""
    line = F.array(G.point(F.col("ax"), F.col("ay")), G.point(F.col("bx"), F.col("by")))
    return noded_pieces(network, key).select(key, F.struct("part", "piece", "sub").alias("part"), line.alias("line"))


def merge_groups(lines: DataFrame, key: str, by: tuple[str, ...]) -> DataFrame:
    """(*by, geom): the merged lines of each group, a part for each chain, in the order of their least members."""
    parts = chains(lines, key, by).groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(key, "part", "line"))).alias("parts"))
    return parts.select(*by, F.transform("parts", lambda p: p["line"]).cast(G.GEOM).alias("geom"))


def _place(p: Column) -> Column:
    return F.xxhash64(p["x"] + 0.0, p["y"] + 0.0)


def merge_parts(rows: DataFrame, ids: Sequence[str], geom: str = "geom", pieces: bool = False, where: Column | None = None, once: bool = True) -> DataFrame:
    """rows (those of `where`, if given) with the parts of each geometry joined wherever exactly two ends meet. ids name a row.

    Parts are lines with two ends; or else (pieces) runs of straight pieces, which have an end at each vertex: a run then is cut
    where it meets itself or another's end. Geometries of one part that doesn't meet itself are merged already, and so are those whose
    parts all end at places of their own. Rows are written once, with what says whether they need it; without `once` only those that need it are
    written, and the others are computed again, as far as they are read."""
    g = F.col(geom)
    within = F.flatten(F.transform(g, lambda p: F.transform(F.slice(p, 2, F.greatest(F.size(p) - 2, F.lit(0))), _place)))
    ends = F.flatten(F.transform(g, lambda p: F.array(_place(F.get(p, 0)), _place(F.try_element_at(p, F.lit(-1))))))
    touch = (F.size(F.array_distinct(within)) < F.size(within)) | F.arrays_overlap(within, ends) if pieces else F.lit(False)
    # an end that is met by another, or a part without two vertices, which goes
    met = (F.size(F.array_distinct(ends)) < F.size(ends)) | F.exists(g, lambda p: F.coalesce(F.size(p), F.lit(0)) < 2)
    some = F.lit(True) if where is None else where
    marked = rows.withColumn("_touch", F.coalesce(some & touch, F.lit(False)))
    marked = marked.withColumn("_open", F.col("_touch") | F.coalesce(some & (F.size(geom) > 1) & met, F.lit(False)))
    if once:
        marked = written(marked, "merged")
    open_ = marked.where("_open") if once else written(marked.where("_open"), "open")
    if open_.isEmpty():
        return marked.select(*rows.columns)
    single = F.transform(G.pieces(g), lambda q: F.array(G.point(q["ax"], q["ay"]), G.point(q["bx"], q["by"])))
    lines = open_.select(*ids, F.lit(0).alias("_line"), F.when(F.col("_touch"), single).otherwise(g).cast(G.GEOM).alias(geom))
    merged = merge_groups(lines, "_line", tuple(ids)).withColumnRenamed(geom, "_merged")
    done = open_.join(merged, list(ids)).withColumn(geom, F.col("_merged"))
    return marked.where("not _open").select(*rows.columns).unionByName(done.select(*rows.columns))
