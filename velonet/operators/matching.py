"""Which ways belong to the network: coverage of buffers, differences of layers, short crossing ways, manual lists."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from velonet.functions import geometry as G
from velonet.operators import near
from velonet.operators.merge import merge_network
from velonet.operators.scratch import written
from velonet.operators.sets import apply_interventions, combine, id_column, keep_first, without_ids
from velonet.operators.translate import one_sided_streets

LAYERS = ("bikelanes", "streets", "paths")


@dataclass(frozen=True)
class MatchOptions:
    """Radii in metres, shares, angles in degrees; which steps are skipped."""

    buffers: dict[str, float] = field(default_factory=lambda: {"bikelanes": 25.0, "streets": 15.0, "paths": 15.0})
    min_fraction: float = 0.7
    difference_buffer: float = 10.0
    difference_fraction: float = 0.8
    short: float = 50.0
    short_buffer: float = 25.0
    short_step: float = 5.0
    max_angle: float = 50.0
    spread: float = 60.0
    parallel: float = 20.0
    skip_layers: frozenset[str] = frozenset()
    skip_orthogonal: frozenset[str] = frozenset()
    skip_manual: bool = False
    skip_difference_streets: bool = False
    skip_difference_paths: bool = False
    all_streets: bool = False


def within_fraction(ways: DataFrame, network: DataFrame, r: float, least: float, key: str) -> DataFrame:
    """Ways of which at least that share lies within r of the network (round caps)."""
    good = near.coverage(ways, network, r, key).where(F.col("fraction") >= least).select(key)
    return ways.join(good, key, "left_semi")


def without_parallel(ways: DataFrame, other: DataFrame, key: str, r: float = 10.0, below: float = 0.8) -> DataFrame:
    """Ways of which less than that share lies within r of the other layer (flat caps). Whole ways stay or go."""
    good = near.coverage(ways, other, r, key, flat=True).where(F.col("fraction") < below).select(key)
    return ways.join(good, key, "left_semi")


def contained(ways: DataFrame, network: DataFrame, r: float, key: str) -> DataFrame:
    """(key, contained): whether all of a way lies within r of the network."""
    return near.coverage(ways, network, r, key).select(key, (F.col("fraction") >= near.WHOLE).alias("contained"))


def short_ways(ways: DataFrame, below: float = 50.0, geom: str = "geom") -> DataFrame:
    return ways.where(G.length(F.col(geom)) < below)


def crossing_short_ways(ways: DataFrame, network: DataFrame, key: str, opts: MatchOptions | None = None, network_key: str = "id", by: tuple[str, ...] = ()) -> DataFrame:
    """Short ways near the network, with what decides whether they cross it: (key, *by, angle, spread, parallel, removed). by: what names
    a way beside its key, such as the layer.

    The network is cut into short chords; those within the radius of a way are ordered by edge and place and joined where
    one ends at the next one's start. The longest such run (in micrometres; of equal ones that of the least edge) is what the way is
    compared with (folded difference of bearings, 0 to 90). A way is removed if it differs by more than max_angle, unless the chords turn by more than `spread` and one of
    them runs nearly parallel: a bend. Pairs are dealt out by way once; all that follows is done where they lie."""
    o = opts or MatchOptions()
    net = near.cut_lines(network.select(network_key, "geom").withColumnRenamed(network_key, "edge"), "edge", o.short_step, equal=False).withColumnRenamed("piece", "pos")
    keys = [key, *by]
    short = short_ways(ways, o.short).select(*keys, "geom", G.bearing_mean(F.col("geom")).alias("own"))
    # chords are many: the ways' boxes are those that are grown by the radius. Nor does the file's size tell how many: a broadcast would
    # take all of them through the driver
    pairs = near.near_pieces(net, near.explode_pieces(short, key, carry=(*by, "own")).select(*keys, "own", "ax", "ay", "bx", "by").hint("merge"), o.short_buffer)
    close = pairs.select(*[F.col(f"r_{c}").alias(c) for c in (*keys, "own")], *[F.col(f"l_{c}").alias(c) for c in ("edge", "part", "pos", "ax", "ay", "bx", "by")]).repartition(*keys)
    # a chord near several pieces of a way comes several times, side by side: its length counts once
    run, again = F.col("pos") - F.dense_rank().over(_window(keys)), F.coalesce(F.lag("pos").over(_window(keys)) == F.col("pos"), F.lit(False))
    raw = F.degrees(F.atan2(F.col("by") - F.col("ay"), F.col("bx") - F.col("ax")))
    close = close.withColumn("run", run).withColumn("long", F.when(again, 0.0).otherwise(G.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")))).withColumn("raw", raw)
    ends = [*[F.min_by(f"a{v}", "pos").alias(f"a{v}") for v in "xy"], *[F.max_by(f"b{v}", "pos").alias(f"b{v}") for v in "xy"]]
    parallel = F.min(G.fold90(F.col("own") - F.col("raw"))).alias("parallel")
    runs = close.groupBy(*keys, "edge", "part", "run").agg(F.sum("long").alias("long"), *ends, F.min("raw").alias("least"), F.max("raw").alias("most"), parallel, F.max("own").alias("own"))
    longest = F.max_by(F.struct("ax", "ay", "bx", "by"), F.struct(F.round("long", 6), -F.col("edge"), -F.col("part"), -F.col("run"))).alias("m")
    j = runs.groupBy(*keys).agg(longest, F.min("least").alias("least"), F.max("most").alias("most"), F.min("parallel").alias("parallel"), F.max("own").alias("own"))
    main = F.degrees(F.atan2(F.col("m.by") - F.col("m.ay"), F.col("m.bx") - F.col("m.ax")))
    turn = F.col("most") - F.col("least")
    j = j.withColumn("angle", G.fold90(F.col("own") - main)).withColumn("spread", F.when(turn > 180, 360 - turn).otherwise(turn))
    bend = (F.col("spread") > o.spread) & (F.col("parallel") < o.parallel)
    return j.select(*keys, "angle", "spread", "parallel", ((F.col("angle") > o.max_angle) & ~bend).alias("removed"))


def _window(keys: list[str]):
    return Window.partitionBy(*keys, "edge", "part").orderBy("pos")


def remove_crossing(matched: DataFrame, layer: DataFrame, network: DataFrame, key: str, id_col: str, opts: MatchOptions | None = None) -> DataFrame:
    """Rows of the layer whose id was matched and isn't that of a crossing short way.

    Ids decide, so a feature that shares its id with a matched one comes back."""
    return _remove(matched, layer, crossing_short_ways(layer, network, key, opts).where("removed").select(key), key, id_col)


def _remove(matched: DataFrame, layer: DataFrame, crossing: DataFrame, key: str, id_col: str) -> DataFrame:
    gone = layer.join(crossing, key, "left_semi").select(id_col).distinct()
    ids = matched.select(id_col).distinct().join(gone, id_col, "left_anti")
    return layer.join(ids, id_col, "left_semi")


def match(layers: dict[str, DataFrame], network: DataFrame, opts: MatchOptions | None = None, exclude: DataFrame | None = None, include: DataFrame | None = None, key: str = "seq") -> dict[str, DataFrame]:
    """The whole matching stage over translated layers with a unique `key`: a table for each step's result, and 'matched'.

    Short ways of all layers are judged in one pass by the network's chains between junctions (its lines merged): chains are cut into
    chords and dealt out once, however many layers there are. Each layer's matches are written once to the
    shared folder, as several later steps read them; the rest is lazy."""
    o = opts or MatchOptions()
    judged = [n for n in LAYERS if n in layers and n not in o.skip_layers and n not in o.skip_orthogonal]
    if judged:
        ways = reduce(DataFrame.unionByName, [layers[n].select(key, "geom", F.lit(LAYERS.index(n)).alias("_layer")) for n in judged])
        crossing = written(crossing_short_ways(ways, written(merge_network(network), "chains"), key, o, by=("_layer",)).where("removed").select("_layer", key), "crossing")
    out: dict[str, DataFrame] = {}
    for at, name in enumerate(LAYERS):
        if name not in layers or name in o.skip_layers:
            continue
        layer = layers[name]
        id_col = id_column(layer, ("tilda_osm_id", "tilda_id"))
        m = within_fraction(layer, network, o.buffers[name], o.min_fraction, key)
        if name in judged:
            m = _remove(m, layer, crossing.where(F.col("_layer") == at).select(key), key, id_col)
        if not o.skip_manual and exclude is not None and include is not None:
            m = apply_interventions(m, layer, exclude, include, id_col)
        out[name] = written(m, name)
    bikelanes, streets, paths = (out.get(n) for n in LAYERS)
    reduced = None
    if not o.skip_difference_streets and bikelanes is not None and streets is not None:
        reduced = without_parallel(streets, bikelanes, key, o.difference_buffer, o.difference_fraction)
        out["streets_without_bikelanes"] = reduced
        one = one_sided_streets(streets)
        out["streets_one_sided"] = one
        reduced = combine_enhanced(reduced, one, key)
        out["streets_enhanced"] = reduced
    rest = None
    if not o.skip_difference_paths and paths is not None and (bikelanes is not None or streets is not None):
        id_col = id_column(bikelanes if bikelanes is not None else streets, ("tilda_id", "tilda_osm_id"))
        # coverage asks for geometry alone: no other attribute is combined
        both = combine([(n, t.select(*[c for c in dict.fromkeys((id_col, key, "geom")) if c in t.columns])) for n, t in (("bikelanes", bikelanes), ("streets", streets)) if t is not None], id_col, key)
        rest = without_parallel(paths, both, key, o.difference_buffer, o.difference_fraction)
        out["paths_without_others"] = rest
    final = [("bikelanes", bikelanes), ("streets", streets if o.all_streets or reduced is None else reduced), ("paths", rest)]
    final = [(n, t) for n, t in final if t is not None]
    if final:
        out["matched"] = combine(final, id_column(final[0][1], ("tilda_id", "tilda_osm_id")), key)
    return out


def combine_enhanced(reduced: DataFrame, one_sided: DataFrame, seq: str) -> DataFrame:
    """Streets without bike lanes, then one-sided ones, one row for each id; street_type tells which."""
    id_col = id_column(reduced, ("tilda_id", "tilda_osm_id"))
    a = reduced.withColumn("has_one_sided_bikelane", F.lit(False))
    return combine([("no_bikelanes", a), ("one_sided_bikelanes", one_sided)], id_col, seq, "street_type")


def enrich(streets: DataFrame, priority: DataFrame, r: float = 5.0, key: str = "id", deny: DataFrame | None = None, unique: str = "unique_id") -> DataFrame:
    """Streets inside the network's buffer, then the network's parts that streets don't cover.

    deny: ids that are left out of the streets. unique: if both tables have this column, one row of each of its values stays, streets
    before the network, then the least key; the column goes."""
    inside = contained(streets, priority, r, key).where("contained").select(key)
    s = streets.join(inside, key, "left_semi")
    if deny is not None:
        s = without_ids(s, deny, key)
    s = written(s, "streets")  # the union and the gaps both read it
    gaps = contained(priority, s, r, key).where("not contained").select(key)
    out = s.withColumn("edge_source", F.lit("detailnetz")).unionByName(priority.join(gaps, key, "left_semi").withColumn("edge_source", F.lit("rvn")), allowMissingColumns=True)
    if unique in streets.columns and unique in priority.columns:
        out = keep_first(out, [unique], ["edge_source", key]).drop(unique)
    return out


def removed_ways(layer: DataFrame, network: DataFrame, key: str, id_col: str, opts: MatchOptions | None = None) -> DataFrame:
    """Rows of the layer that share their id with a crossing short way: what remove_crossing() takes out, to look at."""
    gone = crossing_short_ways(layer, network, key, opts).where("removed").select(key)
    return layer.join(layer.join(gone, key, "left_semi").select(id_col).distinct(), id_col, "left_semi")
