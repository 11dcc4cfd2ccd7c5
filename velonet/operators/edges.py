"""Rule-based aggregation of segments to one row for each edge and direction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velonet.functions.geometry import GEOM
from velonet.functions.text import whole
from velonet.operators.merge import merge_parts
from velonet.operators.sets import number_rows

# Fixed values ---------------------------------------------------------------------------------------------------------
LONGEST = ("bezirk", "fuehr", "pflicht", "ofm", "farbe", "protek")
RESTRICTION_ORDER = ("Physische Sperre", "Schadensschild/StVO Zusatzeichen (Straßenschäden, Gehwegschäden, Radwegschäden)", "keine")
STRIP_ORDER = ("nein", "ja", "entfällt")
SIGNIFICANT_LENGTH, SIGNIFICANT_WIDTH = 50.0, 0.3
DROPPED = ("okstra_id", "existenz", "ist_radvorrangnetz", "elem_nr", "gisid", "gueltig_von", "dnez__sdatenid", "str_bez", "Index", "strassenklasse", "sfid", "fid")
LEADING = ("afid", "element_nr", "beginnt_bei_vp", "endet_bei_vp", "Länge", "ri", "verkehrsri", "Bezirksnummer", "strassenname", "fuehr", "pflicht", "breite", "ofm", "farbe", "protek", "trennstreifen", "nutz_beschr", "Kommentar")
DIRECTIONS = {0: "hinrichtung", 1: "gegenrichtung"}
# ----------------------------------------------------------------------------------------------------------------------


def longest_value(df: DataFrame, keys: Sequence[str], attribute: str, length: str = "length", seq: str = "seq") -> DataFrame:
    """(keys, attribute): the value with the greatest total length; the first seen wins ties; null if none is given.

    Lengths are summed in whole millimetres, so that the order of addition can't decide. Two combining aggregations; a hot
    edge has a row for each value after the first."""
    mm = F.sum(F.bround(F.col(length) * 1000).cast("long"))
    per_value = df.where(F.col(attribute).isNotNull()).groupBy(*keys, attribute).agg(mm.alias("_mm"), F.min(seq).alias("_seq"))
    best = per_value.groupBy(*keys).agg(F.max_by(attribute, F.struct("_mm", -F.col("_seq"))).alias(attribute))
    return df.select(*keys).distinct().join(best, list(keys), "left")


def worst_of(attribute: Column, order: Sequence[str], seq: Column) -> Column:
    """An aggregate: the value that stands first in `order`; values outside it come last, by seq; null if none is given."""
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, order)), attribute), F.lit(0)), F.lit(len(order) + 1).cast("long"))
    given = F.when(attribute.isNotNull(), F.struct(rank.alias("rank"), F.when(rank > len(order), seq).otherwise(F.lit(0)).alias("seq"), attribute.alias("v")))
    return F.min(given)["v"]


def least_number(attribute: Column) -> Column:
    """An aggregate: the least value that is a number."""
    v = attribute.try_cast("double")
    return F.min(F.when(~F.isnan(v), v))


def joined_distinct(attribute: Column, separator: str = ";") -> Column:
    """An aggregate: distinct texts in order, joined; empty ones and words for null are left out; null if nothing stays."""
    t = attribute.cast("string")
    good = F.when(~F.lower(t).isin("", "nan", "none"), t)
    return F.nullif(F.array_join(F.array_sort(F.collect_set(good)), separator), F.lit(""))


def aggregate_edges(df: DataFrame, keys: Sequence[str] = ("element_nr", "ri"), length: str = "length", seq: str = "seq", longest: Sequence[str] = LONGEST, geom: str | None = "geom") -> DataFrame:
    """One row for each edge and direction. Groups of one row pass as they are, but for the whole-metre length.

    longest: value of the greatest total length; breite: least; trennstreifen, nutz_beschr: worst; tilda_*: distinct values
    joined; all else: the first row's by `seq`. All `longest` attributes are folded in one pass: rows become (attribute, value,
    length) once, are summed by value, then by edge. Two shuffles in all, both of combined rows; keys must not be null."""
    keys = list(keys)
    d = df.where(" and ".join(f"`{k}` is not null" for k in keys))
    own = [c for c in longest if c in d.columns]
    tags = [c for c in d.columns if c.startswith("tilda_")]
    special = {"breite": lambda c: least_number(c), "trennstreifen": lambda c: worst_of(c, STRIP_ORDER, F.col(seq)), "nutz_beschr": lambda c: worst_of(c, RESTRICTION_ORDER, F.col(seq))}
    ruled = [c for c in special if c in d.columns]
    carried = [c for c in d.columns if c not in (*keys, length, seq, geom)]
    first = F.min_by(F.struct(*[F.col(f"`{c}`") for c in carried]), F.col(seq)).alias("_first")
    aggs = [F.count("*").alias("_n"), first, F.min(seq).alias("_seq"), F.sum(length).alias("_length"), *[special[c](F.col(c)).alias(f"_w_{c}") for c in ruled], *[joined_distinct(F.col(c)).alias(f"_t_{c}") for c in tags]]
    if geom and geom in d.columns:
        aggs.append(F.sort_array(F.collect_list(F.struct(F.col(seq).alias("at"), F.col(geom).alias("geom")))).alias("_geoms"))
    g = d.groupBy(*keys).agg(*aggs)
    if own:
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("a"), F.col(c).cast("string").alias("v")) for c in own])).alias("x")
        per = d.select(*keys, pairs, F.bround(F.col(length) * 1000).cast("long").alias("mm"), F.col(seq).alias("s")).where("x.v is not null").groupBy(*keys, F.col("x.a").alias("a"), F.col("x.v").alias("v")).agg(F.sum("mm").alias("mm"), F.min("s").alias("s"))
        best = per.groupBy(*keys).agg(*[F.max_by(F.when(F.col("a") == c, F.col("v")), F.when(F.col("a") == c, F.struct("mm", -F.col("s")))).alias(f"_l_{c}") for c in own])
        g = g.join(best, keys, "left")
    kinds = dict(d.dtypes)

    def column(c: str) -> Column:
        plain = F.col(f"_first.`{c}`")
        rule = F.col(f"_l_{c}").cast(kinds[c]) if c in own else F.col(f"_w_{c}") if c in ruled else F.col(f"_t_{c}") if c in tags else None
        if rule is None:
            return plain.alias(c)
        return F.when(F.col("_n") == 1, plain).otherwise(rule.cast(kinds[c])).alias(c)

    out = [*[F.col(k) for k in keys], *[column(c) for c in carried], whole(F.col("_length")).alias("Länge")]
    if geom and geom in d.columns:
        lines = F.filter(F.flatten(F.transform("_geoms", lambda x: F.coalesce(x["geom"], F.array().cast(GEOM)))), lambda p: F.size(p) > 1)
        # a single section keeps its geometry
        joined = g.select(*out, F.when(F.col("_n") == 1, F.get("_geoms", 0)["geom"]).otherwise(lines).alias(geom), (F.col("_n") > 1).alias("_many"))
        return merge_parts(joined, keys, geom, where=F.col("_many")).drop("_many")
    return g.select(*out)


def significant_changes(df: DataFrame, keys: Sequence[str] = ("element_nr", "ri"), length: str = "length", least: float = SIGNIFICANT_LENGTH, width: float = SIGNIFICANT_WIDTH) -> DataFrame:
    """(keys, attributes): what changes along an edge more than it should: any change of pflicht and nutz_beschr; on sections of
    `least` metres or more also of fuehr, ofm, protek and trennstreifen, and a range of widths above `width`.

    Two values differ if the least and the greatest do: one combining aggregation, where counts of distinct values would deal out
    each row once a column."""
    differ = lambda c: F.coalesce(F.min(c) < F.max(c), F.lit(False))
    long = F.col(length) >= least
    some = {}
    for c in ("pflicht", "nutz_beschr"):
        if c in df.columns:
            some[c] = differ(F.col(c))
    for c in ("fuehr", "ofm", "protek", "trennstreifen"):
        if c in df.columns:
            some[c] = differ(F.when(long, F.col(c)))
    if "breite" in df.columns:
        w = F.when(long, F.col("breite").try_cast("double"))
        some["breite"] = F.coalesce(F.round(F.max(w) - F.min(w), 9) > width, F.lit(False))
    marks = df.groupBy(*keys).agg(*[e.alias(f"_{c}") for c, e in some.items()])
    names = F.filter(F.array(*[F.when(F.col(f"_{c}"), c) for c in some]), lambda x: x.isNotNull())
    return marks.select(*keys, F.array_join(names, ",").alias("attributes")).where("attributes <> ''")


def finish(df: DataFrame, geom: str = "geom") -> DataFrame:
    """Surplus columns go; running numbers by edge and direction; columns in their order, others after."""
    d = number_rows(df.drop(*[c for c in DROPPED if c in df.columns]), ["element_nr", *(["ri"] if "ri" in df.columns else [])], "afid")
    lead = [c for c in LEADING if c in d.columns]
    rest = [c for c in d.columns if c not in lead and c != geom]
    return d.select(*[F.col(f"`{c}`") for c in [*lead, *rest, *([geom] if geom in d.columns else [])]])


def split_directions(df: DataFrame) -> dict[str, DataFrame]:
    """The rows of each direction, numbered anew; rows of neither are left out. Without a direction column: one table."""
    if "ri" not in df.columns:
        return {"all": df}
    return {name: number_rows(df.where(F.col("ri") == ri).drop("afid"), ["element_nr"], "afid") for ri, name in DIRECTIONS.items()}


def length_stats(df: DataFrame, by: Sequence[str], length: str = "length") -> DataFrame:
    """(by, n, total, mean) of lengths."""
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.sum(length).alias("total"), F.avg(length).alias("mean"))
