"""Expected attributes and lengths of features, checked by joins: the acceptance tests of a result."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velonet.functions import geometry as G
from velonet.functions.text import same_value

SCHEMA = "case string, element_nr string, mode string, attribute string, expected string, min_length double"
MODES = ("all_features", "any_segment")


def expectations(rows: Sequence[dict], spark) -> DataFrame:
    """Long form, a row for each expected attribute, of cases like
    {"case", "element_nr", "mode", "attributes": {...}, "min_length"}; a case without attributes has one row."""
    out = []
    for r in rows:
        for a, v in (r.get("attributes") or {None: None}).items():
            out.append((r["case"], r["element_nr"], r.get("mode", MODES[0]), a, v if v is None or isinstance(v, str) else json.dumps(v), r.get("min_length")))
    return spark.createDataFrame(out, SCHEMA)


def long_form(features: DataFrame, key: str, row_key: str, columns: Sequence[str], geom: str | None = None, measured: str | None = None) -> DataFrame:
    """(element_nr, row, attribute, actual, length) of features; measured: a column that has their lengths."""
    length = F.col(measured).cast("double") if measured else G.length(F.col(geom)) if geom else F.lit(None).cast("double")
    pairs = F.array(*[F.struct(F.lit(c).alias("attribute"), F.col(f"`{c}`").cast("string").alias("actual")) for c in columns])
    return features.select(F.col(key).cast("string").alias("element_nr"), F.col(row_key).alias("row"), length.alias("length"), F.explode(pairs).alias("p")).select("element_nr", "row", "length", "p.*")


def named(features: DataFrame, key: str, expected: DataFrame) -> DataFrame:
    """Features of edges that a case names. Spark doesn't move it below a window: apply it to what the window reads."""
    return features.join(F.broadcast(expected.select(F.col("element_nr").alias("_nr"))), F.col(key).cast("string") == F.col("_nr"), "left_semi")


def check(expected: DataFrame, features: DataFrame) -> DataFrame:
    """(case, mode, features, attributes_ok, geometry_ok, passed). features: long_form() of the checked table.

    An absent or null attribute fails. all_features: every feature of the edge must satisfy all. any_segment: some feature
    satisfies the attributes, and some, perhaps another, the length. An edge without features fails. Other modes give no row.
    Features of edges that no case names are left out before anything is dealt."""
    e = expected.where(F.col("mode").isin(*MODES))
    features = named(features, "element_nr", e)
    ids = features.select("element_nr", "row", "length").distinct().alias("f")
    base = e.select("case", "element_nr", "mode", "attribute", "expected", "min_length").join(ids, "element_nr", "left")
    j = base.join(features.select("element_nr", "row", "attribute", "actual"), ["element_nr", "row", "attribute"], "left")
    ok = F.col("attribute").isNull() | same_value(F.col("actual"), F.col("expected"))
    long = F.col("min_length").isNull() | F.coalesce(F.col("length") >= F.col("min_length"), F.lit(False))
    per = j.groupBy("case", "mode", "row").agg(F.bool_and(ok & F.col("row").isNotNull()).alias("a"), F.bool_and(long & F.col("row").isNotNull()).alias("g"))
    every = F.col("mode") == "all_features"
    out = per.groupBy("case", "mode").agg(F.count("row").alias("features"), F.bool_and("a").alias("aa"), F.bool_or("a").alias("oa"), F.bool_and("g").alias("ag"), F.bool_or("g").alias("og"))
    a, g = F.when(every, F.col("aa")).otherwise(F.col("oa")), F.when(every, F.col("ag")).otherwise(F.col("og"))
    return out.select("case", "mode", "features", a.alias("attributes_ok"), g.alias("geometry_ok"), (a & g).alias("passed"))


def failures(expected: DataFrame, features: DataFrame) -> DataFrame:
    """(case, row, attribute, expected, actual) of every attribute that differs."""
    e = expected.where("attribute is not null")
    ids = features.select("element_nr", "row").distinct()
    j = e.join(ids, "element_nr", "left").join(features, ["element_nr", "row", "attribute"], "left")
    return j.where(~same_value(F.col("actual"), F.col("expected"))).select("case", "row", "attribute", "expected", "actual")


def summary(checked: DataFrame) -> DataFrame:
    """One row: cases, passed, failed. A run succeeds if failed is 0."""
    return checked.agg(F.count("*").alias("cases"), F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"))


def report(expected: DataFrame, features: DataFrame) -> tuple[DataFrame, int]:
    """(case, mode, features, passed, wrong) of each case, and the exit code of a run: 0 if all passed, else 1.

    wrong: what differs, as (row, attribute, expected, actual), in order."""
    wrong = failures(expected, features).groupBy("case").agg(F.array_sort(F.collect_list(F.struct("row", "attribute", "expected", "actual"))).alias("wrong"))
    checked = check(expected, features)
    out = checked.join(wrong, "case", "left").select("case", "mode", "features", "passed", F.when(~F.col("passed"), F.col("wrong")).alias("wrong"))
    return out, int(not checked.where("not passed").isEmpty())
