"""Unions of differing tables, keep-first de-duplication and id sets."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from velonet.operators.scratch import written

#: What a task of dealt() holds.
ROWS_A_TASK = 200_000


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row for each key: the first by `order`, which must be total. Rows of a key are combined before the shuffle.

    Null keys are one key."""
    cols = df.columns
    row = F.struct(*[F.col(f"`{c}`") for c in cols])
    best = df.groupBy(*keys).agg(F.min_by(row, F.struct(*order)).alias("_row"))
    return best.select("_row.*")


def dealt(df: DataFrame, key: str, rows: int = ROWS_A_TASK) -> DataFrame:
    """df dealt out by key, about so many rows a task, whose memory then doesn't follow the table's size as it would with a fixed number of
    shuffle partitions. Windows and aggregations by the key (and more) find their rows together. Counts df once."""
    return df.repartition(max(1, math.ceil(df.count() / rows)), key)


def number_rows(df: DataFrame, order: Sequence[str], name: str, by: Sequence[str] = ()) -> DataFrame:
    """Running numbers from 1, by group. Without a group the rows are sorted in ranges, and each range's numbers go on from
    the one before: no single task sees all rows."""
    if by:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    at = written(df.orderBy(*order).withColumn("_at", F.spark_partition_id()).withColumn("_in", F.monotonically_increasing_id()))
    total, starts = 0, []
    for s in at.groupBy("_at").agg(F.count("*").alias("n"), F.min("_in").alias("first")).orderBy("_at").collect():  # a row a partition
        starts.append((s["_at"], total - s["first"]))
        total += s["n"]
    table = df.sparkSession.createDataFrame(starts or [(-1, 0)], "_at int, _shift long")
    return at.join(F.broadcast(table), "_at").withColumn(name, (F.col("_in") + F.col("_shift") + 1).cast("int")).select(*df.columns, name)


def union_harmonised(tables: Sequence[tuple[str, DataFrame]], source_col: str = "data_source") -> DataFrame:
    """All tables under each other, with their names in source_col; absent columns are null; columns by name."""
    tagged = [t.withColumn(source_col, F.lit(name)) for name, t in tables]
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return out.select(*[F.col(f"`{c}`") for c in sorted(out.columns)])


def combine(tables: Sequence[tuple[str, DataFrame]], key: str, seq: str, source_col: str = "data_source") -> DataFrame:
    """union_harmonised(), one row for each key: earlier tables first, then `seq`. Rows without a key are one, as in the source rule."""
    rank = reduce(lambda c, k: c.when(F.col(source_col) == k[1][0], k[0]), enumerate(tables), F.when(F.lit(False), -1))
    u = union_harmonised(tables, source_col).withColumn("_prio", rank)
    return keep_first(u, [key], ["_prio", seq]).drop("_prio")


def common_columns(tables: Sequence[DataFrame], order: Sequence[str] = ()) -> DataFrame:
    """All tables under each other, reduced to the columns that every one has."""
    names = [c for c in tables[0].columns if all(c in t.columns for t in tables)]
    out = reduce(lambda a, b: a.unionByName(b), [t.select(*names) for t in tables])
    return out.orderBy(*order) if order else out


def unique_id(df: DataFrame, index: str, name: str, columns: Sequence[str]) -> DataFrame:
    """The columns with nulls as '', and unique_id = index_name."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns], F.concat_ws("_", F.col(index).cast("string"), F.coalesce(F.col(name).cast("string"), F.lit(""))).alias("unique_id"))


def id_column(df: DataFrame, prefer: Sequence[str]) -> str:
    """The first of the columns that the table has."""
    for c in prefer:
        if c in df.columns:
            return c
    raise ValueError(f"none of {list(prefer)} is a column")


def without_ids(df: DataFrame, ids: DataFrame, key: str, id_col: str = "id") -> DataFrame:
    """Rows whose key isn't listed; null keys stay."""
    return df.join(ids.select(F.col(id_col).alias(key)).distinct(), key, "left_anti")


def with_ids(df: DataFrame, ids: DataFrame, key: str, id_col: str = "id") -> DataFrame:
    """Rows whose key is listed."""
    return df.join(ids.select(F.col(id_col).alias(key)).distinct(), key, "left_semi")


def id_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct ids of a that b doesn't have."""
    return a.distinct().join(b.distinct(), a.columns, "left_anti")


def apply_interventions(matched: DataFrame, layer: DataFrame, exclude: DataFrame, include: DataFrame, key: str) -> DataFrame:
    """Manual lists: excluded ids go; included ids of the layer that aren't there yet come. manual_action says which came.

    Lists hold numbers, so a key that isn't a number matches none."""
    ids = lambda t: t.select(F.col("id").try_cast("bigint").alias("_id")).where("_id is not null").distinct()
    numeric = dict(matched.dtypes)[key] in ("int", "bigint", "smallint", "tinyint")
    on = F.col(key).cast("bigint") == F.col("_id") if numeric else F.lit(False)
    kept = matched.join(ids(exclude), on, "left_anti").withColumn("manual_action", F.lit(None).cast("string"))
    added = layer.join(ids(include), on, "left_semi").join(matched.select(F.col(key).alias("_have")).distinct(), F.col(key) == F.col("_have"), "left_anti")
    return kept.unionByName(added.withColumn("manual_action", F.lit("included")), allowMissingColumns=True)
