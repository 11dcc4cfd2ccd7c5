"""Shared helpers: paths for written intermediates, document columns, bounded slices of batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velonet.operators.scratch import shared_folder, written

#: Stands for a null doc_id where ids are compared: after every other id.
NO_ID = 2**63 - 1


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text); a null text is the empty text. Other columns, whatever their names, are left behind."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def text_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As texts(), with the text as UTF-8 bytes."""
    return texts(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("text"))


def text_node(text_col: str = "text") -> F.Column:
    """A hash of the text's bytes; a null text is the empty text."""
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"))


def keep_first(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """docs with one row of each group: the one with the least doc_id (null after all), then the least text node.

    rows: doc_id, node, component of every row. Only ids and nodes of rows that stay cross the join with the texts. Of other columns'
    names, only __id and __node are this operator's own."""
    named = rows.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("__id"), F.col("node").alias("__node"), "component")
    counted = named.groupBy("component", "__id", "__node").agg(F.count("*").alias("copies"))
    stay = written(counted.groupBy("component").agg(F.min(F.struct("__id", "__node", "copies")).alias("r")).select("r.*"), "stay")
    keyed = docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "__node": text_node()}).join(stay.select("__id", "__node"), ["__id", "__node"], "left_semi")
    if not stay.where("copies > 1").isEmpty():
        keyed = keyed.dropDuplicates(["__id", "__node"])
    return keyed.select(*docs.columns)


def by_size(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of `limit` bytes of text (or items of a list) at most, or one row, so that memory doesn't follow
    the rows of a batch."""
    for b in batches:
        length = pc.list_value_length if pa.types.is_list(b[column].type) else pc.binary_length
        size = np.cumsum(pc.fill_null(length(b[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64)
        at = 0
        while at < b.num_rows:
            end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + limit, side="right")))
            yield b.slice(at, end - at)
            at = end
