"""Bounded samples of labelled documents, for fitting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velonet.llm.common import texts


def sample(docs: DataFrame, labels: DataFrame, value: F.Column, rows: int, where: F.Column | None = None) -> DataFrame:
    """(doc_id, text, y) of at most `rows` labelled documents, chosen by a hash of the id. Label rows without a value don't count;
    of several values of an id the least does, and of several texts of an id the first in order.

    Only the sample's ids, `rows` at most, are broadcast."""
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), value.alias("y")).where("doc_id is not null and y is not null")
    if where is not None:
        own = own.where(where)
    own = own.groupBy("doc_id").agg(F.min("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return texts(docs).join(F.broadcast(own), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("doc_id", "text", "y")
