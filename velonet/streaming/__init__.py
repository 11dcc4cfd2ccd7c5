"""Stateless rules on streams: what a batch layer gets, a stream of features gets too."""

from __future__ import annotations

from pyspark.sql import DataFrame

from velonet.operators.quality_rules import classify
from velonet.operators.translate import derived_columns


def translate_stream(features: DataFrame, layer: str) -> DataFrame:
    """A stream of raw features with the derived attributes. No state: rows pass as they come."""
    return features.withColumns(derived_columns(features, layer))


def classify_stream(features: DataFrame, layer: str) -> DataFrame:
    """A stream of raw features with its quality labels."""
    return classify(features, layer)


def write_stream(features: DataFrame, path: str, checkpoint: str):
    """Starts a query that appends to Parquet, exactly once, and ends when what is there has been read."""
    return features.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
