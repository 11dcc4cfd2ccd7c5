"""A corpus pipeline of five of the text operators. Each stage's rows are written as Parquet and read again by the next.

Defined cases: a null or empty text is a text without words: never toxic by its words, contaminated or secret; all such texts are alike, so
one stays of them; it is packed as its end token alone. Null ids are ids like any other, after all others where the least is
kept. Repeated rows are near copies: one stays. Very long texts are read whole, and only packing cuts them, into pieces. Of groups
that tie, the least id stays, then the least hash of the text. Other columns pass all stages but the last, whatever their names, if these don't
begin with two underscores. Without documents, labels or benchmark items no stage fails: the result is empty, or nothing is rejected."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from velonet.llm import decontam, packing, secret_scan, similar, toxicity
from velonet.llm.common import read, scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go. The model is learned from the labels of these documents."""
    return toxicity.reject_toxic(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word similarity 0.8 or more) stays: the one with the least id."""
    return similar.keep_one_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontam.remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; spans with secrets are masked in its text."""
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scan", mask_secrets),
    ("best_fit_packing", pack),
]
#: Fingerprints by XXH64, a trained model and packing aren't SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
