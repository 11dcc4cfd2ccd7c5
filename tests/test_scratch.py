"""Intermediates that are kept from run to run, and what is cleared."""

import os
import time

import pytest
from pyspark.sql import functions as F

from velonet.functions import geometry as G
from velonet.operators import scratch, snapping


@pytest.fixture
def shared(spark, tmp_path, monkeypatch):
    folder = tmp_path / "shared"
    monkeypatch.setattr(scratch, "shared_folder", lambda s: f"file://{folder}")
    return folder


@pytest.fixture
def edges(spark, tmp_path):
    line = G.line(G.point(F.lit(0.0), F.col("id") * 100.0), G.point(F.lit(100.0), F.col("id") * 100.0))
    df = spark.range(5).select(F.col("id").alias("seq"), F.concat(F.lit("E"), "id").alias("element_nr"), F.lit("a").alias("beginnt_bei_vp"), F.lit("b").alias("endet_bei_vp"), line.alias("geom"))
    df.write.parquet(str(tmp_path / "net"))
    return str(tmp_path / "net")


def segments(shared):
    return sorted(p.name for p in shared.iterdir() if p.name.startswith("segments-"))


def test_a_second_run_reads_the_segments(spark, shared, edges):
    ways = spark.createDataFrame([(1, [[(0.0, 3.0), (100.0, 3.0)]], "Radweg")], "way_id long, geom array<array<struct<x:double,y:double>>>, fuehr string")
    run = lambda **o: sorted(snapping.snap(spark.read.parquet(edges), ways, opts=snapping.SnapOptions(**o)).drop("geom").collect(), key=str)
    first, one = run(), segments(shared)
    parts = {p: p.stat().st_mtime_ns for p in (shared / one[0]).iterdir()}
    assert len(one) == 1 and run() == first and segments(shared) == one and {p: p.stat().st_mtime_ns for p in (shared / one[0]).iterdir()} == parts
    run(step=5.0)
    assert len(segments(shared)) == 2  # another step
    run(radius=20.0)
    assert len(segments(shared)) == 2  # segments don't depend on the radius
    run(reuse=False)
    assert len(segments(shared)) == 3
    spark.read.parquet(edges).where("seq < 4").write.parquet(edges + "2")
    spark.read.parquet(edges + "2").write.mode("append").parquet(edges)
    assert len(run()) >= len(first) and len(segments(shared)) == 4  # other files


def test_names_follow_content(spark, shared, edges):
    df = spark.read.parquet(edges)
    key = scratch.content_key
    assert key(df) == key(spark.read.parquet(edges)) != key(df.where("seq > 1")) != key(df.where("seq > 2"))
    assert key(df.withColumn("r", F.rand())) is None and key(spark.createDataFrame([(1,)], "a int")) is None
    assert key(df.select("seq").mapInArrow(lambda b: b, "seq long")) is None
    assert key(df.withColumns({f"c{k}": F.lit(k) for k in range(60)})) != key(df.withColumns({f"c{k}": F.lit(k + (k == 50)) for k in range(60)}))
    made = scratch.kept(df, "some", 1)
    assert sorted(made.collect()) == sorted(df.collect()) and not [p for p in shared.iterdir() if "half" in p.name]
    scratch.kept(df, "some", 1)
    assert len(list(shared.iterdir())) == 1
    (own,) = shared.iterdir()
    os.utime(own, (0, 0))
    assert scratch.kept(df, "some", 1).count() == df.count() and time.time() - own.stat().st_mtime < 100  # past its time


def test_clear_takes_old_intermediates_alone(spark, shared):
    old, young = scratch.written(spark.range(3), "old"), scratch.written(spark.range(3), "young")
    (shared / "ledger").mkdir()
    for p in (old._written_path, f"file://{shared}/ledger"):
        os.utime(p.removeprefix("file://"), (0, 0))
    assert scratch.clear(spark, 3600) == 1
    assert young.count() == 3 and sorted(p.name for p in shared.iterdir()) == sorted(["ledger", young._written_path.rpartition("/")[2]])
    scratch.discard(young)
    assert scratch.clear(spark, 0) == 0
