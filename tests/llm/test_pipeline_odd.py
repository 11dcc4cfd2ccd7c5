"""The pipeline on nulls, empty and long texts, repeated rows, clashing columns and empty tables."""

import pytest

import corpus_pipeline
from tests.llm.test_scan_pack_print import check_packing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, component long, fp long, s binary, label int, blob string, spans string, chunk int"


def folder(spark, path, docs, items, labels):
    rows = [(i, t, "en", "s", len(t) if t is not None else None, 1, 2, 3, b"x", 0, "b", "c", 4) for i, t in docs]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_odd_rows(spark, tmp_path, odd):
    item = "ten words that the test set holds in just this order"
    docs = [*odd, (20, f"before {item} after"), (21, "my password = hunter2hunter2 is here today"), (22, "my password = hunter2hunter2 is here today"), (22, "my password = hunter2hunter2 is here today"), (None, None)]
    sf = folder(spark, tmp_path, docs, [(1, item), (2, None), (None, "")], [(1, 1, 0), (4, 1, 0), (None, 1, None), (3, None, 0)])
    rows = corpus_pipeline.run(spark, sf).collect()
    kept = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, sf)
        assert kept.columns == spark.read.parquet(f"{sf}/documents.parquet").columns, name
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert len(texts) == kept.count() and not {20, 22} & set(texts) and {3, 4, 6, 7, 21} <= set(texts)
    assert len([t for t in texts.values() if not (t or "").split()]) == 1  # of all texts without words one stays
    assert "hunter2" not in texts[21] and texts[7] == "word " * 60000
    assert {r.doc_id for r in rows} == set(texts)
    check_packing(rows, {i: t or "" for i, t in texts.items()}, 2048)


@pytest.mark.parametrize("which", ["documents", "labels", "benchmark"])
def test_empty_tables(spark, tmp_path, which):
    docs = [(1, "one two three"), (2, "four five six seven eight nine")]
    sf = folder(spark, tmp_path, [] if which == "documents" else docs, [] if which == "benchmark" else [(1, "no such words")], [] if which == "labels" else [(1, 1, 0)])
    assert sorted({r.doc_id for r in corpus_pipeline.run(spark, sf).collect()}) == ([] if which == "documents" else [1, 2])
