import pytest

#: Columns that operators use by these names inside.
CLASH = "blob string, fp long, chunk long, hit boolean, ids array<int>, score double, row long, y int, bucket int, halo boolean, key string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}"


def make(spark, rows):
    """documents from (doc_id, text)."""
    return spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None, "x", 1, 2, True, [1], 0.5, 3, 1, 4, False, "k") for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture
def docs(spark):
    return lambda rows: make(spark, rows)


#: Null, empty and one-word texts, a repeated row, a null id, blanks only, odd characters, a long text.
ODD = [(1, None), (2, ""), (3, "a"), (4, "one two"), (4, "one two"), (None, "one two three four"), (5, " \n\t "), (6, "Ünïcode “quoted” ’s \U0001f600 words"), (7, "word " * 60000)]


@pytest.fixture
def odd():
    return list(ODD)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i // 2) % 2) for i in range(40)] + [(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
