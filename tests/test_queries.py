"""Every query that has SQL gives DuckDB's rows, on the smallest tables; those at a bound of distance on larger ones too."""

import os

import duckdb
import pytest

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events".split()

from velonet.plans.queries import QUERIES, SQL  # noqa: E402


def tables(folder):
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    con = duckdb.connect()
    for t in [*TABLES, "embeddings"]:
        con.sql(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def duck():
    return tables(SF)


def rows(table):
    names = sorted(table.schema.names)
    return sorted(tuple(str(r[c]) for c in names) for r in table.to_pylist())


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toArrow(), duck.sql(SQL[name]).to_arrow_table()
    assert sorted(got.schema.names) == sorted(want.schema.names)
    assert {f.name: str(f.type).replace("large_", "") for f in got.schema} == {f.name: str(f.type).replace("large_", "") for f in want.schema}
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", ["near_join_25m", "near_join_left", "snap_candidates"])
def test_matches_sql_at_the_bound(spark, name):
    """Here a pair lies exactly 25 m apart."""
    got, want = QUERIES[name](spark, LARGER).toArrow(), tables(LARGER).sql(SQL[name]).to_arrow_table()
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, duck, name):
    table = QUERIES[name](spark, SF).toArrow()
    assert table.num_rows and table.schema.names


def test_entry_has_all():
    import __spark_entry__ as e

    assert set(QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
