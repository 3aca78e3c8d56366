"""Every registered query with an SQL oracle matches DuckDB at sf0.001; every
registered query (with or without oracle) runs and keeps a stable schema."""

import pytest

from conftest import SF0001
from oracle_compare import compare, duck

import __spark_entry__ as entry_mod

ORACLE = entry_mod.oracle_sql()
QUERIES = entry_mod.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, SF0001, name, QUERIES[name], ORACLE[name])
    assert res["ok"], res


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_oracle_runs(spark, name):
    df = QUERIES[name](spark, SF0001)
    assert df.count() > 0


def test_entry(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["user_id", "n_items", "line"]
    rows = df.collect()
    assert len(rows) == 138
    assert all(r["n_items"] == 10 for r in rows)
