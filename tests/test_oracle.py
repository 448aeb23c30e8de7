"""Every registered query against its independent DuckDB answer (sf0.001)."""

import pytest

import __spark_entry__ as entry
from deskflow.queries import REGISTRY
from deskflow.sources.fixtures import RAW_TABLES
from oracle.compare import compare, duck_views

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
KEYS = sorted(REGISTRY)


@pytest.fixture(scope="module")
def duck():
    return duck_views(SF, RAW_TABLES)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_sql(spark, duck, key):
    df = entry.queries()[key](spark, SF)
    if key not in SQL:
        assert df.count() >= 0
        return
    assert compare(df, duck, SQL[key]) == []
