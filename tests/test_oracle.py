"""Registered queries against their DuckDB oracle on the smallest scale."""
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tools.compare import compare, duck

SQL = entry.oracle_sql()
QS = entry.queries()
FAST_ROWS_ONLY = ("schema_profile",)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_oracle(spark, con, key):
    r = compare(QS[key](spark, SF_SMALL), con, SQL[key])
    assert r["ok"], r


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QS)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "excluded" in df.columns
