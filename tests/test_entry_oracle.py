"""Driver contract: entry smoke check, and every oracle-backed query against
DuckDB on the smallest driver tables."""

import pytest

import __spark_entry__ as E
from conftest import SF001
from oracle import compare, duck


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "o_orderkey" in df.columns


def test_every_oracle_key_is_registered():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_oracle(spark, con, key):
    ok, msg = compare(spark, key, E.queries()[key], E.oracle_sql()[key], SF001, con)
    assert ok, msg
