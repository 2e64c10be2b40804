"""Every registered query equals its DuckDB oracle (rows, names, types, values)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF001, SF01
from tests.harness import compare, duck_connection

KEYS = sorted(E.catalog.QUERIES)


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck01():
    return duck_connection(SF01)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle_sf0_01(spark, duck01, key):
    r = compare(spark, duck01, key, E.queries()[key], E.oracle_sql()[key], SF01)
    assert r["ok"], r


@pytest.mark.parametrize("key", ["open_ffs", "open_cco", "denied_ffs", "denied_cco", "quoted_line"])
def test_reports_match_oracle_sf0_001(spark, key):
    r = compare(spark, duck_connection(SF001), key, E.queries()[key], E.oracle_sql()[key], SF001)
    assert r["ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == E.entry(spark).columns
