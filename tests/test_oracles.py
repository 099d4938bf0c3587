"""Every registered query against its DuckDB oracle (the driver's check),
on the smallest scale factor; ``tests/oracle_compare.py`` runs the same at
sf0.01."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_mod
from tessera.plans import catalog
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck

QUERIES = catalog.queries()
ORACLES = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_is_registered():
    assert len(QUERIES) >= 72
    assert set(QUERIES) <= set(entry_mod.queries()) and set(ORACLES) <= set(entry_mod.oracle_sql())
    assert set(ORACLES) <= set(QUERIES)
    rows_only = set(QUERIES) - set(ORACLES)
    assert rows_only == {"partition_profile"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF_SMALL)
    assert r["ok"] in (True, None), r


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    row = df.collect()[0]
    assert row["rows"] == 1500
    assert row["present"] == 500
    assert abs(row["mean_present"] - 117.252555) < 1e-6
    assert abs(row["mean_all_rows"] - 39.084185) < 1e-6
