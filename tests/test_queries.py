"""Every registered query against its DuckDB oracle, and the driver entry."""

import os
import sys

import pytest

from conftest import ROOT, SF_ORACLE

sys.path.insert(0, os.path.join(ROOT, "tools"))

import oracle_check  # noqa: E402
from stratum.queries import ORACLES, QUERIES  # noqa: E402


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


@pytest.fixture(scope="module")
def duck():
    return oracle_check.duckdb_connection(SF_ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    out = oracle_check.compare(spark, SF_ORACLE, [name], con=duck)[name]
    assert out["columns_match"], out
    assert out["values_match"], out
    assert out["spark_rows"] == out["oracle_rows"] > 0


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())
