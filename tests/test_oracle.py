"""Every registered query equals its DuckDB oracle on the small test scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from meterlake.plans import registry
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck

SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


# Spark type name -> DuckDB type name
_TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = contract.queries()[name](spark, SF_SMALL)
    assert name in SQL, "every query has an oracle"
    res = compare(df, con, SQL[name])
    assert res["ok"], res
    rel = con.sql(SQL[name])
    oracle_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert {c: _TYPES.get(t, t) for c, t in df.dtypes} == oracle_types


def test_entry_smoke(spark):
    df = contract.entry(spark)
    assert df.count() == 3
    assert df.columns == ["meter_type", "total_kwh", "reading_count", "avg_kwh", "max_kwh", "anomaly_count"]
