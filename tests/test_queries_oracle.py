"""Every registered query: runs, has a stable schema, and equals its DuckDB oracle (sf0.001)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from oracle import compare, duck

SF = "/root/testdata/sf0.001"
QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["Contract", "Churn", "n"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sp = QUERIES[name](spark, SF).toPandas()
    if name not in ORACLE:
        assert len(sp.columns) > 0
        return
    dk = con.execute(ORACLE[name]).df()
    diff = compare(sp, dk)
    assert diff is None, diff
