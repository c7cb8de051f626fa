"""Every query with SQL gives the rows DuckDB gives; the others run."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from compare import SF_DIR, differences, duck

QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_contract(spark):
    assert set(SQL) <= set(QUERIES)
    assert entry_points.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_query_equals_sql(spark, con, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    assert differences(got, con.execute(SQL[name]).df()) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL])
def test_query_runs(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    assert df.count() > 0
    spark.catalog.clearCache()
