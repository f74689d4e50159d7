"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import pytest

import __spark_entry__ as E
from cohortkit.checks.compare import duck, rows_of
from cohortkit.checks.oracle import oracle_sql
from cohortkit.plans.queries import QUERIES
from tests.conftest import SF_SMALL

SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sp = QUERIES[name](spark, SF_SMALL).toPandas()
    du = con.execute(SQL[name]).df()
    sc, sr = rows_of(sp)
    dc, dr = rows_of(du)
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr


def test_oracle_keys_subset_of_queries():
    assert set(SQL) == set(QUERIES)
    assert set(SQL) <= set(E.oracle_sql()) and set(QUERIES) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "Initial Label" in df.columns and "Final Label" in df.columns
