"""Correctness gate: every registered query against its DuckDB oracle at sf0.01."""

import pytest

from feedlens.plans import catalog, oracle
from feedlens.streaming import registered as streaming_queries
from tests.oracle_compare import compare, duck, type_mismatches

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def registry():
    return catalog.build() | streaming_queries(), oracle.build()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def _names():
    return sorted(oracle.build())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, registry, con, name):
    qs, sql = registry
    df = qs[name](spark, SF)
    got = df.toPandas()
    want = con.execute(sql[name]).df()
    ok, why = compare(got, want)
    assert ok, why
    assert not type_mismatches(df.schema, con.sql(sql[name]))


def test_every_query_runs_and_entry(spark, registry):
    import __spark_entry__ as E

    qs, sql = registry
    assert set(qs) == set(sql) and set(qs) <= set(E.queries()) and set(sql) <= set(E.oracle_sql())
    assert E.entry(spark).count() > 0
