"""Every registered query against its SQL twin on the smallest tables."""

import pytest
from oracle import compare, connect

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
QUERIES, TWINS = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_contract(spark):
    assert set(TWINS) <= set(QUERIES)
    result = contract.entry(spark)
    assert result.columns == ["code", "name", "g1", "area_sqkm", "density"]
    assert result.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    outcome, _ = compare(spark, con, QUERIES[name], TWINS.get(name), SF)
    assert outcome.startswith(("ok", "rows-only")), outcome
