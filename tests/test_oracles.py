"""Every registered query equals its DuckDB oracle on the given tables."""

import pytest
from helpers import SF
from oracle_check import compare, duck

import __spark_entry__ as entry
from footfall.plans.oracle import ORACLES
from footfall.plans.queries import QUERIES



@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_registers_every_query():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_oracle(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLES[name], SF) == ""
