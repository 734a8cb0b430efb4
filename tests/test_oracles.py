"""Every registered query against its SQL twin, on the smallest tables."""

import compare
import pytest

import __spark_entry__ as entry_point
from registry.oracles import ORACLES
from registry.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF)


def test_every_query_has_a_twin():
    # the training-data package registers more and tests them itself
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare.difference(spark, con, SF, QUERIES[name], ORACLES[name]) is None


def test_entry(spark):
    assert entry_point.entry(spark).count() == 15
