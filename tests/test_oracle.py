"""Every registered query against its SQL on the smallest driver tables."""

import os

import pytest
from compare import connect, difference

import __spark_entry__ as entry_module
from workloads.oracles import ORACLES
from workloads.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query(spark, con, name):
    assert difference(entry_module.queries()[name](spark, SF), con, entry_module.oracle_sql()[name]) is None


def test_entry(spark):
    got = entry_module.entry(spark)
    assert got.count() > 0 and "segment_tier" in got.columns
