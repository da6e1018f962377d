import os

import pytest

import __spark_entry__ as entry
from tests.oracle import same
from voxloom.plans import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables aren't here")


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_same_as_sql(spark, name):
    same(spark, catalog.QUERIES[name], catalog.ORACLES[name], SF)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() >= 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
