"""Every registered query against its SQL on the smallest test tables."""

import pytest

import catalog.all_queries  # noqa: F401
from catalog.compare import connect, differences
from catalog.registry import CATALOG, run

SF_DIR = "/root/testdata/sf0.001"
# no row can qualify in the smallest tables
EMPTY_AT_THIS_SIZE = {"heatpump_owners_in_city"}


@pytest.fixture(scope="module")
def oracle():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query(spark, oracle, name):
    df = run(name, spark, SF_DIR)
    if CATALOG[name].sql is None:
        assert df.count() > 0
        return
    found = differences(df, oracle, CATALOG[name].sql)
    if name in EMPTY_AT_THIS_SIZE:
        found = [f for f in found if f != "no rows"]
    assert not found
