"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import pytest
from compare import connect, difference

from trialspark.plans import registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = registry.load()
# filters that keep nothing on the smallest tables; both sides must agree on that
MAY_BE_EMPTY = {
    "val04_duplicate_keys",
    "jn09_orphan_rows",
    "sl04_page_among_nulls",
    "prj13_metadata_predicate",
    "prj15_area_search",
}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, name):
    problem = difference(QUERIES[name](spark, SF_DIR), con, ORACLES[name])
    if name in MAY_BE_EMPTY and problem == "no rows on either side":
        return
    assert problem is None, problem


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_oracle(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
