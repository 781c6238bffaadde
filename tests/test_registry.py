"""Every registered query against its SQL twin, at the smallest scale."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as contract  # noqa: E402
from ticketlake.queries import REGISTRY  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


@pytest.fixture(scope="module")
def con():
    from compare import connect

    return connect(SF)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_matches_sql(spark, con, name):
    from compare import compare

    query = REGISTRY[name]
    ok, note = compare(spark, con, name, query.run, query.sql, SF)
    assert ok, note


def test_contract(spark):
    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
