"""Every registered query against its reference SQL on the smallest driver data."""

import os

import pytest

from oracle import load_all
from tools.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
QUERIES = load_all()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver data not present")

# Thresholds these two queries use leave nothing at this scale.
EMPTY_HERE = {"m28b_delivery_risk_250", "m28_delivery_risk", "m26_product_portfolio"}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_reference(spark, con, name):
    problem = compare(spark, con, QUERIES[name], FOLDER)
    assert problem is None or (problem == "no rows" and name in EMPTY_HERE), problem


def test_every_query_has_reference_sql():
    import __spark_entry__ as driver

    assert set(QUERIES) <= set(driver.queries()) and set(QUERIES) <= set(driver.oracle_sql())
