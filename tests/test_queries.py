"""Every query against its SQL, on the smallest tables."""

import os

import compare
import pytest

import __spark_entry__ as contract
from wayfare.plans.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.fixture(scope="module")
def connection():
    return compare.connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    frame = contract.queries()[name](spark, FOLDER)
    assert compare.differences(frame, connection, contract.oracle_sql()[name]) == []


def test_flagship(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["fit_travel_time", "encode_rides", "nyc_rides", "earliest_stop"])
def test_scans_read_only_what_they_need(spark, name):
    plan = contract.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan
