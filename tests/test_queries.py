"""Every registered query against its SQL, on the smallest test tables."""

import os

import pytest

import __spark_entry__ as driver
from checks import inputs
from checks import queries as own
from checks.compare import connect, difference
from checks.inputs import STUDY_ID, parameters, stored

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(own.QUERIES) == set(own.ORACLES)
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", list(own.QUERIES))
def test_query_equals_sql(spark, con, name):
    assert difference(spark, SF_DIR, name, con) is None


def test_entry(spark):
    assert driver.entry(spark).count() == 35


def test_summaries_read_one_study(spark):
    summary = stored(spark, SF_DIR).route_summary(STUDY_ID, *parameters(spark))
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(study_id" in plan


def test_store_holds_the_only_copy(spark, monkeypatch):
    for name in ("_OVERLAYS", "_STORES"):
        monkeypatch.setattr(inputs, name, {})
    for name in ("import_append", "import_replace", "import_lookup", "element_summary"):
        own.QUERIES[name](spark, SF_DIR)
    assert not inputs._OVERLAYS
