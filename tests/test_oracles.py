"""Every registered query against its SQL oracle."""

import pytest

import __spark_entry__ as driver
from tests.compare import connect, differences
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    assert differences(spark, duck, SF_DIR, name) == []


def test_entry(spark):
    report = driver.entry(spark)
    assert len(report.columns) == 13 and report.count() > 0
