import pytest

import __spark_entry__ as driver
from compare import connect, diff
from eventloom.plans import oracles, registry

SF = "/root/testdata/sf0.001"
QUERIES = registry.queries()
ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_checking_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() > 0 and df.columns[:2] == ["summary_date", "team_id"]


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_checking_sql(spark, con, name):
    assert diff(QUERIES[name](spark, SF), con, ORACLES[name]) is None
