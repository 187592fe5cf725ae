import pytest

import __spark_entry__ as driver
from checks.compare import connect, difference
from checks.oracle import ORACLE


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, connection, sf_dir, name):
    assert difference(spark, connection, name, sf_dir) is None


def test_every_check_belongs_to_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert len({r["scenario_name"] for r in rows}) == 4
