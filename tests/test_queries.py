import pytest

import __spark_entry__ as driver
from strata.queries import ALL

from .compare import connect, difference


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", list(ALL))
def test_query_equals_sql(spark, con, sf, name):
    assert ALL[name].sql, "every query has SQL to agree with"
    assert difference(spark, con, ALL[name], sf) is None


def test_driver_contract(spark):
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert driver.entry(spark).limit(1).count() == 1
