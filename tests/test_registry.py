"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as registered
from compare import difference, duck

FOLDER = "/root/testdata/sf0.001"
NAMES = sorted(registered.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_sql_has_a_query():
    assert set(registered.oracle_sql()) <= set(registered.queries())
    own = {n for n in registered.queries() if n not in registered.LLM_QUERIES}
    assert own - set(registered.oracle_sql()) == {"forecast_arima"}


def test_entry(spark):
    assert registered.entry(spark).count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    assert difference(spark, con, name, FOLDER) is None
