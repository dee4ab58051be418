"""Every registered query that has SQL against it, on the same tables."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from tests.parity_check import connect, difference

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = connect(SMALL)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    assert difference(spark, duck, name, SMALL) is None


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns[:2] == ["station", "zone"]
