"""Every named query that SQL can express equals its oracle, row for row."""

import pytest

from tests.parity import compare, connect
from wardstone.plans.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_oracle(spark, duck, name):
    problems, rows, _ = compare(spark, duck, QUERIES[name], ORACLES[name], FOLDER)
    assert problems == []
    assert rows > 0


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 10
