"""Every registered query on the smallest data set, against its oracle SQL where it has one."""

import os

import pytest

import __spark_entry__ as entry
from tools.check import compare, connect

FOLDER = entry.SMOKE_DIR
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test data not present")
PLANS, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("key", sorted(PLANS))
def test_query(spark, duck, key):
    _, rows, problems = compare(spark, duck, key, PLANS[key], SQL.get(key), FOLDER)
    assert not problems, problems
    assert rows >= 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(SQL) <= set(PLANS)
