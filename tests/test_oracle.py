"""Every registered query against its SQL, at the smallest scale."""

import __spark_entry__ as entry
import pytest
from check import connect, difference

from sluicegate.checks import oracle, queries

SF_DIR = "/root/testdata/sf0.001"
NAMES = sorted(queries.queries())


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(oracle.oracle_sql()) == set(NAMES)
    assert set(NAMES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, connection, name):
    assert difference(spark, connection, name, SF_DIR) == ""


def test_entry(spark):
    assert entry.entry(spark).columns == ["hour_slot", "event_type", "event_cnt"]
