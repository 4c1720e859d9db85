"""Every registered query against its SQL on the benchmark tables."""

import pytest

import __spark_entry__ as entry
import compare

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    frame = entry.queries()[name](spark, FOLDER)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert frame.count() > 0
    else:
        assert compare.differences(frame, con, sql) == []


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 986
