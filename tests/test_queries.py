"""Every registered query against its SQL, or at least against its own shape."""

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

# Learnt results: no SQL, and slow enough to be left to the other tests.
ROWS_ONLY = sorted(set(entry.queries()) - set(entry.oracle_sql()))


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, data, con, name):
    problem, _ = compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], data)
    assert not problem


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_gives_rows(spark, data, name):
    assert entry.queries()[name](spark, data).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    row = entry.entry(spark).collect()[0]
    assert 0 <= row["f1"] <= 1
