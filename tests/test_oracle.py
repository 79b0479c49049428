"""Every registered query against its SQL; queries without SQL must run and return rows."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import check, connect
from tests.conftest import SMALL

ALL = queries()
SQL = oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(ALL)


def test_entry_runs(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ALL))
def test_query(spark, connection, name):
    difference, rows, _ = check(spark, connection, SMALL, name, ALL, SQL)
    assert difference is None
    if name not in SQL:
        assert rows > 0
