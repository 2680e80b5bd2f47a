"""Every registered query against its SQL at the smallest scale."""

from __future__ import annotations

import check
import pytest

from oracle import ORACLE_SQL
from queries import QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return check.duck(sf)


def test_every_sql_has_a_query():
    assert set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_sql(spark, con, sf, key):
    ok, note = check.compare(spark, con, sf, key)
    assert ok, note


def test_entry_has_rows(spark):
    from __spark_entry__ import entry

    assert not entry(spark).isEmpty()
