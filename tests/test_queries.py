"""Every named query against its SQL, on the smallest sample tables."""

from __future__ import annotations

import compare as harness
import pytest
from conftest import SMALL

import __spark_entry__ as entry
from accolade.plans import catalog
from oracle import statements

QUERIES = catalog.queries()
SQL = statements.oracle_sql()


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert harness.compare(spark, con, name, QUERIES[name], SQL[name], SMALL) is None


def test_entry_is_the_worklist(spark):
    df = entry.entry(spark)
    assert {"property_id", "worklist_rank", "talking_point", "guest_context"} <= set(df.columns)
    assert df.count() > 0
