"""Every registered query against its SQL."""

import re

import __spark_entry__ as entry
import pytest
from compare import compare
from conftest import SMALL


def own_queries():
    """The queries that must have SQL; those of the training-data part are tested beside it."""
    return [name for name in entry.queries() if not re.match(r"op\d+_|pipeline$", name)]


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_same_as_sql(spark, con, name):
    query, sql = entry.queries()[name], entry.oracle_sql()[name]
    assert compare(query(spark, SMALL), con, sql) is None


def test_every_query_has_sql():
    assert set(own_queries()) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() == 5
