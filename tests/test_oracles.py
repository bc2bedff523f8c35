"""Every registered query against DuckDB on the same files: columns, types, rows, values."""

import pytest

import __spark_entry__ as entry
from gaugeframe.plans import catalog
from oracles import ORACLES
from oracle import compare, connect

ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(catalog.queries())


def test_entry_lists_every_query():
    assert set(catalog.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, sf_dir, name):
    assert compare(entry.queries()[name](spark, sf_dir), con, entry.oracle_sql()[name]) == []


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 20
