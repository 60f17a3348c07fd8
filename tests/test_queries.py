"""Every registered query against its SQL on the smallest tables."""

import oracle
import pytest

import __spark_entry__ as entry
from marketloom.plans import load_queries

SF_DIR = "/root/testdata/sf0.001"
LIBRARY = load_queries()
QUERIES = {name: q.run for name, q in LIBRARY.items()}
SQL = {name: q.sql for name, q in LIBRARY.items() if q.sql is not None}


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_entry(spark):
    assert entry.entry(spark).columns[:3] == ["code", "level_no", "level"]


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_entry_registers_the_library():
    assert set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert oracle.difference(QUERIES[name](spark, SF_DIR), con, SQL[name]) == ""
