"""Every registered query against the SQL of another engine, on the given tables."""

import pytest
from comparing import connect, differences

import __spark_entry__ as entries
from depotlake.checks.oracle import ORACLE_SQL
from depotlake.checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    with connect(FOLDER) as connection:
        yield connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entries.queries()) and set(ORACLE_SQL) <= set(entries.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    assert differences(QUERIES[name](spark, FOLDER), duck, ORACLE_SQL[name]) == []


def test_no_query_is_empty(duck):
    empty = [n for n, sql in ORACLE_SQL.items() if not duck.sql(sql).limit(1).fetchall()]
    assert empty == []


def test_entry(spark):
    assert entries.entry(spark).count() > 0


def test_tie_columns_tell_lines_apart(duck):
    repeated = duck.sql(
        "SELECT 1 FROM lineitem GROUP BY l_orderkey, l_partkey, l_linenumber, l_quantity"
        " HAVING count(*) > 1"
    )
    assert repeated.fetchall() == []
