"""Every registered query against its SQL on the small tables."""

import pytest
from conftest import SMALL
from oracle_check import compare, sql_connection

import __spark_entry__ as contract


@pytest.fixture(scope="module")
def connection():
    return sql_connection(SMALL)


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query(spark, connection, name):
    sql = contract.oracle_sql().get(name)
    problem = compare(spark, connection, SMALL, name, contract.queries()[name], sql)
    assert problem is None, problem


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["text", "news_uuid", "property", "emotion", "hits", "datatime"]
    assert df.count() > 0


def test_contract():
    assert set(contract.oracle_sql()) <= set(contract.queries())
