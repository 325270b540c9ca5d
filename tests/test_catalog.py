"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as driver
from tidemark.plans.catalog import QUERIES
from tidemark.plans.catalog_sql import ORACLES
from tests.compare import differences, oracle_connection

SF_DIR = driver.SMOKE_DIR


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(compiled_spark, connection, name):
    result = driver.queries()[name](compiled_spark, SF_DIR)
    sql = driver.oracle_sql()[name]
    assert connection.execute(f"SELECT count(*) FROM ({sql})").fetchall()[0][0] > 0
    assert differences(result, connection, sql) == []


def test_queries_without_sql(compiled_spark):
    assert set(QUERIES) - set(ORACLES) == {"render_full"}
    assert driver.queries()["render_full"](compiled_spark, SF_DIR).count() == 50


def test_entry(compiled_spark):
    assert tuple(driver.entry(compiled_spark).first()) == (8, 7, 35, 23)
