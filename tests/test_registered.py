"""Every registered query equals its SQL on the driver's tables, in rows, values and types."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import duck, rows_of_duck, rows_of_spark, types_of_duck
from workload.catalog import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SPARK_TYPE = {"VARCHAR": "string", "INTEGER": "int", "HUGEINT": "bigint"}

needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(queries()) & set(oracle_sql())


@needs_data
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, connection, name):
    df = queries()[name](spark, SF_DIR)
    sql = oracle_sql()[name]
    names, got = rows_of_spark(df)
    expected_names, expected = rows_of_duck(connection, sql)
    assert names == expected_names
    assert got == expected
    types = {c: SPARK_TYPE.get(t, t.lower()) for c, t in types_of_duck(connection, sql).items()}
    assert types == dict(df.dtypes)


@needs_data
@pytest.mark.parametrize("name", ["price_analytics", "scd2", "asof_union", "daily_valuation", "financial_ratios"])
def test_equals_sql_when_sliced(spark, connection, name):
    spark.conf.set("spark.ledgerline.rowsPerGroup", "3" if name in ("scd2", "financial_ratios") else "40")
    try:
        names, got = rows_of_spark(queries()[name](spark, SF_DIR))
    finally:
        spark.conf.unset("spark.ledgerline.rowsPerGroup")
    assert got == rows_of_duck(connection, oracle_sql()[name])[1]


def test_entry(spark):
    df = entry(spark)
    assert df.columns == queries()["daily_valuation"](spark, "/root/testdata/sf0.001").columns
    assert df.count() > 0
