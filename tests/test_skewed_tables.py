"""All queries over tables where single keys hold a third of the rows, with small groups."""

import os

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from tests.compare import duck, rows_of_duck, rows_of_spark
from workload.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    root = tmp_path_factory.mktemp("skewed")
    connection = duckdb.connect()
    for name in ("region", "nation", "customer", "supplier", "events", "lineitem", "orders"):
        columns = {
            "lineitem": "* replace (case when l_orderkey % 3 = 0 then 4 else l_suppkey end as l_suppkey)",
            "orders": "* replace (case when o_orderkey % 3 = 0 then 7 else o_custkey end as o_custkey)",
        }.get(name, "*")
        connection.execute(f"copy (select {columns} from '{SF_DIR}/{name}.parquet') to '{root}/{name}.parquet' (format parquet)")
    return str(root), duck(root)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, skewed, name):
    sf_dir, connection = skewed
    spark.conf.set("spark.ledgerline.rowsPerGroup", "25" if name in ("scd2", "pivot_facts", "financial_ratios") else "150")
    try:
        names, got = rows_of_spark(queries()[name](spark, sf_dir))
    finally:
        spark.conf.unset("spark.ledgerline.rowsPerGroup")
    assert (names, got) == rows_of_duck(connection, oracle_sql()[name])
