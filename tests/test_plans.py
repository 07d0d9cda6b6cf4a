"""The physical plans stay what they should be at scale."""

import os
import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from ledgerline.operators.asof import asof_join
from ledgerline.operators.history import latest_per_key, scd2
from ledgerline.operators.price_analytics import price_analytics
from ledgerline.operators.staging import extract_facts, stage_prices
from ledgerline.plans.gold import daily_valuation
from workload import shapes
from workload.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(text, operator):
    return len(re.findall(rf"(?:\+- |:- )(?:\*\(\d+\) )?{operator}\b", text))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    shapes.px_raw(spark, SF_DIR).write.parquet(f"{root}/prices")
    shapes.filings_raw(spark, SF_DIR).write.parquet(f"{root}/filings")
    return spark.read.parquet(f"{root}/prices"), spark.read.parquet(f"{root}/filings")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"build_gold"}))
def test_no_nested_loops_and_no_python(spark, name):
    text = plan(queries()[name](spark, SF_DIR))
    for operator in ("BroadcastNestedLoopJoin", "CartesianProduct", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert operator not in text


def test_one_shuffle_and_sort_for_price_analytics(tables):
    text = plan(price_analytics(stage_prices(tables[0]), slicing=None))
    assert (count(text, "Exchange"), count(text, "Sort")) == (1, 1)


def test_one_shuffle_and_sort_for_versions(tables):
    text = plan(scd2(extract_facts(tables[1]), slicing=None))
    assert (count(text, "Exchange"), count(text, "Sort")) == (2, 1)  # one of them for distinct


def test_asof_after_a_window_does_not_move_the_prices_again(tables):
    prices = price_analytics(stage_prices(tables[0]), slicing=None)
    right = prices.selectExpr("ticker", "trade_date as filing_date", "volume as v").distinct()
    text = plan(asof_join(prices, right, "ticker", "trade_date", "filing_date", slicing=None))
    above_union = text.split("Union")[0]
    assert "Exchange" not in above_union


def test_range_form_leaves_the_left_side_in_place(tables):
    prices = stage_prices(tables[0])
    right = prices.groupBy("ticker").agg(F.min("trade_date").alias("filing_date"))
    text = plan(asof_join(prices, right, "ticker", "trade_date", "filing_date", strategy="range"))
    assert "BroadcastHashJoin" in text
    left_side = text.split("BroadcastHashJoin")[1].split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in left_side


def test_latest_is_limited_before_the_shuffle(tables):
    text = plan(latest_per_key(stage_prices(tables[0]), "ticker", ["trade_date"]))
    below_exchange = text.split("Exchange")[1]
    assert "WindowGroupLimit" in below_exchange


def test_documents_are_parsed_once_and_never_shuffled(tables):
    text = plan(extract_facts(tables[1]))
    assert text.count("from_json(") == 1
    above, below = text.split("Exchange", 1)
    assert "payload" not in above and "payload" in below


def test_only_needed_columns_are_read(tables):
    prices, filings = tables
    text = plan(price_analytics(stage_prices(prices), slicing=None).select("ticker", "trade_date", "daily_return"))
    assert "ReadSchema: struct<ticker:string,trade_date:date,adj_close:decimal(14,4)>" in text
    text = plan(stage_prices(prices).where("trade_date >= date'1998-01-01'").select("volume"))
    assert "GreaterThanOrEqual(trade_date,1998-01-01)" in text


def test_valuation_prunes_price_columns(tables):
    prices = price_analytics(stage_prices(tables[0]), slicing=None)
    statements = queries()["financial_ratios"](prices.sparkSession, SF_DIR)
    text = plan(daily_valuation(prices, statements, slicing=None).select("ticker", "trade_date", "net_margin"))
    assert "sma_" not in text and "dollar_volume" not in text
    assert "ReadSchema: struct<ticker:string,trade_date:date>" in text
