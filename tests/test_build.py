"""Builds that are committed whole, rebuilds of what changed, and lookups that read few files."""

import datetime as dt
import json
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.plans import build as plan
from ledgerline.plans.build import GROUP, build, built, group_of, rebuild, ticker_group
from ledgerline.plans.ingest import FILINGS, PRICES
from ledgerline.plans.reports import built_history, built_page, company_page, company_sk, statement_history
from ledgerline.functions.columns import company_key
from ledgerline.sources.merge_on_read import land_delta
from ledgerline.sources.versions import TableSet

STAMPS = ("updated_at", "computed_at", "created_at", "calculated_at")
TICKERS = [f"T{k}" for k in range(12)] + ["1155.KL"]


def price_rows(tickers, days=6, bump=0):
    return [(t, dt.date(2024, 1, 1) + dt.timedelta(days=d), *[D(k + d + bump) for _ in range(5)], 10, None, None) for k, t in enumerate(tickers, 1) for d in range(days)]


def filing(ticker, cik, value, year=2023):
    node = {"form": "10-K", "fy": year, "fp": "FY", "filed": "2024-01-03", "end": f"{year}-12-31", "val": value, "accn": f"{cik}-{year}"}
    facts = {t: {"units": {"USD": [node]}} for t in ("Revenues", "NetIncomeLoss", "NetCashProvidedByUsedInOperatingActivities")}
    return (str(cik), ticker, "FACTS", 0, "ALL", json.dumps({"entityName": f"Company {ticker}", "facts": {"us-gaap": facts}}))


def bronze(spark, root, prices, filings):
    columns = [f for f in S.RAW_MARKET_PRICES.fieldNames() if f != "ingested_at"]
    spark.createDataFrame(prices, ", ".join(f"{c} {S.RAW_MARKET_PRICES[c].dataType.simpleString()}" for c in columns)).write.mode("overwrite").parquet(f"{root}/raw_market_prices")
    spark.createDataFrame(filings, "cik string, ticker string, form_type string, fiscal_year int, fiscal_period string, payload string").write.mode("overwrite").parquet(f"{root}/raw_sec_filings")
    return str(root)


def contents(tables):
    return {n: sorted(map(str, (tuple(r) for r in tables.read(n).drop(*STAMPS).collect()))) for n in tables.names}


FILED = [filing(t, k, 100 + k) for k, t in enumerate(TICKERS[:9])]


def test_a_build_that_is_cut_off_leaves_the_old_set(spark, tmp_path, monkeypatch):
    source, out = bronze(spark, tmp_path / "b", price_rows(TICKERS), FILED), str(tmp_path / "out")
    before = contents(build(spark, source, out))
    bronze(spark, tmp_path / "b", price_rows(TICKERS, bump=5), FILED)

    def cut_off(*_, **__):
        raise RuntimeError("cut off")

    for step in ("dim_company", "daily_valuation", "scd2"):
        with monkeypatch.context() as broken:
            broken.setattr(plan, step, cut_off)
            for again in (build, rebuild):
                with pytest.raises(RuntimeError, match="cut off") if step != "scd2" or again is build else pytest.MonkeyPatch.context():
                    if step == "scd2" and again is rebuild:
                        continue  # no documents changed
                    again(spark, source, out)
        assert TableSet(spark, out).version == 1 and contents(TableSet(spark, out)) == before
    after = build(spark, source, out)
    assert after.version == 2 and contents(after) != before
    assert contents(TableSet(spark, out, 1)) == before


def test_rebuild_equals_a_build_and_leaves_other_files(spark, tmp_path):
    out = str(tmp_path / "out")
    source = bronze(spark, tmp_path / "b", price_rows(TICKERS), FILED)
    first = build(spark, source, out, groups=8)
    assert rebuild(spark, source, out).version == 1  # nothing changed

    prices = [r for r in price_rows(TICKERS) if r[0] != "T5"] + [("T3", dt.date(2024, 2, 1), *[D(9)] * 5, 1, None, None), *price_rows(["NEW"])]
    filings = [r for r in FILED if r[1] != "T1"] + [filing("T1", 1, 777), filing("NEW", 99, 5)]
    second = rebuild(spark, bronze(spark, tmp_path / "b", prices, filings), out)
    whole = build(spark, source, str(tmp_path / "other"), groups=8)
    assert second.version == 2 and contents(second) == contents(whole)

    priced, filed = {group_of(t, 8) for t in ("T3", "T5", "NEW")}, {group_of(t, 8) for t in ("T1", "NEW")}
    touched = {"silver/market_prices": priced, "sources/raw_market_prices": priced, "gold/dim_company": priced | filed, "gold/fact_daily_market_valuation": priced | filed}
    for name in first.names:
        old, new = first.tables[name].parts, second.tables[name].parts
        assert {v for v in old.keys() | new.keys() if old.get(v) != new.get(v)} <= touched.get(name, filed)
        assert any(old.get(v) == new.get(v) for v in old)


def test_rebuild_without_a_build_builds(spark, tmp_path):
    source = bronze(spark, tmp_path / "b", price_rows(["A"]), [filing("A", 1, 5)])
    assert rebuild(spark, source, str(tmp_path / "out")).read("gold/fact_daily_market_valuation").count() == 6


def test_build_over_landed_deltas(spark, tmp_path):
    landed, out = TableSet(spark, str(tmp_path / "bronze")), str(tmp_path / "out")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.RAW_MARKET_PRICES if f.name != "ingested_at")
    for k in range(3):
        landed, _ = land_delta(landed, PRICES, spark.createDataFrame(price_rows(TICKERS, bump=k), schema))
    landed, _ = land_delta(landed, FILINGS, spark.createDataFrame(FILED, "cik string, ticker string, form_type string, fiscal_year int, fiscal_period string, payload string"))
    made = build(spark, landed, out)
    assert made.read("gold/fact_daily_market_valuation").count() == 6 * len(TICKERS)
    landed, _ = land_delta(landed, PRICES, spark.createDataFrame(price_rows(["T2"], bump=50), schema))
    again = rebuild(spark, landed, out)
    assert contents(again) == contents(build(spark, landed, str(tmp_path / "whole")))


def test_a_lookup_reads_one_folder_with_literal_keys(spark, tmp_path):
    made = build(spark, bronze(spark, tmp_path / "b", price_rows(TICKERS), FILED), str(tmp_path / "out"))
    gold = {n: made.read(f"gold/{n}").drop(GROUP) for n in ("dim_company", "fact_daily_market_valuation", "fact_quarterly_financials")}
    for ticker in ("t3", "1155.kl", "T11", "nobody"):
        page, history = built_page(made, ticker), built_history(made, ticker, chart=True)
        assert page.drop("projections").collect() == company_page(*gold.values(), ticker).drop("projections").collect()
        assert history.collect() == statement_history(gold["dim_company"], gold["fact_quarterly_financials"], ticker, chart=True).collect()
    page = built_page(made, "t3")
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    text = page._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for line in text.split("\n") if "FileScan parquet" in line]
    pushed = [line for line in scans if f"EqualTo(company_sk,{company_sk('T3')})" in line]
    assert len(scans) == 3 and len(pushed) == 2 and all("EqualTo(ticker,T3)" in line for line in scans)
    for name in gold:
        own, every = built(made, f"gold/{name}", "T3").inputFiles(), made.read(f"gold/{name}").inputFiles()
        assert len(own) == 1 and len(every) > 3
        assert f"{GROUP}={group_of('T3', 16)}" in own[0]


def test_keys_and_groups_made_here_are_those_made_there(spark):
    tickers = [("T3",), ("1155.KL",), ("É",)]
    for r in spark.createDataFrame(tickers, "t string").select("t", company_key("t").alias("sk"), ticker_group("t", 16).alias("g")).collect():
        assert (company_sk(r.t), group_of(r.t, 16)) == (r.sk, str(r.g))


def test_the_lookup_key_goes_below_the_windows(spark, tmp_path):
    """Over tables that are computed, not built, the key still selects rows before anything is shuffled."""
    from ledgerline.operators.price_analytics import price_analytics
    from ledgerline.operators.staging import stage_prices

    raw = spark.read.parquet(f"{bronze(spark, tmp_path / 'b', price_rows(TICKERS), FILED)}/raw_market_prices")
    daily = price_analytics(stage_prices(raw), slicing=None).select(company_key("ticker").alias("company_sk"), "*", *[F.lit(1).alias(c) for c in ("free_cash_flow", "net_margin", "return_on_equity")])
    companies = spark.createDataFrame([(company_sk("T1"), "T1", "1", "n", "USD", "x", "i")], "company_sk string, ticker string, cik string, company_name string, reporting_currency string, primary_exchange string, industry string")
    quarterly = spark.createDataFrame([], "company_sk string, period_end_date date, fiscal_year int, fiscal_period string, filing_date date, accession_number string, free_cash_flow decimal(38,2), cash_and_cash_equivalents decimal(20,2), total_liabilities decimal(20,2)")
    text = company_page(companies, daily, quarterly, "T1", key=company_sk("T1"))._jdf.queryExecution().executedPlan().toString()
    below = text[text.index("Window") :].split("FileScan")[0]
    assert "Filter" in below[below.index("Exchange") :]


def test_price_tables_are_dealt_by_group_once(spark, tmp_path, monkeypatch):
    """Prices reach their folders with the shuffle of their windows, and the daily fact stays there; sliced tickers are spread after."""
    spreads = {}
    write = TableSet.write

    def noted(self, name, df, partition_by=None, bloom=(), sort=(), spread=True):
        spreads[name] = spread
        return write(self, name, df, partition_by, bloom, sort, spread)

    monkeypatch.setattr(TableSet, "write", noted)
    prices = price_rows(TICKERS)
    plain = build(spark, bronze(spark, tmp_path / "b", prices, FILED), str(tmp_path / "out"))
    assert not spreads["silver/market_prices"] and not spreads["gold/fact_daily_market_valuation"]
    assert spreads["silver/financial_statements"]
    for name in ("silver/market_prices", "gold/fact_daily_market_valuation"):
        rows = plain.read(name).select(GROUP, ticker_group("ticker", plan.GROUPS).alias("g")).collect()
        assert len(rows) == len(prices) and all(r[GROUP] == r.g for r in rows)
    spark.conf.set("spark.ledgerline.rowsPerGroup", "4")
    try:
        sliced = build(spark, str(tmp_path / "b"), str(tmp_path / "sliced"))
    finally:
        spark.conf.unset("spark.ledgerline.rowsPerGroup")
    assert spreads["silver/market_prices"]
    assert contents(sliced) == contents(plain)
