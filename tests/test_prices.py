"""Hand-made prices, as-of joins and reports."""

import datetime as dt
from decimal import Decimal as D

import pytest

from ledgerline.functions.columns import billions_label, company_key, currency_label, in_billions, surrogate_key, to_fixed, zfill
from ledgerline.operators.asof import asof_join
from ledgerline.operators.price_analytics import price_analytics
from ledgerline.operators.staging import stage_prices
from ledgerline.plans.reports import company_page, statement_history, watchlist_report

PRICE = "ticker string, trade_date date, open_price decimal(14,4), high_price decimal(14,4), low_price decimal(14,4), close_price decimal(14,4), adj_close decimal(14,4), volume bigint, dividend_amount decimal(10,4), split_coefficient decimal(10,4)"
START = dt.date(2024, 1, 1)


def series(spark, *closes, ticker="T"):
    rows = [(ticker, START + dt.timedelta(days=i), None, None, None, D(2), D(str(c)), 3, None, None) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, PRICE)


def analysed(spark, *closes):
    return price_analytics(stage_prices(series(spark, *closes))).orderBy("trade_date").collect()


def test_staging_cleans_and_defaults(spark):
    rows = stage_prices(series(spark, 1, ticker=" goog\t ")).collect()
    assert rows[0]["ticker"] == "GOOG\t"
    assert (rows[0]["dividend_amount"], rows[0]["split_coefficient"]) == (D("0.0000"), D("1.0000"))


def test_first_day(spark):
    (row,) = analysed(spark, 7)
    assert row["daily_return"] is None
    assert (row["sma_20"], row["sma_50"], row["dollar_volume"]) == (D("7.0000"), D("7.0000"), D("6.00"))


def test_return_after_zero_price(spark):
    rows = analysed(spark, 0, 5, 4)
    assert [r["daily_return"] for r in rows] == [None, None, D("-0.200000")]


def test_averages_over_the_last_rows(spark):
    rows = analysed(spark, *range(1, 52))
    assert rows[-1]["sma_50"] == D("26.5000")
    assert rows[-1]["sma_20"] == D("41.5000")
    assert rows[48]["sma_50"] == D("25.0000")


def test_extreme_return_does_not_overflow(spark):
    rows = analysed(spark, "0.0001", "9999999999.9999")
    assert rows[1]["daily_return"] == D("99999999999998.000000")


def asof(spark, left, right, **options):
    l = spark.createDataFrame([("T", d) for d in left], "k string, t date")
    r = spark.createDataFrame(right, "k string, u date, e date, v int")
    return {x["t"]: x["v"] for x in asof_join(l, r, "k", "t", "u", tiebreak=["e"], **options).collect()}


@pytest.mark.parametrize("strategy", ["window", "range", "packed"])
def test_asof_edges(spark, strategy):
    d = dt.date
    left = [d(2024, 1, 1), d(2024, 2, 1), d(2024, 2, 2), None]
    right = [
        ("T", d(2024, 2, 1), d(2023, 12, 31), 1),
        ("T", d(2024, 2, 1), None, 2),
        ("T", None, d(2025, 1, 1), 9),
        ("U", d(2020, 1, 1), d(2019, 1, 1), 8),
        (None, d(2020, 1, 1), d(2019, 1, 1), 7),
    ]
    assert asof(spark, left, right, strategy=strategy) == {left[0]: None, left[1]: 2, left[2]: 2, None: None}


def test_asof_range_falls_back_when_too_large(spark, monkeypatch):
    from ledgerline.operators import asof as module

    monkeypatch.setattr(module, "BROADCAST_ROWS", 1)
    l = spark.createDataFrame([("T", 5)], "k string, t int")
    r = spark.createDataFrame([("T", 1), ("T", 3)], "k string, u int")
    df = asof_join(l, r, "k", "t", "u", strategy="range")
    assert "BroadcastHashJoin" not in df._jdf.queryExecution().toString()
    assert df.first()["u"] == 3


def test_asof_arguments(spark):
    l = spark.createDataFrame([("T", 5)], "k string, t int")
    with pytest.raises(ValueError):
        asof_join(l, l, "k", "t", "t")
    with pytest.raises(ValueError):
        asof_join(l, l.withColumnRenamed("t", "u"), "k", "t", "u", strategy="other")


def company(spark, ticker="T", currency="USD"):
    return spark.createDataFrame(
        [(f"sk-{ticker}", ticker, None, ticker, currency, "X", "I", True)],
        "company_sk string, ticker string, cik string, company_name string, reporting_currency string, primary_exchange string, industry string, is_active boolean",
    )


DAILY = "company_sk string, trade_date date, close_price decimal(14,4), daily_return decimal(24,6), sma_20 decimal(18,4), sma_50 decimal(18,4), free_cash_flow decimal(38,2), net_margin decimal(28,4), return_on_equity decimal(28,4)"


def test_watchlist_falsy_values(spark):
    daily = spark.createDataFrame(
        [
            ("sk-T", START, D(1), D("0.5"), D(1), D(1), D(5), D("0.1234"), D("0.1")),
            ("sk-T", dt.date(2024, 1, 2), D(3), None, D(1), D(1), D("-1500000000"), D(0), D(0)),
        ],
        DAILY,
    )
    row = watchlist_report(company(spark), daily, labels=True).first()
    assert (row["latest_trade_date"], row["daily_return"], row["net_margin"], row["roe"]) == ("2024-01-02", 0.0, 0.0, None)
    assert (row["close_label"], row["free_cash_flow_label"]) == ("$3.00", "$-1.50B")


def test_watchlist_without_prices_and_inactive(spark):
    daily = spark.createDataFrame([], DAILY)
    row = watchlist_report(company(spark), daily, labels=True).first()
    assert (row["close_price"], row["daily_return"], row["net_margin"], row["close_label"]) == (None, 0.0, None, "—")
    inactive = company(spark).selectExpr("* except (is_active)", "false as is_active")
    assert watchlist_report(inactive, daily).count() == 0


QUARTER = "company_sk string, fiscal_year int, fiscal_period string, period_end_date date, filing_date date, accession_number string, total_revenue decimal(20,2), operating_income decimal(20,2), net_income decimal(20,2), free_cash_flow decimal(38,2), operating_cash_flow decimal(20,2), capital_expenditures decimal(20,2), net_margin decimal(28,4), return_on_equity decimal(28,4), cash_and_cash_equivalents decimal(20,2), total_liabilities decimal(20,2)"


def test_statement_history_and_lookup(spark):
    quarterly = spark.createDataFrame(
        [("sk-T", 2023, "FY", dt.date(2023, 12, 31), START, "a", D("1005000000"), None, D(1), D(1), None, None, D("0.0005"), None, D(1), D(2))], QUARTER
    )
    rows = statement_history(company(spark), quarterly, ticker="t", chart=True).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row["period"], row["period_end_date"], row["operating_income"], row["net_margin"], row["roe"]) == ("2023 FY", "2023-12-31", 0.0, 0.05, 0.0)
    assert row["revenue_billions"] == 1.0
    assert statement_history(company(spark), quarterly, ticker="missing").count() == 0
    page = company_page(company(spark), spark.createDataFrame([], DAILY), quarterly, ticker="t").first()
    assert (page["base_fcf"], page["cash"], page["total_debt"], page["current_price"]) == (1.0, 1.0, 2.0, 100.0)


def test_statement_order_and_first_company(spark):
    rows = [("sk-T", 2020 + i, "FY", dt.date(2020 + i, 12, 31), START, "a", *[None] * 6, None, None, None, None) for i in (1, 0, 2)]
    quarterly = spark.createDataFrame(rows, QUARTER)
    twice = company(spark).unionByName(company(spark))
    assert [r["period"] for r in statement_history(twice, quarterly, ticker="T").collect()] == ["2020 FY", "2021 FY", "2022 FY"]
    newest = statement_history(twice, quarterly, ticker="T", order="reference").collect()
    assert [r["period"] for r in newest] == ["2022 FY", "2021 FY", "2020 FY"]
    assert statement_history(twice, quarterly).count() == 6
    with pytest.raises(ValueError):
        statement_history(twice, quarterly, order="newest")


@pytest.mark.parametrize(
    "value, digits, expected",
    [(1.005, 2, 1.0), (1.015, 2, 1.01), (0.125, 2, 0.13), (-0.125, 2, -0.13), (2.5, 0, 3.0), (1.45, 1, 1.4), (0.25, 1, 0.3), (8.345, 2, 8.35), (1234567.125, 2, 1234567.13)],
)
def test_to_fixed(spark, value, digits, expected):
    assert spark.createDataFrame([(value,)], "x double").select(to_fixed("x", digits)).first()[0] == expected


def test_labels(spark):
    df = spark.createDataFrame(
        [(D("1234.505"), "USD"), (D("-1234.5"), "MYR"), (None, "MYR")], "x decimal(20,4), c string"
    ).select(currency_label("x", "c"), billions_label(1e9 * df_col("x"), "c"), in_billions("x"))
    rows = [tuple(r)[:2] for r in df.collect()]
    assert rows == [("$1,234.51", "$1234.51B"), ("-MYR 1,234.50", "RM -1234.50B"), ("—", "—")]


def df_col(name):
    from pyspark.sql import functions as F

    return F.col(name).cast("double")


def test_zfill_and_keys(spark):
    df = spark.createDataFrame([("123", "a", None), ("123456789012", "a", "b")], "x string, y string, z string")
    rows = df.select(zfill("x"), surrogate_key("y", "z")).collect()
    assert [r[0] for r in rows] == ["0000000123", "123456789012"]
    assert rows[0][1] == df.selectExpr("md5('a')").first()[0]
    assert df.select(company_key("z")).first()[0] is None
