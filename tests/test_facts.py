"""Hand-made filings, versions and statements."""

import datetime as dt
import json
from decimal import Decimal as D

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from ledgerline.operators.dims import dim_company
from ledgerline.operators.fundamentals import dcf_defaults, financial_ratios, pivot_facts, ttm_rollup
from ledgerline.operators.history import current_versions, scd2
from ledgerline.operators.quality import expect_not_null, expect_unique
from ledgerline.operators.staging import extract_facts, extract_parsed_facts, parse_filings, rejected_filings

FACT = "ticker string, cik string, gaap_tag string, form_type string, fiscal_year int, fiscal_period string, filed_date date, period_start_date date, period_end_date date, amount decimal(20,2), accession_number string"


def day(text):
    return dt.date.fromisoformat(text) if text else None


def fact(filed, accn="a1", end="2023-12-31", amount="1", tag="Assets", ticker="T", year=2023, period="FY"):
    return (ticker, "1", tag, "10-K", year, period, day(filed), None, day(end), D(amount), accn)


def facts(spark, *rows):
    return spark.createDataFrame(list(rows), FACT)


def node(**changes):
    base = {"form": "10-K", "fy": 2023, "fp": "FY", "filed": "2024-02-01", "start": "2023-01-01", "end": "2023-12-31", "val": 1, "accn": "x"}
    return {k: v for k, v in {**base, **changes}.items() if v != "absent"}


def filing(spark, us_gaap, ticker="T", raw=None, **other):
    payload = raw if raw is not None else json.dumps({"entityName": "E", "facts": {"us-gaap": us_gaap, **other}})
    return spark.createDataFrame([(ticker, "0000000001", payload)], "ticker string, cik string, payload string")


def usd(*nodes):
    return {"units": {"USD": list(nodes)}}


def test_extract_drops_what_is_not_wanted(spark):
    doc = {
        "Assets": usd(
            node(val=5, accn="keep"),
            node(fp="q1"),
            node(fp="Q4"),
            node(val=None),
            node(val="absent"),
            node(fy=None),
        ),
        "Liabilities": {"units": {"EUR": [node(val=7)]}},
        "Revenues": None,
        "SomethingElse": usd(node(val=9)),
        "NetIncomeLoss": {"units": {}},
    }
    rows = extract_facts(filing(spark, doc, **{"ifrs-full": {"Assets": usd(node(val=8))}})).collect()
    assert [(r["gaap_tag"], r["amount"], r["accession_number"]) for r in rows] == [("Assets", D("5.00"), "keep")]


def test_extract_duplicates_and_missing_dates(spark):
    doc = {"Assets": usd(node(), node(), node(start="absent"), node(filed="absent"))}
    rows = extract_facts(filing(spark, doc)).collect()
    assert len(rows) == 3
    assert sorted((r["filed_date"] is None, r["period_start_date"] is None) for r in rows) == [(False, False), (False, True), (True, False)]


def test_amounts_are_exact(spark):
    raw = '{"facts":{"us-gaap":{"Assets":{"units":{"USD":[%s]}}}}}' % ",".join(
        '{"form":"10-K","fy":2023,"fp":"FY","filed":"2024-02-01","end":"2023-12-31","accn":"%d","val":%s}' % (i, v)
        for i, v in enumerate(["1.005", "-1.005", "123456789012345678.91", "1.5E9"])
    )
    rows = extract_facts(filing(spark, None, raw=raw)).orderBy("accession_number").collect()
    assert [r["amount"] for r in rows] == [D("1.01"), D("-1.01"), D("123456789012345678.91"), D("1500000000.00")]


def test_malformed_document(spark):
    broken = filing(spark, None, raw='{"facts": {"us-gaap": ')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        extract_facts(broken).count()
    assert extract_facts(broken, mode="PERMISSIVE").count() == 0
    assert rejected_filings(broken).count() == 1


@pytest.mark.parametrize("bad", [{"val": "none"}, {"val": 10**40}], ids=["text", "large"])
def test_amounts_that_are_no_amounts(spark, bad):
    tags = {"Assets": {"units": {"USD": [node(), node(**bad)]}}}
    broken = filing(spark, tags)
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        extract_facts(broken).count()
    assert rejected_filings(broken).count() == 1
    assert rejected_filings(filing(spark, {"Assets": {"units": {"USD": [node()]}}})).count() == 0


def test_other_unit_and_taxonomy(spark):
    doc = filing(spark, {}, **{"ifrs-full": {"Equity": {"units": {"EUR": [node(val=3)]}}}})
    rows = extract_facts(doc, tags=["Equity"], taxonomy="ifrs-full", unit="EUR").collect()
    assert [(r["gaap_tag"], r["amount"]) for r in rows] == [("Equity", D("3.00"))]


def test_undated_version_is_current(spark):
    rows = scd2(facts(spark, fact("2024-01-01"), fact(None, "a0"))).collect()
    by_date = {r["valid_from"]: r for r in rows}
    assert by_date[None]["is_current"] and not by_date[day("2024-01-01")]["is_current"]
    assert by_date[day("2024-01-01")]["valid_to"] == day("9999-12-31")


def test_versions_are_contiguous(spark):
    rows = scd2(facts(spark, fact("2024-05-01", "a2"), fact("2024-01-01", "a1"), fact("2024-09-01", "a3"))).orderBy("valid_from").collect()
    assert [r["valid_to"] for r in rows] == [day("2024-05-01"), day("2024-09-01"), day("9999-12-31")]
    assert [r["is_current"] for r in rows] == [False, False, True]


def test_same_day_tie_goes_to_the_later_period(spark):
    rows = scd2(facts(spark, fact("2024-01-01", end="2023-12-31"), fact("2024-01-01", end="2022-12-31"))).collect()
    by_end = {r["period_end_date"]: r for r in rows}
    assert by_end[day("2023-12-31")]["is_current"]
    other = by_end[day("2022-12-31")]
    assert not other["is_current"] and other["valid_from"] == other["valid_to"]


def test_colliding_key(spark):
    data = facts(spark, fact("2024-01-01", "a2"), fact("2024-01-01", "a1"))
    rows = scd2(data).collect()
    assert [r["accession_number"] for r in rows if r["is_current"]] == ["a2"]
    assert len({r["statement_sk"] for r in rows}) == 1
    assert [r["accession_number"] for r in current_versions(data).collect()] == ["a2"]


def statement(spark, *rows):
    return financial_ratios(pivot_facts(current_versions(facts(spark, *rows)))).collect()


def test_two_revenue_tags(spark):
    (row,) = statement(spark, fact("2024-01-01", tag="Revenues", amount="10"), fact("2024-01-01", tag="SalesRevenueNet", amount="12"))
    assert row["total_revenue"] == D("12.00")


def test_zero_denominators_and_missing_cash_flows(spark):
    (row,) = statement(
        spark,
        *[fact("2024-01-01", tag=t, amount="0") for t in ("Revenues", "StockholdersEquity", "LiabilitiesCurrent")],
        *[fact("2024-01-01", tag=t, amount="5") for t in ("NetIncomeLoss", "OperatingIncomeLoss", "Liabilities", "AssetsCurrent")],
    )
    assert [row[c] for c in ("operating_margin", "net_margin", "return_on_equity", "debt_to_equity", "current_ratio")] == [None] * 5
    assert row["free_cash_flow"] == D("0.00")


def test_ratio_rounds_half_away_from_zero(spark):
    (row,) = statement(spark, fact("2024-01-01", tag="Revenues", amount="20000"), fact("2024-01-01", tag="NetIncomeLoss", amount="-1"))
    assert row["net_margin"] == D("-0.0001")
    (row,) = statement(spark, fact("2024-01-01", tag="Revenues", amount="0.01"), fact("2024-01-01", tag="NetIncomeLoss", amount="99999999999999999"))
    assert row["net_margin"] == D("9999999999999999900.0000")


QUARTER = "company_sk string, fiscal_year int, fiscal_period string, period_end_date date, filing_date date, accession_number string, free_cash_flow decimal(38,2), cash_and_cash_equivalents decimal(20,2), total_liabilities decimal(20,2)"


def quarters(spark, *flows, company="c"):
    rows = [
        (company, 2020 + i // 4, f"Q{i % 4 + 1}", dt.date(2020, 1, 1) + dt.timedelta(days=91 * i), None, None, D(f), D(100 + i), D(200 + i))
        for i, f in enumerate(flows)
    ]
    return spark.createDataFrame(rows, QUARTER)


def defaults(spark, quarterly, close=None):
    company = spark.createDataFrame([("c", close)], "company_sk string, close_price decimal(14,4)")
    return dcf_defaults(company, ttm_rollup(quarterly)).first()


def test_ttm_takes_the_last_four(spark):
    data = quarters(spark, 1, 2, 3, 4, 5, 6)
    newest, oldest = ttm_rollup(data).first(), ttm_rollup(data, order="reference").first()
    assert (newest["ttm_free_cash_flow"], newest["last_cash"], newest["last_liabilities"]) == (D("18.00"), D("105.00"), D("205.00"))
    assert (oldest["ttm_free_cash_flow"], oldest["last_cash"]) == (D("10.00"), D("100.00"))
    with pytest.raises(ValueError):
        ttm_rollup(data, order="newest")


@pytest.mark.parametrize(
    "flows, base",
    [((1, 2, 3, 4, 5, 6), 18.0), ((7, -7), 5e9), ((-9, 9), 9.0), ((-1, -2), 5e9), ((0,), 5e9)],
)
def test_base_cash_flow_fallbacks(spark, flows, base):
    assert defaults(spark, quarters(spark, *flows))["base_fcf"] == base


def test_company_without_statements(spark):
    row = defaults(spark, quarters(spark, 1, company="other"))
    assert (row["base_fcf"], row["cash"], row["total_debt"], row["current_price"]) == (1e9, 0.0, 0.0, 100.0)
    assert defaults(spark, quarters(spark, 1), D("12.5"))["current_price"] == 12.5


def test_dim_company(spark):
    prices = spark.createDataFrame([("1155.KL",), ("GOOGL",), ("GOOGL",), ("NEW",)], "ticker string")
    doc = '{"entityName": "Alphabet Inc.", "sic": "7370", "sicDescription": "Services"}'
    filings = spark.createDataFrame(
        [("GOOGL", "0001652044", doc), ("GOOGL", "0000000002", "{}"), ("UNPRICED", "3", doc)], "ticker string, cik string, payload string"
    )
    rows = dim_company(prices, filings).orderBy("ticker", "cik").collect()
    got = [tuple(r[c] for c in ("ticker", "cik", "company_name", "reporting_currency", "primary_exchange", "industry")) for r in rows]
    assert got == [
        ("1155.KL", None, "1155.KL", "MYR", "Bursa Malaysia", "General Equity"),
        ("GOOGL", "0000000002", "GOOGL", "USD", "US Equities (SEC)", "General Equity"),
        ("GOOGL", "0001652044", "Alphabet Inc.", "USD", "US Equities (SEC)", "Services"),
        ("NEW", None, "NEW", "USD", "US Equities (SEC)", "General Equity"),
    ]
    assert expect_unique(dim_company(prices, filings), "company_sk").count() == 1


def test_not_null_check(spark):
    data = spark.createDataFrame([("a", 1), (None, 2), ("c", 3)], "ticker string, n int")
    rows = {r["column_name"]: tuple(r)[1:] for r in expect_not_null(data, ["ticker", "n"]).collect()}
    assert rows == {"ticker": (1, True, True), "n": (0, False, False)}


def test_unique_check_ignores_null_parts(spark):
    data = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), ("b", None)], "k string, n int")
    assert [tuple(r) for r in expect_unique(data, ["k", "n"]).collect()] == [("a", 1, 2)]
    assert expect_unique(data.select(F.monotonically_increasing_id().alias("i")), "i").count() == 0


def test_parsed_documents_give_any_tag_without_reading_text(spark, tmp_path):
    node = lambda v, **more: {"form": "10-K", "fy": 2023, "fp": "FY", "filed": "2024-02-01", "start": "2023-01-01", "end": "2023-12-31", "val": v, "accn": "a", **more}
    facts = {"Assets": {"units": {"USD": [node(100.25), node(12345678901234567.89), node(None), node(5, fp="Q9"), node(100.25)], "EUR": [node(7)]}}, "Goodwill": {"units": {"USD": [node(-3)]}}, "Odd": 4}
    rows = [("1", "T", json.dumps({"facts": {"us-gaap": facts}})), ("2", "U", "{}"), ("3", "V", '{"facts": {"us-gaap": 5}}'), ("4", "W", None)]
    filings = spark.createDataFrame(rows, "cik string, ticker string, payload string")
    parse_filings(filings).write.parquet(f"{tmp_path}/documents")
    documents = spark.read.parquet(f"{tmp_path}/documents")
    usable = filings.where("ticker in ('T', 'U')")
    for tags in (("Assets",), ("Goodwill",), ("Assets", "Goodwill")):
        assert sorted(map(str, extract_parsed_facts(documents, tags).collect())) == sorted(map(str, extract_facts(usable, tags).collect()))
    every = extract_parsed_facts(documents, tags=None)
    assert {r.gaap_tag for r in every.collect()} == {"Assets", "Goodwill"}
    assert every.count() == 3
    plan = every._jdf.queryExecution().executedPlan().toString()
    assert "parse_json" not in plan and "from_json" not in plan
    with pytest.raises(Py4JJavaError, match="MALFORMED"):
        parse_filings(spark.createDataFrame([("1", "T", "{")], "cik string, ticker string, payload string")).collect()
