"""Report projections over the gold tables."""

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import ascending, billions_label, currency_label, descending, in_billions, percent
from ledgerline.operators.fundamentals import dcf_defaults, ttm_rollup
from ledgerline.operators.history import latest_per_key
from ledgerline.operators.valuation import dcf
from ledgerline.plans.build import built
from ledgerline.sources.versions import TableSet

PAGE_COLUMNS = ("ticker", "company_name", "reporting_currency", "primary_exchange", "industry")


def watchlist_report(companies: DataFrame, daily: DataFrame, labels: bool = False) -> DataFrame:
    """Active companies with their latest trading day; ``labels`` adds display texts.

    Percent columns follow the original page: a missing return shows as 0, a missing or
    zero return on equity as null, a zero net margin as 0.
    """
    latest = _latest_day(daily)
    rows = companies.where("is_active").join(latest, "company_sk", "left")
    roe = percent("return_on_equity")
    report = rows.select(
        "ticker",
        F.col("company_name").alias("name"),
        F.col("reporting_currency").alias("currency"),
        F.col("primary_exchange").alias("exchange"),
        "industry",
        F.date_format("trade_date", "yyyy-MM-dd").alias("latest_trade_date"),
        "close_price",
        F.coalesce(percent("daily_return"), F.lit(0.0)).alias("daily_return"),
        "sma_20",
        "sma_50",
        "free_cash_flow",
        percent("net_margin").alias("net_margin"),
        F.when(F.col("return_on_equity") != 0, roe).alias("roe"),
    )
    if not labels:
        return report
    return report.withColumns(
        {
            "close_label": currency_label("close_price", "currency"),
            "sma_20_label": currency_label("sma_20", "currency"),
            "sma_50_label": currency_label("sma_50", "currency"),
            "free_cash_flow_label": billions_label("free_cash_flow", "currency"),
        }
    )


def statement_history(
    companies: DataFrame,
    quarterly: DataFrame,
    ticker: str | None = None,
    chart: bool = False,
    order: str = "latest",
    key: str | None = None,
) -> DataFrame:
    """Statement rows per company; ``ticker`` looks one company up.

    ``key`` is that company's ``company_sk`` where it is known beforehand (:func:`company_sk`): as a literal
    it reaches the scan of every table.

    The rows of one company come in order: oldest first, or with ``order="reference"``
    newest first, which is what the original page ends up showing. Rows of all companies
    are left unsorted. Companies without statements have no rows. ``chart=True`` adds the
    figures in billions. An inner join: either side can be split, so one company may hold
    any share of the rows.
    """
    if order not in ("latest", "reference"):
        raise ValueError("order must be 'latest' or 'reference'")
    if ticker is not None:
        companies, quarterly = _company(companies, ticker), _only(quarterly, key)
    figures = {
        "revenue": "total_revenue",
        "operating_income": "operating_income",
        "net_income": "net_income",
        "free_cash_flow": "free_cash_flow",
        "operating_cash_flow": "operating_cash_flow",
        "capital_expenditures": "capital_expenditures",
    }
    statements = quarterly.select("company_sk", "fiscal_year", "fiscal_period", "period_end_date", "net_margin", "return_on_equity", *figures.values())
    rows = statements.join(companies.select("company_sk", "ticker"), "company_sk").select(
        "ticker",
        F.concat_ws(" ", F.col("fiscal_year").cast("string"), "fiscal_period").alias("period"),
        F.date_format("period_end_date", "yyyy-MM-dd").alias("period_end_date"),
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(name) for name, c in figures.items()],
        F.coalesce(percent("net_margin"), F.lit(0.0)).alias("net_margin"),
        F.coalesce(percent("return_on_equity"), F.lit(0.0)).alias("roe"),
    )
    if ticker is not None:
        by = ["period_end_date", "period"]
        rows = rows.orderBy(*(ascending(by) if order == "latest" else descending(by)))
    if chart:
        rows = rows.withColumns({f"{c}_billions": in_billions(c) for c in ("revenue", "net_income", "free_cash_flow")})
    return rows


def statement_positions(companies: DataFrame, quarterly: DataFrame) -> DataFrame:
    """Every company's statements with their places, from 1, in the order of :func:`statement_history` and in the page's original one."""
    by = ["period_end_date", "period"]
    rows = statement_history(companies, quarterly).select("ticker", *by)
    place = lambda order: F.row_number().over(Window.partitionBy("ticker").orderBy(*order))
    return rows.withColumns({"oldest_first": place(ascending(by)), "newest_first": place(descending(by))})


def company_page(
    companies: DataFrame,
    daily: DataFrame,
    quarterly: DataFrame,
    ticker: str | None = None,
    order: str = "latest",
    key: str | None = None,
) -> DataFrame:
    """Header, default valuation inputs and initial valuation, one row per company.

    The statements of the page are :func:`statement_history`, where ``key`` is described as well.
    """
    if ticker is not None:
        companies, daily, quarterly = _company(companies, ticker), _only(daily, key), _only(quarterly, key)
    latest = _latest_day(daily).select("company_sk", "close_price", "daily_return", "sma_20", "sma_50")
    header = companies.join(latest, "company_sk", "left").select(
        "company_sk",
        *PAGE_COLUMNS,
        F.coalesce(percent("daily_return"), F.lit(0.0)).alias("daily_return"),
        "sma_20",
        "sma_50",
        "close_price",
    )
    inputs = dcf_defaults(header, ttm_rollup(quarterly, order=order))
    return dcf(inputs)


def built_page(tables: TableSet, ticker: str, order: str = "latest") -> DataFrame:
    """:func:`company_page` of one company out of the built tables: one partition folder of each is read."""
    return company_page(*[built(tables, f"gold/{t}", ticker) for t in ("dim_company", "fact_daily_market_valuation", "fact_quarterly_financials")], ticker, order, company_sk(ticker))


def built_history(tables: TableSet, ticker: str, chart: bool = False, order: str = "latest") -> DataFrame:
    """:func:`statement_history` of one company out of the built tables."""
    return statement_history(*[built(tables, f"gold/{t}", ticker) for t in ("dim_company", "fact_quarterly_financials")], ticker, chart, order, company_sk(ticker))


def _company(companies: DataFrame, ticker: str) -> DataFrame:
    """The first company row of a ticker in any case; no row when there is none."""
    return companies.where(F.col("ticker") == ticker.upper()).orderBy(F.col("cik").asc_nulls_last()).limit(1)


def _only(facts: DataFrame, key: str | None) -> DataFrame:
    """The rows of one company, if its key is known."""
    return facts if key is None else facts.where(F.col("company_sk") == key)


def company_sk(ticker: str) -> str:
    """The key that ``company_key`` gives a ticker."""
    return hashlib.md5(ticker.upper().encode(), usedforsecurity=False).hexdigest()


def _latest_day(daily: DataFrame) -> DataFrame:
    columns = [
        "company_sk",
        "trade_date",
        "close_price",
        "daily_return",
        "sma_20",
        "sma_50",
        "free_cash_flow",
        "net_margin",
        "return_on_equity",
    ]
    return latest_per_key(daily.select(*columns), "company_sk", ["trade_date"])
