"""Gold fact: daily prices with the fundamentals known on each day."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import company_key, safe_ratio, surrogate_key
from ledgerline.operators.asof import asof_join, fits_broadcast
from ledgerline.schemas import RETURN

FUNDAMENTALS = ("total_revenue", "net_income", "operating_cash_flow", "free_cash_flow", "net_margin", "return_on_equity")


def _known(quarterly: DataFrame) -> DataFrame:
    return quarterly.select(
        "ticker",
        "filing_date",
        "period_end_date",
        F.col("fiscal_year").alias("latest_filed_year"),
        F.col("fiscal_period").alias("latest_filed_period"),
        *FUNDAMENTALS,
    )


def leaves_prices_in_place(quarterly: DataFrame, strategy: str) -> bool:
    """Whether :func:`daily_valuation` joins without moving the prices."""
    return strategy == "range" and fits_broadcast(_known(quarterly).dropna(subset=["ticker", "filing_date"]), ["ticker"])


def daily_valuation(
    prices: DataFrame,
    quarterly: DataFrame,
    strategy: str = "window",
    slicing="auto",
    rows_at_most: int | None = None,
) -> DataFrame:
    """Join analysed prices to the latest statement filed by the trade date.

    "Known on the day" follows the filing date of the statement's *current* versions: after
    a restatement the earlier days see the older quarter.
    """
    market = prices.select(
        "ticker",
        "trade_date",
        "close_price",
        "adj_close",
        "volume",
        "dollar_volume",
        "daily_return",
        *[c for c in prices.columns if c.startswith("sma_")],
        "dividend_amount",
    )
    joined = asof_join(
        market,
        _known(quarterly),
        "ticker",
        "trade_date",
        "filing_date",
        tiebreak=("period_end_date", "latest_filed_year", "latest_filed_period"),
        strategy=strategy,
        slicing=slicing,
        rows_at_most=rows_at_most,
    )
    return joined.select(
        surrogate_key("ticker", "trade_date").alias("valuation_sk"),
        company_key("ticker").alias("company_sk"),
        *market.columns,
        "latest_filed_year",
        "latest_filed_period",
        "filing_date",
        *FUNDAMENTALS,
        safe_ratio("dividend_amount", "adj_close", 6, RETURN).alias("daily_dividend_yield"),
    )
