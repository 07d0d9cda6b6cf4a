"""Quarterly statements: tag pivot, ratios and the trailing roll-up."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import ascending, company_key, descending, safe_ratio, surrogate_key
from ledgerline.schemas import AMOUNT, MONEY, RATIO, STATEMENT_COLUMNS

# Valuation defaults of the company page.
GROWTH_DEFAULT = 0.10
TERMINAL_GROWTH_DEFAULT = 0.025
WACC_DEFAULT = 0.085
SHARES_DEFAULT = 1e9
PRICE_DEFAULT = 100.0
FCF_WITHOUT_STATEMENTS = 1e9
FCF_WHEN_NOT_POSITIVE = 5e9


def pivot_facts(
    current: DataFrame,
    group=("ticker", "cik", "fiscal_year", "fiscal_period"),
    mapping=STATEMENT_COLUMNS,
    tag: str = "gaap_tag",
    amount: str = "amount",
) -> DataFrame:
    """One row per group with a column per statement line; several tags may feed one."""
    lines = [F.max(F.when(F.col(tag).isin(*tags), F.col(amount))).alias(name) for name, tags in mapping.items()]
    return current.groupBy(*group).agg(
        F.max("period_end_date").alias("period_end_date"),
        F.max("valid_from").alias("filing_date"),
        F.max("accession_number").alias("accession_number"),
        *lines,
    )


def financial_ratios(statements: DataFrame) -> DataFrame:
    """Free cash flow, margins, return on equity, leverage and current ratio."""
    zero = F.lit(0).cast(AMOUNT)
    return statements.select(
        surrogate_key("ticker", "fiscal_year", "fiscal_period").alias("financial_sk"),
        company_key("ticker").alias("company_sk"),
        "ticker",
        "fiscal_year",
        "fiscal_period",
        "period_end_date",
        "filing_date",
        "accession_number",
        *STATEMENT_COLUMNS,
        (F.coalesce("operating_cash_flow", zero) - F.coalesce("capital_expenditures", zero)).cast(MONEY).alias("free_cash_flow"),
        safe_ratio("operating_income", "total_revenue", 4, RATIO).alias("operating_margin"),
        safe_ratio("net_income", "total_revenue", 4, RATIO).alias("net_margin"),
        safe_ratio("net_income", "stockholders_equity", 4, RATIO).alias("return_on_equity"),
        safe_ratio("total_liabilities", "stockholders_equity", 4, RATIO).alias("debt_to_equity"),
        safe_ratio("current_assets", "current_liabilities", 4, RATIO).alias("current_ratio"),
    )


def quarterly_financials(current: DataFrame) -> DataFrame:
    """Pivot plus ratios over current fact versions."""
    return financial_ratios(pivot_facts(current))


def ttm_rollup(quarterly: DataFrame, n: int = 4, order: str = "latest", company: str = "company_sk") -> DataFrame:
    """Sum of free cash flow over the last ``n`` statements and the last balance figures.

    ``order="latest"`` takes the newest statements. ``order="reference"`` takes the oldest,
    which is what the original page ends up doing because its two sort orders are chained.
    The rows are summed as they are: annual and year-to-date figures are not separated.
    """
    if order not in ("latest", "reference"):
        raise ValueError("order must be 'latest' or 'reference'")
    by = ["period_end_date", "fiscal_year", "fiscal_period", "filing_date", "accession_number"]
    along = Window.partitionBy(company).orderBy(*(descending(by) if order == "latest" else ascending(by)))
    ranked = quarterly.withColumn("_rank", F.row_number().over(along)).where(F.col("_rank") <= n)

    def first(name):
        return F.max(F.when(F.col("_rank") == 1, F.col(name)))

    return ranked.groupBy(company).agg(
        F.sum("free_cash_flow").cast(MONEY).alias("ttm_free_cash_flow"),
        F.count(F.lit(1)).alias("statements"),
        first("free_cash_flow").alias("last_free_cash_flow"),
        first("cash_and_cash_equivalents").alias("last_cash"),
        first("total_liabilities").alias("last_liabilities"),
    )


def dcf_defaults(companies: DataFrame, rollup: DataFrame, price: str = "close_price", company: str = "company_sk") -> DataFrame:
    """Default valuation inputs per company, with fallbacks where figures are missing.

    Base cash flow: the trailing sum; if that is zero the last statement's; one billion
    without statements; five billion if the result is not positive. ``price`` names the
    latest price in ``companies``; it comes out as ``current_price``.
    """
    joined = companies.join(rollup, company, "left")
    trailing = F.col("ttm_free_cash_flow").cast("double")
    base = F.when(trailing != 0, trailing).otherwise(
        F.coalesce(F.col("last_free_cash_flow").cast("double"), F.lit(FCF_WITHOUT_STATEMENTS))
    )
    return joined.select(
        *[c for c in companies.columns if c != price],
        F.when(base > 0, base).otherwise(F.lit(FCF_WHEN_NOT_POSITIVE)).alias("base_fcf"),
        F.lit(GROWTH_DEFAULT).alias("growth"),
        F.lit(TERMINAL_GROWTH_DEFAULT).alias("terminal_growth"),
        F.lit(WACC_DEFAULT).alias("wacc"),
        F.coalesce(F.col("last_cash").cast("double"), F.lit(0.0)).alias("cash"),
        F.coalesce(F.col("last_liabilities").cast("double"), F.lit(0.0)).alias("total_debt"),
        F.lit(SHARES_DEFAULT).alias("shares_outstanding"),
        F.coalesce(F.col(price).cast("double"), F.lit(PRICE_DEFAULT)).alias("current_price"),
    )
