"""Declared schemas and decimal types of the bronze, silver and gold layers."""

from pyspark.sql import types as T

PRICE = T.DecimalType(14, 4)
AMOUNT = T.DecimalType(20, 2)
MONEY = T.DecimalType(38, 2)
AVERAGE = T.DecimalType(18, 4)
# Quotients are as wide as their operands allow, so that ANSI casts cannot overflow:
# a (14,4) price over the smallest non-zero price, an (20,2) amount over one cent.
RETURN = T.DecimalType(24, 6)
RATIO = T.DecimalType(28, 4)

OPEN_END = "9999-12-31"

# The reporting tags and periods the pipeline follows by default.
GAAP_TAGS = (
    "Revenues",
    "SalesRevenueNet",
    "OperatingIncomeLoss",
    "NetIncomeLoss",
    "Assets",
    "AssetsCurrent",
    "Liabilities",
    "LiabilitiesCurrent",
    "StockholdersEquity",
    "CashAndCashEquivalentsAtCarryingValue",
    "NetCashProvidedByUsedInOperatingActivities",
    "PaymentsToAcquirePropertyPlantAndEquipment",
)
FISCAL_PERIODS = ("Q1", "Q2", "Q3", "FY")

# Statement column -> tags that feed it.
STATEMENT_COLUMNS = {
    "total_revenue": ("Revenues", "SalesRevenueNet"),
    "operating_income": ("OperatingIncomeLoss",),
    "net_income": ("NetIncomeLoss",),
    "total_assets": ("Assets",),
    "current_assets": ("AssetsCurrent",),
    "total_liabilities": ("Liabilities",),
    "current_liabilities": ("LiabilitiesCurrent",),
    "stockholders_equity": ("StockholdersEquity",),
    "cash_and_cash_equivalents": ("CashAndCashEquivalentsAtCarryingValue",),
    "operating_cash_flow": ("NetCashProvidedByUsedInOperatingActivities",),
    "capital_expenditures": ("PaymentsToAcquirePropertyPlantAndEquipment",),
}


def _struct(*fields):
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


RAW_MARKET_PRICES = _struct(
    ("ticker", T.StringType(), False),
    ("trade_date", T.DateType(), False),
    ("open_price", PRICE, True),
    ("high_price", PRICE, True),
    ("low_price", PRICE, True),
    ("close_price", PRICE, True),
    ("adj_close", PRICE, False),
    ("volume", T.LongType(), True),
    ("dividend_amount", T.DecimalType(10, 4), True),
    ("split_coefficient", T.DecimalType(10, 4), True),
    ("ingested_at", T.TimestampType(), True),
)

RAW_FILINGS = _struct(
    ("cik", T.StringType(), False),
    ("ticker", T.StringType(), False),
    ("form_type", T.StringType(), False),
    ("fiscal_year", T.IntegerType(), True),
    ("fiscal_period", T.StringType(), True),
    ("payload", T.StringType(), False),
    ("ingested_at", T.TimestampType(), True),
)

RAW_MACRO_YIELDS = _struct(
    ("series_id", T.StringType(), False),
    ("observation_date", T.DateType(), False),
    ("yield_percent", T.DecimalType(6, 4), False),
    ("ingested_at", T.TimestampType(), True),
)

WATCHLIST = _struct(("ticker", T.StringType(), False), ("cik", T.StringType(), True))

# Unique keys of the bronze tables and the columns a repeated landing refreshes.
PRICE_KEYS = ("ticker", "trade_date")
PRICE_UPDATES = ("adj_close", "volume", "dividend_amount", "split_coefficient")
FILING_KEYS = ("cik", "form_type", "fiscal_year", "fiscal_period")
FILING_UPDATES = ("payload",)
YIELD_KEYS = ("series_id", "observation_date")
YIELD_UPDATES = ("yield_percent",)
