"""Company dimension."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import company_key, json_fields

# How a ticker's suffix decides currency and exchange, and the default industry.
BURSA_SUFFIX = ".KL"
BURSA_CURRENCY, BURSA_EXCHANGE = "MYR", "Bursa Malaysia"
OTHER_CURRENCY, OTHER_EXCHANGE = "USD", "US Equities (SEC)"
DEFAULT_INDUSTRY = "General Equity"


def dim_company(prices: DataFrame, filings: DataFrame) -> DataFrame:
    """Every priced ticker with the entity data of its filings.

    Filings that say the same of a ticker count once, before the join, so many documents of
    one company do not multiply it. Only filings that differ in what they say give a ticker
    several rows; ``expect_unique`` on ``company_sk`` reports that. Each input is read once,
    and both sides of the join are small by then.
    """
    tickers = prices.select("ticker").distinct()
    entity = json_fields("payload", entityName="string", sicDescription="string")
    entities = (
        filings.select("ticker", "cik", entity.alias("_entity"))
        .select("ticker", "cik", F.col("_entity.entityName").alias("_name"), F.col("_entity.sicDescription").alias("_industry"))
        .distinct()
    )
    combined = tickers.join(entities, "ticker", "left")

    bursa = F.col("ticker").endswith(BURSA_SUFFIX)
    return combined.select(
        company_key("ticker").alias("company_sk"),
        "ticker",
        "cik",
        F.coalesce("_name", "ticker").alias("company_name"),
        F.when(bursa, BURSA_CURRENCY).otherwise(OTHER_CURRENCY).alias("reporting_currency"),
        F.when(bursa, BURSA_EXCHANGE).otherwise(OTHER_EXCHANGE).alias("primary_exchange"),
        F.coalesce("_industry", F.lit(DEFAULT_INDUSTRY)).alias("industry"),
        F.lit(True).alias("is_active"),
    )
