"""The driver's tables in the shape of landed prices, facts and filings (FIXTURES.md B).

Every shape covers its whole base table.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.schemas import GAAP_TAGS

FILING_BLOCK = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_bound(spark: SparkSession, sf_dir: str, *names: str) -> int:
    """Rows of base tables, from the file footers: bounds whatever is derived from them."""
    return sum(table(spark, sf_dir, n).count() for n in names)


def price_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged ticker and day of every line item: no fewer rows per ticker than ``px_raw``."""
    suffix = F.when(F.col("l_suppkey") % 3 == 0, ".KL").otherwise("")
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string"), suffix).alias("ticker"),
        F.col("l_shipdate").cast("date").alias("trade_date"),
    )


def px_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("l_shipdate").cast("date")
    suffix = F.when(F.col("l_suppkey") % 3 == 0, ".kl").otherwise("")
    daily = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", day.alias("trade_date"))
        .agg(
            F.min("l_extendedprice").alias("low"),
            F.max("l_extendedprice").alias("high"),
            F.sum("l_quantity").cast("bigint").alias("volume"),
            F.max("l_discount").alias("discount"),
            F.max("l_tax").alias("tax"),
        )
    )
    return daily.select(
        F.concat(F.lit(" s"), F.col("l_suppkey").cast("string"), suffix, F.lit(" ")).alias("ticker"),
        "trade_date",
        F.col("low").cast("decimal(14,4)").alias("open_price"),
        F.col("high").cast("decimal(14,4)").alias("high_price"),
        F.col("low").cast("decimal(14,4)").alias("low_price"),
        F.col("high").cast("decimal(14,4)").alias("close_price"),
        F.col("low").cast("decimal(14,4)").alias("adj_close"),
        "volume",
        F.when(F.col("discount") >= F.lit(0.08), F.col("discount").cast("decimal(10,4)")).alias("dividend_amount"),
        F.when(F.col("tax") > 0, F.lit(1).cast("decimal(10,4)")).alias("split_coefficient"),
    )


def facts_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _facts(spark, sf_dir).drop("block")


def _facts(spark, sf_dir):
    k = F.col("o_custkey") % 20
    day = F.col("o_orderdate").cast("date")
    quarter = F.quarter(day)
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("S"), k.cast("string"), F.when(k % 3 == 0, ".KL").otherwise("")).alias("ticker"),
        F.lpad(k.cast("string"), 10, "0").alias("cik"),
        F.get(F.array(*[F.lit(t) for t in GAAP_TAGS]), (F.col("o_orderkey") % 12).cast("int")).alias("gaap_tag"),
        F.when(quarter == 4, "10-K").otherwise("10-Q").alias("form_type"),
        F.year(day).alias("fiscal_year"),
        F.when(quarter == 4, "FY").otherwise(F.concat(F.lit("Q"), quarter.cast("string"))).alias("fiscal_period"),
        F.date_add(day, 40).alias("filed_date"),
        F.date_sub(day, 90).alias("period_start_date"),
        day.alias("period_end_date"),
        F.col("o_totalprice").cast("decimal(20,2)").alias("amount"),
        F.lpad(F.col("o_orderkey").cast("string"), 10, "0").alias("accession_number"),
        F.floor(F.col("o_orderkey") / FILING_BLOCK).cast("int").alias("block"),
    )


def filings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts folded back into nested documents.

    One document per company and block of order keys. Order keys are unique, so no document
    gathers more than ``FILING_BLOCK`` facts at any scale.
    """
    fact = F.struct(
        F.col("form_type").alias("form"),
        F.col("fiscal_year").alias("fy"),
        F.col("fiscal_period").alias("fp"),
        F.col("filed_date").cast("string").alias("filed"),
        F.col("period_start_date").cast("string").alias("start"),
        F.col("period_end_date").cast("string").alias("end"),
        F.col("amount").alias("val"),
        F.col("accession_number").alias("accn"),
    )
    company = ["cik", "ticker", "block"]
    per_tag = [
        F.collect_list(F.when(F.col("gaap_tag") == t, fact)).alias(t) for t in GAAP_TAGS
    ]
    body = F.struct(*[F.struct(F.struct(F.col(t).alias("USD")).alias("units")).alias(t) for t in GAAP_TAGS])
    payload = F.struct(
        F.concat(F.lit("Company "), "ticker").alias("entityName"),
        F.struct(body.alias("us-gaap")).alias("facts"),
    )
    return (
        _facts(spark, sf_dir)
        .groupBy(*company)
        .agg(*per_tag)
        .select(
            "cik",
            "ticker",
            F.lit("FACTS").alias("form_type"),
            F.col("block").alias("fiscal_year"),
            F.lit("ALL").alias("fiscal_period"),
            F.to_json(payload).alias("payload"),
        )
    )


def entity_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One filing per nation with entity data only, for the company dimension."""
    k = F.col("n_nationkey")
    entity = F.struct(
        F.col("n_name").alias("entityName"),
        F.col("n_nationkey").cast("string").alias("sic"),
        F.when(F.col("n_regionkey") != 2, F.col("r_name")).alias("sicDescription"),
    )
    return (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.lpad(k.cast("string"), 10, "0").alias("cik"),
            F.concat(F.lit("S"), k.cast("string"), F.when(k % 3 == 0, ".KL").otherwise("")).alias("ticker"),
            F.lit("FACTS").alias("form_type"),
            F.lit(0).alias("fiscal_year"),
            F.lit("ALL").alias("fiscal_period"),
            F.to_json(entity).alias("payload"),
        )
    )


def dcf_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One valuation per order; some rates lie at or below terminal growth."""
    c, o = F.col("o_custkey"), F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").alias("base_fcf"),
        ((c % 46 - 10).cast("double") / F.lit(100.0)).alias("growth"),
        ((o % 8 + 1).cast("double") / F.lit(200.0)).alias("terminal_growth"),
        ((c % 12 + 2).cast("double") / F.lit(100.0)).alias("wacc"),
        (F.col("o_totalprice") / F.lit(2.0)).alias("cash"),
        (c.cast("double") * F.lit(10.0)).alias("total_debt"),
        F.when(o % 50 == 0, F.lit(0.0)).otherwise((o % 1000 + 1).cast("double")).alias("shares_outstanding"),
    )


def scenario_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valuation inputs per supplier, taken from its line items."""
    cents = F.sum(F.col("l_extendedprice").cast("decimal(20,2)"))
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey")
        .agg(
            cents.alias("sales"),
            F.max(F.col("l_extendedprice").cast("decimal(20,2)")).alias("top"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("units"),
        )
        .select(
            F.col("l_suppkey").alias("company"),
            F.col("sales").cast("double").alias("base_fcf"),
            (F.col("top").cast("double") * F.lit(10.0)).alias("cash"),
            (F.col("top").cast("double") * F.lit(25.0)).alias("total_debt"),
            F.col("units").cast("double").alias("shares_outstanding"),
            (F.col("top").cast("double") / F.lit(100.0)).alias("current_price"),
        )
    )


def vendor_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items under the price vendor's column names; no split column."""
    price = F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string"), F.lit(".kl")).alias("Ticker"),
        F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit(" 00:00:00+08:00")).alias("Date"),
        price.alias("Open"),
        (price + F.col("l_quantity")).alias("High"),
        (price - F.col("l_quantity")).alias("Low"),
        price.alias("Close"),
        price.alias("Adj Close"),
        F.col("l_quantity").alias("Volume"),
        F.col("l_tax").alias("Dividends"),
    )


def customer_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    entity = F.struct(F.col("c_name").alias("entityName"), F.col("c_mktsegment").alias("sicDescription"))
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("ticker"),
        F.col("c_custkey").cast("string").alias("cik"),
        F.to_json(entity).alias("payload"),
    )


def landed_prices(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders by customer and year as prices: what is there, and a batch that overlaps it."""
    price = F.col("o_totalprice").cast("decimal(14,4)")
    rows = (
        table(spark, sf_dir, "orders")
        .groupBy(
            F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("ticker"),
            F.trunc(F.col("o_orderdate").cast("date"), "year").alias("trade_date"),
            (F.col("o_orderstatus") == "F").alias("incoming"),
        )
        .agg(F.max(price).alias("high"), F.min(price).alias("low"), F.count(F.lit(1)).alias("n"))
        .select(
            "ticker",
            "trade_date",
            F.col("low").alias("open_price"),
            F.col("high").alias("high_price"),
            F.col("low").alias("low_price"),
            F.col("high").alias("close_price"),
            F.col("low").alias("adj_close"),
            F.col("n").alias("volume"),
            F.when(F.col("incoming"), F.lit("0.5")).otherwise("0").cast("decimal(10,4)").alias("dividend_amount"),
            F.lit(1).cast("decimal(10,4)").alias("split_coefficient"),
            F.lit("2024-01-01").cast("timestamp").alias("ingested_at"),
            "incoming",
        )
    )
    return rows.where(~F.col("incoming")).drop("incoming"), rows.where("incoming").drop("incoming", "ingested_at")


def landed_filings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    incoming = F.col("incoming")
    cik = F.lpad(F.col("o_custkey").cast("string"), 10, "0")
    rows = (
        table(spark, sf_dir, "orders")
        .groupBy(cik.alias("cik"), F.year("o_orderdate").alias("fiscal_year"), (F.col("o_orderstatus") == "F").alias("incoming"))
        .agg(F.max(F.col("o_totalprice").cast("decimal(14,2)")).alias("top"))
        .select(
            "cik",
            F.concat(F.when(incoming, "NEW").otherwise("OLD"), "cik").alias("ticker"),
            F.lit("FACTS").alias("form_type"),
            "fiscal_year",
            F.lit("ALL").alias("fiscal_period"),
            F.to_json(F.struct("top")).alias("payload"),
            F.lit("2024-01-01").cast("timestamp").alias("ingested_at"),
            "incoming",
        )
    )
    return rows.where(~incoming).drop("incoming"), rows.where(incoming).drop("incoming", "ingested_at")


def vendor_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by customer and day as vendor files in three batches that overlap; the last order of a day counts."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    cents = F.col("o_totalprice").cast("decimal(14,2)")
    rows = (
        table(spark, sf_dir, "orders")
        .groupBy((F.col("o_custkey") % 50).alias("k"), day.alias("Date"), (F.col("o_orderkey") % 3).cast("int").alias("batch"))
        .agg(F.max(cents).alias("high"), F.min(cents).alias("low"), F.count(F.lit(1)).alias("n"))
    )
    text = {"Open": "low", "High": "high", "Low": "low", "Close": "high", "Adj Close": "low", "Volume": "n"}
    return rows.select(F.concat(F.lit("c"), F.col("k").cast("string")).alias("Ticker"), "Date", *[F.col(c).cast("string").alias(n) for n, c in text.items()], "batch")


def shared_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as filers; every two share a CIK and so one document."""
    pair = F.floor(F.col("c_custkey") / 2).cast("string")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("c"), F.lpad(F.col("c_custkey").cast("string"), 8, "0")).alias("ticker"),
        pair.alias("cik"),
        F.to_json(F.struct(F.concat(F.lit("Company "), pair).alias("entityName"))).alias("payload"),
    )


def yields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by customer and day as yield series, in three batches that overlap."""
    percent = F.max((F.col("o_totalprice").cast("decimal(14,2)") % 1000) / 100)
    return (
        table(spark, sf_dir, "orders")
        .groupBy((F.col("o_custkey") % 40).alias("k"), F.col("o_orderdate").cast("date").alias("observation_date"), (F.col("o_orderkey") % 3).cast("int").alias("batch"))
        .agg(percent.cast("decimal(6,4)").alias("yield_percent"))
        .select(F.concat(F.lit("Y"), F.col("k").cast("string")).alias("series_id"), "observation_date", "yield_percent", "batch")
    )
