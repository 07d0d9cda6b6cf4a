"""Landed price files and filing documents in the shape of the bronze tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.columns import zfill
from ledgerline.operators.history import latest_per_key
from ledgerline.schemas import PRICE

# Column names of the price vendor's history files.
VENDOR_COLUMNS = {
    "Open": "open_price",
    "High": "high_price",
    "Low": "low_price",
    "Close": "close_price",
    "Adj Close": "adj_close",
}
VENDOR_OPTIONAL = {"Dividends": ("dividend_amount", 0), "Stock Splits": ("split_coefficient", 1)}
VENDOR_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("Ticker", "Date", *VENDOR_COLUMNS, "Volume", *VENDOR_OPTIONAL)]
)


def read_prices(spark: SparkSession, path: str, fmt: str = "parquet", ticker: str | None = None) -> DataFrame:
    """Read landed vendor history files (``parquet``, ``csv`` with header, or ``json`` lines).

    ``ticker`` names the asset when the files have no ``Ticker`` column. Parquet files may
    differ in their optional columns; CSV files with differing headers are refused.
    """
    if fmt == "parquet":
        return shape_prices(spark.read.option("mergeSchema", True).parquet(path), ticker)
    if fmt == "csv":
        return shape_prices(spark.read.option("header", True).option("enforceSchema", False).csv(path), ticker)
    if fmt == "json":
        # Lines say which columns there are by their keys; a reported null is not an absent column.
        lines = spark.read.text(path).where(F.trim("value") != "")
        keys = F.json_object_keys("value")
        row = F.from_json("value", VENDOR_SCHEMA, {"mode": "FAILFAST"})
        raw = lines.select(row.alias("row"), keys.alias("keys")).select("row.*", "keys")
        for name, (_, default) in VENDOR_OPTIONAL.items():
            raw = raw.withColumn(name, F.when(F.array_contains("keys", name), F.col(f"`{name}`")).otherwise(F.lit(str(default))))
        return shape_prices(raw.drop("keys"), ticker)
    raise ValueError(f"unknown format {fmt!r}")


def shape_prices(raw: DataFrame, ticker: str | None = None) -> DataFrame:
    """Vendor columns to bronze columns.

    A time-zoned trading time gives its local date. Dividend and split default to 0 and 1
    only when the column is absent (from the table, or from a JSON line); a reported 0
    split is data, and a reported null stays null.
    """
    symbol = F.lit(ticker) if ticker is not None else F.col("Ticker")
    if isinstance(raw.schema["Date"].dataType, T.StringType):
        day = F.substring(F.trim("Date"), 1, 10).cast("date")
    else:
        day = F.col("Date").cast("date")

    def number(name):
        value = F.col(f"`{name}`").cast("double")
        return F.when(~F.isnan(value), value)

    optional = [
        (number(name) if name in raw.columns else F.lit(default)).cast("decimal(10,4)").alias(column)
        for name, (column, default) in VENDOR_OPTIONAL.items()
    ]
    return raw.select(
        F.upper(symbol).alias("ticker"),
        day.alias("trade_date"),
        *[number(name).cast(PRICE).alias(column) for name, column in VENDOR_COLUMNS.items()],
        number("Volume").cast("bigint").alias("volume"),
        *optional,
    )


def read_filings(spark: SparkSession, path: str, layout: str = "lines", watchlist: DataFrame | None = None) -> DataFrame:
    """Read landed filing documents.

    ``layout="lines"``: JSON lines with ``ticker``, ``cik`` and ``payload`` (an object or its
    text). ``layout="documents"``: one document per file, named after its CIK; the ticker
    comes from ``watchlist``, and files of other companies are left out.
    """
    if layout == "lines":
        return shape_filings(spark.read.schema("ticker string, cik string, payload string").json(path))
    if layout != "documents":
        raise ValueError(f"unknown layout {layout!r}")
    if watchlist is None:
        raise ValueError("layout='documents' needs a watchlist")
    files = spark.read.text(path, wholetext=True).select(
        zfill(F.regexp_extract("_metadata.file_name", r"(\d+)", 1)).alias("cik"), F.col("value").alias("payload")
    )
    return shape_filings(files.join(first_tickers(watchlist), "cik"))


def shape_filings(raw: DataFrame) -> DataFrame:
    """Whole-company snapshots: one row per company under a constant form and period."""
    return raw.select(
        zfill("cik").alias("cik"),
        F.upper("ticker").alias("ticker"),
        F.lit("FACTS").alias("form_type"),
        F.lit(0).alias("fiscal_year"),
        F.lit("ALL").alias("fiscal_period"),
        "payload",
    )


def first_tickers(watchlist: DataFrame) -> DataFrame:
    """One ``ticker`` for each ``cik``: companies with several listed shares land under the first by name."""
    return filers(watchlist).groupBy(zfill("cik").alias("cik")).agg(F.min(F.upper("ticker")).alias("ticker"))


def filers(watchlist: DataFrame) -> DataFrame:
    """Watchlist entries that file with the regulator."""
    return watchlist.where(F.col("cik").isNotNull() & (F.col("cik") != ""))


def on_watchlist(landed: DataFrame, watchlist: DataFrame) -> DataFrame:
    """Landed rows of watched tickers."""
    return landed.join(watchlist.select(F.upper("ticker").alias("ticker")), "ticker", "left_semi")


def lookback(prices: DataFrame, run_date, days: int) -> DataFrame:
    """Rows of the ``days`` calendar days up to ``run_date``; prunes files and row groups."""
    run = F.to_date(F.lit(run_date))
    return prices.where((F.col("trade_date") > F.date_sub(run, days)) & (F.col("trade_date") <= run))


def last_sessions(prices: DataFrame, n: int) -> DataFrame:
    """The last ``n`` trading days of every ticker."""
    return latest_per_key(prices, "ticker", ["trade_date"], n)
