"""One landing run: landed files into the bronze tables."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.sources.landed import lookback, on_watchlist, read_filings, read_prices
from ledgerline.sources.landing import land_partitions, read_if_there
from ledgerline.sources.merge_on_read import Landing

CIK_GROUPS = 64


def trade_month() -> Column:
    return F.date_format("trade_date", "yyyy-MM")


def cik_group(groups: int) -> Column:
    return F.pmod(F.crc32(F.col("cik").cast("binary")), F.lit(groups)).cast("int")


#: How the bronze tables are landed as deltas: prices and yields by month, documents by a fixed number of CIK groups.
PRICES = Landing("raw_market_prices", S.RAW_MARKET_PRICES, S.PRICE_KEYS, S.PRICE_UPDATES, "trade_month", trade_month)
FILINGS = Landing("raw_sec_filings", S.RAW_FILINGS, S.FILING_KEYS, S.FILING_UPDATES, "cik_group", lambda: cik_group(CIK_GROUPS))
YIELDS = Landing("raw_macro_yields", S.RAW_MACRO_YIELDS, S.YIELD_KEYS, S.YIELD_UPDATES, "observation_month", lambda: F.date_format("observation_date", "yyyy-MM"))


def ingest_prices(
    spark: SparkSession,
    incoming: str,
    table_path: str,
    work_path: str,
    run_id: str,
    fmt: str = "parquet",
    ticker: str | None = None,
    watchlist: DataFrame | None = None,
    run_date=None,
    lookback_days: int | None = None,
) -> int:
    """Upsert landed price files, of watched tickers if a watchlist is given.

    With ``lookback_days``, only the days up to ``run_date`` count. Returns the number of
    price rows; without any, nothing is written. Repeating a run is safe.
    """
    batch = read_prices(spark, incoming, fmt, ticker)
    if lookback_days is not None:
        batch = lookback(batch, run_date, lookback_days)
    if watchlist is not None:
        batch = on_watchlist(batch, watchlist)
    return land_partitions(
        spark,
        table_path,
        S.RAW_MARKET_PRICES,
        batch,
        work_path,
        run_id,
        S.PRICE_KEYS,
        S.PRICE_UPDATES,
        "trade_month",
        trade_month(),
    )


def ingest_filings(
    spark: SparkSession,
    incoming: str,
    table_path: str,
    work_path: str,
    run_id: str,
    watchlist: DataFrame,
    layout: str = "documents",
    groups: int | None = None,
) -> int:
    """Upsert landed filing documents of watched companies; returns their number.

    Shares of one company have one document; it lands once, under the first ticker by name.
    Documents lie in ``groups`` partitions by CIK, chosen for the table's size by its first
    run (default :data:`CIK_GROUPS`) and kept by later ones.
    """
    batch = read_filings(spark, incoming, layout, watchlist)
    if layout == "lines":
        batch = watched_filings(batch, watchlist)
    return land_partitions(
        spark,
        table_path,
        S.RAW_FILINGS,
        batch,
        work_path,
        run_id,
        S.FILING_KEYS,
        S.FILING_UPDATES,
        "cik_group",
        cik_group(_stored_groups(spark, table_path, groups)),
    )


def _stored_groups(spark: SparkSession, table_path: str, groups: int | None) -> int:
    """The table's number of groups, written beside it by its first run; another number is refused."""
    path = f"{table_path.rstrip('/')}_groups"
    stored = read_if_there(spark, path)
    if stored is not None:
        known = stored.first()["groups"]
    elif read_if_there(spark, table_path) is not None:
        known = CIK_GROUPS
    else:
        known = groups or CIK_GROUPS
    if groups is not None and groups != known:
        raise ValueError(f"{table_path} was made with {known} groups, not {groups}")
    if stored is None:
        spark.createDataFrame([(known,)], "groups int").write.mode("overwrite").parquet(path)
    return known


def watched_filings(batch: DataFrame, watchlist: DataFrame) -> DataFrame:
    """One document of every watched company."""
    return _one_per_company(on_watchlist(batch, watchlist))


def _one_per_company(batch: DataFrame) -> DataFrame:
    keys = list(S.FILING_KEYS)
    others = [c for c in batch.columns if c not in keys]
    first = F.min_by(F.struct(*others), F.struct("ticker", "payload")).alias("_first")
    return batch.groupBy(*keys).agg(first).select(*keys, "_first.*").select(*batch.columns)
