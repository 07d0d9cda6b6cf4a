"""The whole build: bronze tables to silver and gold tables, and the rebuild of what changed."""

from __future__ import annotations

import zlib
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.operators.dims import dim_company
from ledgerline.operators.fundamentals import quarterly_financials
from ledgerline.operators.history import scd2
from ledgerline.operators.price_analytics import price_analytics
from ledgerline.operators.quality import expect_not_null, expect_unique
from ledgerline.operators.slicing import measure
from ledgerline.operators.staging import extract_facts, stage_prices
from ledgerline.plans.gold import daily_valuation, leaves_prices_in_place
from ledgerline.plans.ingest import FILINGS, PRICES
from ledgerline.sources.merge_on_read import read_merged
from ledgerline.sources.versions import Table, TableSet

# Every written table with its sort inside the files, which gives row groups narrow min/max
# ranges, so key and date filters skip most of them: keys first, then the order column.
TABLES = {
    "staging/sec_facts": ("ticker", "fiscal_year", "fiscal_period", "gaap_tag", "filed_date"),
    "silver/market_prices": ("ticker", "trade_date"),
    "silver/financial_statements": ("ticker", "fiscal_year", "fiscal_period", "gaap_tag", "valid_from"),
    "gold/dim_company": ("ticker",),
    "gold/fact_quarterly_financials": ("ticker", "period_end_date"),
    "gold/fact_daily_market_valuation": ("ticker", "trade_date"),
}
#: What each ticker's rows in the sources were at the last build, for the rebuild.
PRICE_DIGESTS, FILING_DIGESTS = "sources/raw_market_prices", "sources/raw_sec_filings"
NOT_NULL = {"raw_market_prices": ("ticker", "trade_date"), "raw_sec_filings": ("cik", "form_type")}
UNIQUE = {"raw_market_prices": S.PRICE_KEYS, "raw_sec_filings": S.FILING_KEYS}

GROUP = "ticker_group"
#: Partition folders of every built table; the first build of a set decides.
GROUPS = 16
#: Tickers that are broadcast; more are joined by a shuffle.
BROADCAST_TICKERS = 1_000_000


def ticker_group(ticker: str | Column, groups: int) -> Column:
    return F.pmod(F.crc32((F.col(ticker) if isinstance(ticker, str) else ticker).cast("binary")), F.lit(groups)).cast("int")


def group_of(ticker: str, groups: int) -> str:
    """The same for one ticker, as the name of its partition folder."""
    return str(zlib.crc32(ticker.encode()) % groups)


def read_bronze(spark: SparkSession, bronze: str | TableSet) -> dict[str, DataFrame]:
    """The bronze tables: of a folder of Parquet tables, or of a set whose deltas are merged."""
    if isinstance(bronze, TableSet):
        return {landing.name: read_merged(bronze, landing).drop(landing.partition_by) for landing in (PRICES, FILINGS)}
    return {name: spark.read.parquet(f"{bronze}/{name}") for name in (PRICES.name, FILINGS.name)}


class _Build:
    """One run into a table set: what is written stays unseen until everything is committed together."""

    def __init__(self, spark: SparkSession, bronze: str | TableSet, tables: TableSet, groups: int):
        sources = read_bronze(spark, bronze)
        self.prices, self.filings = sources[PRICES.name], sources[FILINGS.name]
        self.spark, self.tables, self.groups, self.written = spark, tables, groups, {}
        # Stamped once, so that all rows of a run agree.
        self.run_at = F.lit(spark.range(1).select(F.current_timestamp()).first()[0])

    def write(self, name: str, df: DataFrame, bloom=(), spread: bool = True) -> DataFrame:
        grouped = df.withColumn(GROUP, ticker_group("ticker", self.groups))
        table = self.tables.write(name, grouped, GROUP, bloom, TABLES.get(name, ("ticker",)), spread)
        self.written[name] = replace(table, info={"groups": str(self.groups)})
        return self.tables.read_written(table).drop(GROUP)

    def price_branch(self, prices: DataFrame) -> tuple[DataFrame, bool]:
        """The analysed prices, and whether they still have to be spread over the groups.

        Tickers are dealt in the order of their groups, so one shuffle serves the windows and the folders. If some
        are so large that they are sliced, slices are dealt anyhow and the rows are spread after that.
        """
        staged = stage_prices(prices)
        slicing = measure(staged, ["ticker"], ["trade_date"], rows_at_most=prices.count())
        if slicing is None:
            dealt = staged.withColumn(GROUP, ticker_group("ticker", self.groups)).repartitionByRange(GROUP, "ticker")
            analysed = price_analytics(dealt, [GROUP, "ticker"], slicing=None).drop(GROUP)
        else:
            analysed = price_analytics(staged, slicing=slicing)
        if "ingested_at" in analysed.columns:
            analysed = analysed.withColumnRenamed("ingested_at", "updated_at")
        return analysed, slicing is not None

    def statement_branch(self, facts: DataFrame) -> DataFrame:
        return scd2(facts, rows_at_most=facts.count()).withColumn("updated_at", self.run_at)

    def quarterly_branch(self, statements: DataFrame) -> DataFrame:
        return quarterly_financials(statements.where("is_current")).withColumn("computed_at", self.run_at)

    def company_branch(self, silver_prices: DataFrame, filings: DataFrame) -> DataFrame:
        return dim_company(silver_prices, filings).withColumn("created_at", self.run_at)

    def daily_branch(self, silver_prices: DataFrame, quarterly: DataFrame, strategy: str) -> tuple[DataFrame, bool]:
        """The daily fact, and whether it has to be spread: prices that are read by group and not moved lie right already."""
        rows = silver_prices.count() + quarterly.count()
        daily = daily_valuation(silver_prices, quarterly, strategy=strategy, rows_at_most=rows)
        return daily.withColumn("calculated_at", self.run_at), not leaves_prices_in_place(quarterly, strategy)


def build(spark: SparkSession, bronze: str | TableSet, out_dir: str, strategy: str = "range", groups: int | None = None) -> TableSet:
    """Build every table in lineage order and commit them together; returns the committed set.

    Price staging stays lazy and is inlined into its consumers; the extracted facts are written, so the nested
    documents are parsed once. Silver and gold are written, and later steps read the written tables: nothing is
    computed twice, a lost executor costs at most one step, and no long lineage builds up. Prices and facts are
    independent until the daily fact and are built at the same time. The bronze checks run first and the company
    keys are checked once written: a violation fails the build. Readers of ``out_dir`` see the set of the last
    build that was committed, whatever becomes of this one.

    Tables lie in ``groups`` partition folders by ticker (default: as in the set, else :data:`GROUPS`).
    """
    _check(spark, bronze)
    tables = TableSet(spark, out_dir)
    run = _Build(spark, bronze, tables, groups or _groups(tables))

    def price_side() -> DataFrame:
        run.write(PRICE_DIGESTS, _price_digests(run.prices))
        analysed, spread = run.price_branch(run.prices)
        return run.write("silver/market_prices", analysed, spread=spread)

    def fact_side() -> DataFrame:
        run.write(FILING_DIGESTS, _filing_digests(run.filings))
        facts = run.write("staging/sec_facts", extract_facts(run.filings))
        statements = run.write("silver/financial_statements", run.statement_branch(facts))
        return run.write("gold/fact_quarterly_financials", run.quarterly_branch(statements), ["company_sk"])

    def daily_side() -> DataFrame:
        daily, spread = run.daily_branch(silver_prices, quarterly, strategy)
        return run.write("gold/fact_daily_market_valuation", daily, ["company_sk"], spread)

    silver_prices, quarterly = _together(price_side, fact_side)
    companies, _ = _together(
        lambda: run.write("gold/dim_company", run.company_branch(silver_prices, run.filings), ["company_sk"]),
        daily_side,
    )
    _check_companies(companies)
    return tables.commit(run.written.values())


def rebuild(spark: SparkSession, bronze: str | TableSet, out_dir: str, strategy: str = "range") -> TableSet:
    """The tables of :func:`build`, computing only tickers whose source rows changed since the last commit.

    Row hashes of every ticker are compared with those of the last build. Tickers with other prices are followed
    into the price tables, those with other documents into the fact tables, both into the dimension and the
    daily fact. Their rows are computed anew and put in place of the old ones; folders of groups without such a
    ticker stay as they are. Everything is committed together.
    """
    tables = TableSet(spark, out_dir)
    if PRICE_DIGESTS not in tables:
        return build(spark, bronze, out_dir, strategy)
    _check(spark, bronze)
    run = _Build(spark, bronze, tables, _groups(tables))
    prices = _Changed(run, _price_digests(run.prices), PRICE_DIGESTS)
    filings = _Changed(run, _filing_digests(run.filings), FILING_DIGESTS)
    if not prices.groups and not filings.groups:
        return tables
    either = prices.with_other(filings)
    replaced: dict[str, Table] = {}

    def splice(name: str, changed: _Changed, fresh: DataFrame, bloom=(), spread: bool = True) -> None:
        """Write the touched groups of a table: the new rows, and the old ones of all other tickers."""
        if not changed.groups:
            return
        kept = changed.without(tables.read(name, changed.groups).drop(GROUP))
        run.write(name, kept.unionByName(fresh), bloom, spread or not changed.sent)
        replaced[name] = tables.replace_parts(name, run.written[name], changed.groups)

    def now(name: str, changed: _Changed) -> DataFrame:
        """A table's rows of changed tickers, as they are after this run."""
        table = replaced.get(name) or tables.tables[name]
        return changed.only(tables.read_written(table, changed.groups).drop(GROUP))

    splice(PRICE_DIGESTS, prices, prices.only(_price_digests(run.prices)))
    splice(FILING_DIGESTS, filings, filings.only(_filing_digests(run.filings)))
    analysed, spread = run.price_branch(prices.only(run.prices, F.upper(F.trim("ticker"))))
    splice("silver/market_prices", prices, analysed, spread=spread)
    splice("staging/sec_facts", filings, extract_facts(filings.only(run.filings)))
    splice("silver/financial_statements", filings, run.statement_branch(now("staging/sec_facts", filings)))
    splice("gold/fact_quarterly_financials", filings, run.quarterly_branch(now("silver/financial_statements", filings)), ["company_sk"])
    silver_prices = now("silver/market_prices", either)
    splice("gold/dim_company", either, run.company_branch(silver_prices, either.only(run.filings)), ["company_sk"])
    daily, spread = run.daily_branch(silver_prices, now("gold/fact_quarterly_financials", either), strategy)
    splice("gold/fact_daily_market_valuation", either, daily, ["company_sk"], spread)
    _check_companies(now("gold/dim_company", either))
    return tables.commit(replaced.values())


class _Changed:
    """Tickers whose rows differ from those of the last build, and the groups they lie in."""

    def __init__(self, run: _Build, digests: DataFrame | None, name: str = "", tickers: DataFrame | None = None):
        self.run = run
        if tickers is None:
            old, new = run.tables.read(name).drop(GROUP).alias("o"), digests.alias("n")
            same = F.col("o.n_rows").eqNullSafe(F.col("n.n_rows")) & F.col("o.hash").eqNullSafe(F.col("n.hash"))
            joined = old.join(new, F.col("o.ticker").eqNullSafe(F.col("n.ticker")), "full").where(~same)
            found = joined.select(F.coalesce("n.ticker", "o.ticker").alias("ticker"))
            table = run.tables.write(f"changed/{name}", found)
            tickers = run.tables.read_written(table)
        self.tickers = tickers
        #: Whether the tickers are broadcast, so that rows compared with them stay where they are.
        self.sent = tickers.count() <= BROADCAST_TICKERS
        groups = tickers.select(ticker_group("ticker", run.groups).cast("string").alias("g")).distinct().collect()  # no more than there are groups
        self.groups = sorted("__HIVE_DEFAULT_PARTITION__" if r.g is None else r.g for r in groups)

    def with_other(self, other: _Changed) -> _Changed:
        return _Changed(self.run, None, tickers=self.tickers.unionByName(other.tickers).distinct())

    def _joined(self, df: DataFrame, how: str, ticker: Column | None = None) -> DataFrame:
        sent = self.tickers.select(F.col("ticker").alias("_changed"))
        sent = F.broadcast(sent) if self.sent else sent
        return df.join(sent, (df["ticker"] if ticker is None else ticker).eqNullSafe(F.col("_changed")), how)

    def only(self, df: DataFrame, ticker: Column | None = None) -> DataFrame:
        return self._joined(df, "left_semi", ticker)

    def without(self, df: DataFrame) -> DataFrame:
        return self._joined(df, "left_anti")


def _digests(df: DataFrame) -> DataFrame:
    """``ticker, n_rows, hash``: rows in any order have the same hash. The hashes' sum, as wide as it gets."""
    others = [c for c in df.columns if c != "ticker"]
    return df.groupBy("ticker").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.xxhash64(*others).cast("decimal(38,0)")).alias("hash"))


def _price_digests(prices: DataFrame) -> DataFrame:
    return _digests(stage_prices(prices))


def _filing_digests(filings: DataFrame) -> DataFrame:
    return _digests(filings)


def _groups(tables: TableSet) -> int:
    built = tables.tables.get("gold/dim_company")
    return int(built.info["groups"]) if built is not None else GROUPS


def _together(*steps):
    """Independent steps, each from a thread of its own; the first failure is raised."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [f.result() for f in [pool.submit(step) for step in steps]]


def _check(spark: SparkSession, bronze: str | TableSet) -> None:
    broken = check_sources(spark, bronze).where("should_error").collect()  # a row per checked column or key
    if broken:
        raise ValueError("bronze checks failed: " + "; ".join(f"{r.table_name}.{r.column_name}: {r.failures}" for r in broken))


def _check_companies(companies: DataFrame) -> None:
    twice = expect_unique(companies, ("company_sk",)).first()
    if twice is not None:
        raise ValueError(f"gold/dim_company has company_sk {twice.company_sk} {twice.n_rows} times")


def register_views(tables: TableSet) -> list[str]:
    """Make built tables available to SQL, e.g. ``gold_dim_company``; returns the names."""
    names = []
    for name in tables.names:
        names.append(name.replace("/", "_"))
        tables.read(name).drop(GROUP).createOrReplaceTempView(names[-1])
    return names


def check_sources(spark: SparkSession, bronze: str | TableSet) -> DataFrame:
    """The not-null and unique checks of the bronze tables, one row per checked column or key."""
    sources = read_bronze(spark, bronze)
    results = [expect_not_null(sources[table], cols).select(F.lit(table).alias("table_name"), "*") for table, cols in NOT_NULL.items()]
    for table, keys in UNIQUE.items():
        whole = sources[table].dropna(subset=list(keys))
        failures = expect_unique(whole, keys).agg(F.count(F.lit(1)).alias("failures"))
        broken = F.col("failures") > 0
        results.append(failures.select(F.lit(table).alias("table_name"), F.lit(",".join(keys)).alias("column_name"), "failures", broken.alias("should_warn"), broken.alias("should_error")))
    combined = results[0]
    for more in results[1:]:
        combined = combined.unionByName(more)
    return combined


def built(tables: TableSet, name: str, ticker: str | None = None) -> DataFrame:
    """A built table; with ``ticker`` only the folder of its group is read, and of its files what its key selects."""
    if ticker is None:
        return tables.read(name).drop(GROUP)
    symbol = ticker.upper()
    return tables.read(name, [group_of(symbol, _groups(tables))]).drop(GROUP).where(F.col("ticker") == symbol)
