"""The registered queries: one per operator, each over its whole tables."""

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.functions.columns import json_fields
from ledgerline.operators.asof import asof_join
from ledgerline.operators.dims import dim_company
from ledgerline.operators.fundamentals import pivot_facts, quarterly_financials, ttm_rollup
from ledgerline.operators.history import current_versions, latest_per_key, scd2
from ledgerline.operators.price_analytics import price_analytics
from ledgerline.operators.quality import expect_not_null, expect_unique
from ledgerline.operators.slicing import measure
from ledgerline.operators.staging import extract_facts, extract_parsed_facts, parse_filings, stage_prices
from ledgerline.operators.upsert import upsert
from ledgerline.operators.valuation import dcf, dcf_projections, dcf_scenarios
from ledgerline.plans.build import TABLES, build, built, rebuild
from ledgerline.plans.gold import daily_valuation
from ledgerline.plans.history import STATEMENTS, apply_facts
from ledgerline.plans.ingest import FILINGS, PRICES, YIELDS, ingest_filings, ingest_prices
from ledgerline.plans.reports import built_history, built_page, company_page, company_sk, statement_history, statement_positions, watchlist_report
from ledgerline.session import shared_dir
from ledgerline.sources.landed import last_sessions, lookback, shape_filings, shape_prices
from ledgerline.sources.merge_on_read import compact, land_delta, read_merged
from ledgerline.sources.versions import CODEC, TableSet
from ledgerline.streaming.analytics import stream_price_analytics
from workload import shapes as W


def _staged(spark, d):
    return stage_prices(W.px_raw(spark, d))


def _price_slicing(spark, d):
    """From the base table, which is cheaper than from the prices derived from it."""
    return measure(W.price_keys(spark, d), ["ticker"], ["trade_date"], rows_at_most=W.row_bound(spark, d, "lineitem"))


def _asof_slicing(spark, d):
    """From the base tables of both sides."""
    facts = W.facts_raw(spark, d).select("ticker", F.col("filed_date").alias("trade_date"))
    both = W.price_keys(spark, d).unionByName(facts)
    return measure(both, ["ticker"], ["trade_date"], rows_at_most=W.row_bound(spark, d, "lineitem", "orders"))


def _silver(spark, d):
    return price_analytics(_staged(spark, d), slicing=_price_slicing(spark, d))


def _versions(spark, d):
    return scd2(W.facts_raw(spark, d), rows_at_most=W.row_bound(spark, d, "orders"))


def _quarterly(spark, d):
    return quarterly_financials(current_versions(W.facts_raw(spark, d)))


def _dim(spark, d):
    return dim_company(_staged(spark, d), W.entity_filings(spark, d))


def _daily(spark, d):
    return daily_valuation(_silver(spark, d), _quarterly(spark, d), slicing=_asof_slicing(spark, d))


def _asof(strategy):
    def query(spark, d):
        prices = _staged(spark, d).select("ticker", "trade_date", "close_price")
        statements = _quarterly(spark, d).select(
            "ticker", "filing_date", "period_end_date", "fiscal_year", "fiscal_period", "free_cash_flow"
        )
        return asof_join(
            prices,
            statements,
            "ticker",
            "trade_date",
            "filing_date",
            tiebreak=("period_end_date", "fiscal_year", "fiscal_period"),
            strategy=strategy,
            slicing=_asof_slicing(spark, d) if strategy == "window" else None,  # the other forms need none
        )

    return query


def _upsert(landed, keys, update_cols):
    def query(spark, d):
        target, batch = landed(spark, d)
        touched = F.lit("2024-02-02").cast("timestamp")
        after = upsert(target, batch, keys, update_cols, touched_at=touched)
        return after.withColumn("ingested_on", F.col("ingested_at").cast("date")).drop("ingested_at")

    return query


def _exact_sum(column: str, digits: int):
    """Sum of doubles of so many digits as ``sum(column :: decimal(28, digits))``.

    Those of usual size are added as whole units, which need no decimal a row; a group of up to 900,000 rows cannot overflow.
    """
    units = F.col(column) * F.lit(float(10**digits))
    usual = F.abs(units) < F.lit(1e13)
    of_units = F.sum(F.when(usual, F.rint(units).cast("bigint"))).cast("decimal(19,0)").cast(f"decimal(38,{digits})")
    of_rest = F.sum(F.when(~usual, F.col(column).cast(f"decimal(28,{digits})")))
    whole = (of_units * F.lit(10**-digits).cast(f"decimal({digits},{digits})")).cast(f"decimal(38,{digits})")
    return F.when(whole.isNull() | of_rest.isNull(), F.coalesce(whole, of_rest)).otherwise((whole + of_rest).cast(f"decimal(38,{digits})"))


def _scenarios(spark, d):
    """Every triple of the default ranges for every company, then totals of the rounded results."""
    swept = dcf_scenarios(W.scenario_companies(spark, d))
    return swept.groupBy("company", "rating").agg(
        F.count(F.lit(1)).alias("scenarios"),
        _exact_sum("fair_value", 2).alias("fair_value_sum"),
        F.min("fair_value").alias("fair_value_min"),
        F.max("fair_value").alias("fair_value_max"),
        _exact_sum("margin_of_safety", 1).alias("margin_sum"),
    )


def _bronze(spark: SparkSession, d: str) -> str:
    folder = shared_dir(spark, "bronze")
    W.px_raw(spark, d).write.option("compression", CODEC).parquet(f"{folder}/raw_market_prices")
    W.filings_raw(spark, d).write.option("compression", CODEC).parquet(f"{folder}/raw_sec_filings")
    return folder


def _built(spark: SparkSession, d: str) -> TableSet:
    """The tables of a whole build. Every query makes its own, so that what it costs does not depend on which ran before."""
    return build(spark, _bronze(spark, d), shared_dir(spark, "warehouse"))


def _gold(name, *audit):
    return lambda spark, d: built(_built(spark, d), f"gold/{name}").drop(*audit)


def _build_watchlist(spark, d):
    tables = _built(spark, d)
    return watchlist_report(built(tables, "gold/dim_company"), built(tables, "gold/fact_daily_market_valuation"))


def _build_gold(spark: SparkSession, d: str) -> DataFrame:
    tables = _built(spark, d)
    counts = [built(tables, name).select(F.lit(name).alias("table_name")).groupBy("table_name").agg(F.count(F.lit(1)).alias("n_rows")) for name in TABLES]
    return reduce(DataFrame.unionByName, counts)


def _rebuilt_daily(spark: SparkSession, d: str) -> DataFrame:
    """A build over bronze tables that lack some tickers and have other prices and amounts of some, then a rebuild over the right ones."""
    early, out = shared_dir(spark, "bronze"), shared_dir(spark, "warehouse")
    prices = W.px_raw(spark, d).where(~F.trim("ticker").endswith("7")).withColumn("adj_close", F.when(F.trim("ticker").like("%3"), F.col("adj_close") * 2).otherwise(F.col("adj_close")).cast(S.PRICE))
    prices.write.option("compression", CODEC).parquet(f"{early}/raw_market_prices")
    W.filings_raw(spark, d).withColumn("payload", F.when(F.col("ticker").endswith("1"), F.lit("{}")).otherwise(F.col("payload"))).write.option("compression", CODEC).parquet(f"{early}/raw_sec_filings")
    build(spark, early, out)
    return built(rebuild(spark, _bronze(spark, d), out), "gold/fact_daily_market_valuation").drop("calculated_at")


def _landed_deltas(landing, batches, compacted=0):
    """Batches landed as deltas, with one compaction after the given number of them, and merged when read."""

    def query(spark: SparkSession, d: str) -> DataFrame:
        tables = TableSet(spark, shared_dir(spark, "landed"))
        for n, (batch, stamp) in enumerate(batches(spark, d), 1):
            tables, _ = land_delta(tables, landing, batch, str(n), F.lit(stamp).cast("timestamp"))
            if n == compacted:
                tables = compact(tables, landing)
        merged = read_merged(tables, landing).drop(landing.partition_by)
        return merged.withColumn("ingested_on", F.col("ingested_at").cast("date")).drop("ingested_at")

    return query


def _price_batches(spark, d):
    target, batch = W.landed_prices(spark, d)
    return [(target.drop("ingested_at"), "2024-01-01"), (batch, "2024-02-02")]


def _filing_batches(spark, d):
    target, batch = W.landed_filings(spark, d)
    return [(target.drop("ingested_at"), "2024-01-01"), (batch, "2024-02-02")]


def _vendor_batches(spark, d):
    rows = W.vendor_batches(spark, d)
    return [(shape_prices(rows.where(F.col("batch") == n).drop("batch")), f"2024-01-0{n + 1}") for n in range(3)]


def _yield_batches(spark, d):
    rows = W.yields(spark, d)
    return [(rows.where(F.col("batch") == n).drop("batch"), f"2024-01-0{n + 1}") for n in range(3)]


def _landed_counts(spark: SparkSession, d: str) -> DataFrame:
    """The row counts that landing returns, batch by batch, for files and for deltas."""
    landed, table, work = shared_dir(spark, "landed"), shared_dir(spark, "prices"), shared_dir(spark, "work")
    tables, rows = TableSet(spark, shared_dir(spark, "deltas")), W.vendor_batches(spark, d)
    counts = []
    for n, (batch, _) in enumerate(_vendor_batches(spark, d)):
        rows.where(F.col("batch") == n).drop("batch").write.json(f"{landed}/{n}")
        tables, as_delta = land_delta(tables, PRICES, batch)
        counts.append((n, ingest_prices(spark, f"{landed}/{n}", table, work, str(n), "json"), as_delta))
    return spark.createDataFrame(counts, "batch int, by_files long, by_deltas long")


def _spliced_versions(spark: SparkSession, d: str) -> DataFrame:
    """All facts in four batches that overlap in time, each spliced into the versions of those before."""
    facts, tables = W.facts_raw(spark, d), TableSet(spark, shared_dir(spark, "history"))
    for n in (2, 0, 3, 1):
        tables = apply_facts(tables, facts.where(F.pmod(F.crc32(F.col("accession_number").cast("binary")), F.lit(4)) == n))
    return built(tables, STATEMENTS)


def _streamed_prices(spark: SparkSession, d: str) -> DataFrame:
    """The price history landed in four batches by day, through a stream that takes each batch and is stopped after it.

    The staged prices are written once and dealt out of that; a batch is as many files as its tasks write.
    """
    folder = shared_dir(spark, "stream")
    _staged(spark, d).write.parquet(f"{folder}/staged")
    staged = spark.read.parquet(f"{folder}/staged")
    days = staged.select(F.percentile_approx(F.unix_date("trade_date"), [0.25, 0.5, 0.75])).first()[0] or []
    cuts = [dt.date(1970, 1, 1) + dt.timedelta(days=n) for n in days]
    for first, last in zip([None, *cuts], [*cuts, None]):
        inside = (F.lit(True) if first is None else F.col("trade_date") > first) & (F.lit(True) if last is None else F.col("trade_date") <= last)
        staged.where(inside).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(staged.schema).parquet(f"{folder}/in")
        out = stream_price_analytics(stream).writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint")
        out.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def _parsed_facts(spark: SparkSession, d: str) -> DataFrame:
    """Documents parsed into a written table, and the facts of all tags out of it."""
    folder = shared_dir(spark, "documents")
    parse_filings(W.filings_raw(spark, d)).write.parquet(folder)
    return extract_parsed_facts(spark.read.parquet(folder), tags=None)


def _statement_positions(spark, d):
    """The rows of :func:`statement_history` with their places in both orders."""
    quarterly, dim = _quarterly(spark, d), _dim(spark, d)
    return statement_positions(dim, quarterly)


def _ingest_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Three landed batches of price files: CSV, JSON lines, and CSV again under the run id of the second."""
    landed, table, work = shared_dir(spark, "landed"), shared_dir(spark, "prices"), shared_dir(spark, "work")
    rows = W.vendor_batches(spark, d)
    for batch, fmt, run in ((0, "csv", "a"), (1, "json", "b"), (2, "csv", "b")):
        writer = rows.where(F.col("batch") == batch).drop("batch").write
        (writer.option("header", True).csv if fmt == "csv" else writer.json)(f"{landed}/{batch}")
        ingest_prices(spark, f"{landed}/{batch}", table, work, run, fmt)
    return spark.read.parquet(table).drop("ingested_at", "trade_month")


def _ingest_filings(spark: SparkSession, d: str) -> DataFrame:
    """One document per customer, every two tickers of which share a CIK."""
    landed, table, work = shared_dir(spark, "landed"), shared_dir(spark, "filings"), shared_dir(spark, "work")
    shares = W.shared_filings(spark, d)
    shares.write.json(landed)
    ingest_filings(spark, landed, table, work, "a", shares.select("ticker", "cik"), layout="lines")
    return spark.read.parquet(table).drop("ingested_at", "cik_group")


QUERIES = {
    "read_prices": lambda s, d: shape_prices(W.vendor_prices(s, d)),
    "read_filings": lambda s, d: shape_filings(W.customer_filings(s, d)),
    "stage_prices": _staged,
    "price_analytics": _silver,
    "last_sessions": lambda s, d: last_sessions(_staged(s, d), 5),
    "latest_per_key": lambda s, d: latest_per_key(_staged(s, d), "ticker", ["trade_date"]),
    "lookback": lambda s, d: lookback(_staged(s, d), "1998-12-01", 365),
    "extract_facts": lambda s, d: extract_facts(W.filings_raw(s, d)),
    "extract_parsed_facts": _parsed_facts,
    "json_scalar": lambda s, d: W.table(s, d, "events").select("event_id", json_fields("props", k="int")["k"].alias("k")),
    "scd2": _versions,
    "current_versions": lambda s, d: current_versions(W.facts_raw(s, d)),
    "pivot_facts": lambda s, d: pivot_facts(current_versions(W.facts_raw(s, d))),
    "financial_ratios": _quarterly,
    "dim_company": _dim,
    "asof_union": _asof("window"),
    "asof_range": _asof("range"),
    "daily_valuation": _daily,
    "watchlist_report": lambda s, d: watchlist_report(_dim(s, d), _daily(s, d)),
    "watchlist_labels": lambda s, d: watchlist_report(_dim(s, d), _daily(s, d), labels=True).select(
        "ticker", "close_label", "sma_20_label", "sma_50_label", "free_cash_flow_label"
    ),
    "statement_history": lambda s, d: statement_history(_dim(s, d), _quarterly(s, d)),
    "statement_chart": lambda s, d: statement_history(_dim(s, d), _quarterly(s, d), chart=True).select(
        "ticker", "period", "period_end_date", "revenue_billions", "net_income_billions", "free_cash_flow_billions"
    ),
    "ttm_rollup": lambda s, d: ttm_rollup(_quarterly(s, d)),
    "ttm_rollup_oldest": lambda s, d: ttm_rollup(_quarterly(s, d), order="reference"),
    "company_page": lambda s, d: company_page(_dim(s, d), _daily(s, d), _quarterly(s, d)).drop("projections"),
    "dcf": lambda s, d: dcf(W.dcf_inputs(s, d)).drop("projections"),
    "dcf_projections": lambda s, d: dcf_projections(dcf(W.dcf_inputs(s, d)), "id"),
    "dcf_scenarios": _scenarios,
    "upsert_prices": _upsert(W.landed_prices, S.PRICE_KEYS, S.PRICE_UPDATES),
    "upsert_filings": _upsert(W.landed_filings, S.FILING_KEYS, S.FILING_UPDATES),
    "expect_not_null": lambda s, d: expect_not_null(
        W.px_raw(s, d), ("ticker", "trade_date", "dividend_amount", "split_coefficient")
    ),
    "expect_unique": lambda s, d: expect_unique(W.table(s, d, "lineitem"), ("l_orderkey", "l_linenumber")),
    "expect_unique_two_pass": lambda s, d: expect_unique(W.table(s, d, "lineitem"), ("l_orderkey", "l_linenumber"), two_pass=True),
    "price_stream": _streamed_prices,
    "build_gold": _build_gold,
    "build_daily": _gold("fact_daily_market_valuation", "calculated_at"),
    "build_quarterly": _gold("fact_quarterly_financials", "computed_at"),
    "build_dim": _gold("dim_company", "created_at"),
    "rebuild_daily": _rebuilt_daily,
    "company_lookup_built": lambda s, d: built_page(_built(s, d), "s1").drop("projections"),
    "statement_lookup_built": lambda s, d: built_history(_built(s, d), "s1"),
    "upsert_prices_merged": _landed_deltas(PRICES, _price_batches, compacted=1),
    "upsert_filings_merged": _landed_deltas(FILINGS, _filing_batches),
    "ingest_deltas": _landed_deltas(PRICES, _vendor_batches, compacted=2),
    "upsert_yields": _landed_deltas(YIELDS, _yield_batches),
    "landed_counts": _landed_counts,
    "scd2_spliced": _spliced_versions,
    "asof_packed": _asof("packed"),
    "statement_positions": _statement_positions,
    "build_watchlist": _build_watchlist,
    "company_lookup": lambda s, d: company_page(_dim(s, d), _daily(s, d), _quarterly(s, d), ticker="S1", key=company_sk("S1")).drop("projections"),
    "company_projections": lambda s, d: dcf_projections(company_page(_dim(s, d), _daily(s, d), _quarterly(s, d)), "ticker"),
    "statement_lookup": lambda s, d: statement_history(_dim(s, d), _quarterly(s, d), ticker="s1", key=company_sk("s1")),
    "statement_lookup_newest": lambda s, d: statement_history(_dim(s, d), _quarterly(s, d), ticker="s1", order="reference", key=company_sk("s1")),
    "ingest_round_trip": _ingest_round_trip,
    "ingest_filings": _ingest_filings,
}
