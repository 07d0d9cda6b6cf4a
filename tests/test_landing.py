"""Reading landed files, upserts, streaming and the whole build."""

import datetime as dt
import json
from decimal import Decimal as D

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.operators.upsert import upsert
from ledgerline.plans.build import build, check_sources, register_views
from ledgerline.plans.ingest import ingest_filings, ingest_prices
from ledgerline.session import shared_dir
from ledgerline.sources.landed import filers, last_sessions, lookback, on_watchlist, read_filings, read_prices
from ledgerline.sources.landing import land, land_partitions
from ledgerline.streaming.landing import land_price_stream

OLD, NEW = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 2)
DAY = dt.date(2024, 1, 5)


def price(day=DAY, close="1", adj="1", ticker="T", open_="1", stamp=OLD):
    number = lambda x: None if x is None else D(x)
    return (ticker, day, number(open_), D(1), D(1), D(close), D(adj), 10, D(0), D(1), stamp)


def prices(spark, *rows):
    return spark.createDataFrame(list(rows), S.RAW_MARKET_PRICES)


def apply(target, batch, **options):
    return upsert(target, batch, S.PRICE_KEYS, S.PRICE_UPDATES, touched_at=F.lit(NEW), **options)


def test_frozen_and_updated_columns(spark):
    target = prices(spark, price(open_=None), price(dt.date(2024, 1, 4)))
    batch = prices(spark, price(close="9", adj="8", open_="7"), price(dt.date(2024, 1, 8), "3")).drop("ingested_at")
    rows = {r["trade_date"]: r for r in apply(target, batch).collect()}
    assert len(rows) == 3
    again = rows[DAY]
    assert (again["close_price"], again["adj_close"], again["open_price"], again["ingested_at"]) == (D("1.0000"), D("8.0000"), None, NEW)
    assert rows[dt.date(2024, 1, 4)]["ingested_at"] == OLD
    assert rows[dt.date(2024, 1, 8)]["ingested_at"] == NEW


def test_idempotent(spark):
    target, batch = prices(spark, price()), prices(spark, price(adj="2"), price(dt.date(2024, 1, 9)))
    once = apply(target, batch)
    assert sorted(apply(once, batch).collect()) == sorted(once.collect())


def test_duplicate_batch_key(spark):
    target = prices(spark, price())
    batch = prices(spark, price(adj="2"), price(adj="3", stamp=NEW))
    with pytest.raises(PySparkException, match="duplicate key in batch: T, 2024-01-05"):
        apply(target, batch).collect()
    (row,) = apply(target, batch, latest_by=["ingested_at"]).collect()
    assert row["adj_close"] == D("3.0000")


def test_duplicate_found_when_columns_are_pruned(spark):
    batch = prices(spark, price(adj="2"), price(adj="3"))
    with pytest.raises(PySparkException, match="duplicate key"):
        apply(prices(spark), batch).select("adj_close").collect()


def test_duplicate_found_whatever_is_selected(spark):
    after = apply(prices(spark), prices(spark, price(adj="2"), price(adj="3")))
    for pruned in (after.select("ticker"), after.groupBy().count()):
        with pytest.raises(PySparkException, match="duplicate key"):
            pruned.collect()


def test_null_key_parts_never_conflict(spark):
    row = ("1", "T", "FACTS", None, "ALL", "{}", OLD)
    table = spark.createDataFrame([row], S.RAW_FILINGS)
    twice = upsert(table, spark.createDataFrame([row, row], S.RAW_FILINGS), S.FILING_KEYS, S.FILING_UPDATES)
    assert twice.count() == 3


def test_filing_ticker_is_kept(spark):
    table = spark.createDataFrame([("1", "A", "FACTS", 0, "ALL", "{}", OLD)], S.RAW_FILINGS)
    batch = spark.createDataFrame([("1", "B", "FACTS", 0, "ALL", '{"x":1}', OLD)], S.RAW_FILINGS)
    row = upsert(table, batch, S.FILING_KEYS, S.FILING_UPDATES).first()
    assert (row["ticker"], row["payload"]) == ("A", '{"x":1}')


def test_macro_yields(spark):
    table = spark.createDataFrame([("US10Y", DAY, D("4.1"), OLD)], S.RAW_MACRO_YIELDS)
    batch = spark.createDataFrame([("US10Y", DAY, D("4.2"), OLD), ("MGS10Y", DAY, D("3.9"), OLD)], S.RAW_MACRO_YIELDS)
    rows = upsert(table, batch, S.YIELD_KEYS, S.YIELD_UPDATES).orderBy("series_id").collect()
    assert [(r["series_id"], r["yield_percent"]) for r in rows] == [("MGS10Y", D("3.9000")), ("US10Y", D("4.2000"))]


def test_land_counts_the_batch(spark, tmp_path):
    out = str(tmp_path / "v2")
    n = land(prices(spark, price()), prices(spark, price(adj="2"), price(dt.date(2024, 1, 9))), out, S.PRICE_KEYS, S.PRICE_UPDATES)
    assert n == 2 and spark.read.parquet(out).count() == 2




def land_month(spark, tmp_path, number, *rows):
    land_partitions(
        spark,
        str(tmp_path / "table"),
        S.RAW_MARKET_PRICES,
        prices(spark, *rows),
        str(tmp_path / "staging"),
        str(number),
        S.PRICE_KEYS,
        S.PRICE_UPDATES,
        "trade_month",
        F.date_format("trade_date", "yyyy-MM"),
        touched_at=F.lit(NEW),
    )
    return spark.read.parquet(str(tmp_path / "table"))


def test_land_partitions_touches_only_the_batch_months(spark, tmp_path):
    land_month(spark, tmp_path, 0, price(), price(dt.date(2024, 3, 1)))
    untouched = sorted((tmp_path / "table" / "trade_month=2024-03").glob("*.parquet"))
    table = land_month(spark, tmp_path, 1, price(adj="5"), price(dt.date(2024, 1, 31)), price(dt.date(2024, 2, 1)))
    assert sorted((r["trade_date"], r["adj_close"]) for r in table.collect()) == [
        (DAY, D("5.0000")),
        (dt.date(2024, 1, 31), D("1.0000")),
        (dt.date(2024, 2, 1), D("1.0000")),
        (dt.date(2024, 3, 1), D("1.0000")),
    ]
    assert sorted((tmp_path / "table" / "trade_month=2024-03").glob("*.parquet")) == untouched


def test_land_partitions_resumes_after_a_cut_off_copy(spark, tmp_path):
    land_month(spark, tmp_path, 0, price(), price(dt.date(2024, 3, 1)))
    land_month(spark, tmp_path, 1, price(adj="5"))
    for part in (tmp_path / "table" / "trade_month=2024-01").glob("*.parquet"):
        part.unlink()
    table = land_month(spark, tmp_path, 1, price(adj="5"))
    assert sorted((r["trade_date"], r["adj_close"]) for r in table.collect()) == [(DAY, D("5.0000")), (dt.date(2024, 3, 1), D("1.0000"))]


def test_land_partitions_reads_a_new_batch_under_a_used_run_id(spark, tmp_path):
    land_month(spark, tmp_path, 0, price())
    table = land_month(spark, tmp_path, 0, price(adj="9"))
    assert [r["adj_close"] for r in table.collect()] == [D("9.0000")]


def test_rows_without_a_partition_value_stay(spark, tmp_path):
    filing = lambda cik, year: (cik, "T", "FACTS", year, "ALL", "{}", OLD)

    def land_filing(run, row):
        batch = spark.createDataFrame([row], S.RAW_FILINGS)
        land_partitions(spark, str(tmp_path / "t"), S.RAW_FILINGS, batch, str(tmp_path / "s"), run, S.FILING_KEYS, S.FILING_UPDATES, "year", F.col("fiscal_year"))

    land_filing("1", filing("1", None))
    land_filing("2", filing("2", None))
    assert sorted(r["cik"] for r in spark.read.parquet(str(tmp_path / "t")).collect()) == ["1", "2"]


def test_price_stream(spark, tmp_path):
    incoming, table = str(tmp_path / "in"), str(tmp_path / "prices")
    args = (spark, incoming, table, str(tmp_path / "checkpoint"))
    prices(spark, price(), price(dt.date(2024, 2, 1))).write.parquet(incoming)
    land_price_stream(*args).awaitTermination()
    prices(spark, price(adj="4", close="4"), price(dt.date(2024, 2, 2))).write.mode("append").parquet(incoming)
    land_price_stream(*args).awaitTermination()
    rows = spark.read.parquet(table).orderBy("trade_date").collect()
    assert [(r["trade_date"].day, r["adj_close"], r["close_price"]) for r in rows] == [
        (5, D("4.0000"), D("1.0000")),
        (1, D("1.0000"), D("1.0000")),
        (2, D("1.0000"), D("1.0000")),
    ]


HEADER = "Ticker,Date,Open,High,Low,Close,Adj Close,Volume"


def test_read_csv_without_optional_columns(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text(f"{HEADER}\ngoogl,2024-01-05 00:00:00-05:00,1.00005,2,0.5,1.5,NaN,10.0\n")
    (row,) = read_prices(spark, str(path), "csv").collect()
    assert (row["ticker"], row["trade_date"], row["open_price"], row["adj_close"], row["volume"]) == ("GOOGL", DAY, D("1.0001"), None, 10)
    assert (row["dividend_amount"], row["split_coefficient"]) == (D("0.0000"), D("1.0000"))


def test_reported_zero_split_is_kept(spark, tmp_path):
    path = tmp_path / "p.json"
    record = {"Ticker": "T", "Date": "2024-01-05", "Open": 1, "High": 1, "Low": 1, "Close": 1, "Adj Close": 1, "Volume": 5}
    path.write_text("\n".join(json.dumps(r) for r in (record, {**record, "Date": "2024-01-06", "Stock Splits": 0.0, "Dividends": 0.25})))
    rows = read_prices(spark, str(path), "json").orderBy("trade_date").collect()
    assert [(r["dividend_amount"], r["split_coefficient"]) for r in rows] == [(D("0.0000"), D("1.0000")), (D("0.2500"), D("0.0000"))]


def test_reported_nulls_in_json_lines_stay_null(spark, tmp_path):
    path = tmp_path / "n.json"
    record = {"Ticker": "T", "Date": "2024-01-05", "Open": 1, "High": 1, "Low": 1, "Close": 1, "Adj Close": 1, "Volume": 5}
    path.write_text(json.dumps({**record, "Dividends": None, "Stock Splits": None}) + "\n\n")
    (row,) = read_prices(spark, str(path), "json").collect()
    assert (row["dividend_amount"], row["split_coefficient"]) == (None, None)


def test_shares_of_one_company_land_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "CIK0001652044.json").write_text('{"entityName": "Alphabet"}')
    shares = spark.createDataFrame([("googl", "1652044"), ("GOOG", "0001652044"), ("X", None)], S.WATCHLIST)
    assert ingest_filings(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "w"), "1", shares) == 1
    assert [(r["cik"], r["ticker"]) for r in spark.read.parquet(str(tmp_path / "t")).collect()] == [("0001652044", "GOOG")]


def test_filings_keep_the_groups_of_their_first_run(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for cik in range(1, 9):
        (tmp_path / "in" / f"CIK{cik:010d}.json").write_text("{}")
    watched = spark.createDataFrame([(f"T{cik}", str(cik)) for cik in range(1, 9)], S.WATCHLIST)
    paths = str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "w")
    assert ingest_filings(spark, *paths, "1", watched, groups=2) == 8
    assert ingest_filings(spark, *paths, "2", watched) == 8
    table = spark.read.parquet(str(tmp_path / "t"))
    assert (table.count(), table.select("cik_group").distinct().count()) == (8, 2)
    with pytest.raises(ValueError, match="2 groups"):
        ingest_filings(spark, *paths, "3", watched, groups=3)


def test_ingest_looks_back_from_the_run_date(spark, tmp_path):
    (tmp_path / "d.csv").write_text(f"{HEADER}\nA,2024-01-01,1,1,1,1,1,5\nA,2024-01-04,1,1,1,1,1,5\nA,2024-01-09,1,1,1,1,1,5\n")
    n = ingest_prices(spark, str(tmp_path / "d.csv"), str(tmp_path / "t"), str(tmp_path / "w"), "1", "csv", run_date="2024-01-05", lookback_days=3)
    assert n == 1 and spark.read.parquet(str(tmp_path / "t")).first()["trade_date"] == dt.date(2024, 1, 4)


def test_broken_bronze_fails_the_build(spark, tmp_path):
    prices(spark, price(), price()).write.parquet(f"{tmp_path}/raw_market_prices")
    spark.createDataFrame([("1", "T", "FACTS", 0, "ALL", "{}", OLD)], S.RAW_FILINGS).write.parquet(f"{tmp_path}/raw_sec_filings")
    with pytest.raises(ValueError, match="raw_market_prices.ticker,trade_date: 1"):
        build(spark, str(tmp_path), f"{tmp_path}/out")


def test_read_parquet_for_one_ticker(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.sql(
        "select date'2024-01-05' as Date, 1d as Open, 1d as High, 1d as Low, 1d as Close, 1d as `Adj Close`, 7.9d as Volume"
    ).write.parquet(path)
    row = read_prices(spark, path, ticker="1155.kl").first()
    assert (row["ticker"], row["volume"]) == ("1155.KL", 7)
    with pytest.raises(ValueError):
        read_prices(spark, path, "xlsx")


def test_files_with_differing_columns(spark, tmp_path):
    csv, parquet = tmp_path / "csv", str(tmp_path / "parquet")
    csv.mkdir()
    (csv / "a.csv").write_text(f"{HEADER}\nA,2024-01-05,1,1,1,1,1,5\n")
    (csv / "b.csv").write_text(f"Volume,{HEADER.removesuffix(',Volume')}\n5,B,2024-01-05,1,1,1,1,1\n")
    with pytest.raises(Exception, match="CSV header"):
        read_prices(spark, str(csv), "csv").collect()
    base = "select 'A' as Ticker, date'2024-01-05' as Date, 1d as Open, 1d as High, 1d as Low, 1d as Close, 1d as `Adj Close`, 7d as Volume"
    spark.sql(base).write.parquet(f"{parquet}/1")
    spark.sql(f"{base}, 0.5d as Dividends").write.parquet(f"{parquet}/2")
    rows = read_prices(spark, f"{parquet}/*").collect()
    assert sorted(str(r["dividend_amount"]) for r in rows) == ["0.5000", "None"]


def watchlist(spark):
    return spark.createDataFrame([("1155.KL", None), ("googl", "1652044")], S.WATCHLIST)


def test_read_filing_documents(spark, tmp_path):
    (tmp_path / "CIK0001652044.json").write_text('{"entityName": "Alphabet",\n "facts": {}}')
    (tmp_path / "CIK0000000009.json").write_text("{}")
    (row,) = read_filings(spark, str(tmp_path), "documents", watchlist(spark)).collect()
    assert (row["cik"], row["ticker"], row["form_type"], row["fiscal_year"], row["fiscal_period"]) == ("0001652044", "GOOGL", "FACTS", 0, "ALL")
    assert json.loads(row["payload"])["entityName"] == "Alphabet"
    with pytest.raises(ValueError):
        read_filings(spark, str(tmp_path), "documents")


def test_read_filing_lines(spark, tmp_path):
    path = tmp_path / "f.json"
    path.write_text('{"ticker": "t", "cik": "123456789012", "payload": {"a": 1.10}}\n')
    row = read_filings(spark, str(path)).first()
    assert (row["cik"], row["ticker"], row["payload"].replace(" ", "")) == ("123456789012", "T", '{"a":1.10}')


def test_watchlist_and_lookback(spark):
    assert [r["ticker"] for r in filers(watchlist(spark)).collect()] == ["googl"]
    rows = prices(spark, *[price(DAY - dt.timedelta(days=2 * i), ticker=t) for i in range(5) for t in ("GOOGL", "X")])
    watched = on_watchlist(rows, watchlist(spark))
    assert watched.count() == 5
    assert lookback(watched, "2024-01-05", 5).count() == 3
    assert [r["trade_date"].day for r in last_sessions(watched, 2).orderBy("trade_date").collect()] == [3, 5]


def test_build(spark, tmp_path):
    bronze, out = str(tmp_path / "bronze"), str(tmp_path / "out")
    days = [DAY + dt.timedelta(days=i) for i in range(60)]
    prices(spark, *[price(d, adj=str(i + 1), ticker=t) for i, d in enumerate(days) for t in ("googl", "1155.kl")]).write.parquet(f"{bronze}/raw_market_prices")
    node = {"form": "10-K", "fy": 2023, "fp": "FY", "filed": "2024-02-01", "end": "2023-12-31", "val": 100, "accn": "x"}
    facts = {t: {"units": {"USD": [node]}} for t in ("Revenues", "NetIncomeLoss")}
    payload = json.dumps({"entityName": "Alphabet", "facts": {"us-gaap": facts}})
    spark.createDataFrame([("0001652044", "GOOGL", "FACTS", 0, "ALL", payload, OLD)], S.RAW_FILINGS).write.parquet(f"{bronze}/raw_sec_filings")

    for strategy in ("range", "window"):
        tables = build(spark, bronze, out, strategy=strategy)
        daily = tables.read("gold/fact_daily_market_valuation")
        assert daily.count() == 120
        seen = daily.where("filing_date is not null").agg(F.min("trade_date"), F.count("*"), F.max("net_margin")).first()
        assert tuple(seen) == (dt.date(2024, 2, 1), 33, D("1.0000"))
    assert tables.read("gold/dim_company").count() == 2
    assert "ingested_at" not in tables.read("silver/market_prices").columns
    assert "gold_dim_company" in register_views(tables)
    assert spark.sql("select count(*) from gold_fact_daily_market_valuation join gold_dim_company using (company_sk)").first()[0] == 120
    assert check_sources(spark, bronze).where("should_error").count() == 0
    assert check_sources(spark, bronze).count() == 6


def test_shared_dir_follows_the_session(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_ingest_then_build(spark, tmp_path):
    bronze, work = str(tmp_path / "bronze"), str(tmp_path / "work")
    landed, documents = tmp_path / "landed", tmp_path / "documents"
    landed.mkdir()
    documents.mkdir()
    (landed / "day1.csv").write_text(f"{HEADER}\ngoogl,2024-01-31,1,1,1,1,1,5\n1155.kl,2024-01-31,2,2,2,2,2,5\nother,2024-01-31,2,2,2,2,2,5\n")
    node = {"form": "10-K", "fy": 2023, "fp": "FY", "filed": "2024-02-01", "end": "2023-12-31", "val": 100, "accn": "x"}
    (documents / "CIK0001652044.json").write_text(
        json.dumps({"entityName": "Alphabet", "facts": {"us-gaap": {"Revenues": {"units": {"USD": [node]}}}}}, indent=1)
    )
    prices_path, filings_path = f"{bronze}/raw_market_prices", f"{bronze}/raw_sec_filings"
    assert ingest_prices(spark, str(landed), prices_path, f"{work}/prices", "1", "csv", watchlist=watchlist(spark)) == 2
    (landed / "day1.csv").write_text(f"{HEADER}\ngoogl,2024-01-31,9,9,9,9,7,5\ngoogl,2024-02-01,3,3,3,3,3,5\n")
    assert ingest_prices(spark, str(landed), prices_path, f"{work}/prices", "2", "csv", watchlist=watchlist(spark)) == 2
    for run in ("1", "2"):
        assert ingest_filings(spark, str(documents), filings_path, f"{work}/filings", run, watchlist(spark)) == 1
    assert spark.read.parquet(filings_path).count() == 1
    (landed / "day1.csv").write_text(f"{HEADER}\nother,2024-01-31,9,9,9,9,7,5\n")
    assert ingest_prices(spark, str(landed), prices_path, f"{work}/prices", "3", "csv", watchlist=watchlist(spark)) == 0
    daily = build(spark, bronze, str(tmp_path / "out")).read("gold/fact_daily_market_valuation")
    rows = {(r["ticker"], str(r["trade_date"])): (r["close_price"], r["adj_close"], r["total_revenue"]) for r in daily.collect()}
    assert rows == {
        ("1155.KL", "2024-01-31"): (D("2.0000"), D("2.0000"), None),
        ("GOOGL", "2024-01-31"): (D("1.0000"), D("7.0000"), None),
        ("GOOGL", "2024-02-01"): (D("3.0000"), D("3.0000"), D("100.00")),
    }
