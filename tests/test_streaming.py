"""Streams with state, and deltas landed from streams."""

import datetime as dt
import json
import random
from decimal import Decimal as D

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.operators.price_analytics import price_analytics
from ledgerline.operators.quality import expect_unique
from ledgerline.plans.ingest import FILINGS, PRICES
from ledgerline.sources.merge_on_read import read_merged
from ledgerline.sources.versions import TableSet
from ledgerline.streaming.analytics import stream_price_analytics
from ledgerline.streaming.landing import land_deltas, land_filing_stream
from tests.test_landing import land_month, price, prices

STAGED = "ticker string, trade_date date, close_price decimal(14,4), adj_close decimal(14,4), volume bigint"
DAY = dt.date(2024, 1, 1)


def sessions(rng, tickers, first, last):
    number = lambda: rng.choice([None, D(0), D(rng.randint(1, 10**7)) / 10_000, D(rng.randint(1, 99)) / 10_000])
    rows = [(t, DAY + dt.timedelta(days=k), D(rng.randint(1, 10**6)) / 10_000, number(), rng.randint(0, 1000)) for t in tickers for k in range(first, last) if rng.random() < 0.9]
    rng.shuffle(rows)
    return rows


def drain(spark, folder):
    stream = spark.readStream.schema(STAGED).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    out = stream_price_analytics(stream, windows=(3, 20)).writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint")
    out.trigger(availableNow=True).start().awaitTermination()


def test_a_drained_stream_equals_the_batch(spark, tmp_path):
    rng, every = random.Random(4), []
    for n, (first, last) in enumerate([(0, 5), (5, 6), (6, 40), (40, 70)]):
        rows = sessions(rng, ["A", "B", "C"] if n != 1 else ["A"], first, last)
        every += rows
        spark.createDataFrame(rows, STAGED).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        if n != 1:  # two files in one go, and a restart after each
            drain(spark, tmp_path)
    expected = price_analytics(spark.createDataFrame(every, STAGED), windows=(3, 20), slicing=None)
    got = spark.read.parquet(f"{tmp_path}/out")
    assert dict(got.dtypes) == dict(expected.dtypes)
    assert sorted(map(str, got.select(*expected.columns).collect())) == sorted(map(str, expected.collect()))


def test_a_late_session_fails_the_stream(spark, tmp_path):
    for day in (5, 3):
        spark.createDataFrame([("A", DAY + dt.timedelta(days=day), D(1), D(1), 1)], STAGED).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        if day == 5:
            drain(spark, tmp_path)
        else:
            with pytest.raises(StreamingQueryException, match="not after"):
                drain(spark, tmp_path)


def test_deltas_from_a_stream(spark, tmp_path):
    incoming, root, checkpoint = f"{tmp_path}/in", f"{tmp_path}/tables", f"{tmp_path}/checkpoint"
    for adj in ("1", "4"):
        prices(spark, price(adj=adj, close=adj), price(dt.date(2024, 2, int(adj)))).write.mode("append").parquet(incoming)
        land_deltas(spark.readStream.schema(S.RAW_MARKET_PRICES).parquet(incoming), root, PRICES, checkpoint).awaitTermination()
    rows = read_merged(TableSet(spark, root), PRICES).orderBy("trade_date").collect()
    assert [(r.trade_date.day, r.adj_close, r.close_price) for r in rows] == [(5, D(4), D(1)), (1, D(1), D(1)), (4, D(1), D(1))]
    assert len(TableSet(spark, root).tables["raw_market_prices"].deltas) == 2


def test_filings_from_a_stream(spark, tmp_path):
    incoming, root, checkpoint = tmp_path / "in", f"{tmp_path}/tables", f"{tmp_path}/checkpoint"
    incoming.mkdir()
    watchlist = spark.createDataFrame([("googl", "1652044"), ("GOOG", "1652044"), ("now", "1373715")], S.WATCHLIST)
    for n, lines in enumerate([[("googl", "1652044", {"v": 1}), ("goog", "1652044", {"v": 1}), ("other", "9", {})], [("now", "1373715", {"v": 2}), ("googl", "1652044", {"v": 3})]]):
        (incoming / f"{n}.json").write_text("\n".join(json.dumps({"ticker": t, "cik": c, "payload": p}) for t, c, p in lines))
        land_filing_stream(spark, str(incoming), root, checkpoint, watchlist).awaitTermination()
    rows = read_merged(TableSet(spark, root), FILINGS).orderBy("cik").collect()
    assert [(r.cik, r.ticker, r.payload) for r in rows] == [("0001373715", "NOW", '{"v": 2}'), ("0001652044", "GOOG", '{"v": 3}')]


def test_a_changed_batch_under_the_id_of_a_cut_off_run_lands(spark, tmp_path, monkeypatch):
    from ledgerline.sources import landing

    land_month(spark, tmp_path, 0, price())
    mark = landing._mark

    def cut_off(spark_, path, run_id, state, digest):
        mark(spark_, path, run_id, state, digest)
        if state == "staged":
            raise RuntimeError("cut off")

    monkeypatch.setattr(landing, "_mark", cut_off)
    with pytest.raises(RuntimeError):
        land_month(spark, tmp_path, 1, price(adj="2"))
    monkeypatch.setattr(landing, "_mark", mark)
    table = land_month(spark, tmp_path, 1, price(adj="3"), price(dt.date(2024, 1, 9)))
    assert sorted((r.trade_date.day, r.adj_close) for r in table.collect()) == [(5, D(3)), (9, D(1))]


def test_two_pass_uniqueness(spark):
    rows = spark.range(3000).select(F.concat(F.lit("a wide key " * 20), (F.col("id") % 2990).cast("string")).alias("k"), F.when(F.col("id") % 7 != 0, 1).alias("n"))
    one, two = (expect_unique(rows, ["k", "n"], two_pass=p) for p in (False, True))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect())) and one.count() > 0
    text = two._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in text


def test_the_price_history_is_dealt_to_the_stream_in_parallel(spark, tmp_path, monkeypatch):
    """The history is shaped once, and no batch of it passes through a single task."""
    from workload import catalog

    shaped = []
    days = spark.range(400).select(F.concat(F.lit("T"), F.col("id") % 4).alias("ticker"), F.expr("date_add(date'2024-01-01', cast(id div 4 as int))").alias("trade_date"), *[(F.col("id") % 7 + 1).cast("decimal(18,4)").alias(c) for c in ("close_price", "adj_close")], F.lit(1).cast("bigint").alias("volume"))

    def staged(*_):
        shaped.append(1)
        return days.repartition(4)

    monkeypatch.setattr(catalog, "_staged", staged)
    monkeypatch.setattr(catalog, "shared_dir", lambda *_: str(tmp_path))
    got = catalog._streamed_prices(spark, "")
    want = price_analytics(days).select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 400
    assert len(shaped) == 1
    assert len(list((tmp_path / "in").glob("part-*"))) > 4
