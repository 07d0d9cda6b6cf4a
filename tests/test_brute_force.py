"""Operators against plain Python over random small inputs, sliced and not."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP
from decimal import Decimal as D

import pytest

from ledgerline import schemas as S
from ledgerline.operators.history import latest_per_key, scd2
from ledgerline.operators.price_analytics import price_analytics
from ledgerline.operators.slicing import measure
from ledgerline.operators.upsert import upsert

DAY = dt.date(2021, 1, 1)


def rounded(x, digits):
    return x.quantize(D(1).scaleb(-digits), ROUND_HALF_UP)


@pytest.mark.parametrize("seed, limit", [(1, None), (2, 15), (3, 40), (4, 90)])
def test_price_analytics(spark, seed, limit):
    rng = random.Random(seed)
    rows = []
    for ticker, n in (("HOT", 130), ("B", 60), ("C", 1), ("D", 25)):
        days = rng.sample(range(400), n)
        rows += [(ticker, DAY + dt.timedelta(days=d), D(rng.choice([0, 0, rng.randrange(1, 10**9)])) / 10000, D(rng.randrange(10**6)) / 10000, rng.randrange(1000)) for d in days]
    expected = {}
    for ticker in {r[0] for r in rows}:
        series = sorted((r for r in rows if r[0] == ticker), key=lambda r: r[1])
        for i, (_, day, adj, close, volume) in enumerate(series):
            before = series[i - 1][2] if i else None
            expected[ticker, day] = (
                rounded((adj - before) / before, 6) if before else None,
                rounded(close * volume, 2),
                *[rounded(sum(r[2] for r in series[max(0, i - n + 1) : i + 1]) / min(n, i + 1), 4) for n in (3, 20, 50)],
            )
    prices = spark.createDataFrame(rows, "ticker string, trade_date date, adj_close decimal(14,4), close_price decimal(14,4), volume bigint")
    plan = measure(prices, ["ticker"], ["trade_date"], rows_per_group=limit) if limit else None
    assert (plan is None) == (limit is None)
    got = price_analytics(prices, windows=(3, 20, 50), slicing=plan).collect()
    assert {(r["ticker"], r["trade_date"]): (r["daily_return"], r["dollar_volume"], r["sma_3"], r["sma_20"], r["sma_50"]) for r in got} == expected
    assert len(got) == len(rows)


def test_price_must_be_decimal(spark):
    with pytest.raises(TypeError):
        price_analytics(spark.createDataFrame([("A", DAY, 1.0)], "ticker string, trade_date date, adj_close double"))


@pytest.mark.parametrize("seed, limit", [(1, None), (2, 5), (3, 12)])
def test_scd2(spark, seed, limit):
    rng = random.Random(seed)
    day = lambda: None if rng.random() < 0.1 else DAY + dt.timedelta(days=rng.randrange(15))
    rows = sorted({(rng.choice("AAAB"), day(), rng.choice("xyz"), rng.randrange(4)) for _ in range(90)}, key=str)
    last = (dt.date.max, "", 0)
    order = lambda r: (r[1] is None, r[1] or DAY, r[2], r[3])
    expected = []
    for key in "AB":
        versions = sorted((r for r in rows if r[0] == key), key=order)
        for i, r in enumerate(versions):
            following = versions[i + 1][1] if i + 1 < len(versions) else None
            expected.append((*r, following or dt.date(9999, 12, 31), i + 1 == len(versions)))
    data = spark.createDataFrame(rows, "k string, filed date, accn string, n int")
    args = dict(keys=["k"], effective="filed", order=["filed", "accn", "n"])
    plan = measure(data, ["k"], args["order"], rows_per_group=limit) if limit else None
    got = [(r["k"], r["valid_from"], r["accn"], r["n"], r["valid_to"], r["is_current"]) for r in scd2(data, slicing=plan, **args).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    latest = {r["k"]: (r["filed"], r["accn"], r["n"]) for r in latest_per_key(data, "k", args["order"]).collect()}
    assert latest == {r[0]: r[1:4] for r in expected if r[5]}


@pytest.mark.parametrize("seed", [1, 2])
def test_upsert(spark, seed):
    rng = random.Random(seed)

    def table(keys, stamp):
        return {k: (D(rng.randrange(100)), D(rng.randrange(100)), stamp) for k in keys}

    universe = [(t, DAY + dt.timedelta(days=i)) for t in "AB" for i in range(12)]
    old = table(rng.sample(universe, 14), dt.datetime(2024, 1, 1))
    new = table(rng.sample(universe, 12), dt.datetime(2024, 3, 3))
    expected = dict(old)
    for key, (close, adj, stamp) in new.items():
        expected[key] = (old[key][0] if key in old else close, adj, stamp)

    def frame(rows):
        return spark.createDataFrame(
            [(*k, close, close, close, close, adj, 1, D(0), D(1), stamp) for k, (close, adj, stamp) in rows.items()], S.RAW_MARKET_PRICES
        )

    from pyspark.sql import functions as F

    after = upsert(frame(old), frame(new), S.PRICE_KEYS, S.PRICE_UPDATES, touched_at=F.lit(dt.datetime(2024, 3, 3)))
    assert {(r["ticker"], r["trade_date"]): (r["close_price"], r["adj_close"], r["ingested_at"]) for r in after.collect()} == expected
