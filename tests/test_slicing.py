"""Sliced windows equal plain windows, whatever the skew."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.operators import slicing
from ledgerline.operators import asof
from ledgerline.operators.asof import asof_join
from ledgerline.operators.history import FACT_KEYS, FACT_ORDER, scd2
from ledgerline.operators.price_analytics import price_analytics
from ledgerline.operators.slicing import measure

DAY = dt.date(2020, 1, 1)


def same(a, b):
    return a.count() == b.count() and a.exceptAll(b).count() == 0


def skewed_prices(spark, n=6000):
    """A third of all rows in one key, the others spread over many."""
    key = F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("K"), (F.col("id") % 50).cast("string")))
    return spark.range(n).select(
        key.alias("ticker"),
        F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("trade_date"),
        (F.abs(F.hash("id")) % 100000 + 1).cast("decimal(14,4)").alias("adj_close"),
        F.lit(Decimal("2.5")).cast("decimal(14,4)").alias("close_price"),
        (F.col("id") % 7).alias("volume"),
    )


@pytest.mark.parametrize("limit", [200, 777, 1999])
def test_price_analytics(spark, limit):
    prices = skewed_prices(spark)
    plan = measure(prices, ["ticker"], ["trade_date"], rows_per_group=limit)
    assert plan is not None and [r[0] for r in plan.cuts.select("ticker").collect()] == ["HOT"]
    sizes = plan.assign(prices).where("ticker = 'HOT'").groupBy("_slice").count().agg(F.max("count")).first()[0]
    assert sizes <= limit
    assert same(price_analytics(prices, slicing=plan), price_analytics(prices, slicing=None))


def test_slices_shorter_than_the_frame(spark):
    prices = skewed_prices(spark, 600)
    plan = measure(prices, ["ticker"], ["trade_date"], rows_per_group=12)
    assert plan.most_cuts > 20
    assert same(price_analytics(prices, slicing=plan), price_analytics(prices, slicing=None))


def test_nothing_to_measure(spark):
    prices = skewed_prices(spark, 300)
    assert measure(prices, ["ticker"], ["trade_date"]) is None
    assert measure(prices, ["ticker"], ["trade_date"], rows_at_most=10, rows_per_group=10) is None


def test_groups_do_not_grow_with_the_data(spark):
    """The largest slice holds no more rows of a table ten times as long."""
    for n in (6000, 60000):
        prices = skewed_prices(spark, n)
        plan = measure(prices, ["ticker"], ["trade_date"], rows_per_group=500)
        groups = plan.assign(prices).groupBy("ticker", "_slice").count()
        assert groups.where("ticker = 'HOT'").agg(F.max("count")).first()[0] <= 500
        assert plan.most_cuts >= n / 3 / 500


def test_cuts_too_many_to_broadcast(spark, monkeypatch):
    prices = skewed_prices(spark)
    monkeypatch.setattr(slicing, "BROADCAST_CUTS", 0)
    plan = measure(prices, ["ticker"], ["trade_date"], rows_per_group=200)
    assert same(price_analytics(prices, slicing=plan), price_analytics(prices, slicing=None))


def test_known_rows_reach_over_empty_slices(spark):
    """One statement at the start, thousands of later prices: every slice needs a copy of it."""
    left = spark.range(3000).select(F.lit("A").alias("k"), F.col("id").alias("t"))
    right = spark.createDataFrame([("A", 0, 1), ("A", 2990, 2)], "k string, u bigint, r int")
    plan = measure(left, ["k"], ["t"], rows_per_group=100)
    assert plan.most_cuts > 30
    found = asof_join(left, right, "k", "t", "u", slicing=plan)
    assert found.groupBy("r").count().orderBy("r").collect() == [(1, 2990), (2, 10)]


def test_single_order_value_cannot_be_cut(spark):
    rows = spark.range(100).select(F.lit("A").alias("k"), F.lit(1).alias("t"))
    assert measure(rows, ["k"], ["t"], rows_per_group=10) is None


def test_null_keys_and_null_order(spark):
    rows = spark.range(500).select(
        F.when(F.col("id") % 2 == 0, "A").alias("ticker"),
        F.when(F.col("id") % 5 != 0, F.date_add(F.lit(DAY), (F.col("id") % 200).cast("int"))).alias("filed_date"),
        F.col("id").cast("string").alias("accession_number"),
    )
    plan = measure(rows, ["ticker"], ["filed_date", "accession_number"], rows_per_group=30)
    assert plan.cuts.count() == 2
    args = dict(keys=["ticker"], order=["filed_date", "accession_number"])
    assert same(scd2(rows, slicing=plan, **args), scd2(rows, slicing=None, **args))


def test_scd2(spark):
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 != 0, "HOT").otherwise(F.concat(F.lit("K"), (F.col("id") % 40).cast("string"))).alias("ticker"),
        F.lit("0000000001").alias("cik"),
        F.lit("Assets").alias("gaap_tag"),
        F.lit("10-K").alias("form_type"),
        F.lit(2020).alias("fiscal_year"),
        F.lit("FY").alias("fiscal_period"),
        F.date_add(F.lit(DAY), (F.col("id") % 90).cast("int")).alias("filed_date"),
        F.date_add(F.lit(DAY), (F.col("id") % 4).cast("int")).alias("period_start_date"),
        F.lit(DAY).alias("period_end_date"),
        F.col("id").cast("decimal(20,2)").alias("amount"),
        F.lpad((F.col("id") % 100).cast("string"), 4, "0").alias("accession_number"),
    )
    plan = measure(facts, FACT_KEYS, FACT_ORDER, rows_per_group=100)
    sliced = scd2(facts, slicing=plan)
    assert same(sliced, scd2(facts, slicing=None))
    current = sliced.where("is_current").groupBy("ticker").count()
    assert current.where("count <> 1").count() == 0


def test_asof_hot_on_either_side(spark):
    left = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("K"), (F.col("id") % 30).cast("string"))).alias("k"),
        (F.col("id") * 37 % 1009).alias("t"),
        F.col("id").alias("l"),
    )
    right = spark.range(900).select(
        F.when(F.col("id") % 2 == 0, "HOT").otherwise(F.concat(F.lit("K"), (F.col("id") % 30).cast("string"))).alias("k"),
        (F.col("id") * 53 % 997 + 20).alias("u"),
        F.col("id").alias("r"),
    )
    events = left.select("k", "t").unionByName(right.select("k", F.col("u").alias("t")))
    assert measure(events, ["k"], ["t"], rows_per_group=150) is not None
    spark.conf.set("spark.ledgerline.rowsPerGroup", "150")
    try:
        sliced = asof_join(left, right, "k", "t", "u", tiebreak=["r"])
    finally:
        spark.conf.unset("spark.ledgerline.rowsPerGroup")
    assert same(sliced, asof_join(left, right, "k", "t", "u", tiebreak=["r"], slicing=None))
    assert sliced.count() == 4000


def test_packed_form_has_no_bound_per_key(spark, monkeypatch):
    """Many right rows of one key in many arrays; without a broadcast the join is by key and array."""
    one = F.when(F.col("id") >= 0, "A").otherwise("B").alias("k")  # a literal would leave no key to join by
    left = spark.range(5000).select(one, (F.col("id") * 7 % 4001).alias("t"), F.col("id").alias("l"))
    right = spark.range(3000).select(one, (F.col("id") + 100).alias("u"), F.col("id").alias("r"))
    for rows in (10**6, 0):
        monkeypatch.setattr(asof, "BROADCAST_ROWS", rows)
        df = asof_join(left, right, "k", "t", "u", strategy="packed")
        assert df.where(~F.col("r").eqNullSafe(F.when(F.col("t") >= 100, F.least(F.col("t") - 100, F.lit(2999))))).count() == 0
        assert df.count() == 5000
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert "_chunk" in text and "BroadcastNestedLoopJoin" not in df._jdf.queryExecution().executedPlan().toString()


def test_asof_hot_key_and_time(spark):
    """A third of the left rows share key and time; they still spread over slices."""
    left = spark.range(3000).select(F.lit("A").alias("k"), F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 11).alias("t"), "id")
    right = spark.range(11).select(F.lit("A").alias("k"), F.col("id").alias("u"), F.col("id").alias("r"))
    spark.conf.set("spark.ledgerline.rowsPerGroup", "200")
    try:
        sliced = asof_join(left, right, "k", "t", "u")
    finally:
        spark.conf.unset("spark.ledgerline.rowsPerGroup")
    assert sliced.where("r <> t or r is null").count() == 0
    assert sliced.count() == 3000


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    left=st.lists(st.tuples(st.sampled_from("ab"), st.one_of(st.none(), st.integers(0, 30))), min_size=1, max_size=40),
    right=st.lists(st.tuples(st.sampled_from("abc"), st.one_of(st.none(), st.integers(0, 30))), max_size=25),
)
def test_asof_forms_against_brute_force(spark, left, right):
    rows = [(k, t, i) for i, (k, t) in enumerate(left)]
    known = [(k, u, i) for i, (k, u) in enumerate(right)]
    expected = []
    for k, t, i in rows:
        matches = [(u, r) for rk, u, r in known if rk == k and u is not None and t is not None and u <= t]
        expected.append((i, max(matches)[1] if matches else None))
    l = spark.createDataFrame(rows, "k string, t int, l int")
    r = spark.createDataFrame(known, "k string, u int, r int")
    events = l.select("k", F.col("t").alias("_at")).unionByName(r.select("k", F.col("u").alias("_at")))
    forms = {
        "window": asof_join(l, r, "k", "t", "u", tiebreak=["r"], slicing=None),
        "range": asof_join(l, r, "k", "t", "u", tiebreak=["r"], strategy="range"),
        "packed": asof_join(l, r, "k", "t", "u", tiebreak=["r"], strategy="packed"),
    }
    with pytest.MonkeyPatch.context() as small:
        small.setattr(asof, "CHUNK", 4)
        small.setattr(asof, "BROADCAST_ROWS", 0)
        forms["packed, shuffled"] = asof_join(l, r, "k", "t", "u", tiebreak=["r"], strategy="packed")
    spark.conf.set("spark.ledgerline.rowsPerGroup", "4")
    try:
        forms["sliced"] = asof_join(l, r, "k", "t", "u", tiebreak=["r"])
    finally:
        spark.conf.unset("spark.ledgerline.rowsPerGroup")
    for name, df in forms.items():
        assert sorted((x["l"], x["r"]) for x in df.select("l", "r").collect()) == expected, name
