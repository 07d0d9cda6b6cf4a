"""Discounted cash flow against plain arithmetic."""

import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.columns import to_fixed
from ledgerline.operators.valuation import GROWTH_RANGE, TERMINAL_RANGE, WACC_RANGE, dcf, dcf_projections, dcf_scenarios
from workload.catalog import _exact_sum

INPUT = "base_fcf double, growth double, terminal_growth double, wacc double, cash double, total_debt double, shares_outstanding double"


def expected(base, growth, terminal, rate, cash, debt):
    flow, total, years = base, 0.0, []
    for year in range(1, 6):
        flow *= 1 + growth
        value = flow / (1 + rate) ** year
        total += value
        years.append((year, round(flow, 2), round(value, 2)))
    end = flow * (1 + terminal) / (rate - terminal)
    end_value = end / (1 + rate) ** 5
    return total, end, end_value, total + end_value, debt - cash, total + end_value - (debt - cash), years


def value(spark, *inputs, **options):
    return dcf(spark.createDataFrame([inputs], INPUT), **options).first()


def test_dcf(spark):
    row = value(spark, 1e6, 0.10, 0.025, 0.085, 5e5, 2e6, 1000.0)
    want = expected(1e6, 0.10, 0.025, 0.085, 5e5, 2e6)
    names = ("pv_explicit_fcf", "terminal_value", "pv_terminal_value", "enterprise_value", "net_debt", "equity_value")
    assert [row[n] for n in names] == [round(x, 2) for x in want[:6]]
    assert row["fair_value_per_share"] == round(want[5] / 1000.0, 2)
    assert [tuple(p) for p in row["projections"]] == want[6]
    assert row["enterprise_value"] - row["net_debt"] == pytest.approx(row["equity_value"], abs=0.011)


def test_rate_floor(spark):
    assert value(spark, 1e6, 0.0, 0.025, 0.02, 0.0, 0.0, 1.0)["equity_value"] == round(expected(1e6, 0.0, 0.025, 0.035, 0, 0)[5], 2)
    assert value(spark, 1e6, 0.0, 0.025, 0.025, 0.0, 0.0, 1.0)["equity_value"] == round(expected(1e6, 0.0, 0.025, 0.035, 0, 0)[5], 2)
    assert value(spark, 1e6, 0.0, 0.025, 0.026, 0.0, 0.0, 1.0)["equity_value"] == round(expected(1e6, 0.0, 0.025, 0.026, 0, 0)[5], 2)


def test_no_shares(spark):
    assert value(spark, 1e6, 0.1, 0.025, 0.085, 0.0, 0.0, 0.0)["fair_value_per_share"] == 0.0
    assert value(spark, 1e6, 0.1, 0.025, 0.085, 0.0, 0.0, -1.0)["fair_value_per_share"] == 0.0


def test_projections_and_filters(spark):
    valued = dcf(spark.createDataFrame([(1e6, 0.1, 0.02, 0.08, 0.0, 0.0, 1.0)], INPUT))
    assert dcf_projections(valued, "base_fcf").count() == 5
    assert valued.where("fair_value_per_share > 0 and equity_value > 0").count() == 1


COMPANY = "company string, base_fcf double, cash double, total_debt double, shares_outstanding double, current_price double"


def sweep(spark, *company, **options):
    return dcf_scenarios(spark.createDataFrame([company], COMPANY), **options)


def test_whole_grid(spark):
    assert sweep(spark, "T", 1e6, 0.0, 0.0, 1000.0, 10.0).count() == 91 * 45 * 36
    assert [len(range(a, b + 1, s)) for a, b, s in (GROWTH_RANGE, WACC_RANGE, TERMINAL_RANGE)] == [91, 45, 36]


def one(spark, *company, growth=1000, wacc=850, terminal=250, **options):
    rows = sweep(spark, *company, growth=(growth, growth, 1), wacc=(wacc, wacc, 1), terminal=(terminal, terminal, 1), **options).collect()
    assert len(rows) == 1
    return rows[0]


def test_scenario_equals_single_valuation(spark):
    row = one(spark, "T", 1e6, 5e5, 2e6, 1000.0, 100.0)
    single = value(spark, 1e6, 0.10, 0.025, 0.085, 5e5, 2e6, 1000.0)
    assert round(row["equity_value"], 2) == single["equity_value"]
    assert row["fair_value"] == pytest.approx(single["fair_value_per_share"], abs=0.011)


def test_scenario_floor(spark):
    row = one(spark, "T", 1e6, 0.0, 0.0, 1.0, 1.0, growth=0, wacc=200, terminal=250)
    assert row["equity_value"] == pytest.approx(expected(1e6, 0.0, 0.025, 0.030, 0, 0)[5], rel=1e-12)


def test_no_shares_or_negative_value(spark):
    row = one(spark, "T", 1e6, 0.0, 0.0, 0.0, 1.0)
    assert (row["fair_value"], row["margin_of_safety"], row["rating"]) == (0.0, 0.0, "Overvalued")
    assert one(spark, "T", -1e6, 0.0, 0.0, 10.0, 1.0)["margin_of_safety"] == 0.0


def test_rating_edge(spark):
    fair = one(spark, "T", 1e6, 0.0, 0.0, 1.0, 1.0)["equity_value"]
    low = one(spark, "T", 1e6, 0.0, 0.0, 1.0, fair * 0.901)
    high = one(spark, "T", 1e6, 0.0, 0.0, 1.0, fair * 0.9)
    assert (low["margin_of_safety"], low["rating"]) == (9.9, "Overvalued")
    assert (high["margin_of_safety"], high["rating"]) == (10.0, "Undervalued")


def test_quantized_inputs(spark):
    plain = one(spark, "T", 1.005e9, 0.0, 0.0, 1e9, 1.0)
    rounded = one(spark, "T", 1.005e9, 0.0, 0.0, 1e9, 1.0, quantize=True)
    assert rounded["equity_value"] == pytest.approx(plain["equity_value"] / 1.005, rel=1e-12)
    assert rounded["base_fcf"] == 1.005e9


def test_to_fixed_rounds_usual_values_like_the_decimal_of_the_double(spark):
    """The double arithmetic of usual values, ties and the values that leave it agree with exact decimals, also in the sign of zero."""
    rnd = random.Random(5)
    values = [0.0, -0.0, -0.001, 0.005, 1.005, 2.675, 0.125, -0.125, -1.005, 3999999.994, 4000000.006, 4.2e6, 5000000.125, 123456789012.345, -7e15]
    values += [rnd.uniform(-1, 1) * 10 ** rnd.randint(-3, 8) for _ in range(3000)] + [rnd.randint(-10**8, 10**8) / 1000 for _ in range(3000)]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    for digits in (1, 2):
        got = {r.i: r.y for r in rows.select("i", to_fixed("x", digits).alias("y")).collect()}
        for i, v in enumerate(values):
            want = float(Decimal(v).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))
            assert got[i] == want, (v, digits)
            assert str(got[i]) != "-0.0"
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (None,)], "x double").select(to_fixed("x", 2)).collect()
    assert [str(r[0]) for r in odd] == ["nan", "inf", "None"]


def test_scenario_totals_are_those_of_decimals(spark):
    """Whole units and the decimals of unusually large values add up to the sum over decimal(28, 2)."""
    rows = [("a", 1.25), ("a", -3.5), ("b", 1.5e14), ("b", 0.25), ("c", -2e20), ("d", None), ("e", None), ("e", 0.01)] + [("f", 99999999.99)] * 1000
    table = spark.createDataFrame(rows, "k string, x double").groupBy("k").agg(_exact_sum("x", 2).alias("got"), F.sum(F.col("x").cast("decimal(28,2)")).alias("want"))
    assert dict(table.dtypes)["got"] == dict(table.dtypes)["want"] == "decimal(38,2)"
    assert all(r.got == r.want for r in table.collect())
