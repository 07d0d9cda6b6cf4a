"""Facts spliced into a version history against the history made of all facts at once."""

import datetime as dt
import random
from decimal import Decimal as D

import pytest

from ledgerline.operators.history import batch_spans, scd2, splice_versions, versions_beside
from ledgerline.plans.history import STATEMENTS, apply_facts
from ledgerline.sources.versions import TableSet

SCHEMA = (
    "ticker string, cik string, gaap_tag string, form_type string, fiscal_year int, fiscal_period string, filed_date date, "
    "period_start_date date, period_end_date date, amount decimal(20,2), accession_number string"
)


def fact(rng, n):
    filed = rng.choice([None, *[dt.date(2024, 1, 1) + dt.timedelta(days=rng.randint(0, 6)) for _ in range(12)]])
    return (rng.choice(["A", "B", "C", None]), "1", rng.choice(["Assets", "Liabilities"]), "10-K", 2023, rng.choice(["FY", None]), filed, None, None, D(rng.randint(0, 3)), rng.choice([f"a{n}", f"a{n % 5}", None]))


def rows(df):
    names = sorted(c for c in df.columns if c != "_new")
    return sorted(map(str, (tuple(r[c] for c in names) for r in df.collect())))


@pytest.mark.parametrize("seed", range(2))
def test_batches_in_any_order_equal_the_whole(spark, tmp_path, seed):
    rng = random.Random(seed)
    facts = [fact(rng, n) for n in range(90)]
    batches = [facts[k::10] for k in range(10)]
    rng.shuffle(batches)
    batches[5] += batches[2]  # some come twice
    tables = TableSet(spark, str(tmp_path / "t"))
    if seed % 2:
        spark.conf.set("spark.ledgerline.rowsPerGroup", "4")
    try:
        so_far = []
        for k, batch in enumerate(batches):
            so_far += batch
            tables = apply_facts(tables, spark.createDataFrame(batch, SCHEMA), groups=3)
            if k in (1, 5, 9):
                expected = scd2(spark.createDataFrame(so_far, SCHEMA).distinct(), slicing=None)
                assert rows(tables.read(STATEMENTS).drop("ticker_group")) == rows(expected)
    finally:
        spark.conf.unset("spark.ledgerline.rowsPerGroup")


def version(k, day, end, current, amount=1):
    return ("A", "1", "Assets", "10-K", 2023, "FY", day, None, None, D(amount), f"a{k}", end, current)


def test_only_versions_around_a_new_fact_change(spark):
    day = lambda k: dt.date(2024, 1, k)
    facts = [("A", "1", "Assets", "10-K", 2023, "FY", day(k), None, None, D(1), f"a{k}") for k in (2, 4, 6, 8)]
    versions = scd2(spark.createDataFrame(facts, SCHEMA), slicing=None)

    def changes(*new):
        found = splice_versions(versions, spark.createDataFrame([("A", "1", "Assets", "10-K", 2023, "FY", d, None, None, D(1), a) for d, a in new], SCHEMA), slicing=None)
        return sorted((str(r.valid_from), str(r.valid_to), r.is_current, r._new) for r in found.collect())

    forever = "9999-12-31"
    assert changes((day(5), "x")) == [("2024-01-04", "2024-01-05", False, False), ("2024-01-05", "2024-01-06", False, True)]
    assert changes((day(1), "x")) == [("2024-01-01", "2024-01-02", False, True)]
    assert changes((day(9), "x")) == [("2024-01-08", "2024-01-09", False, False), ("2024-01-09", forever, True, True)]
    assert changes((None, "x")) == [("2024-01-08", forever, False, False), ("None", forever, True, True)]
    assert changes((day(4), "a4")) == []
    assert changes((day(1), "x"), (day(7), "y")) == [("2024-01-01", "2024-01-02", False, True), ("2024-01-06", "2024-01-07", False, False), ("2024-01-07", "2024-01-08", False, True)]


def test_untouched_folders_stay(spark, tmp_path):
    rng = random.Random(9)
    tables = apply_facts(TableSet(spark, str(tmp_path / "t")), spark.createDataFrame([(f"T{k}", *fact(rng, k)[1:]) for k in range(40)], SCHEMA), groups=8)
    before = tables.tables[STATEMENTS].parts
    tables = apply_facts(tables, spark.createDataFrame([("T3", *fact(rng, 99)[1:])], SCHEMA))
    after = tables.tables[STATEMENTS].parts
    assert sum(before[v] != after[v] for v in before) == 1


def test_what_is_looked_at_and_what_lies_beside_are_the_whole(spark):
    rng = random.Random(4)
    facts = [fact(rng, n) for n in range(60)]
    versions = scd2(spark.createDataFrame(facts[:50], SCHEMA).distinct(), slicing=None)
    batch = spark.createDataFrame(facts[50:] + facts[45:55], SCHEMA)
    spans = batch_spans(versions, batch)
    around = splice_versions(versions, batch, slicing=None, spans=spans, unchanged=True)
    assert around.where("_new is null").count() > 0
    expected = scd2(spark.createDataFrame(facts, SCHEMA).distinct(), slicing=None)
    assert rows(versions_beside(versions, spans).unionByName(around.drop("_new"))) == rows(expected)


def test_a_splice_moves_both_sides_once(spark):
    facts = spark.createDataFrame([fact(random.Random(5), n) for n in range(20)], SCHEMA)
    versions = spark.createDataFrame(scd2(facts.distinct(), slicing=None).collect(), scd2(facts, slicing=None).schema)
    plan = splice_versions(versions, facts, slicing=None)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan


def test_versions_that_stay_keep_their_stamp(spark, tmp_path):
    day = lambda k: dt.date(2024, 1, k)
    facts = [("A", "1", "Assets", "10-K", 2023, "FY", day(k), None, None, D(1), f"a{k}") for k in (2, 4, 6, 8)]
    tables = apply_facts(TableSet(spark, str(tmp_path / "t")), spark.createDataFrame(facts, SCHEMA), stamp="made_at")
    before = {r.valid_from.day: r.made_at for r in tables.read(STATEMENTS).collect()}
    tables = apply_facts(tables, spark.createDataFrame([("A", "1", "Assets", "10-K", 2023, "FY", day(5), None, None, D(1), "x")], SCHEMA), stamp="made_at")
    after = {r.valid_from.day: r.made_at for r in tables.read(STATEMENTS).collect()}
    assert sorted(after) == [2, 4, 5, 6, 8] and {k for k in before if after[k] == before[k]} == {2, 6, 8}
