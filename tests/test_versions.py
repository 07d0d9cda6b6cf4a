"""Versioned table sets and upserts merged on read."""

import datetime as dt
import itertools
import random
from decimal import Decimal as D
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.operators.upsert import upsert
from ledgerline.plans.ingest import PRICES
from ledgerline.sources import merge_on_read
from ledgerline.sources.merge_on_read import compact, compact_when_full, land_delta, read_merged
from ledgerline.sources.versions import ConcurrentCommit, TableSet
from tests.test_landing import prices

OLD = dt.datetime(2024, 1, 1)


def files(root):
    return {str(p) for p in Path(root).rglob("*.parquet")}


def numbers(spark, *rows):
    return spark.createDataFrame(list(rows), "k int, v string")


def test_an_empty_set(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path / "t"))
    assert (tables.version, tables.names) == (0, [])
    with pytest.raises(ValueError, match="no version 3"):
        TableSet(spark, str(tmp_path / "t"), 3)


def test_readers_see_the_last_commit_only(spark, tmp_path):
    root = str(tmp_path / "t")
    tables = TableSet(spark, root)
    first = tables.commit([tables.write("a", numbers(spark, (1, "x"))), tables.write("b", numbers(spark, (1, "x"), (2, "y")), "k")])
    assert first.version == 1 and TableSet(spark, root).names == ["a", "b"]
    reader = TableSet(spark, root)
    a = first.write("a", numbers(spark, (5, "new")))  # cut off here: one of two tables is written
    assert [tuple(r) for r in TableSet(spark, root).read("a").collect()] == [(1, "x")]
    second = first.commit([a, first.write("b", numbers(spark, (7, "z")), "k")])
    assert [tuple(r) for r in TableSet(spark, root).read("a").collect()] == [(5, "new")]
    assert sorted(tuple(r) for r in reader.read("b").collect()) == [(1, "x"), (2, "y")]  # still readable, still the old set
    assert sorted(tuple(r) for r in TableSet(spark, root, 1).read("b").collect()) == [(1, "x"), (2, "y")]
    assert [f.name for f in second.read("b").schema] == ["k", "v"]


def test_only_replaced_partitions_change(spark, tmp_path):
    root = str(tmp_path / "t")
    tables = TableSet(spark, root)
    rows = spark.createDataFrame([(k, f"v{k}", k % 4) for k in range(20)] + [(99, "none", None)], "id int, v string, k int")
    tables = tables.commit([tables.write("a", rows, "k")])
    before = tables.tables["a"].parts
    written = tables.write("a", rows.where("k = 2").withColumn("v", F.lit("new")), "k")
    tables = tables.commit([tables.replace_parts("a", written, gone=["1"])])
    after = TableSet(spark, root).tables["a"].parts
    assert set(after) == {"0", "2", "3", "__HIVE_DEFAULT_PARTITION__"}
    assert {k: v for k, v in after.items() if k != "2"} == {k: v for k, v in before.items() if k not in "12"}
    got = {(r.id, r.v, r.k) for r in TableSet(spark, root).read("a").collect()}
    assert got == {(k, "new" if k % 4 == 2 else f"v{k}", k % 4) for k in range(20) if k % 4 != 1} | {(99, "none", None)}
    assert {r.id % 4 for r in tables.read("a", ["3", "1"]).collect()} == {3}


def test_a_second_writer_is_refused(spark, tmp_path):
    root = str(tmp_path / "t")
    one, other = TableSet(spark, root), TableSet(spark, root)
    one.commit([one.write("a", numbers(spark, (1, "x")))])
    with pytest.raises(ConcurrentCommit):
        other.commit([other.write("a", numbers(spark, (2, "y")))])
    assert TableSet(spark, root).read("a").first().k == 1


def test_tables_without_rows(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path / "t"))
    tables = tables.commit([tables.write("a", numbers(spark)), tables.write("b", numbers(spark), "k")])
    for name in ("a", "b"):
        assert TableSet(spark, str(tmp_path / "t")).read(name).collect() == []


def test_partition_values_must_be_plain(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError, match="letters"):
        tables.write("a", numbers(spark, (1, "a/b")), "v")


# ---- merge on read


def price(ticker, day, adj, open_="1", stamp=OLD):
    return (ticker, day, None if open_ is None else D(open_), D(1), D(1), D(1), D(adj), 10, D(0), D(1), stamp)


def batches(rng):
    days = [dt.date(2024, m, d) for m in (1, 2, 3, 4) for d in (1, 9)]
    keys = list(itertools.product(["A", "B", "C"], days))
    return [[price(t, d, str(k), rng.choice(["1", "2", None]), dt.datetime(2024, 5, 1 + n)) for k, (t, d) in enumerate(rng.sample(keys, rng.randint(1, 9)))] for n in range(7)]


def plain(df):
    return sorted(map(str, (tuple(r) for r in df.select(*S.RAW_MARKET_PRICES.fieldNames()).collect())))


@pytest.mark.parametrize("broadcast", [0, 200_000])
def test_merging_equals_upserts(spark, tmp_path, monkeypatch, broadcast):
    monkeypatch.setattr(merge_on_read, "BROADCAST_ROWS", broadcast)
    root, expected = str(tmp_path / "t"), prices(spark)
    tables = TableSet(spark, root)
    for n, rows in enumerate(batches(random.Random(broadcast))):
        batch = prices(spark, *rows)
        stamp = F.lit(rows[0][-1])
        expected = spark.createDataFrame(upsert(expected, batch, S.PRICE_KEYS, S.PRICE_UPDATES, touched_at=stamp).collect(), S.RAW_MARKET_PRICES)
        tables, landed = land_delta(tables, PRICES, batch.drop("ingested_at"), str(n), stamp)
        assert landed == len(rows)
        assert plain(read_merged(TableSet(spark, root), PRICES)) == plain(expected)
        if n == 3:
            tables = compact(tables, PRICES)
            assert not tables.tables["raw_market_prices"].deltas
            assert plain(read_merged(TableSet(spark, root), PRICES)) == plain(expected)
    months = read_merged(tables, PRICES, ["2024-02", "2024-04"])
    assert plain(months) == plain(expected.where("month(trade_date) in (2, 4)"))


def test_a_batch_writes_its_own_rows_only(spark, tmp_path):
    root = str(tmp_path / "t")
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(90)]
    tables, _ = land_delta(TableSet(spark, root), PRICES, prices(spark, *[price("A", d, "1") for d in days]))
    tables = compact(tables, PRICES)
    before, parts = files(root), tables.tables["raw_market_prices"].parts
    tables, n = land_delta(tables, PRICES, prices(spark, price("A", days[3], "7")))
    new = files(root) - before
    assert n == 1 and len(new) == 1 and spark.read.parquet(*new).count() == 1
    assert tables.tables["raw_market_prices"].parts == parts
    assert read_merged(tables, PRICES).where("adj_close = 7").count() == 1
    text = read_merged(tables, PRICES)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text
    after = compact(tables, PRICES).tables["raw_market_prices"].parts
    assert {v for v in parts if parts[v] != after[v]} == {"2024-01"}


def test_compaction_follows_size(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path / "t"))
    for k in range(3):
        tables, _ = land_delta(tables, PRICES, prices(spark, price("A", dt.date(2024, 1, 1 + k), "1")))
    assert compact_when_full(tables, PRICES) is tables
    tables = compact_when_full(tables, PRICES, most_deltas=2)
    assert not tables.tables["raw_market_prices"].deltas
    tables, _ = land_delta(tables, PRICES, prices(spark, *[price("A", dt.date(2024, 2, k), "1") for k in (1, 2, 3)]))
    assert not compact_when_full(tables, PRICES, most_rows=2).tables["raw_market_prices"].deltas


def test_landing_again(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path / "t"))
    tables, n = land_delta(tables, PRICES, prices(spark, price("A", dt.date(2024, 1, 1), "1")), "run")
    same, n_again = land_delta(tables, PRICES, prices(spark, price("A", dt.date(2024, 1, 1), "1")), "run")
    assert same is tables and (n, n_again) == (1, 1)
    assert land_delta(tables, PRICES, prices(spark))[1] == 0
    with pytest.raises(ValueError, match="duplicate key in batch for raw_market_prices: A, 2024-01-02"):
        land_delta(tables, PRICES, prices(spark, *[price("A", dt.date(2024, 1, 2), "1")] * 2))
    with pytest.raises(ValueError, match="lacks"):
        land_delta(tables, PRICES, prices(spark).drop("volume"))


def test_a_landing_that_fails_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    tables, _ = land_delta(TableSet(spark, root), PRICES, prices(spark, price("A", dt.date(2024, 1, 1), "1")))
    broken = prices(spark, price("A", dt.date(2024, 1, 1), "9")).withColumn("volume", F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(PySparkException, match="lost"):
        land_delta(tables, PRICES, broken)
    again = TableSet(spark, root)
    assert again.version == 1 and read_merged(again, PRICES).first().adj_close == 1


def test_rows_without_a_key_are_always_inserted(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path / "t"))
    for n in range(2):
        rows = spark.createDataFrame([(None, dt.date(2024, 1, 1), D(n)), ("A", None, D(n)), ("A", dt.date(2024, 1, 1), D(n))], "ticker string, trade_date date, adj_close decimal(14,4)")
        others = [F.lit(1).alias(c) for c in ("volume", "dividend_amount", "split_coefficient")]
        tables, _ = land_delta(tables, PRICES, rows.select("*", *others))
    assert read_merged(tables, PRICES).count() == 5
    tables = compact(tables, PRICES)
    assert read_merged(tables, PRICES).count() == 5
