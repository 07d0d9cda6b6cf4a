"""Incremental version history: a batch of facts is spliced into the stored versions."""

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.history import FACT_KEYS, FACT_ORDER, batch_spans, scd2, splice_versions, versions_beside
from ledgerline.operators.slicing import measure
from ledgerline.plans.build import GROUP, GROUPS, TABLES, ticker_group
from ledgerline.sources.versions import WITHOUT_VALUE, TableSet

STATEMENTS = "silver/financial_statements"


def apply_facts(tables: TableSet, facts: DataFrame, name: str = STATEMENTS, groups: int = GROUPS, stamp: str | None = None) -> TableSet:
    """The set with ``facts`` added to the version table ``name``; versions of other keys are not computed anew.

    The batch is written once and read from there. What is looked at comes out of one window, changed or not, and is
    put together with the versions beside it, so that no version is joined with its changes.
    Only partition folders in which a version opens, closes or is split are written again. ``stamp`` names a column
    that gets the time of the run on those versions. The first batch makes the table.
    """
    if name not in tables:
        slicing = measure(facts, FACT_KEYS, [c for c in FACT_ORDER if c in facts.columns])  # before repeated facts go, which needs no shuffle
        now = [F.current_timestamp().alias(stamp)] if stamp else []
        return tables.commit([_written(tables, name, scd2(facts.distinct(), slicing=slicing).select("*", *now), groups)])
    groups = int(tables.tables[name].info["groups"])
    facts = tables.read_written(tables.write(f"batch/{name}", facts))
    touched = _groups_of(facts, groups)
    present = tables.read(name, touched).drop(GROUP)
    carried = [c for c in [stamp] if c in present.columns]
    spans = batch_spans(present, facts)
    spliced = splice_versions(present, facts, spans=spans, unchanged=True, carried=carried)
    if stamp:
        spliced = spliced.withColumn(stamp, F.when(F.col("_new").isNull(), F.col(stamp) if carried else F.lit(None)).otherwise(F.current_timestamp()))
    spliced = tables.read_written(tables.write(f"changed/{name}", spliced))
    touched = _groups_of(spliced.where(F.col("_new").isNotNull()), groups)
    if not touched:
        return tables
    kept = versions_beside(tables.read(name, touched).drop(GROUP), spans)
    around = spliced.where(_group("ticker", groups).isin(touched)).drop("_new")
    written = _written(tables, name, kept.unionByName(around), groups)
    return tables.commit([tables.replace_parts(name, written, touched)])


def _written(tables: TableSet, name: str, df: DataFrame, groups: int):
    table = tables.write(name, df.withColumn(GROUP, ticker_group("ticker", groups)), GROUP, (), TABLES.get(name, ("ticker",)))
    return replace(table, info={"groups": str(groups)})


def _group(ticker: str, groups: int):
    """The name of the partition folder."""
    return F.coalesce(ticker_group(ticker, groups).cast("string"), F.lit(WITHOUT_VALUE))


def _groups_of(df: DataFrame, groups: int) -> list[str]:
    return [r.g for r in df.select(_group("ticker", groups).alias("g")).distinct().collect()]  # no more than there are groups
