"""Upserts that write the batch only: it lands as a delta beside the table and is merged when the table is read.

A delta holds a batch's rows under a growing number. Reading merges column by column: the update columns come from
the last row that landed with a key, all others from the first one - the same table as ``upsert`` makes of the
batches one by one. Partitions that no delta touches are read as they are, without a shuffle; in the others a
delta of few narrow rows is broadcast to the stored rows, a larger one is joined with them by one shuffle of each side.
Compaction writes the merged rows of touched partitions, and only those, as new partition folders.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.quality import expect_unique
from ledgerline.operators.upsert import upsert
from ledgerline.sources.versions import Delta, Table, TableSet

#: Rows of all deltas that are sent to the stored rows; rows hold columns of fixed width then, besides their keys.
BROADCAST_ROWS = 200_000
#: Deltas, and rows in them, beyond which a landing compacts.
MOST_DELTAS, MOST_ROWS = 16, 10_000_000


@dataclass(frozen=True)
class Landing:
    """How a table is landed: its columns, unique keys, refreshed columns and partitions.

    ``partition_of`` makes ``partition_by`` from key columns, so a key stays in its partition. ``touch`` is set on
    every landed row and refreshed with the update columns.
    """

    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    updates: tuple[str, ...]
    partition_by: str
    partition_of: Callable[[], Column]
    touch: str | None = "ingested_at"

    @property
    def refreshed(self) -> list[str]:
        return [*self.updates, *([self.touch] if self.touch else [])]

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


def land_delta(tables: TableSet, landing: Landing, batch: DataFrame, batch_id: str | None = None, touched_at: Column | None = None) -> tuple[TableSet, int]:
    """The set with ``batch`` landed in one table, and the batch's row count; without rows nothing is committed.

    A batch must hold all update columns and no key twice. ``batch_id``, if given, is remembered: a batch that is
    the last one committed under the same id is not landed again. A run that was cut off has committed nothing, so
    repeating it, with the same or other input, lands what it is given.
    """
    if missing := set(landing.updates) - set(batch.columns):
        raise ValueError(f"the batch lacks {sorted(missing)}")
    old = tables.tables.get(landing.name) or Table(landing.name, _stored(landing), landing.partition_by)
    if batch_id is not None and old.info.get("last_batch") == batch_id:
        return tables, int(old.info["last_rows"])
    twice = expect_unique(batch, landing.keys).drop("n_rows").first()
    if twice is not None:
        raise ValueError(f"duplicate key in batch for {landing.name}: {', '.join(map(str, twice))}")
    if landing.touch is not None:
        batch = batch.withColumn(landing.touch, F.current_timestamp() if touched_at is None else touched_at)
    absent = [F.lit(None).cast(f.dataType).alias(f.name) for f in landing.schema if f.name not in batch.columns]
    shaped = batch.select(*[F.col(f.name).cast(f.dataType) for f in landing.schema if f.name in batch.columns], *absent).select(*landing.columns)
    written = tables.write(landing.name, shaped.withColumn(landing.partition_by, landing.partition_of()), landing.partition_by)
    if not written.parts:
        return tables, 0
    number = 1 + int(old.info.get("last_number", 0))
    folder = next(iter(written.parts.values()))
    delta = Delta(folder, number, 0, batch_id or "", tuple(written.parts))
    n_rows = tables.read_delta(landing.name, delta, written).count()  # from the file footers
    info = old.info | {"last_number": str(number), "last_rows": str(n_rows), "last_batch": batch_id or ""}
    made = replace(old, columns=written.columns, deltas=(*old.deltas, replace(delta, n_rows=n_rows)), info=info)
    return tables.commit([made]), n_rows


def read_merged(tables: TableSet, landing: Landing, values: Iterable[str] | None = None) -> DataFrame:
    """The landed table, of all partitions or of ``values`` only, with its partition column."""
    table = tables.tables[landing.name]
    touched = {v for d in table.deltas for v in d.values}
    wanted = set(table.parts) | touched if values is None else set(values)
    plain = tables.read(landing.name, sorted(wanted - touched))
    if not touched & wanted:
        return plain
    stored = tables.read(landing.name, sorted(wanted & touched))
    batch = _combined(tables, landing, table, None if values is None else wanted)
    if sum(d.n_rows for d in table.deltas) <= BROADCAST_ROWS and _narrow(landing):
        merged = _broadcast_merge(stored, batch, landing)
    else:
        merged = upsert(stored.select(*landing.columns), batch, landing.keys, landing.refreshed, touch_col=None)
    merged = merged.withColumn(landing.partition_by, landing.partition_of().cast(table.columns[landing.partition_by].dataType))
    return plain.unionByName(merged.select(*plain.columns))


def compact(tables: TableSet, landing: Landing) -> TableSet:
    """The set with all deltas of a table merged into the partitions they touch; the folders of all others stay."""
    table = tables.tables[landing.name]
    touched = sorted({v for d in table.deltas for v in d.values})
    if not touched:
        return tables
    merged = read_merged(tables, landing, touched)
    written = tables.write(landing.name, merged, landing.partition_by)
    return tables.commit([replace(tables.replace_parts(landing.name, written, touched), deltas=())])


def compact_when_full(tables: TableSet, landing: Landing, most_deltas: int = MOST_DELTAS, most_rows: int = MOST_ROWS) -> TableSet:
    table = tables.tables.get(landing.name)
    full = table is not None and (len(table.deltas) > most_deltas or sum(d.n_rows for d in table.deltas) > most_rows)
    return compact(tables, landing) if full else tables


def _stored(landing: Landing) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in landing.schema])


def _narrow(landing: Landing) -> bool:
    """Whether all columns besides the keys have a fixed width."""
    others = [f.dataType for f in landing.schema if f.name not in landing.keys]
    return all(isinstance(t, (T.NumericType, T.DateType, T.TimestampType, T.BooleanType)) for t in others)


def _combined(tables: TableSet, landing: Landing, table: Table, values: set[str] | None) -> DataFrame:
    """All deltas as one batch: of each key the first row's values, and the last one's in the refreshed columns."""
    parts = [tables.read_delta(landing.name, d).withColumn("_number", F.lit(d.number)) for d in table.deltas]
    rows = reduce(DataFrame.unionByName, parts)
    if values is not None:
        rows = rows.where(F.coalesce(F.col(landing.partition_by).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")).isin(*values))
    rows = rows.select(*landing.columns, "_number")
    if len(parts) == 1:
        return rows.drop("_number")
    # Column by column, so that values of fixed width are aggregated in hash tables.
    picked = [(F.max_by if c in landing.refreshed else F.min_by)(c, "_number").alias(c) for c in landing.columns if c not in landing.keys]
    once = rows.dropna(subset=list(landing.keys)).groupBy(*landing.keys).agg(*picked)
    loose = rows.where(~F.expr(" and ".join(f"`{k}` is not null" for k in landing.keys)))
    return once.select(*landing.columns).unionByName(loose.select(*landing.columns))


def _broadcast_merge(stored: DataFrame, batch: DataFrame, landing: Landing) -> DataFrame:
    """The stored rows with the batch broadcast to them, and the batch's keys that they lack."""
    keys = list(landing.keys)
    new = F.broadcast(batch.dropna(subset=keys).select(*keys, F.struct(*landing.refreshed).alias("_new")))
    kept = [F.when(F.col("_new").isNotNull(), F.col("_new").getField(c)).otherwise(F.col(c)).alias(c) if c in landing.refreshed else F.col(c) for c in landing.columns]
    updated = stored.join(new, keys, "left").select(*kept)
    known = stored.select(*keys).join(F.broadcast(batch.select(*keys)), keys, "left_semi")  # no more rows than the batch has
    inserted = batch.join(F.broadcast(known), keys, "left_anti")
    return updated.unionByName(inserted.select(*landing.columns))
