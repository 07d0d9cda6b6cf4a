"""Sets of Parquet tables that change together, version by version.

Every write goes to a fresh folder below the table's own, and one commit record says which folders make up
which table. The record is a single file that appears by one rename after all its folders are complete, so a
reader sees the last committed set, whole and unchanged, at any moment of a write or after one that was cut
off. A partitioned table is a list of partition folders, which may come from different writes: a
commit that replaces some of them leaves the files of all others, and their names, as they are.

One writer at a time: a commit names the version it is based on and is refused if another came in between.
Folders that no record names any more are not removed here.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The partition column that stands for the write a folder comes from.
WRITE = "ledgerline_write"
CODEC = "zstd"
WITHOUT_VALUE = "__HIVE_DEFAULT_PARTITION__"
_PLAIN = re.compile(r"[A-Za-z0-9_.\-]+")

_LOG = """version bigint, token string, base bigint, tables array<struct<
    name: string, columns: string, partition_by: string,
    parts: array<struct<value: string, folder: string>>,
    deltas: array<struct<folder: string, number: bigint, n_rows: bigint, batch: string, values: array<string>>>,
    info: map<string, string>>>"""


class ConcurrentCommit(RuntimeError):
    """Another writer committed first."""


@dataclass(frozen=True)
class Delta:
    """One landed batch that is merged when the table is read."""

    folder: str
    number: int
    n_rows: int
    batch: str
    values: tuple[str, ...]


@dataclass(frozen=True)
class Table:
    """The folders of one table. ``parts`` maps partition values (as in folder names) to the write they come from."""

    name: str
    columns: T.StructType
    partition_by: str | None = None
    parts: dict[str | None, str] = field(default_factory=dict)
    deltas: tuple[Delta, ...] = ()
    info: dict[str, str] = field(default_factory=dict)


class TableSet:
    """The tables below one folder, as of the last commit when it was made (or of ``version``)."""

    def __init__(self, spark: SparkSession, root: str, version: int | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.version, self.tables = 0, {}
        row = self._record(version)
        if row is not None:
            self.version, self.tables = row.version, {t.name: _table(t) for t in row.tables}
        elif version is not None:
            raise ValueError(f"{root} has no version {version}")

    @property
    def names(self) -> list[str]:
        return sorted(self.tables)

    def __contains__(self, name: str) -> bool:
        return name in self.tables

    def read(self, name: str, where: Iterable[str] | None = None) -> DataFrame:
        """The table's columns; of ``where`` partition values only, whose folders alone are listed."""
        return self.read_written(self.tables[name], where)

    def read_written(self, table: Table, where: Iterable[str] | None = None) -> DataFrame:
        """A table that need not be committed yet."""
        chosen = table.parts if where is None else {v: table.parts[v] for v in where if v in table.parts}
        return self._folders(table, [f"{self.root}/{table.name}/{WRITE}={write}" + _below(table, value) for value, write in chosen.items()])

    def read_delta(self, name: str, delta: Delta, table: Table | None = None) -> DataFrame:
        """A landed batch; ``table`` stands for one that is not committed yet."""
        table = table or self.tables[name]
        return self._folders(table, [f"{self.root}/{name}/{WRITE}={delta.folder}"])

    def _folders(self, table: Table, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], table.columns)
        schema = T.StructType([*table.columns.fields, T.StructField(WRITE, T.StringType())])
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{table.name}").parquet(*sorted(folders)).select(*table.columns.fieldNames())

    def write(self, name: str, df: DataFrame, partition_by: str | None = None, bloom: Iterable[str] = (), sort=(), spread: bool = True) -> Table:
        """Write ``df`` to a fresh folder. Nothing shows until the returned table is committed.

        A partitioned write spreads the rows over the partition values by a rebalance, which adaptive execution
        splits where a value has many rows; ``spread=False`` leaves out that shuffle, for rows whose tasks hold few
        values each already. ``bloom`` columns get Bloom filters, ``sort`` orders each file. Files are compressed with
        zstd, which also takes the keys' hexadecimal digits to half their length.
        """
        write = uuid.uuid4().hex
        folder = f"{self.root}/{name}/{WRITE}={write}"
        if partition_by is not None and spread:
            df = df.hint("rebalance", F.col(partition_by))
        if sort:
            df = df.sortWithinPartitions(*([partition_by] if partition_by else []), *sort)
        writer = df.write.option("compression", CODEC)
        for column in bloom:
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(folder)
        return Table(name, _nullable(df.schema), partition_by, dict.fromkeys(self._values(folder, partition_by, df.schema), write))

    def _values(self, folder: str, partition_by: str | None, schema: T.StructType) -> list[str | None]:
        """The partition values of a written folder, read from its listing."""
        if partition_by is None:
            return [None]
        rows = self.spark.read.schema(schema).parquet(folder).select(F.col(partition_by).cast("string").alias("v")).distinct().collect()
        values = [WITHOUT_VALUE if r.v is None else r.v for r in rows]
        if odd := [v for v in values if not _PLAIN.fullmatch(v)]:
            raise ValueError(f"partition values of {partition_by} may hold letters, digits and ._- only: {odd[:3]}")
        return values

    def commit(self, tables: Iterable[Table], drop: Iterable[str] = ()) -> TableSet:
        """The set with ``tables`` put in (whole, as given) and those named in ``drop`` left out; all others stay."""
        new = {n: t for n, t in self.tables.items() if n not in set(drop)} | {t.name: t for t in tables}
        number, token = self.version + 1, uuid.uuid4().hex
        latest = self._record()
        if (latest.version if latest else 0) != self.version:
            raise ConcurrentCommit(f"{self.root} is at version {latest.version}, not {self.version}")
        rows = [(t.name, t.columns.json(), t.partition_by, [(v, w) for v, w in t.parts.items()], [(d.folder, d.number, d.n_rows, d.batch, list(d.values)) for d in t.deltas], t.info) for t in new.values()]
        record = self.spark.createDataFrame([(number, token, self.version, rows)], _LOG).coalesce(1)
        record.write.mode("append").json(f"{self.root}/commits")
        if self._record(number).token != token:
            raise ConcurrentCommit(f"another writer made version {number} of {self.root}")
        made = TableSet.__new__(TableSet)
        made.spark, made.root, made.version, made.tables = self.spark, self.root, number, new
        return made

    def paths(self, name: str) -> list[str]:
        """The folders that a table's rows lie in."""
        table = self.tables[name]
        return sorted({f"{self.root}/{name}/{WRITE}={write}" for write in table.parts.values()})

    def replace_parts(self, name: str, written: Table, gone: Iterable[str] = ()) -> Table:
        """The table with the partitions of ``written`` in place of its own, and without those of ``gone``."""
        old = self.tables[name]
        parts = {v: w for v, w in old.parts.items() if v not in set(gone)} | written.parts
        return replace(old, parts=parts)

    def _record(self, version: int | None = None):
        try:
            log = self.spark.read.schema(_LOG).json(f"{self.root}/commits")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        log = log if version is None else log.where(F.col("version") == version)
        return log.orderBy(F.desc("version"), "token").limit(1).first()


def _below(table: Table, value: str | None) -> str:
    return "" if table.partition_by is None else f"/{table.partition_by}={value}"


def _nullable(schema: T.StructType) -> T.StructType:
    """What Parquet gives back: every column may be null."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def _table(row) -> Table:
    return Table(
        row.name,
        T.StructType.fromJson(json.loads(row.columns)),
        row.partition_by,
        {p["value"]: p["folder"] for p in row.parts},
        tuple(Delta(d["folder"], d["number"], d["n_rows"], d["batch"], tuple(d["values"])) for d in row.deltas),
        dict(row.info),
    )
