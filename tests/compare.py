"""Compare a Spark frame with a DuckDB result as multisets of typed rows."""

from collections import Counter
from pathlib import Path

import duckdb


def duck(sf_dir):
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def rows_of_spark(df):
    names = sorted(df.columns)
    return names, Counter(tuple(r[n] for n in names) for r in df.collect())


def rows_of_duck(connection, sql):
    cursor = connection.execute(sql)
    columns = [c[0] for c in cursor.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(r[i] for i in order) for r in cursor.fetchall())


def types_of_duck(connection, sql):
    return {r[0]: r[1] for r in connection.execute(f"describe {sql}").fetchall()}
