"""Data-quality checks."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def expect_not_null(df: DataFrame, cols) -> DataFrame:
    """One row per column: ``column_name, failures, should_warn, should_error``.

    All columns are checked in a single pass.
    """
    cols = list(cols)
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("failures")) for i, c in enumerate(cols)])
    return counted.select(F.inline(rows)).select(
        "column_name",
        "failures",
        (F.col("failures") != 0).alias("should_warn"),
        (F.col("failures") != 0).alias("should_error"),
    )


def expect_unique(df: DataFrame, cols, two_pass: bool = False) -> DataFrame:
    """The key values that occur more than once, with ``n_rows``; empty when unique.

    As for a SQL unique constraint, keys with a null part never collide.

    ``two_pass`` is for wide keys: a first pass shuffles one 64-bit hash for each key, a second one, which reads the rows
    again, only the keys whose hash came twice, so of a table with few repetitions hardly any key is moved.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    if two_pass:
        whole = df.dropna(subset=cols)
        hashed = F.xxhash64(*cols)
        again = whole.select(hashed.alias("_hash")).groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("_hash")
        suspect = whole.select(*cols, hashed.alias("_hash")).join(again, "_hash", "left_semi")
        return suspect.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)
    return df.dropna(subset=cols).groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)
