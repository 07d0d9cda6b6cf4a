"""Writing upserts to Parquet tables."""

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from ledgerline.operators.upsert import upsert


def empty_table(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


def land(target: DataFrame, batch: DataFrame, out_path: str, keys, update_cols, **options) -> int:
    """Write ``target`` after the upsert to a new location; returns the batch's row count.

    ``out_path`` must not be where ``target`` is read from.
    """
    seen = Observation()
    counted = batch.observe(seen, F.count(F.lit(1)).alias("rows"))
    upsert(target, counted, keys, update_cols, **options).write.mode("overwrite").parquet(out_path)
    return seen.get["rows"]


def land_partitions(
    spark: SparkSession,
    table_path: str,
    schema,
    batch: DataFrame,
    staging_path: str,
    run_id: str,
    keys,
    update_cols,
    partition_col: str,
    partition_of,
    **options,
) -> int:
    """Upsert into a partitioned table, rewriting only the partitions the batch touches.

    Returns the batch's row count; without rows nothing new is written.

    ``partition_of`` computes ``partition_col`` from key columns, so a key never changes its
    partition. A daily batch with a few days of lookback rewrites one or two months of a
    table of any length.

    The new partitions are written to ``staging_path``, marked as staged under ``run_id``,
    copied over the old ones, and marked as copied. Only a run that was cut off between the
    two marks is resumed, by the same ``run_id`` with a batch of the same rows: it copies again. Every other
    call upserts its batch, also under a ``run_id`` that has been used before. The copy replaces partition by
    partition, so readers should wait for it to end.
    """
    staged, done = f"{staging_path}/rows", f"{staging_path}/done"
    marker = read_if_there(spark, done)
    batch = batch.withColumn(partition_col, partition_of)
    # No more values than the table has partitions.
    content = F.sum(F.xxhash64(*batch.columns).cast("decimal(38,0)")).alias("content")
    sizes = batch.groupBy(partition_col).agg(F.count(F.lit(1)).alias("count"), content).collect()
    rows_landed = sum(row["count"] for row in sizes)
    digest = f"{rows_landed} {sum(int(row['content']) for row in sizes)}"
    same = (F.col("run_id") == run_id) & (F.col("state") == "staged") & (F.col("digest") == digest)
    if marker is None or "digest" not in marker.columns or marker.where(same).isEmpty():
        if not rows_landed:
            return 0
        old = read_if_there(spark, table_path)
        if old is None:
            old = empty_table(spark, schema).withColumn(partition_col, partition_of)
        # As literals the values prune the listing, so untouched partitions are not read.
        touched = [row[0] for row in sizes]
        inside = F.col(partition_col).isin([value for value in touched if value is not None])
        if None in touched:
            inside = inside | F.col(partition_col).isNull()
        current = old.where(inside).select(*schema.fieldNames())
        merged = upsert(current, batch.drop(partition_col), keys, update_cols, **options)
        merged.withColumn(partition_col, partition_of).write.mode("overwrite").partitionBy(partition_col).parquet(staged)
        _mark(spark, done, run_id, "staged", digest)
    rows = read_if_there(spark, staged)
    if rows is not None:
        (
            # computed again: a column of null partition values only is read back without a type
            rows.withColumn(partition_col, partition_of)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition_col)
            .parquet(table_path)
        )
    _mark(spark, done, run_id, "copied", digest)
    return rows_landed


def _mark(spark, path, run_id, state, digest):
    spark.createDataFrame([(run_id, state, digest)], "run_id string, state string, digest string").write.mode("overwrite").parquet(path)


def read_if_there(spark, path):
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
