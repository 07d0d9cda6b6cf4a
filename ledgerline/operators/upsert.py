"""Column-selective upsert."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.history import latest_per_key


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys,
    update_cols,
    touch_col: str | None = "ingested_at",
    touched_at=None,
    latest_by=None,
) -> DataFrame:
    """``target`` after ``INSERT .. ON CONFLICT (keys) DO UPDATE SET update_cols``.

    * a new key is inserted with all its batch values;
    * for a known key only ``update_cols`` take the batch value. Every other column keeps
      what was landed first, also when that was null;
    * ``touch_col`` is set to ``touched_at`` (default: now) on inserted and updated rows;
    * rows with a null key part never conflict and are always inserted.

    A batch must not hold a key twice: the running job fails if it does, unless
    ``latest_by`` names the columns by which the last duplicate is kept. The check shares
    the shuffle of the join and filters its rows, so it runs whatever is selected later.
    """
    keys = list(keys)
    now = F.current_timestamp() if touched_at is None else touched_at
    if touch_col is not None and touch_col not in batch.columns:
        batch = batch.withColumn(touch_col, F.lit(None).cast(target.schema[touch_col].dataType))
    batch = batch.select(*[F.col(f.name).cast(f.dataType) for f in target.schema if f.name in batch.columns])

    keyed = batch.dropna(subset=keys)
    if latest_by is not None:
        keyed = latest_per_key(keyed, keys, latest_by)
    values = [c for c in batch.columns if c not in keys]
    # A row with another one of its key behind it fails the job. The window shares the shuffle and the sort of the join.
    again = F.lead(F.lit(True)).over(Window.partitionBy(*keys).orderBy(*keys))
    message = F.concat(F.lit("duplicate key in batch: "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))
    checked = (
        keyed.withColumn("_again", again)
        .where(F.when(F.col("_again"), F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
        .select(*keys, F.struct(F.lit(True).alias("_present"), *values).alias("_new"))
    )
    old = target.select(*keys, F.struct(F.lit(True).alias("_present"), *[c for c in target.columns if c not in keys]).alias("_old"))
    joined = old.join(checked, keys, "full")

    is_old = F.col("_old").isNotNull()
    is_new = F.col("_new").isNotNull()

    def merged(field):
        if field.name in keys:
            return F.col(field.name)
        before = F.col("_old").getField(field.name)
        if field.name not in batch.columns:
            return before.alias(field.name)
        after = F.col("_new").getField(field.name)
        if field.name == touch_col:
            value = F.when(is_new, now.cast(field.dataType)).otherwise(before)
        elif field.name in update_cols:
            value = F.when(is_new, after).otherwise(before)
        else:
            value = F.when(is_old, before).otherwise(after)
        return value.alias(field.name)

    result = joined.select(*[merged(f) for f in target.schema])
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    loose = batch.where(any_null)
    if touch_col is not None:
        loose = loose.withColumn(touch_col, now.cast(target.schema[touch_col].dataType))
    return result.unionByName(loose, allowMissingColumns=True).select(*target.columns)
