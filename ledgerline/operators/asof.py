"""As-of join: for each left row the latest right row that is not after it."""

import warnings

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.columns import ascending
from ledgerline.operators.slicing import count_not_above, order_key, resolve
from ledgerline.session import shared_dir

# Bounds for the broadcast form, all checked against the data before it is used.
BROADCAST_ROWS = 1_000_000
BROADCAST_ROWS_PER_KEY = 512
BROADCAST_BYTES = 256 * 1024 * 1024
# Rows of a packed array; a power of two.
CHUNK = 1024


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on,
    left_time: str,
    right_time: str,
    tiebreak=(),
    strategy: str = "window",
    slicing="auto",
    rows_at_most: int | None = None,
) -> DataFrame:
    """Left outer as-of join; every left row appears exactly once.

    Among right rows of equal time the last by ``tiebreak`` wins (nulls count as last).
    Right rows without a time never match. Apart from ``on`` the column names of both
    sides must differ.

    ``strategy``:

    * ``"window"`` unions both sides and carries the last right row forward in one shuffle
      and one sort. It is linear in the rows of both sides, and oversized keys are sliced.
    * ``"packed"`` packs the right rows of a key into sorted arrays of at most :data:`CHUNK` rows and
      finds each left row's match by binary search, first among the arrays, then inside one. Work per
      left row grows with the logarithm of its key's right rows, whose number has no bound. The left
      side is moved only if the arrays are measured to be too large to broadcast, and then by key and
      array, so a large key is spread over as many tasks as it has arrays.
    * ``"range"`` turns right rows into validity ranges and broadcasts them, so the left
      side is not moved at all. Only taken when the right side is measured to be small in
      total and per key, otherwise the window form runs, with a warning.
    """
    on = [on] if isinstance(on, str) else list(on)
    clash = (set(left.columns) & set(right.columns)) - set(on)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    if strategy not in ("window", "range", "packed"):
        raise ValueError("strategy must be 'window', 'range' or 'packed'")
    right = right.dropna(subset=[*on, right_time])
    if strategy == "packed":
        return _packed_form(left, right, on, left_time, right_time, tiebreak)
    if strategy == "range":
        if fits_broadcast(right, on):
            return _range_form(left, right, on, left_time, right_time, tiebreak)
        warnings.warn("the right side is too large to broadcast: the window form runs", stacklevel=2)
    return _window_form(left, right, on, left_time, right_time, tiebreak, slicing, rows_at_most)


def _window_form(left, right, on, left_time, right_time, tiebreak, slicing, rows_at_most):
    values = [c for c in right.columns if c not in on]
    ties = [f"_tie{i}" for i in range(len(tiebreak))]
    probes = left.withColumns({"_at": F.col(left_time), "_side": F.lit(1)})
    # Left rows of one key and time may be cut anywhere, so their content extends the order.
    plain = [f.name for f in left.schema if isinstance(f.dataType, T.AtomicType)]
    spread = F.xxhash64(*plain)
    known = right.select(
        *on,
        F.col(right_time).alias("_at"),
        F.lit(0).alias("_side"),
        *[F.col(c).alias(t) for c, t in zip(tiebreak, ties)],
        F.struct(*values).alias("_row"),
    )
    order = ["_at", "_side", *ties]

    def events():
        return probes.withColumn("_spread", spread).unionByName(known, allowMissingColumns=True)

    plan = resolve(slicing, events, on, [*order, "_spread"], rows_at_most)
    if plan is None:
        # When the left side is already partitioned by its key (it comes out of a window over
        # it), a right side partitioned alike lets the union keep that: only the right side
        # is shuffled for the join.
        rows = probes.unionByName(known.repartition(*on), allowMissingColumns=True)
        groups = list(on)
    else:
        order.append("_spread")
        rows = plan.assign(events())
        known = rows.where(F.col("_side") == 0).select(*on, *order, "_row", "_slice", "_last")
        rows = rows.drop("_last").unionByName(plan.neighbours(known, 1, "before", order), allowMissingColumns=True)
        groups = [*on, "_slice"]

    so_far = Window.partitionBy(*groups).orderBy(*ascending(order)).rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumn("_row", F.last("_row", ignorenulls=True).over(so_far))
        .where(F.col("_side") == 1)
        .withColumn("_row", F.when(F.col(left_time).isNotNull(), F.col("_row")))
        .select(*left.columns, *[F.col("_row").getField(c).alias(c) for c in values])
    )


def _range_form(left, right, on, left_time, right_time, tiebreak):
    values = [c for c in right.columns if c not in on]
    along = Window.partitionBy(*on).orderBy(*ascending([right_time, *tiebreak]))
    # Of rows with equal time all but the last get an empty range.
    ranges = right.select(
        *on,
        F.col(right_time).alias("_from"),
        F.lead(right_time).over(along).alias("_until"),
        F.struct(*values).alias("_row"),
    )
    spans = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in on] + [
        F.col(f"l.{left_time}") >= F.col("r._from"),
        F.col("r._until").isNull() | (F.col(f"l.{left_time}") < F.col("r._until")),
    ]
    joined = left.alias("l").join(F.broadcast(ranges).alias("r"), spans, "left")
    return joined.select("l.*", *[F.col("r._row").getField(c).alias(c) for c in values])


def _packed_form(left, right, on, left_time, right_time, tiebreak):
    spark = left.sparkSession
    values = [c for c in right.columns if c not in on]
    # Rows in order are numbered through, and every CHUNK of them make up the arrays of the keys they belong to; a key's
    # arrays follow one another in time. Written once, so that the numbers stay what they are.
    ordered = right.select(*on, F.col(right_time).alias("_at"), order_key([F.col(c) for c in tiebreak]).alias("_tie") if tiebreak else F.lit(0).alias("_tie"), F.struct(*values).alias("_row"))
    ordered = ordered.repartitionByRange(*on, "_at", "_tie").sortWithinPartitions(*on, "_at", "_tie")
    numbered = ordered.withColumn("_chunk", F.shiftright(F.monotonically_increasing_id(), CHUNK.bit_length() - 1))
    entry = F.sort_array(F.collect_list(F.struct("_at", "_tie", "_row")))
    packed = numbered.groupBy(*on, "_chunk").agg(entry.alias("_entries"))
    packed = packed.select(*on, "_chunk", F.col("_entries._at").alias("_times"), F.col("_entries._row").alias("_rows"))
    path = shared_dir(spark, "packed")
    packed.write.parquet(path)
    packed = spark.read.schema(packed.schema).parquet(path)
    index = packed.groupBy(*on).agg(F.sort_array(F.collect_list(F.struct(F.element_at("_times", 1).alias("_at"), "_chunk"))).alias("_index"))
    index = index.select(*on, F.col("_index._at").alias("_starts"), F.col("_index._chunk").alias("_chunks"))
    most_chunks, chunks = index.agg(F.max(F.size("_starts")), F.sum(F.size("_starts"))).first()
    most_rows, rows = packed.agg(F.max(F.size("_times")), F.sum(F.size("_times"))).first()
    if not chunks:
        return left.select("*", *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in values])

    def joined(probes, table, keys, broadcast, take):
        table = F.broadcast(table) if broadcast else table
        return probes.alias("l").join(table.alias("r"), [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys], "left").select("l.*", *[f"r.{c}" for c in take])

    probes = left.withColumn("_probe", F.col(left_time))
    probes = joined(probes, index, on, chunks <= BROADCAST_ROWS, ["_starts", "_chunks"])
    probes = count_not_above(probes, "_starts", "_probe", most_chunks, "_nth").withColumn("_chunk", F.get("_chunks", F.col("_nth") - 1)).drop("_starts", "_chunks", "_nth")
    probes = joined(probes, packed, [*on, "_chunk"], rows <= BROADCAST_ROWS and _size(right) <= BROADCAST_BYTES, ["_times", "_rows"])
    found = count_not_above(probes, "_times", "_probe", most_rows, "_nth").withColumn("_row", F.get("_rows", F.col("_nth") - 1))
    # Through a generator no filter on the found columns is pushed down, which would write the search out many times over.
    return found.select(*left.columns, F.inline_outer(F.array("_row")))


def fits_broadcast(right: DataFrame, on) -> bool:
    """Whether the range form is taken for these right rows, which have a time: the left side then stays where it is."""
    size = _row_size(right)
    if size is None:
        return False
    counts = right.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"), F.sum(size).alias("_size"))
    total, largest, volume = counts.agg(F.sum("_n"), F.max("_n"), F.sum("_size")).first()
    return total is None or (
        total <= BROADCAST_ROWS and largest <= BROADCAST_ROWS_PER_KEY and volume <= BROADCAST_BYTES
    )


def _row_size(df):
    """About the bytes of a row; None if it has nested columns."""
    if any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)) for f in df.schema):
        return None
    size = F.lit(16 * len(df.columns)).cast("bigint")
    for f in df.schema:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(f.name), F.lit(0))
    return size


def _size(df):
    """About the bytes of all rows; beyond any bound if they have nested columns."""
    size = _row_size(df)
    return BROADCAST_BYTES + 1 if size is None else (df.agg(F.sum(size)).first()[0] or 0)
