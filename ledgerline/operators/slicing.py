"""Ordered windows over keys that may hold a large share of all rows.

A window partitioned by a key runs each key in one task. For a key with too many rows the
key's ordered rows are cut into slices of bounded size, each slice becomes its own window
group, and the few neighbouring rows a frame needs (``lag``, ``lead``, a moving average,
the last known value) are copied in from the slices beside it. Results are exactly those of
the unsliced window.

:func:`measure` finds such keys with one aggregation that combines on the map side. When
there are none, which is the usual case, it returns ``None`` and the operators keep their
plain one-shuffle window.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import ascending, descending
from ledgerline.session import shared_dir

ROWS_PER_GROUP = 2_000_000
SAMPLES_PER_SLICE = 16
# Cut points, or keys while they are placed, that are broadcast; more are joined by a shuffle.
BROADCAST_CUTS = 1_000_000

ROWS_PER_GROUP_CONF = "spark.ledgerline.rowsPerGroup"


@dataclass(frozen=True)
class Slicing:
    """Cut points of the oversized keys: a written table (keys, ``_cuts`` array of ordered structs).

    Any cut points give right results, they only have to be the same everywhere, which is why
    they are written. So a slicing measured on a cheap superset of the rows (a base table) or
    with fewer order columns serves as well; ``order`` names the columns of the frame it is
    assigned to.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...]
    cuts: DataFrame
    most_cuts: int
    all_cuts: int

    def assign(self, df: DataFrame) -> DataFrame:
        """Add ``_slice`` (0 for ordinary keys) and ``_last`` (null for ordinary keys)."""
        table = _sent(self.cuts, self.all_cuts).alias("c")
        same_key = [F.col(f"d.{k}").eqNullSafe(F.col(f"c.{k}")) for k in self.keys]
        key = order_key([F.col(f"d.{c}") for c in self.order])
        found = df.alias("d").join(table, same_key, "left").select("d.*", "c._cuts", key.alias("_key"))
        found = count_not_above(found, "_cuts", "_key", self.most_cuts, "_slice")
        last = F.when(F.col("_cuts").isNotNull(), F.size("_cuts"))
        return found.withColumn("_last", last).drop("_cuts", "_key")

    def neighbours(self, rows: DataFrame, n: int, side: str, order) -> DataFrame:
        """For every slice of an oversized key, copies of the ``n`` rows next to it.

        ``rows`` has been through :meth:`assign`; ``order`` is the full order of the window,
        which begins with the order of the slices. ``side`` is ``"before"`` or ``"after"``.
        A slice's neighbours may come from several other slices when those are short: how far
        the rows of a slice reach follows from the row counts alone, one narrow row per slice.
        """
        before = side == "before"
        step = F.col("_slice") if before else -F.col("_slice")
        final = F.col("_last") if before else F.lit(0)
        nearest_first = descending(order) if before else ascending(order)
        names = [c for c in rows.columns if c not in ("_slice", "_last", *self.keys)]
        inside = rows.where(F.col("_last").isNotNull())

        # Slices that hold rows, each with those up to the next such slice ("stretch") and the
        # rows that lie between a slice and a stretch further along.
        along = Window.partitionBy(*self.keys).orderBy("_step")
        counted = (
            inside.groupBy(*self.keys, "_slice", "_last")
            .agg(F.count(F.lit(1)).alias("_n"))
            .select(*self.keys, "_slice", step.alias("_step"), final.alias("_final"), "_n")
            .withColumns(
                {
                    "_until": F.coalesce(F.lead("_step").over(along), F.col("_final")),
                    "_sum": F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, 0)),
                }
            )
        )
        stretch = F.struct("_step", "_until", "_sum")
        reach = (
            counted.withColumn("_ahead", F.collect_list(stretch).over(along.rowsBetween(0, n - 1)))
            .withColumn("_stretch", F.explode("_ahead"))
            .select(*self.keys, "_slice", F.col("_stretch._step").alias("_from"), F.col("_stretch._until").alias("_until"), (F.col("_stretch._sum") - F.col("_sum")).alias("_between"))
            .where((F.col("_between") < n) & (F.col("_from") < F.col("_until")))
            .withColumn("_to", F.explode(F.sequence(F.col("_from") + 1, F.col("_until"))))
        )
        # At most n rows per slice leave the map side (row_number <= n is a group limit).
        edge = inside.withColumn("_rank", F.row_number().over(Window.partitionBy(*self.keys, "_slice").orderBy(*nearest_first))).where(F.col("_rank") <= n)
        met = [F.col(f"e.{k}").eqNullSafe(F.col(f"r.{k}")) for k in (*self.keys, "_slice")]
        return (
            edge.alias("e")
            .join(reach.alias("r"), [*met, F.col("_rank") + F.col("_between") <= n])
            .select(*[F.col(f"e.{c}") for c in (*self.keys, *names)], F.abs("_to").cast("int").alias("_slice"))
        )


def count_not_above(df: DataFrame, array: str, value: str, most: int, name: str) -> DataFrame:
    """Add ``name``: how many entries of the ascending ``array``, of at most ``most``, are not above ``value``.

    Binary search, one column per step, so that it runs in generated code. Without an array, or
    for a null value, every comparison is null and 0 remains.
    """
    found = df.withColumn(name, F.lit(0))
    for step in [2**i for i in reversed(range(most.bit_length()))]:
        # The bits from this step's on are still 0, so they can be set instead of added, which needs no overflow checks.
        probe = F.get(array, F.col(name).bitwiseOR(step - 1))
        found = found.withColumn(name, F.when(probe <= F.col(value), F.col(name).bitwiseOR(step)).otherwise(F.col(name)))
    return found


def _sent(table: DataFrame, size: int) -> DataFrame:
    return F.broadcast(table) if size <= BROADCAST_CUTS else table


def measure(
    df: DataFrame,
    keys,
    order,
    *,
    rows_at_most: int | None = None,
    rows_per_group: int | None = None,
) -> Slicing | None:
    """Find keys with too many rows for one window group and choose their cut points.

    ``rows_at_most`` is a known upper bound on the rows of ``df`` (for example the footer
    row count of its base table); when even that fits one group nothing has to be measured.
    A group holds about ``rows_per_group`` rows at most, however many rows there are. There
    are about two cuts for so many rows of an oversized key; they are written below the shared
    folder, and only their numbers come to the driver. The sample only places the cut
    points; no row is dropped.
    """
    spark = df.sparkSession
    limit = rows_per_group or int(spark.conf.get(ROWS_PER_GROUP_CONF, str(ROWS_PER_GROUP)))
    if rows_at_most is not None and rows_at_most <= limit:
        return None

    keys, order = tuple(keys), tuple(order)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    largest, many = counts.agg(F.max("_n"), F.count_if(F.col("_n") > limit)).first()
    if not many:
        return None

    hot = _sent(counts.where(F.col("_n") > limit).select(*keys), many).alias("h")
    same_key = [F.col(f"d.{k}").eqNullSafe(F.col(f"h.{k}")) for k in keys]
    share = min(1.0, 2 * SAMPLES_PER_SLICE / limit)
    every = max(1, int(share * limit / 2))  # sampled rows to half a group
    along = Window.partitionBy(*keys).orderBy("_at")
    placed = (
        df.select(*keys, *[c for c in order if c not in keys])
        .sample(share, seed=7)
        .alias("d")
        .join(hot, same_key, "left_semi")
        .select(*[F.col(f"d.{k}") for k in keys], order_key([F.col(f"d.{c}") for c in order]).alias("_at"))
        .withColumns({"_nth": F.row_number().over(along), "_least": F.first("_at").over(along)})
        # A cut at the smallest value would only open an empty slice.
        .where((F.col("_nth") % every == 0) & (F.col("_at") > F.col("_least")))
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_set("_at")).alias("_cuts"))
    )
    path = shared_dir(spark, "cuts")
    placed.write.parquet(path)
    cuts = spark.read.schema(placed.schema).parquet(path)
    most, total = cuts.agg(F.max(F.size("_cuts")), F.sum(F.size("_cuts"))).first()
    if not most:
        return None
    return Slicing(keys, order, cuts, most, total)


def resolve(slicing, df, keys, order, rows_at_most=None):
    """``"auto"`` measures ``df`` (a frame, or a function that makes it); ``None`` or a
    :class:`Slicing` is taken as given."""
    if isinstance(slicing, str):
        if slicing != "auto":
            raise ValueError(f"slicing must be 'auto', None or a Slicing, not {slicing!r}")
        return measure(df() if callable(df) else df, keys, order, rows_at_most=rows_at_most)
    if slicing is None:
        return None
    return replace(slicing, order=tuple(order[: len(slicing.order)]))


def order_key(cols) -> Column:
    """A struct that compares like ``ORDER BY cols ASC NULLS LAST``."""
    parts = []
    for i, c in enumerate(cols):
        parts += [c.isNull().alias(f"n{i}"), c.alias(f"v{i}")]
    return F.struct(*parts)
