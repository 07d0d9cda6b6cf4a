"""Version history (SCD2), current versions and the latest rows of a key."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import ascending, descending, surrogate_key
from ledgerline.operators.slicing import BROADCAST_CUTS, resolve
from ledgerline.schemas import OPEN_END
from ledgerline.session import shared_dir

FACT_KEYS = ("ticker", "fiscal_year", "fiscal_period", "gaap_tag")
# The first two decide between versions; the rest make the order total, so that facts of
# one filing that differ only in their reporting period get a defined winner.
FACT_ORDER = (
    "filed_date",
    "accession_number",
    "period_end_date",
    "period_start_date",
    "form_type",
    "amount",
    "cik",
)


def scd2(
    facts: DataFrame,
    keys=FACT_KEYS,
    effective: str = "filed_date",
    order=FACT_ORDER,
    key_name: str = "statement_sk",
    slicing="auto",
    rows_at_most: int | None = None,
) -> DataFrame:
    """Turn dated rows into versions: ``valid_from``, ``valid_to`` and ``is_current``.

    A version ends where the next one of its key begins; the last in order is current. An
    undated row sorts last, so it is the current one. One shuffle and one sort serve both
    columns: being last means having no row ahead.
    """
    order = [c for c in order if c in facts.columns]
    plan = resolve(slicing, facts, keys, order, rows_at_most)
    groups, rows = list(keys), facts
    if plan is not None:
        sliced = plan.assign(facts)
        following = plan.neighbours(sliced.select(*keys, *order, "_slice", "_last"), 1, "after", order)
        rows = sliced.drop("_last").withColumn("_own", F.lit(True)).unionByName(
            following.withColumn("_own", F.lit(False)), allowMissingColumns=True
        )
        groups = [*keys, "_slice"]

    along = Window.partitionBy(*groups).orderBy(*ascending(order))
    versions = rows.withColumns({"_next": F.lead(effective).over(along), "_ahead": F.lead(F.lit(1)).over(along)})
    if plan is not None:
        versions = versions.where("_own")
    kept = [c for c in facts.columns if c != effective]
    return versions.select(
        surrogate_key(*keys, effective).alias(key_name),
        *kept,
        F.col(effective).alias("valid_from"),
        F.coalesce("_next", F.lit(OPEN_END).cast("date")).alias("valid_to"),
        F.col("_ahead").isNull().alias("is_current"),
    )


def batch_spans(versions: DataFrame, facts: DataFrame, keys=FACT_KEYS, effective: str = "filed_date") -> DataFrame:
    """For every key of a batch its first and last new date, and the date at which its present versions begin.

    One narrow row a key, written below the shared folder, and broadcast if counted to be at most ``BROADCAST_CUTS``.
    """
    spark, path = facts.sparkSession, shared_dir(facts.sparkSession, "spans")
    day = F.coalesce(F.col(effective), F.lit(OPEN_END).cast("date"))
    new = facts.groupBy(*keys).agg(F.min(day).alias("_least"), F.max(day).alias("_most")).alias("n")
    old = versions.groupBy(*keys).agg(F.min("valid_from").alias("_began"), F.lit(True).alias("_some")).alias("o")
    both = new.join(old, [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys], "left").select("n.*", "_began", "_some")
    both.write.parquet(path)
    spans = spark.read.schema(both.schema).parquet(path)
    return F.broadcast(spans) if spans.count() <= BROADCAST_CUTS else spans


def _with_spans(rows: DataFrame, spans: DataFrame, keys, how: str = "inner") -> DataFrame:
    met = [F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    return rows.alias("r").join(spans.alias("s"), met, how).select("r.*", "_least", "_most", "_began", "_some")


def _around() -> Column:
    """Versions that a batch may change: those that end no earlier than the key's first new date and begin no later than its last."""
    return (F.col("valid_to") >= F.col("_least")) & (F.coalesce("valid_from", F.lit(OPEN_END).cast("date")) <= F.col("_most"))


def versions_beside(versions: DataFrame, spans: DataFrame, keys=FACT_KEYS) -> DataFrame:
    """The versions that :func:`splice_versions` does not look at for a batch with such ``spans``."""
    return _with_spans(versions, spans, keys, "left").where(F.col("_least").isNull() | ~_around()).select(*versions.columns)


def splice_versions(
    versions: DataFrame,
    facts: DataFrame,
    keys=FACT_KEYS,
    effective: str = "filed_date",
    order=FACT_ORDER,
    key_name: str = "statement_sk",
    slicing="auto",
    rows_at_most: int | None = None,
    spans: DataFrame | None = None,
    unchanged: bool = False,
    carried=(),
) -> DataFrame:
    """What changes in a version history when ``facts``, late or new, come to it.

    ``versions`` is what :func:`scd2` makes of the facts so far. Returned are the versions that open (``_new``) and
    the present ones that end at another date or are current no longer, with all columns of ``versions``; every other version
    stays. Facts that the history holds already, in all columns, open nothing.

    Of a touched key only the versions around the new dates are looked at: those that end no earlier than the key's
    first new date and begin no later than its last one. That includes the one before every new fact, whose old
    end is the end of the last new fact behind it. A fact before a key's whole history ends where that begins.

    Both sides are moved once, to the window of their key, in which equal facts stand side by side. ``spans`` is what
    :func:`batch_spans` gives, if that is known. With ``unchanged`` the versions looked at that stay as they are come too, with
    a null ``_new``; then these and :func:`versions_beside` are the whole history. ``carried`` names further columns
    of ``versions``, which are null for a version that opens.
    """
    order = [c for c in order if c in facts.columns]
    names, carried = facts.columns, list(carried)
    never = F.lit(OPEN_END).cast("date")
    spans = batch_spans(versions, facts, keys, effective) if spans is None else spans
    present = _with_spans(versions, spans, keys).where(_around()).select(
        *[F.col("valid_from").alias(effective) if c == effective else F.col(c) for c in names],
        F.struct("valid_to", "is_current", *carried).alias("_old"),
    )
    rows = present.unionByName(facts, allowMissingColumns=True)

    plan = resolve(slicing, rows, keys, order, rows_at_most)
    groups, rows = (list(keys), rows) if plan is None else ([*keys, "_slice"], plan.assign(rows))
    rest = [c for c in names if c not in keys]
    by_all = Window.partitionBy(*groups).orderBy(*ascending([*order, *[c for c in rest if c not in order]]), F.col("_old").isNull())
    earlier = F.lag(F.struct(*rest)).over(by_all)
    known_already = F.col("_old").isNull() & F.col("_earlier").isNotNull() & F.col("_earlier").eqNullSafe(F.struct(*rest))
    rows = rows.withColumn("_earlier", earlier).where(~known_already).drop("_earlier")
    if plan is not None:
        after = plan.neighbours(rows.select(*keys, *order, "_old", "_slice", "_last"), 1, "after", order)
        before = plan.neighbours(rows.where(F.col("_old").isNotNull()).select(*keys, *order, "_old", "_slice", "_last"), 1, "before", order)
        rows = rows.drop("_last").withColumn("_own", F.lit(True))
        for more in (after, before):
            rows = rows.unionByName(more.withColumn("_own", F.lit(False)), allowMissingColumns=True)
    along = Window.partitionBy(*groups).orderBy(*ascending(order))
    next_ = F.lead(F.struct(F.col(effective).alias("at"), F.col("_old").isNull().alias("new"))).over(along)
    last_old = F.last("_old", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, 0))
    placed = rows.withColumns({"_next": next_, "_before": last_old})
    if plan is not None:
        placed = placed.where("_own")
    opens, followed = F.col("_old").isNull(), F.col("_next").isNotNull()
    changes = opens | F.coalesce(F.col("_next.new"), F.lit(False))
    placed = _with_spans(placed if unchanged else placed.where(changes), spans, keys)
    known = F.col("_before").isNotNull()  # some present version comes before; else what follows last is the key's first one
    end = F.when(followed, F.col("_next.at")).when(known, F.col("_before.valid_to")).otherwise(F.col("_began"))
    current = F.when(followed, F.lit(False)).when(known, F.col("_before.is_current")).otherwise(F.col("_some").isNull())
    return placed.select(
        surrogate_key(*keys, effective).alias(key_name),
        *[F.col(c) for c in names if c != effective],
        F.col(effective).alias("valid_from"),
        F.when(changes, F.coalesce(end, never)).otherwise(F.col("_old.valid_to")).alias("valid_to"),
        F.when(changes, current).otherwise(F.col("_old.is_current")).alias("is_current"),
        *[F.col("_old")[c].alias(c) for c in carried],
        F.when(changes, opens).alias("_new"),
    )


def current_versions(facts: DataFrame, keys=FACT_KEYS, effective: str = "filed_date", order=FACT_ORDER) -> DataFrame:
    """The rows :func:`scd2` marks current, without building the history.

    Keeps one row per key on the map side before anything is shuffled.
    """
    order = [c for c in order if c in facts.columns]
    return latest_per_key(facts, keys, order).withColumnRenamed(effective, "valid_from")


def latest_per_key(df: DataFrame, keys, order, n: int = 1) -> DataFrame:
    """The last ``n`` rows per key by ``order``, nulls counting as latest.

    ``row_number() <= n`` becomes a group limit that also runs before the shuffle, so each
    map task sends at most ``n`` rows of a key, however many the key has. Spark does so up to
    ``spark.sql.optimizer.windowGroupLimitThreshold`` (1000); for a larger ``n`` raise it, or
    whole keys are sorted in one task each. Results do not depend on it.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    along = Window.partitionBy(*keys).orderBy(*descending(order))
    return df.withColumn("_rank", F.row_number().over(along)).where(F.col("_rank") <= n).drop("_rank")
