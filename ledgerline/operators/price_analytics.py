"""Daily return, traded value and moving averages."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ledgerline.functions.columns import ascending, null_if_zero, safe_ratio
from ledgerline.operators.slicing import resolve
from ledgerline.schemas import AVERAGE, MONEY, RETURN


def price_analytics(
    prices: DataFrame,
    key="ticker",
    order: str = "trade_date",
    price: str = "adj_close",
    windows=(20, 50),
    slicing="auto",
    rows_at_most: int | None = None,
) -> DataFrame:
    """Add ``daily_return``, ``dollar_volume`` and one ``sma_<n>`` per window length.

    ``key`` is a column or several. Moving averages run over the last ``n`` rows of the key, fewer at its start. All of
    them share one shuffle and one sort. With ``slicing="auto"`` a small job first looks for
    oversized keys, which are then sliced (see :mod:`ledgerline.operators.slicing`);
    ``rows_at_most``, a bound on the rows, can save that job.
    """
    if not isinstance(prices.schema[price].dataType, DecimalType):
        raise TypeError(f"{price} must be a decimal: running sums of doubles are not exact")
    keys = [key] if isinstance(key, str) else list(key)
    plan = resolve(slicing, prices, keys, [order], rows_at_most)
    names, groups, rows = prices.columns, keys, prices
    if plan is not None:
        sliced = plan.assign(prices)
        reach = max([2, *windows]) - 1
        lead_in = plan.neighbours(sliced.select(*keys, order, price, "_slice", "_last"), reach, "before", [order])
        rows = sliced.drop("_last").withColumn("_own", F.lit(True)).unionByName(
            lead_in.withColumn("_own", F.lit(False)), allowMissingColumns=True
        )
        groups = [*keys, "_slice"]

    # A moving sum is the difference of two running sums: constant work per row, whatever the
    # window length, and exact because the sums are decimals.
    along = Window.partitionBy(*groups).orderBy(*ascending([order]))
    until_now = along.rowsBetween(Window.unboundedPreceding, 0)
    windowed = rows.withColumns(
        {
            "_previous": F.lag(price).over(along),
            "_sum": F.sum(price).over(until_now),
            "_count": F.count(price).over(until_now),
        }
    ).withColumns({f"{total}_{n}": F.lag(total, n).over(along) for n in windows for total in ("_sum", "_count")})
    if plan is not None:
        windowed = windowed.where("_own")

    def average(n):
        total = F.when(F.col(f"_count_{n}") > 0, F.col("_sum") - F.col(f"_sum_{n}")).otherwise(F.col("_sum"))
        count = F.col("_count") - F.coalesce(f"_count_{n}", F.lit(0))
        return F.round(total / null_if_zero(count), 4).cast(AVERAGE).alias(f"sma_{n}")

    return windowed.select(
        *names,
        safe_ratio(F.col(price) - F.col("_previous"), "_previous", 6, RETURN).alias("daily_return"),
        F.round(F.col("close_price") * F.col("volume"), 2).cast(MONEY).alias("dollar_volume"),
        *[average(n) for n in windows],
    )
