"""Price analytics over a stream: each session's return and averages as it arrives.

The state of a ticker is its last session's day and the prices of its last sessions, as many as the longest
average needs, so it stays the same size for ever. Prices are whole ten-thousandths and every quotient is rounded half up
in whole numbers, so a drained stream equals ``price_analytics`` over all its rows, also if it was stopped in between.
"""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ledgerline.schemas import AVERAGE, MONEY, RETURN

STATE = "last_day date, prices array<bigint>"


def stream_price_analytics(prices: DataFrame, key: str = "ticker", order: str = "trade_date", price: str = "adj_close", windows=(20, 50)) -> DataFrame:
    """``prices`` (a stream of staged rows) with the columns that ``price_analytics`` adds.

    Sessions of a ticker have to come in order of their days, across micro-batches and at most once each; within
    a micro-batch they may come in any order. A session that is not after the last one fails the stream, as what
    was emitted for later days would be wrong: land it as a correction and compute the ticker anew. Rows
    of one ticker in one micro-batch meet in one task, so bound the batch (``maxFilesPerTrigger``) for backfills.
    """
    if not isinstance(prices.schema[price].dataType, T.DecimalType):
        raise TypeError(f"{price} must be a decimal")
    scale = prices.schema[price].dataType.scale
    added = [("daily_return", 6), *[(f"sma_{n}", 4) for n in windows]]
    schema = T.StructType([*prices.schema.fields, *[T.StructField(name, T.StringType()) for name, _ in added]])
    stateful = prices.groupBy(key).applyInPandasWithState(_sessions(order, price, scale, tuple(windows), schema.fieldNames()), schema, STATE, "append", GroupStateTimeout.NoTimeout)
    return stateful.select(
        *prices.columns,
        F.col("daily_return").cast(RETURN).alias("daily_return"),
        F.round(F.col("close_price") * F.col("volume"), 2).cast(MONEY).alias("dollar_volume"),
        *[F.col(f"sma_{n}").cast(AVERAGE).alias(f"sma_{n}") for n in windows],
    )


def _rounded(numerator: int, denominator: int, digits: int) -> str:
    """A quotient in decimal text, half up."""
    sign = "-" if (numerator < 0) != (denominator < 0) and numerator else ""
    numerator, denominator = abs(numerator) * 10**digits, abs(denominator)
    whole, part = divmod((2 * numerator + denominator) // (2 * denominator), 10**digits)
    return f"{sign}{whole}.{part:0{digits}d}"


def _sessions(order: str, price: str, scale: int, windows: tuple[int, ...], columns: list[str]) -> Callable:
    reach = max([2, *windows]) - 1

    def sessions(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last_day, before = state.get if state.exists else (None, [])
        series = list(before)
        rows = pd.concat(list(frames)).sort_values(order, kind="stable")
        returns, averages = [], {n: [] for n in windows}
        # Sum and number of the known prices among the last n, carried along.
        sums = {n: sum(x for x in series[-n:] if x is not None) for n in windows}
        counts = {n: sum(x is not None for x in series[-n:]) for n in windows}
        for day, value in zip(rows[order], rows[price]):
            if last_day is not None and day <= last_day:
                raise ValueError(f"{key[0]}: the session of {day} is not after the one of {last_day}")
            last_day = day
            ticks = None if value is None else int(value.scaleb(scale))
            previous = series[-1] if series else None
            returns.append(_rounded(ticks - previous, previous, 6) if ticks is not None and previous else None)
            for n in windows:
                if ticks is not None:
                    sums[n] += ticks
                    counts[n] += 1
                if len(series) >= n and series[-n] is not None:
                    sums[n] -= series[-n]
                    counts[n] -= 1
                averages[n].append(_rounded(sums[n], counts[n] * 10**scale, 4) if counts[n] else None)
            series.append(ticks)
        state.update((last_day, series[-reach:]))
        made = rows.assign(daily_return=pd.Series(returns, index=rows.index, dtype=object), **{f"sma_{n}": pd.Series(averages[n], index=rows.index, dtype=object) for n in windows})
        yield made[columns]

    return sessions
