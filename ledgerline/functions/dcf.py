"""Two-stage discounted cash flow as columns, in double arithmetic.

The five explicit years are unrolled into plain expressions, so the whole valuation stays
inside generated code; there is no Python function and no higher-order function per row.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

YEARS = 5


def grown_flows(df: DataFrame, base: str, growth: str) -> DataFrame:
    """Add ``_fcf1 .. _fcf5``; growth is applied year on year, not by a power."""
    factor = F.lit(1.0) + F.col(growth)
    previous = F.col(base)
    for year in range(1, YEARS + 1):
        df = df.withColumn(f"_fcf{year}", previous * factor)
        previous = F.col(f"_fcf{year}")
    return df


def with_discount_factors(df: DataFrame, rate: str) -> DataFrame:
    """Add ``_df1 .. _df5``, the powers of ``1 + rate``."""
    one_plus = F.lit(1.0) + F.col(rate)
    return df.withColumns({f"_df{y}": F.pow(one_plus, F.lit(float(y))) for y in range(1, YEARS + 1)})


def present_values(df: DataFrame, rate: str, terminal_growth: str, cash: str, debt: str) -> DataFrame:
    """Add the unrounded results; needs ``_fcf*`` and ``_df*``."""
    df = df.withColumns({f"_pv{y}": F.col(f"_fcf{y}") / F.col(f"_df{y}") for y in range(1, YEARS + 1)})
    explicit = F.lit(0.0)
    for year in range(1, YEARS + 1):
        explicit = explicit + F.col(f"_pv{year}")
    terminal = F.col(f"_fcf{YEARS}") * (F.lit(1.0) + F.col(terminal_growth)) / (F.col(rate) - F.col(terminal_growth))
    return (
        df.withColumns({"_explicit": explicit, "_terminal": terminal, "_net_debt": F.col(debt) - F.col(cash)})
        .withColumn("_pv_terminal", F.col("_terminal") / F.col(f"_df{YEARS}"))
        .withColumn("_enterprise", F.col("_explicit") + F.col("_pv_terminal"))
        .withColumn("_equity", F.col("_enterprise") - F.col("_net_debt"))
    )


def money_columns() -> dict[str, Column]:
    return {
        "pv_explicit_fcf": F.col("_explicit"),
        "terminal_value": F.col("_terminal"),
        "pv_terminal_value": F.col("_pv_terminal"),
        "enterprise_value": F.col("_enterprise"),
        "net_debt": F.col("_net_debt"),
        "equity_value": F.col("_equity"),
    }
