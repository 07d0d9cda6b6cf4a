"""Discounted-cash-flow valuation, one scenario per row or a sweep over assumptions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import to_fixed
from ledgerline.functions.dcf import YEARS, grown_flows, money_columns, present_values, with_discount_factors

INPUTS = ("base_fcf", "growth", "terminal_growth", "wacc", "cash", "total_debt", "shares_outstanding")

# Fixed values: (first, last, step) of the assumption ranges, in hundredths of a percent.
GROWTH_RANGE = (-1000, 3500, 50)
WACC_RANGE = (500, 1600, 25)
TERMINAL_RANGE = (100, 450, 10)

UNDERVALUED_FROM = 10.0


def dcf(df: DataFrame, floor: float = 0.01) -> DataFrame:
    """Value every row from its :data:`INPUTS` columns.

    A discount rate at or below terminal growth is replaced by terminal growth plus
    ``floor``. Money is rounded to cents at the end only; without shares the value per share
    is zero. ``projections`` holds the five explicit years.
    """
    terminal, wacc = F.col("_terminal_growth"), F.col("_wacc")
    rows = df.withColumns(
        {
            "_base": F.col("base_fcf").cast("double"),
            "_growth": F.col("growth").cast("double"),
            "_terminal_growth": F.col("terminal_growth").cast("double"),
            "_wacc": F.col("wacc").cast("double"),
            "_cash": F.col("cash").cast("double"),
            "_debt": F.col("total_debt").cast("double"),
        }
    ).withColumn("_rate", F.when(wacc <= terminal, terminal + F.lit(floor)).otherwise(wacc))
    rows = with_discount_factors(grown_flows(rows, "_base", "_growth"), "_rate")
    rows = present_values(rows, "_rate", "_terminal_growth", "_cash", "_debt")
    shares = F.col("shares_outstanding").cast("double")
    years = [
        F.struct(
            F.lit(y).alias("year"),
            F.round(f"_fcf{y}", 2).alias("fcf"),
            F.round(f"_pv{y}", 2).alias("pv_fcf"),
        )
        for y in range(1, YEARS + 1)
    ]
    return rows.select(
        *df.columns,
        *[F.round(value, 2).alias(name) for name, value in money_columns().items()],
        F.when(shares > 0, F.round(F.col("_equity") / shares, 2)).otherwise(F.lit(0.0)).alias("fair_value_per_share"),
        F.array(*years).alias("projections"),
    )


def dcf_projections(valued: DataFrame, *ids: str) -> DataFrame:
    """The explicit years of :func:`dcf`, one row each."""
    # Exploding the position, not the array, keeps Spark from inferring a filter on the
    # array and computing the valuation twice.
    positions = F.explode(F.array(*[F.lit(i) for i in range(YEARS)])).alias("_i")
    return valued.select(*ids, "projections", positions).select(*ids, F.get("projections", F.col("_i")).alias("_p")).select(*ids, "_p.*")


def dcf_scenarios(
    companies: DataFrame,
    growth=GROWTH_RANGE,
    wacc=WACC_RANGE,
    terminal=TERMINAL_RANGE,
    floor: float = 0.005,
    quantize: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Fair value, margin of safety and rating for every assumption triple of every row.

    ``companies`` brings ``base_fcf, cash, total_debt, shares_outstanding, current_price``
    and any identifying columns. Ranges are ``(first, last, step)`` in hundredths of a
    percent; the defaults give 91 x 45 x 36 scenarios a row. The grid has a fixed size and
    is generated inside each row, so no join is involved. Discount factors depend on two of
    the three assumptions only and are computed before growth is expanded. Rows are spread
    over ``partitions`` tasks (default: the shuffle partitions) after the first expansion, 45
    narrow rows a company: the table of companies is small and its product is not, and no
    expanded row crosses the network.

    Money comes out unrounded; fair value has two digits, margin of safety (percent) one, and
    the rating goes by the rounded margin.

    ``quantize=True`` first rounds the money inputs to hundredths of a billion, as the
    interactive page does.
    """
    money = ("base_fcf", "cash", "total_debt", "shares_outstanding")
    names = [c for c in companies.columns if c not in ("growth", "wacc", "terminal_growth")]
    rows = companies.select(*names)
    billion = F.lit(1e9)
    rows = rows.withColumns(
        {f"_{c}": (to_fixed(F.col(c) / billion, 2) * billion if quantize else F.col(c).cast("double")) for c in money}
    )

    spread = partitions or int(companies.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rates = F.array(*[F.lit(p) for p in _fractions(wacc)])
    terminals = F.array(*[F.lit(p) for p in _fractions(terminal)])
    pairs = (
        rows.withColumn("wacc", F.explode(rates))
        .repartition(spread, F.xxhash64(*names), "wacc")
        .withColumn("terminal_growth", F.explode(terminals))
        .withColumn("_rate", F.greatest(F.col("wacc"), F.col("terminal_growth") + F.lit(floor)))
    )
    pairs = with_discount_factors(pairs, "_rate")
    grid = pairs.withColumn("growth", F.explode(F.array(*[F.lit(p) for p in _fractions(growth)])))
    valued = present_values(grown_flows(grid, "_base_fcf", "growth"), "_rate", "terminal_growth", "_cash", "_total_debt")
    price = F.col("current_price").cast("double")
    shares = F.col("_shares_outstanding")
    # Each a column of its own, so that it is computed once and not at every mention.
    valued = valued.withColumn("_fair", F.when(shares > 0, F.col("_equity") / shares).otherwise(F.lit(0.0)))
    valued = valued.withColumn("_margin", F.when(F.col("_fair") > 0, (F.col("_fair") - price) / F.col("_fair") * F.lit(100.0)).otherwise(F.lit(0.0)))
    valued = valued.withColumn("margin_of_safety", to_fixed("_margin", 1))
    return valued.select(
        *names,
        "growth",
        "wacc",
        "terminal_growth",
        *[value.alias(name) for name, value in money_columns().items()],
        to_fixed("_fair", 2).alias("fair_value"),
        "margin_of_safety",
        F.when(F.col("margin_of_safety") >= UNDERVALUED_FROM, "Undervalued").otherwise("Overvalued").alias("rating"),
    )


def _fractions(bounds):
    first, last, step = bounds
    return [(i / 100.0) / 100.0 for i in range(first, last + 1, step)]
