"""Column helpers shared by the operators. All are native Spark expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Units up to which ``to_fixed`` rounds in double arithmetic; beyond half of 1e9 every value counts as a tie.
WHOLE_UNITS = 4e8


def surrogate_key(*cols):
    """md5 over the parts joined by ``||``; null parts are skipped."""
    return F.md5(F.concat_ws("||", *[_col(c).cast("string") for c in cols]))


def company_key(ticker="ticker"):
    """md5 of the ticker; null for a null ticker."""
    return F.md5(_col(ticker).cast("string"))


def zfill(col, width=10):
    """Left-pad with zeros without cutting longer values."""
    text = _col(col).cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def null_if_zero(col):
    col = _col(col)
    return F.when(col != 0, col)


def safe_ratio(numerator, denominator, scale, result_type):
    """``numerator / denominator`` rounded half up; null for a zero denominator."""
    return F.round(_col(numerator) / null_if_zero(denominator), scale).cast(result_type)


def ascending(cols):
    return [_col(c).asc_nulls_last() for c in cols]


def descending(cols):
    """Exact reverse of :func:`ascending`."""
    return [_col(c).desc_nulls_first() for c in cols]


def percent(col):
    """Fraction to percent with two digits, in double arithmetic."""
    return F.round(_col(col).cast("double") * F.lit(100.0), 2)


def to_fixed(col, digits):
    """Round the exact binary value of a double, ties away from zero.

    ``F.round`` rounds the shortest decimal text of a double, so 1.005 (really
    1.00499999999999989...) becomes 1.01. Report figures need 1.0. Only values that look
    like a tie take the costlier path through ``format_number``, which rounds the
    binary value; an exact binary tie is left to ``F.round``. All others of usual size are
    rounded in double arithmetic: half a unit is added and the whole units divided again, which
    gives the double nearest to the decimal, as ``F.round`` does at many times the cost.
    """
    x = _col(col).cast("double")
    unit = F.lit(float(10**digits))
    scaled = F.abs(x) * unit
    looks_like_tie = F.abs(scaled - F.floor(scaled) - 0.5) < F.lit(1e-9) * F.greatest(scaled, F.lit(1.0))
    binary = x * F.lit(float(2 ** (digits + 1)))
    exact_tie = binary == F.floor(binary)
    by_text = F.regexp_replace(F.format_number(x, digits), ",", "").cast("double")
    rounded = F.floor(scaled + 0.5).cast("double") / unit
    plain = F.when(x < 0, F.lit(0.0) - rounded).otherwise(rounded)  # 0.0 - 0.0 has no sign
    usual = (scaled < F.lit(WHOLE_UNITS)) & ~looks_like_tie
    return F.when(usual, plain).when(looks_like_tie & ~exact_tie, by_text).otherwise(F.round(x, digits))


def to_fixed_text(col, digits):
    x = _col(col).cast("double")
    sign = F.when(x < 0, F.lit("-")).otherwise(F.lit(""))
    # format_string writes a null as text.
    return F.when(x.isNotNull(), F.concat(sign, F.format_string(f"%.{digits}f", to_fixed(F.abs(x), digits))))


def currency_label(amount, currency):
    """``$1,234.50`` or ``MYR 1,234.50`` (no-break space); a dash when there is no amount."""
    amount = _col(amount).cast(T.DecimalType(38, 4))
    sign = F.when(amount < 0, F.lit("-")).otherwise(F.lit(""))
    symbol = F.when(_col(currency) == "MYR", F.lit("MYR\u00a0")).otherwise(F.lit("$"))
    digits = F.format_number(F.round(F.abs(amount), 2), 2)
    return F.coalesce(F.concat(sign, symbol, digits), F.lit("—"))


def billions_label(amount, currency):
    """``$1.23B`` or ``RM 1.23B``; a dash when there is no amount."""
    prefix = F.when(_col(currency) == "MYR", F.lit("RM ")).otherwise(F.lit("$"))
    number = to_fixed_text(_col(amount).cast("double") / F.lit(1e9), 2)
    return F.coalesce(F.concat(prefix, number, F.lit("B")), F.lit("—"))


def in_billions(amount):
    return to_fixed(_col(amount).cast("double") / F.lit(1e9), 2)


def json_fields(text, **kinds):
    """A struct of top-level fields of a JSON text, by name and type; absent or unfitting ones are null."""
    return F.from_json(_col(text), ", ".join(f"`{name}` {kind}" for name, kind in kinds.items()))


def _col(c):
    return c if isinstance(c, Column) else F.col(c)
