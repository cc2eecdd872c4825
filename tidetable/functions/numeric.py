"""Number cleaning, guards and error expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def to_number(value: str | Column) -> Column:
    """Text as DOUBLE; anything unreadable, and NaN, becomes NULL."""
    number = _c(value).try_cast("double")
    return F.when(~F.isnan(number), number)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every floating column, as done once at each scan."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not floating:
        return df
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floating})


def hundredths(value: str | Column) -> Column:
    """A two-decimal amount as a whole number of hundredths.

    Sums of whole numbers do not depend on the order of addition, so a repeated
    task gives the same result, and they stay in generated code, which a sum of
    DECIMAL does not.  An overflow is an error under ANSI mode, never a wrong sum,
    and so is a third decimal.
    """
    scaled = _c(value) * 100
    whole = F.rint(scaled)
    near = F.abs(scaled - whole) <= F.greatest(F.abs(scaled) * 1e-12, F.lit(1e-6))
    return F.when(scaled.isNull() | near, whole.cast("bigint")).otherwise(F.raise_error(F.lit("an amount has more than two decimals")).cast("bigint"))


def money_sum(value: str | Column) -> Column:
    """Aggregate: exact sum of two-decimal amounts as a DOUBLE."""
    return F.sum(hundredths(value)) / F.lit(100.0)


def whole_ratio(top: str | Column, bottom: str | Column, digits: int) -> Column:
    """Ratio of non-negative whole numbers, rounded half up without a floating step.

    A tie stays a tie, where a binary quotient may fall on either side of it.
    """
    unit = 10**digits
    t, b = (_c(x).cast("decimal(26,0)") for x in (top, bottom))
    units = F.floor(F.try_divide(t * (2 * unit) + b, b * 2))
    return units.cast("double") / F.lit(float(unit))


def null_to_zero(value: str | Column) -> Column:
    """NULL and NaN as 0."""
    return F.coalesce(F.nanvl(_c(value), F.lit(None).cast("double")), F.lit(0.0))


def round_half_up(value: str | Column, digits: int) -> Column:
    return F.round(_c(value), digits)


def round_half_even(value: str | Column, digits: int) -> Column:
    return F.bround(_c(value), digits)


def ratio(top: str | Column, bottom: str | Column) -> Column:
    """Division that gives NULL when the divisor is zero."""
    return F.try_divide(_c(top).cast("double"), _c(bottom).cast("double"))


def safe_ln(value: str | Column) -> Column:
    """Natural logarithm, NULL for values that are not positive."""
    c = _c(value)
    return F.when(c > 0, F.ln(c))


def pct_change(new: str | Column, old: str | Column, digits: int = 1) -> Column:
    """Change in percent of ``old``; NULL when ``old`` is zero or missing."""
    return F.round(ratio(_c(new) - _c(old), old) * 100, digits)


def absolute_error(actual: str | Column, predicted: str | Column) -> Column:
    return F.abs(_c(actual) - _c(predicted))


def percent_error(actual: str | Column, predicted: str | Column, guard: float = 1e-8) -> Column:
    """Absolute error in percent, with a small guard added to the divisor."""
    return F.try_divide(absolute_error(actual, predicted), _c(actual) + F.lit(guard)) * 100


def same_direction(actual_change: str | Column, predicted_change: str | Column) -> Column:
    return F.signum(_c(actual_change)) == F.signum(_c(predicted_change))


def within(value: str | Column, low: float, high: float, fallback: str | Column) -> Column:
    """``value`` when it lies in the range, else ``fallback``; missing values fall back too."""
    c = _c(value)
    return F.when(c.between(low, high), c).otherwise(_c(fallback))


def blend(weights: dict[str, float]) -> Column:
    """Weighted sum of columns; NULL when any part is missing."""
    return reduce(lambda a, b: a + b, [F.lit(float(w)) * F.col(c) for c, w in weights.items()])


def deflate(price: str | Column, index: str | Column, base: str | Column, digits: int = 2) -> Column:
    """Price at the price level of the base period."""
    return F.round(ratio(_c(price) * _c(base), index), digits)


def reinflate(price: str | Column, index: str | Column, base: str | Column, digits: int = 2) -> Column:
    """Inverse of :func:`deflate`."""
    return F.round(ratio(_c(price) * _c(index), base), digits)


def padding(low: str | Column, high: str | Column, share: float = 0.15, least: float = 0.12) -> Column:
    """Room to leave above and below a charted range."""
    return F.greatest((_c(high) - _c(low)) * share, F.lit(least))
