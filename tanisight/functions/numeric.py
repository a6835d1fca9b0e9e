"""Numbers with engine-independent results.

Averages of money are exact: decimal sums, then one division. Rounding is by formula
(``floor(x * 10^k + 0.5) / 10^k``), so the result does not depend on summation order or on
which rounding mode an engine happens to use.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rnd(x: Column | str, digits: int = 2) -> Column:
    """Round half up by formula."""
    factor = float(10**digits)
    return F.floor(_col(x) * factor + 0.5) / factor


def exact_sum(x: Column | str, scale: int = 2) -> Column:
    """Sum through decimals, returned as double; independent of row order."""
    return F.sum(_col(x).cast(f"decimal(18,{scale})")).cast("double")


def exact_avg(x: Column | str, scale: int = 2) -> Column:
    """Mean whose sum is exact for values with at most ``scale`` decimals."""
    return exact_sum(x, scale) / F.count(_col(x))


def safe_double(x: Column | str) -> Column:
    """Number or null; text that is no number becomes null, and so does NaN."""
    value = _col(x).try_cast("double")
    return F.when(~F.isnan(value), value)


def clamp(x: Column | str, low: float, high: float) -> Column:
    """Limit to [low, high]; null stays null (least/greatest alone would return the bound)."""
    value = _col(x)
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(float(low))), F.lit(float(high))))


def ratio(numerator: Column | str, denominator: Column | str, digits: int, percent: bool = False) -> Column:
    """Rounded quotient, 0 where the denominator is not positive."""
    quotient = _col(numerator) / _col(denominator)
    if percent:
        quotient = quotient * 100
    return F.when(_col(denominator) > 0, rnd(quotient, digits)).otherwise(F.lit(0.0))


def pct_change(new: Column | str, old: Column | str) -> Column:
    """Change in percent; null where the old value is 0 or missing."""
    return (F.try_divide(_col(new), _col(old)) - 1) * 100


# --- fixed-point frames -------------------------------------------------------------------
# Prices have two decimals, weather values one. Sums and squares over a frame are taken on
# the scaled integers, so a flat series has a standard deviation of exactly 0.


def scaled(x: Column | str, scale: int = 2) -> Column:
    """The value as a whole number of 10^-scale units."""
    return F.round(_col(x) * float(10**scale)).cast("decimal(12,0)")


def frame(keys: str | list[str], order: str, rows: int) -> WindowSpec:
    """The last ``rows`` rows of a series, the current one included."""
    return Window.partitionBy(keys).orderBy(order).rowsBetween(-(rows - 1), 0)


def _spread(units: Column, w: WindowSpec | None) -> tuple[Column, Column, Column]:
    """(n, sum, n * sum of squares - sum^2), each exact."""

    def over(agg: Column) -> Column:
        return agg.over(w) if w is not None else agg

    n = over(F.count(units))
    total = over(F.sum(units)).cast("decimal(19,0)")
    squares = over(F.sum((units * units).cast("decimal(24,0)"))).cast("decimal(28,0)")
    gap = (n.cast("decimal(10,0)") * squares) - (total * total)
    return n, total, gap.cast("double")


def frame_mean(x: Column | str, w: WindowSpec, rows: int, scale: int = 2) -> Column:
    """Mean over a frame, null until the frame holds ``rows`` values."""
    units = scaled(x, scale)
    n = F.count(units).over(w)
    total = F.sum(units).over(w).cast("double")
    return F.when(n == rows, total / (rows * float(10**scale)))


def frame_std(x: Column | str, w: WindowSpec, rows: int, scale: int = 2) -> Column:
    """Sample standard deviation over a frame, null until the frame holds ``rows`` values."""
    n, _, gap = _spread(scaled(x, scale), w)
    return F.when(n == rows, F.sqrt(gap / float(rows * (rows - 1))) / float(10**scale))


def spread_agg(x: Column | str, scale: int = 2) -> tuple[Column, Column, Column]:
    """(n, sum, n * sum of squares - sum^2) as aggregates over a group."""
    return _spread(scaled(x, scale), None)


def spread_over(x: Column | str, w: WindowSpec, scale: int = 2) -> tuple[Column, Column, Column]:
    """(n, sum, n * sum of squares - sum^2) over a frame."""
    return _spread(scaled(x, scale), w)


def fixed_sum(x: Column | str, digits: int = 8) -> Column:
    """Sum of values cut to ``digits`` decimals; independent of row order."""
    factor = float(10**digits)
    return F.sum(F.floor(_col(x) * factor + 0.5).cast("decimal(20,0)")).cast("double") / factor
