"""Numeric column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.schemas import BUSINESS_DAYS_PER_YEAR


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_decimal_comma(col) -> Column:
    """``"5,2"`` -> 5.2 as double.  Under ANSI mode a malformed text such as
    ``"1.234,5"`` raises, as a strict float parse does."""
    return F.replace(_c(col), F.lit(","), F.lit(".")).cast("double")


def annualize_rate(daily_pct, scale: int | None = None) -> Column:
    """Compound a daily percentage rate over the business days of a year:
    ``((1 + r/100) ** 252 - 1) * 100``; rounded half away from zero to
    ``scale`` digits when given."""
    r = _c(daily_pct).cast("double")
    value = (F.pow(F.lit(1.0) + r / F.lit(100.0), F.lit(float(BUSINESS_DAYS_PER_YEAR)))
             - F.lit(1.0)) * F.lit(100.0)
    return F.round(value, scale) if scale is not None else value


def nan_to_null(col) -> Column:
    """NaN becomes NULL (NULL stays NULL).  Only meaningful for float/double."""
    c = _c(col)
    return F.when(~F.isnan(c), c)


def store_cast(col, precision: int, scale: int) -> Column:
    """Round half away from zero to ``scale`` digits and cast to
    ``DECIMAL(precision, scale)``; overflow raises under ANSI."""
    return F.round(_c(col), scale).cast(T.DecimalType(precision, scale))


def safe_corr(x, y) -> Column:
    """Pearson correlation with pairwise NULL skipping that yields NULL (not
    an error) when either side is constant or has fewer than two pairs.

    ``corr`` raises DIVIDE_BY_ZERO under ANSI on a constant column; this form
    divides with ``try_divide`` instead."""
    xd, yd = _c(x).cast("double"), _c(y).cast("double")
    both = xd.isNotNull() & yd.isNotNull()
    xs, ys = F.when(both, xd), F.when(both, yd)
    return F.try_divide(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))
