"""Null-safe numeric helpers (ANSI mode stays on; every risky step is a try_*)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: "Column | str") -> Column:
    return F.col(col) if isinstance(col, str) else col


def try_numeric(col: "Column | str") -> Column:
    """Text -> double, fractions and exponents included; unparsable text (e.g. ``NA``) becomes NULL."""
    return _c(col).try_cast("double")


def try_whole(col: "Column | str") -> Column:
    """Text or number -> long: whole numbers in any notation, NULL for the rest."""
    c = _c(col)
    d = c.try_cast("double")
    return F.coalesce(F.when(d == F.floor(d), c.try_cast("bigint")), F.when(d == F.floor(d), d.try_cast("bigint")))


def safe_ratio(num: "Column | str", den: "Column | str", scale: float | int = 1) -> Column:
    """``num / den * scale`` when ``den > 0``, else NULL (division first, as the reference does)."""
    n, d = _c(num), _c(den)
    ratio = F.try_divide(n.cast("double"), d.cast("double"))
    if scale != 1:
        ratio = ratio * F.lit(scale)
    return F.when(d > 0, ratio)


def rate_per_day(value: "Column | str", days: "Column | str") -> Column:
    """``value / days`` for a positive age, ``value`` for age <= 0, NULL for a missing age."""
    v, d = _c(value).cast("double"), _c(days)
    return F.when(d.isNull(), F.lit(None).cast("double")).when(d > 0, F.try_divide(v, d.cast("double"))).otherwise(v)


SNAP_DIGITS = 12


def round_to(col: "Column | str", digits: int) -> Column:
    """Half-up rounding of the value's decimal form, snapped to 12 places first.

    The snap removes binary noise (0.16874999999999998 -> 0.16875) so values that
    are ties in exact arithmetic round the same way on every engine.
    """
    return F.round(F.round(_c(col), SNAP_DIGITS), digits)


def weighted_rate(num_sum: Column, den_sum: Column, digits: int | None = 4) -> Column:
    """Ratio of sums (never the mean of ratios); NULL when the denominator sums to 0."""
    r = F.try_divide(num_sum.cast("double"), F.nullif(den_sum, F.lit(0)).cast("double"))
    return round_to(r, digits) if digits is not None else r


BI_DIGITS = 10


def mean(col: "Column | str") -> Column:
    """Average of the non-null values (native double aggregate, vectorised)."""
    return F.avg(_c(col))


def bi(col: "Column | str") -> Column:
    """A measure as published by a sheet: at 1e-10 resolution.

    Double sums depend on the order rows reach the aggregate (partitioning,
    retries) in the last bits; publishing at this resolution makes every sheet
    value the same on every run and on every engine.
    """
    return round_to(col, BI_DIGITS)
