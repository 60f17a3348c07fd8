"""Numeric column helpers: null-safe parsing, units, rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INFINITY = float("inf")


def as_column(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def finite_or_null(value, multiplier: float = 1.0) -> Column:
    """Finite double, else NULL.  NaN is NULL everywhere in this engine: Spark's
    ``max`` ranks NaN highest and ``sum`` spreads it."""
    number = as_column(value).try_cast("double") * F.lit(float(multiplier))
    return F.when(~F.isnan(number) & (F.abs(number) < _INFINITY), number)


def whole_or_null(value) -> Column:
    return F.trim(as_column(value)).try_cast("bigint")


def whole_or_zero(value) -> Column:
    return F.coalesce(whole_or_null(value), F.lit(0).cast("bigint"))


def truncated(value) -> Column:
    """Toward zero; NULL or non-finite becomes 0."""
    return F.coalesce(finite_or_null(value).cast("bigint"), F.lit(0).cast("bigint"))


def lots_to_shares(lots) -> Column:
    return as_column(lots) * 100


def shares_to_lots(shares) -> Column:
    """Whole lots, flooring (so negatives floor too)."""
    return F.floor(as_column(shares) / 100)


def ten_thousands(value) -> Column:
    """10k yuan -> yuan, 10k shares -> shares.  Scale before any truncation."""
    return as_column(value) * 10_000


def turnover_rate(volume_shares, float_equity) -> Column:
    """Percent; unknown or non-positive inputs give 0.0."""
    volume, equity = as_column(volume_shares), as_column(float_equity)
    return F.when((volume > 0) & (equity > 0), volume / equity * 100.0).otherwise(0.0)


def half_up(value, digits: int) -> Column:
    """HALF_UP (away from zero) rounding of a double.

    A nudge of 1e-8 of the last place absorbs binary noise (13.695 stored as
    13.69499... rounds to 13.70); all in double arithmetic, inside codegen.
    """
    value = as_column(value).cast("double")
    unit = float(10**digits)
    return F.signum(value) * (F.floor(F.abs(value) * unit + (0.5 + 1e-8)) / unit)


def percent(part, whole, digits: int = 2) -> Column:
    """part / whole in percent, 0.0 where whole is not positive."""
    part, whole = as_column(part), as_column(whole)
    return F.when(whole > 0, F.round(part / whole * 100.0, digits)).otherwise(0.0)
