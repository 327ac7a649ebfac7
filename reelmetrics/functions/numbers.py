"""Rates, rounding and display formats."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_half_even(c: Column, digits: int) -> Column:
    """Scale, round to the nearest even, scale back (the built-in ``round`` is half-up)."""
    scale = float(10**digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def rate_percent(part: Column, whole: Column, digits: int = 4) -> Column:
    """``part / whole`` in percent; NULL when the whole is zero or missing."""
    share = part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))
    return round_half_even(share * 100, digits)


def _one_decimal(x: Column) -> Column:
    """A positive value with one decimal, rounded as its exact binary value demands.

    The sign of ``20x - (2r+1)`` tells on which side of the midpoint after ``r`` tenths the
    value lies. ``x`` is split into two short halves so that each product is exact.
    """
    r = F.floor(x * 10)
    high = x.cast("float").cast("double")
    side = (high * 20 - (r * 2 + 1)) + (x - high) * 20
    up = (side > 0) | ((side == 0) & (r % 2 == 1))
    tenths = r + F.when(up, 1).otherwise(0)
    return F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"))


def abbreviate(c: Column, missing: str = "—") -> Column:
    """``1.2M`` / ``3.4K`` / ``56``; NULL shows as ``missing``."""
    n = c.cast("double")
    return (
        F.when(n.isNull() | F.isnan(n), F.lit(missing))
        .when(n >= 1_000_000, F.concat(_one_decimal(n / 1_000_000), F.lit("M")))
        .when(n >= 1_000, F.concat(_one_decimal(n / 1_000), F.lit("K")))
        .otherwise(F.rint(n).cast("bigint").cast("string"))
    )

