"""Counting, rounding and scaling rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def non_negative(column: Column) -> Column:
    """Whole number, null and negative values become 0, fractions are cut off."""
    return F.greatest(F.coalesce(column.cast("long"), F.lit(0)), F.lit(0))


def whole_number(column: Column) -> Column:
    """A number or its text as a 64-bit whole number, fractions cut off; null where it is none."""
    return column.cast("string").try_cast("decimal(38,9)").try_cast("long")


def count_where(condition: Column) -> Column:
    """Rows for which ``condition`` is true; 0, never null, for an empty group."""
    return F.count_if(condition)


def ratio_half_up(part: Column, whole: Column, digits: int) -> Column:
    """Exact decimal ratio, ties away from zero; null when ``whole`` is 0."""
    exact = part.cast("decimal(18,0)") / F.nullif(whole, F.lit(0)).cast("decimal(18,0)")
    return F.round(exact, digits)


def round_half_even(column: Column, digits: int) -> Column:
    """Double rounding, ties to the even neighbour."""
    scale = float(10**digits)
    return F.rint(column * scale) / scale


def ratio_half_even(part: Column, whole: Column, digits: int) -> Column:
    return round_half_even(part.cast("double") / F.nullif(whole, F.lit(0)).cast("double"), digits)


def min_max(column: Column, low: Column, high: Column) -> Column:
    """Position of ``column`` between the bounds; 0 everywhere when the bounds are equal."""
    value, low, high = (c.cast("double") for c in (column, low, high))
    return F.when(high == low, 0.0).otherwise((value - low) / F.nullif(high - low, F.lit(0.0)))
