"""Ratios, rounding and money."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """Quotient rounded half away from zero; NULL when the denominator is zero or NULL."""
    return F.round(F.try_divide(numerator, denominator), digits)


def round_to_long(value: Column) -> Column:
    """Double to bigint, rounding halves away from zero (a bare cast truncates)."""
    return F.round(value).cast("bigint")


def micros(value: Column) -> Column:
    """Millionths to units."""
    return value / F.lit(1000000)
