"""Rounding and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(value: Column, digits: int = 2) -> Column:
    """Half-up rounding of an aggregated double.

    The last bits of a distributed sum of doubles depend on the order in which
    partial sums meet. Going through a decimal removes that noise first, so a
    value on a rounding edge (1.025) does not flip between runs. Values outside
    the decimal range and NaN are rounded as doubles.
    """
    exact = F.round(value.try_cast("decimal(38,10)"), digits).cast("double")
    return F.coalesce(exact, F.round(value, digits))


def ratio_if_positive(top: Column, bottom: Column, digits: int = 2) -> Column:
    """Rounded ``top / bottom``, or null unless ``bottom`` is above zero."""
    return F.when(bottom > 0, rounded(F.try_divide(top, bottom), digits))


def growth(current: Column, previous: Column) -> Column:
    """Relative change from ``previous`` to ``current``; null when there is no base."""
    return F.try_divide(current - previous, previous)
