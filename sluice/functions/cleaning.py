"""Cleaning expressions for the landing data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A device belongs to the first class whose text it contains.
DEVICE_CLASSES = (
    ("tv", "TV"),
    ("phone", "Mobile"),
    ("mobile", "Mobile"),
    ("tablet", "Tablet"),
    ("web", "Web"),
    ("desktop", "Web"),
)
OTHER_DEVICE = "Other"

# Fixed value: stands for an interaction without search text.
NO_SEARCH = "no_search_query"


def device_class(device: Column, classes=DEVICE_CLASSES, other: str = OTHER_DEVICE) -> Column:
    """Class of a free-text device name, ignoring case; unknown and null are ``other``."""
    name = F.lower(device)
    matches = [F.when(name.contains(text), F.lit(label)) for text, label in classes]
    return F.coalesce(*matches, F.lit(other))


def not_above(value: Column, ceiling: Column) -> Column:
    """``value``, but never more than ``ceiling``; a null on either side changes nothing.

    (``least`` would replace a null value by the ceiling.)
    """
    return F.when(value > ceiling, ceiling).otherwise(value)


def within(value: Column, low: float, high: float) -> Column:
    """``value`` limited to [low, high]; null stays null."""
    limited = F.least(F.greatest(value, F.lit(low)), F.lit(high))
    return F.when(value.isNotNull(), limited)


def text_or(value: Column, missing: str) -> Column:
    """Text without surrounding spaces, or ``missing`` for null; empty text stays empty."""
    return F.coalesce(F.trim(value), F.lit(missing))


def event_time(value: Column) -> Column:
    """Timestamp of a text, date or timestamp column; unreadable text gives null."""
    return F.try_to_timestamp(value)
