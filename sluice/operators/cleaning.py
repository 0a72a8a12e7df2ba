"""Landing tables to curated tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.cleaning import (
    DEVICE_CLASSES,
    NO_SEARCH,
    OTHER_DEVICE,
    device_class,
    not_above,
    text_or,
    within,
)


def clean_viewing(
    viewing: DataFrame,
    low: float = 0.0,
    high: float = 100.0,
    devices=DEVICE_CLASSES,
    other: str = OTHER_DEVICE,
    distinct: bool = False,
) -> DataFrame:
    """Viewing rows with both keys, plausible durations and percentages, and a device class.

    With ``distinct``, rows that agree in all columns after cleaning are kept once.
    """
    cleaned = viewing.dropna(subset=["user_id", "content_id"]).withColumns({
        "duration_watched_min": not_above(
            F.col("duration_watched_min"), F.col("total_duration_min")
        ),
        "completion_pct": within(F.col("completion_pct"), low, high),
        "device_standardized": device_class(F.col("device"), devices, other),
    })
    return cleaned.distinct() if distinct else cleaned


def clean_interactions(interactions: DataFrame, missing: str = NO_SEARCH) -> DataFrame:
    """Interactions with trimmed search text and a marker where there is none."""
    return interactions.withColumn("search_query", text_or(F.col("search_query"), missing))
