"""Churn risk of each user and month."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.bands import Bands

# Risk per figure, by the first threshold that is passed.
RISK_BANDS = {
    "watch_hours_risk": Bands(
        "total_watch_hours", "<", ((2, 1.0), (5, 0.7), (10, 0.4)), 0.0),
    "completion_risk": Bands(
        "avg_completion_pct", "<", ((25, 1.0), (50, 0.6), (75, 0.3)), 0.0),
    "buffering_risk": Bands(
        "avg_buffering_events", ">=", ((3, 1.0), (1, 0.5)), 0.0),
    "interaction_risk": Bands(
        "interaction_count", "<=", ((1, 1.0), (5, 0.5)), 0.0),
}
# Weights of the four risks, in the order of RISK_BANDS.
WEIGHTS = (0.40, 0.25, 0.20, 0.15)
# Segment by rounded score.
SEGMENTS = Bands(
    "churn_risk_score", ">=", ((0.70, "High Risk"), (0.40, "Medium Risk")), "Low Risk")
HIGH_RISK = "High Risk"


def _score(names, weights, exact: bool, steps=()) -> Column:
    """Weighted sum, rounded half up to two digits, by default of decimals.

    The decimals have as many digits as weights and risks (``steps``) are given with. With doubles, a sum such as 0.545 can come out just below the rounding
    edge; ``exact`` adds in decimals instead.
    """
    digits = max(-Decimal(str(x)).as_tuple().exponent for x in (*weights, 0.01, *steps))

    def number(value: Column) -> Column:
        return value.cast(f"decimal({digits + 2},{digits})") if exact else value

    total = sum(
        (number(F.lit(w)) * number(F.col(n)) for n, w in zip(names, weights, strict=True)),
        start=number(F.lit(0.0)),
    )
    return F.round(total, 2).cast("double")


def _values(bands) -> list[float]:
    """All risks that bands can give."""
    return [value for band in bands.values() for value in (band.default, *[v for _, v in band.steps])]


def churn_risk(engagement: DataFrame, weights=WEIGHTS, bands=RISK_BANDS,
               segments: Bands = SEGMENTS, exact: bool = True) -> DataFrame:
    """Engagement rows with four risks, their score and its segment; no shuffle."""
    risks = {name: band.expression() for name, band in bands.items()}
    return (
        engagement.withColumns(risks)
        .withColumn("churn_risk_score", _score(list(bands), weights, exact, _values(bands)))
        .withColumn("churn_risk_segment", segments.expression())
    )
