"""Daily reports. Ties are settled by key, so a report is the same in every run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.plans.scoring import HIGH_RISK


def high_risk_users(risk: DataFrame, segment: str = HIGH_RISK) -> DataFrame:
    return risk.where(F.col("churn_risk_segment") == segment)


def top_content(performance: DataFrame, n: int = 100) -> DataFrame:
    return performance.orderBy(F.desc("total_viewing_hours"), "content_id").limit(n)


def worst_quality(by_region_isp: DataFrame, n: int = 100) -> DataFrame:
    return by_region_isp.orderBy(
        F.desc("avg_buffering_events"), F.desc("avg_latency_ms"), "cdn_region", "isp"
    ).limit(n)
