"""Business findings computed from the analytics tables."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.numbers import rounded
from sluice.operators.ranking import rank_from_top
from sluice.plans.engagement import quality_by_user


def cost_decile_share(performance: DataFrame, share: float = 0.10) -> DataFrame:
    """What the titles with the highest cost per viewing hour take of the license spend.

    A title belongs to the worst decile if fewer than a tenth of all priced
    titles (rounded up) cost more per hour, so equal costs are never torn apart.
    """
    cost = "cost_per_viewing_hour"
    spend = F.col("license_cost_monthly").cast("decimal(18,2)")
    priced = (
        performance.where(F.col(cost).isNotNull())
        .groupBy(cost).agg(F.count("*").alias("titles"), F.sum(spend).alias("spend"))
    )
    worst = F.col("above") < F.ceil(F.col("of_total") * F.lit(Decimal(str(share))))
    figures = rank_from_top(priced, cost, "titles").agg(
        F.sum("titles").alias("priced_titles"),
        F.sum(F.when(worst, F.col("titles"))).alias("worst_titles"),
        F.min(F.when(worst, F.col(cost))).alias("cost_threshold"),
        F.sum(F.when(worst, F.col("spend"))).cast("double").alias("worst_monthly_spend"),
        F.sum("spend").cast("double").alias("total_monthly_spend"),
    )
    return figures.withColumns({
        "worst_annual_spend": rounded(F.col("worst_monthly_spend") * 12),
        "spend_share": rounded(
            F.try_divide(F.col("worst_monthly_spend"), F.col("total_monthly_spend")), 4
        ),
    })


def cost_spread(performance: DataFrame) -> DataFrame:
    """Highest and lowest cost per viewing hour and how many times one is the other."""
    cost = F.col("cost_per_viewing_hour")
    ends = performance.agg(F.min(cost).alias("lowest_cost"), F.max(cost).alias("highest_cost"))
    return ends.withColumn(
        "times", rounded(F.try_divide(F.col("highest_cost"), F.col("lowest_cost")))
    )


COHORT_METRICS = (
    "total_watch_hours", "avg_completion_pct", "avg_buffering_events", "unique_titles_watched",
)


def churn_cohorts(engagement: DataFrame, metrics=COHORT_METRICS) -> DataFrame:
    """Mean of each monthly figure for churned and retained users, and the gap between them."""
    churned = F.col("is_churned")
    means = engagement.agg(*[
        F.struct(
            F.avg(F.when(churned, F.col(m))).alias("churned"),
            F.avg(F.when(~churned, F.col(m))).alias("retained"),
        ).alias(m)
        for m in metrics
    ])
    rows = F.array(*[
        F.struct(
            F.lit(m).alias("metric"),
            rounded(F.col(m)["churned"], 4).alias("churned_mean"),
            rounded(F.col(m)["retained"], 4).alias("retained_mean"),
            rounded(
                F.try_divide(F.col(m)["retained"] - F.col(m)["churned"], F.col(m)["retained"]), 4
            ).alias("relative_gap"),
        )
        for m in metrics
    ])
    return means.select(F.inline(rows))


def quality_spread(quality: DataFrame) -> DataFrame:
    """How far mean buffering differs between regions and between providers.

    Spread is (highest - lowest) / mean of the group means.
    """
    sums = quality.groupBy("cdn_region", "isp").agg(
        F.sum("buffering_events").alias("total"), F.count("buffering_events").alias("n")
    )
    levels = []
    for dimension in ("cdn_region", "isp"):
        groups = sums.groupBy(dimension).agg(
            F.try_divide(F.sum("total"), F.sum("n")).alias("mean_buffering")
        )
        value = F.col("mean_buffering")
        levels.append(groups.agg(
            F.lit(dimension).alias("dimension"),
            F.count(value).alias("groups"),
            F.min(value).alias("low"), F.max(value).alias("high"), F.avg(value).alias("mean"),
        ))
    return reduce(DataFrame.unionByName, levels).select(
        "dimension", "groups",
        rounded(F.col("low"), 4).alias("lowest_mean"),
        rounded(F.col("high"), 4).alias("highest_mean"),
        rounded(F.try_divide(F.col("high") - F.col("low"), F.col("mean")), 4).alias("spread"),
    )


def quality_corr(viewing: DataFrame, quality: DataFrame) -> DataFrame:
    """Correlation over sessions of a user's mean buffering with the session's completion.

    Buffering is the same for all sessions of a user, so the sessions are summed
    up per user before the two sides meet, and the coefficient comes from sums.
    """
    pct = F.col("completion_pct").cast("double")
    per_user = viewing.groupBy("user_id").agg(
        F.count(pct).alias("n"), F.sum(pct).alias("y"), F.sum(pct * pct).alias("yy")
    )
    buffering = quality_by_user(quality).select("user_id", F.col("avg_buffering_events").alias("x"))
    n, x, y, yy = (F.col(c) for c in ("n", "x", "y", "yy"))
    sums = per_user.join(buffering, "user_id").where(x.isNotNull()).agg(
        F.sum(n).alias("n"), F.sum(n * x).alias("sx"), F.sum(y).alias("sy"),
        F.sum(n * x * x).alias("sxx"), F.sum(yy).alias("syy"), F.sum(x * y).alias("sxy"),
    )
    n, sx, sy, sxx, syy, sxy = (F.col(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy"))
    both = F.sqrt((n * sxx - sx * sx) * (n * syy - sy * sy))
    return sums.select(
        n.alias("sessions"),
        rounded(F.try_divide(n * sxy - sx * sy, both), 4).alias("buffering_completion_corr"),
    )
