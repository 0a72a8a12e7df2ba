"""Curated and analytics tables of the media lake.

The monthly and per-title tables could be had by enriching every session and
grouping then. Here the sessions are grouped first and the much shorter result
is enriched: no session row is shuffled for a join, and what the grouping
shuffles is partly aggregated before. Profile or catalog rows that
occur more than once multiply sessions in a join; ``copies`` does the same for
the sums here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from sluice.functions.cleaning import event_time
from sluice.functions.numbers import ratio_if_positive, rounded
from sluice.operators.grouping import PART, dealt_by_value
from sluice.operators.matching import repeats_folded

QUALITY_METRICS = ("buffering_events", "avg_bitrate_mbps", "resolution_changes", "latency_ms")


def _mean_name(metric: str) -> str:
    return metric if metric.startswith("avg_") else f"avg_{metric}"


def _quality_means() -> list[Column]:
    return [rounded(F.avg(m)).alias(_mean_name(m)) for m in QUALITY_METRICS]


def quality_by_user(quality: DataFrame) -> DataFrame:
    """Mean delivery quality of each user, rounded to two digits."""
    return quality.groupBy("user_id").agg(*_quality_means())


def quality_by_region_isp(quality: DataFrame) -> DataFrame:
    return quality.groupBy("cdn_region", "isp").agg(
        F.count_distinct("session_id").alias("total_sessions"), *_quality_means()
    )


def enrich_sessions(viewing: DataFrame, catalog: DataFrame, users: DataFrame,
                    quality: DataFrame, by_user: DataFrame | None = None) -> DataFrame:
    """Every session with its title, its user and the user's delivery quality.

    What is known per user is put together first, so the sessions meet it in one
    join instead of two, which also leaves that join free to be split at run
    time where one user has a large part of the sessions. ``by_user`` is
    ``quality_by_user(quality)``, if it is stored.
    """
    means = quality_by_user(quality) if by_user is None else by_user
    per_user = users.where(F.col("user_id").isNotNull()).join(means, "user_id", "full")
    return viewing.join(catalog, "content_id", "left").join(per_user, "user_id", "left")


def _with_month(df: DataFrame, when: str) -> DataFrame:
    moment = event_time(F.col(when))
    return df.withColumns({"year": F.year(moment), "month": F.month(moment)})


# A month as its first day, which is one column of a shuffled row in place of two.
FIRST_DAY = "first_day"


def _month_parts(df: DataFrame, when: str, *values: str) -> GroupedData:
    """Rows by user, month and part of the titles."""
    first_day = F.trunc(event_time(F.col(when)), "month").alias(FIRST_DAY)
    rows = df.select("user_id", first_day, "content_id", *values)
    return dealt_by_value(rows, ["user_id", FIRST_DAY], "content_id").groupBy("user_id", FIRST_DAY, PART)


def _by_user_month(parts: DataFrame, **figures: Column) -> DataFrame:
    """Figures of a user's months from their parts, of which a user has few.

    Gathered by user, they meet what is joined by user without a further shuffle.
    """
    grouped = parts.repartition("user_id").groupBy("user_id", FIRST_DAY).agg(
        *[figure.alias(name) for name, figure in figures.items()])
    return grouped.select("user_id", F.year(FIRST_DAY).alias("year"), F.month(FIRST_DAY).alias("month"), *figures)


def monthly_interactions(interactions: DataFrame) -> DataFrame:
    parts = _month_parts(interactions, "timestamp").agg(
        F.count("*").alias("n"), F.count_distinct("content_id").alias("titles"))
    return _by_user_month(parts, interaction_count=F.sum("n"), interacted_titles=F.sum("titles"))


INTERACTION_FIGURES = ["interaction_count", "interacted_titles"]


def _month_number() -> Column:
    return F.col("year") * 100 + F.col("month")


def _by_user(monthly: DataFrame) -> DataFrame:
    """One row a user: ``by_month``, the interaction figures of the user's months by month number."""
    months = F.collect_list(F.struct(_month_number(), F.struct(*INTERACTION_FIGURES)))
    dated = monthly.where(F.col("user_id").isNotNull() & F.col("year").isNotNull())
    return dated.groupBy("user_id").agg(F.map_from_entries(months).alias("by_month"))


def _hours(minutes: Column) -> Column:
    return rounded(minutes / 60)


def user_monthly_engagement(viewing: DataFrame, users: DataFrame, quality: DataFrame,
                            interactions: DataFrame, by_user: DataFrame | None = None) -> DataFrame:
    """Viewing, quality and interaction figures per user and month.

    Quality is known per user only, so its mean over the sessions of a month is
    the user's value. A month without a readable time has no interactions.
    The interactions of a user's months are one row, so that all joins are by user.
    ``by_user`` is ``quality_by_user(quality)``, if it is stored.
    """
    parts = _month_parts(viewing, "start_time", "duration_watched_min", "completion_pct").agg(
        F.sum("duration_watched_min").alias("part_minutes"), F.count_distinct("content_id").alias("titles"),
        F.sum(F.col("completion_pct").cast("double")).alias("pct"), F.count("completion_pct").alias("rated"),
        F.count("*").alias("n"))
    watched = _by_user_month(
        parts,
        minutes=F.sum("part_minutes"),
        unique_titles_watched=F.sum("titles"),
        avg_completion_pct=rounded(F.try_divide(F.sum("pct"), F.sum("rated"))),
        sessions=F.sum("n"),
    )
    means = quality_by_user(quality) if by_user is None else by_user
    known = users.where(F.col("user_id").isNotNull())
    per_user = repeats_folded(known, ["user_id", "plan_type", "is_churned"]).join(
        means.drop("avg_bitrate_mbps"), "user_id", "full"
    )
    copies = F.coalesce("copies", F.lit(1))
    seen = F.try_element_at("by_month", _month_number())
    return (
        watched.join(_by_user(monthly_interactions(interactions)), "user_id", "left")
        .join(per_user, "user_id", "left")
        .select(
            "user_id", "year", "month", "plan_type", "is_churned",
            _hours(F.col("minutes") * copies).alias("total_watch_hours"),
            "unique_titles_watched",
            "avg_completion_pct",
            (F.col("sessions") * copies).alias("total_viewing_records"),
            "avg_buffering_events", "avg_resolution_changes", "avg_latency_ms",
            *[seen[figure].alias(figure) for figure in INTERACTION_FIGURES],
        )
        .fillna(0, INTERACTION_FIGURES)
    )


TITLE_COLUMNS = ["title", "release_year", "imdb_score", "license_cost_monthly"]


def content_performance(viewing: DataFrame, catalog: DataFrame) -> DataFrame:
    """Viewers, hours and cost per viewing hour of each title.

    The cost is divided by the rounded hours; a title whose hours round to zero
    has no cost per hour. A title missing from the catalog keeps null attributes.
    """
    watched = viewing.groupBy("content_id").agg(
        F.count_distinct("user_id").alias("unique_viewers"),
        F.count("*").alias("sessions"),
        F.sum("duration_watched_min").alias("minutes"),
        rounded(F.avg("completion_pct")).alias("avg_completion_pct"),
    )
    titles = repeats_folded(catalog, ["content_id", *TITLE_COLUMNS])
    copies = F.coalesce("copies", F.lit(1))
    return (
        watched.join(titles, "content_id", "left")
        .select(
            "content_id", *TITLE_COLUMNS, "unique_viewers",
            (F.col("sessions") * copies).alias("total_viewing_records"),
            _hours(F.col("minutes") * copies).alias("total_viewing_hours"),
            "avg_completion_pct",
        )
        .withColumn(
            "cost_per_viewing_hour",
            ratio_if_positive(F.col("license_cost_monthly"), F.col("total_viewing_hours")),
        )
    )


#: Logarithm of a sketch's registers; its relative error is about 1.04 / sqrt(registers).
SKETCH_SIZE = 14


def sketch_error(size: int = SKETCH_SIZE, deviations: float = 3.0) -> float:
    """Relative error of a sketched count that so many standard deviations allow."""
    return deviations * 1.04 / 2 ** (size / 2)


def viewer_sketches(viewing: DataFrame, *groups: str, size: int = SKETCH_SIZE) -> DataFrame:
    """A mergeable sketch of the viewers of each month (and ``groups``), to be stored.

    A sketch has a few kilobytes, whatever the number of viewers, and counts of longer spans
    follow from the sketches of their months without the sessions. ``content_performance`` and
    the monthly tables count exactly; this is for spans that nobody has counted.
    """
    known = _with_month(viewing, "start_time").where(F.col("user_id").isNotNull())
    return known.groupBy(*groups, "year", "month").agg(
        F.hll_sketch_agg(F.col("user_id").cast("string"), size).alias("viewers"), F.count("*").alias("sessions"))


def quarterly_viewers(viewing: DataFrame) -> DataFrame:
    """Exact distinct viewers of each quarter."""
    moment = event_time(F.col("start_time"))
    return viewing.groupBy(F.year(moment).alias("year"), F.quarter(moment).alias("quarter")).agg(
        F.count_distinct("user_id").alias("viewers"))


def sketched_viewers(sketches: DataFrame, *span: str) -> DataFrame:
    """Estimated distinct viewers and exact sessions of each span, from stored sketches of months."""
    quarter = F.ceil(F.col("month") / 3).cast("int")
    return sketches.withColumn("quarter", quarter).groupBy(*span).agg(
        F.hll_sketch_estimate(F.hll_union_agg("viewers")).alias("viewers"), F.sum("sessions").alias("sessions"))
