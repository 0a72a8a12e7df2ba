"""The group-first plans against the straightforward "enrich every session, then group"."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import tuples
from sluice import schemas
from sluice.functions.numbers import rounded
from sluice.operators.cleaning import clean_interactions, clean_viewing
from sluice.plans import engagement as e
from sluice.plans import findings


def random_tables(frame, seed, hot=False):
    """Small random tables with nulls, orphans, repeated profiles and repeated titles."""
    rng = random.Random(seed)

    def pick(values, none=0.1):
        return None if rng.random() < none else rng.choice(values)

    users, titles = list(range(1, 13)), list(range(1, 9))

    def user():
        return 1 if hot and rng.random() < 0.4 else pick(users + [99])

    times = ["2024-01-05 10:00:00", "2024-01-31 23:59:59", "2024-02-01 00:00:00", "bad"]
    viewing = [
        (user(), pick(titles + [77]), pick([0.2, 10.0, 25.0, 33.3]), pick([20.0, 30.0]),
         pick([-5.0, 10.0, 55.5, 120.0]), pick(["TV", "web"]), pick(times))
        for _ in range(300)
    ]
    catalog = [(t, f"t{t}", 2000 + t, 5.0, pick([9.99, 100.0, 0.0])) for t in titles]
    catalog += [catalog[0], (2, "other name", 2002, 5.0, 7.0)]
    profiles = [(u, pick(["basic", "max"]), pick([True, False])) for u in users[:-2]]
    profiles += [profiles[3], profiles[3], (5, "second plan", True)]
    quality = [
        (user(), str(rng.randrange(40)), pick(["eu", "us"]), pick(["a", "b"]), pick([0, 1, 4]),
         pick([1.5, 2.25]), pick([0, 2]), pick([10.0, 35.5]))
        for _ in range(200)
    ]
    interactions = [
        (user(), pick(titles), pick(times), pick(["", " q "])) for _ in range(200)
    ]
    return (
        clean_viewing(frame(schemas.VIEWING_HISTORY, *viewing)),
        frame(schemas.CONTENT_CATALOG, *catalog),
        frame(schemas.USER_PROFILES, *profiles),
        frame(schemas.STREAMING_QUALITY, *quality),
        clean_interactions(frame(schemas.USER_INTERACTIONS, *interactions)),
    )


def two(column):
    # Sums of doubles differ in their last bits with the order of rows, so both sides
    # need the rounding that ignores these bits (7.945 came out as 7.94 and 7.95).
    return rounded(column)


@pytest.mark.parametrize("seed,hot", [(1, False), (2, False), (3, True)])
def test_monthly_engagement_equals_grouping_of_enriched_sessions(frame, seed, hot):
    viewing, catalog, users, quality, interactions = random_tables(frame, seed, hot)
    sessions = e.enrich_sessions(viewing, catalog.dropDuplicates(["content_id"]), users, quality)
    moment = F.try_to_timestamp("start_time")
    keys = ["user_id", "year", "month"]
    direct = (
        sessions.withColumns({"year": F.year(moment), "month": F.month(moment)})
        .groupBy(*keys, "plan_type", "is_churned")
        .agg(
            two(F.sum("duration_watched_min") / 60), F.count_distinct("content_id"),
            two(F.avg("completion_pct")), F.count("*"), two(F.avg("avg_buffering_events")),
            two(F.avg("avg_resolution_changes")), two(F.avg("avg_latency_ms")),
        )
        .join(e.monthly_interactions(interactions), keys, "left")
        .fillna(0, ["interaction_count", "interacted_titles"])
    )
    got = e.user_monthly_engagement(viewing, users, quality, interactions)
    assert tuples(got) == tuples(direct)


@pytest.mark.parametrize("seed,hot", [(4, False), (5, True)])
def test_content_performance_equals_grouping_of_enriched_sessions(frame, seed, hot):
    viewing, catalog, _, _, _ = random_tables(frame, seed, hot)
    direct = (
        viewing.join(catalog, "content_id", "left")
        .groupBy("content_id", *e.TITLE_COLUMNS)
        .agg(
            F.count_distinct("user_id").alias("v"), F.count("*").alias("n"),
            two(F.sum("duration_watched_min") / 60).alias("h"),
            two(F.avg("completion_pct")).alias("p"),
        )
        .withColumn("c", F.when(F.col("h") > 0, two(F.col("license_cost_monthly") / F.col("h"))))
    )
    assert tuples(e.content_performance(viewing, catalog)) == tuples(direct)


@pytest.mark.parametrize("seed", [6, 7])
def test_enriched_sessions_equal_three_joins(frame, seed):
    viewing, catalog, users, quality, _ = random_tables(frame, seed)
    direct = (
        viewing.join(catalog, "content_id", "left").join(users, "user_id", "left")
        .join(e.quality_by_user(quality), "user_id", "left")
    )
    got = e.enrich_sessions(viewing, catalog, users, quality)
    assert got.columns == direct.columns
    assert tuples(got) == tuples(direct)


def test_hours_that_round_to_zero_have_no_cost(frame):
    viewing = frame(schemas.VIEWING_HISTORY,
                    (1, 1, 0.2, 5.0, 1.0, "tv", None), (1, 2, 60.0, 90.0, 1.0, "tv", None),
                    (1, 3, 60.0, 90.0, 1.0, "tv", None))
    catalog = frame(schemas.CONTENT_CATALOG, (1, "a", 2000, 1.0, 9.0), (2, "b", 2000, 1.0, 9.0),
                    (3, "c", 2000, 1.0, None))
    got = tuples(e.content_performance(viewing, catalog),
                 "content_id", "total_viewing_hours", "cost_per_viewing_hour")
    assert got == [(1, 0.0, None), (2, 1.0, 9.0), (3, 1.0, None)]


def test_correlation_equals_the_built_in_one(frame):
    viewing, _, _, quality, _ = random_tables(frame, 8)
    joined = viewing.join(e.quality_by_user(quality), "user_id")
    direct = joined.agg(F.corr("avg_buffering_events", "completion_pct")).first()[0]
    got = findings.quality_corr(viewing, quality).first()
    assert got["buffering_completion_corr"] == pytest.approx(direct, abs=1e-4)


def test_correlation_without_variation_is_null(frame):
    viewing = frame(schemas.VIEWING_HISTORY, (1, 1, 1.0, 2.0, 50.0, "tv", None))
    quality = frame(schemas.STREAMING_QUALITY, (1, "s", "eu", "a", 1, 1.0, 1, 1.0))
    assert findings.quality_corr(viewing, quality).first()["buffering_completion_corr"] is None


def test_grouping_hot_sessions_is_partly_done_before_the_shuffle(frame):
    viewing, catalog, _, _, _ = random_tables(frame, 9, hot=True)
    plan = e.content_performance(viewing, catalog)._jdf.queryExecution().executedPlan().toString()
    first_shuffle = [line for line in plan.splitlines() if "Exchange hashpartitioning(content_id" in line]
    assert any("user_id" in line for line in first_shuffle)  # spread by title and viewer
    assert "partial_sum" in plan


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_cost_decile_against_brute_force(frame, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice([None, 0.0, 0.01, 1.0, 1.01, 5.5, 300.0, 301.0, 1e6]), float(i))
            for i in range(rng.choice([5, 57, 200]))]
    df = frame("content_id INT, cost_per_viewing_hour DOUBLE, license_cost_monthly DOUBLE", *rows)
    priced = [r for r in rows if r[1] is not None]
    limit = -(-len(priced) // 10)
    worst = [r for r in priced if sum(o[1] > r[1] for o in priced) < limit]
    got = findings.cost_decile_share(df).first()
    assert got["priced_titles"] == len(priced)
    assert got["worst_titles"] == len(worst)
    assert got["cost_threshold"] == min(r[1] for r in worst)
    assert got["worst_monthly_spend"] == sum(r[2] for r in worst)
    assert got["worst_annual_spend"] == 12 * sum(r[2] for r in worst)


def test_monthly_figures_of_odd_rows(frame):
    """Nulls in keys and titles, rows that come twice, more titles than parts."""
    day = "2026-03-05 10:00:00"
    clicks = [(1, i % 40, day, None) for i in range(100)]
    clicks += [(1, None, day, None), (None, 3, day, None), (None, 3, day, None), (None, None, None, None),
               (2, 3, None, None), (2, 4, "no time", None), (2, 4, "2026-04-01 00:00:00", None)]
    interactions = frame(schemas.USER_INTERACTIONS, *clicks)
    moment = F.try_to_timestamp("timestamp")
    direct = interactions.groupBy("user_id", F.year(moment).alias("year"), F.month(moment).alias("month")).agg(
        F.count("*"), F.count_distinct("content_id"))
    assert tuples(e.monthly_interactions(interactions)) == tuples(direct)
    viewing = frame(schemas.VIEWING_HISTORY, (1, 1, 30.0, 60.0, None, "tv", day), (1, 1, 30.0, 60.0, None, "tv", day),
                    (2, 2, None, 60.0, 40.0, "tv", None), (None, 2, 60.0, 60.0, 40.0, "tv", day))
    got = e.user_monthly_engagement(viewing, frame(schemas.USER_PROFILES), frame(schemas.STREAMING_QUALITY), interactions)
    assert tuples(got, "user_id", "year", "month", "total_watch_hours", "unique_titles_watched", "avg_completion_pct",
                  "total_viewing_records", "interaction_count", "interacted_titles") == [
        (None, 2026, 3, 1.0, 1, 40.0, 1, 0, 0), (1, 2026, 3, 1.0, 1, None, 2, 101, 40),
        (2, None, None, None, 1, 40.0, 1, 0, 0)]
