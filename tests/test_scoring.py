import itertools
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from helpers import tuples
from sluice.plans.reports import high_risk_users, top_content, worst_quality
from sluice.plans.scoring import SEGMENTS, churn_risk

ENGAGEMENT = ("user_id INT, total_watch_hours DOUBLE, avg_completion_pct DOUBLE, "
              "avg_buffering_events DOUBLE, interaction_count BIGINT")

HOURS = [(1.99, 1.0), (2.0, .7), (4.99, .7), (5.0, .4), (9.99, .4), (10.0, 0.0), (None, 0.0)]
COMPLETION = [(24.99, 1.0), (25.0, .6), (49.99, .6), (50.0, .3), (74.99, .3), (75.0, 0.0), (None, 0.0)]
BUFFERING = [(0.99, 0.0), (1.0, .5), (2.99, .5), (3.0, 1.0), (None, 0.0)]
INTERACTIONS = [(0, 1.0), (1, 1.0), (2, .5), (5, .5), (6, 0.0), (None, 0.0)]


def test_every_combination_of_bands(frame):
    cases = list(itertools.product(HOURS, COMPLETION, BUFFERING, INTERACTIONS))
    df = frame(ENGAGEMENT, *[(i, *[value for value, _ in case]) for i, case in enumerate(cases)])
    got = {r["user_id"]: r for r in churn_risk(df).collect()}
    for i, case in enumerate(cases):
        risks = [risk for _, risk in case]
        row = got[i]
        assert [row["watch_hours_risk"], row["completion_risk"], row["buffering_risk"],
                row["interaction_risk"]] == risks
        exact = sum(Decimal(w) * Decimal(str(r))
                    for w, r in zip(("0.40", "0.25", "0.20", "0.15"), risks))
        assert row["churn_risk_score"] == float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP))


def test_double_scores_are_within_a_cent_and_in_the_same_segment(frame):
    cases = list(itertools.product(HOURS, COMPLETION, BUFFERING, INTERACTIONS))
    df = frame(ENGAGEMENT, *[(i, *[value for value, _ in case]) for i, case in enumerate(cases)])
    exact = {r["user_id"]: r for r in churn_risk(df).collect()}
    double = {r["user_id"]: r for r in churn_risk(df, exact=False).collect()}
    differing = [i for i in exact
                 if exact[i]["churn_risk_score"] != double[i]["churn_risk_score"]]
    assert differing
    for i in differing:
        assert abs(exact[i]["churn_risk_score"] - double[i]["churn_risk_score"]) < 0.0101
    assert all(exact[i]["churn_risk_segment"] == double[i]["churn_risk_segment"] for i in exact)


def test_segments(frame):
    df = frame("churn_risk_score DOUBLE", (0.39,), (0.40,), (0.69,), (0.70,), (None,))
    got = [r[0] for r in df.select(SEGMENTS.expression()).collect()]
    assert got == ["Low Risk", "Medium Risk", "Medium Risk", "High Risk", "Low Risk"]


def test_high_risk_report(frame):
    df = frame("user_id INT, churn_risk_segment STRING", (1, "High Risk"), (2, "Low Risk"))
    assert tuples(high_risk_users(df), "user_id") == [(1,)]


def test_top_content_settles_ties_by_key_and_puts_nulls_last(frame):
    df = frame("content_id INT, total_viewing_hours DOUBLE",
               (9, 5.0), (3, 5.0), (7, 5.0), (1, None), (2, 1.0))
    assert [r[0] for r in top_content(df, 2).collect()] == [3, 7]
    assert [r[0] for r in top_content(df, 5).collect()] == [3, 7, 9, 2, 1]


def test_worst_quality_orders_by_buffering_then_latency(frame):
    df = frame("cdn_region STRING, isp STRING, avg_buffering_events DOUBLE, avg_latency_ms DOUBLE",
               ("a", "x", 1.0, 9.0), ("b", "x", 2.0, 1.0), ("b", "y", 2.0, 3.0), ("a", "y", 2.0, 3.0))
    got = [tuple(r)[:2] for r in worst_quality(df, 3).collect()]
    assert got == [("a", "y"), ("b", "y"), ("b", "x")]


def test_scoring_needs_no_shuffle(frame):
    df = frame(ENGAGEMENT, (1, 1.0, 1.0, 1.0, 1)).select("*", F.lit(1).alias("x"))
    plan = churn_risk(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
