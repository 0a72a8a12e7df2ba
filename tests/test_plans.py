"""What the physical plans must and must not contain."""

import os
import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from helpers import tuples
from sluice import schemas
from sluice.plans import engagement, scoring
from sluice.registry import QUERIES
from sluice.sources.files import read_table, write_table

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not there")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def settings(spark, **values):
    before = {}
    for key, value in values.items():
        name = key.replace("__", ".")
        before[name] = spark.conf.get(name, None)
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@needs_tables
@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_no_nested_loops_and_no_python_in_plans(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert operator not in plan


@needs_tables
def test_only_needed_columns_are_read(spark):
    plan = plan_of(QUERIES["content_performance"](spark, FOLDER))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    lineitem = next(s for s in scans if "l_partkey" in s)
    assert {re.sub(r"#\d+L?", "", c) for c in lineitem.split(",")} == {
        "l_orderkey", "l_partkey", "l_quantity"}


def test_segment_filter_reaches_the_stored_table(spark, frame, tmp_path):
    engaged = frame("user_id INT, total_watch_hours DOUBLE, avg_completion_pct DOUBLE, "
                    "avg_buffering_events DOUBLE, interaction_count BIGINT", (1, 1.0, 1.0, 1.0, 1))
    write_table(scoring.churn_risk(engaged), str(tmp_path / "risk"))
    stored = read_table(spark, str(tmp_path / "risk"))
    plan = plan_of(stored.where(F.col("churn_risk_segment") == scoring.HIGH_RISK))
    assert "EqualTo(churn_risk_segment,High Risk)" in plan


def test_top_content_needs_no_full_sort(spark, frame):
    df = frame("content_id INT, total_viewing_hours DOUBLE", (1, 1.0))
    from sluice.plans.reports import top_content

    assert "TakeOrderedAndProject" in plan_of(top_content(df))


def test_hot_user_is_split_in_the_session_join(spark, tmp_path):
    """A third of the sessions belong to one user; neither side is broadcast."""
    sessions = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("user_id"),
        (F.col("id") % 40).alias("content_id"), F.lit(1.0).alias("duration_watched_min"),
        F.md5(F.col("id").cast("string")).alias("device"),
    )
    sessions.repartition(6).write.parquet(str(tmp_path / "sessions"))
    sessions = spark.read.parquet(str(tmp_path / "sessions"))
    users = spark.range(5000).select(F.col("id").alias("user_id"), F.lit("basic").alias("plan_type"))
    catalog = spark.range(40).select(F.col("id").alias("content_id"), F.lit("t").alias("title"))
    quality = spark.range(5000).selectExpr(
        "id AS user_id", "cast(id AS string) AS session_id", "'eu' AS cdn_region", "'x' AS isp",
        "1 AS buffering_events", "1D AS avg_bitrate_mbps", "1 AS resolution_changes",
        "1D AS latency_ms")
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__shuffle__partitions="16",
    ):
        enriched = engagement.enrich_sessions(sessions, catalog, users, quality)
        result = enriched.groupBy("plan_type").count()
        assert tuples(result) == [("basic", 60000)]
        assert "skew=true" in plan_of(result)


def first_above(lines, leaf, operators):
    """The nearest of ``operators`` above a leaf of a plan tree."""
    depth = [re.search(r"[A-Za-z*]", line).start() for line in lines]
    at = depth[leaf]
    for i in range(leaf - 1, -1, -1):
        if depth[i] < at:
            at = depth[i]
            found = next((o for o in operators if lines[i][at:].startswith(o)), None)
            if found:
                return found
    return None


def test_group_first_plans_join_no_raw_rows(frame):
    viewing, users = frame(schemas.VIEWING_HISTORY), frame(schemas.USER_PROFILES)
    quality, catalog = frame(schemas.STREAMING_QUALITY), frame(schemas.CONTENT_CATALOG)
    interactions = frame(schemas.USER_INTERACTIONS)
    for df, leaves in (
        (engagement.user_monthly_engagement(viewing, users, quality, interactions), 4),
        (engagement.content_performance(viewing, catalog), 2),
    ):
        lines = df._jdf.queryExecution().optimizedPlan().toString().rstrip().splitlines()
        scans = [i for i, line in enumerate(lines) if "LogicalRDD" in line]
        assert len(scans) == leaves
        assert {first_above(lines, i, ("Join", "Aggregate")) for i in scans} == {"Aggregate"}


def test_months_of_users_are_joined_by_user_alone(spark, frame):
    """Once sessions and interactions are gathered by user, no row of them is shuffled again."""
    viewing, users = frame(schemas.VIEWING_HISTORY), frame(schemas.USER_PROFILES)
    quality, interactions = frame(schemas.STREAMING_QUALITY), frame(schemas.USER_INTERACTIONS)
    with settings(spark, spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = plan_of(engagement.user_monthly_engagement(viewing, users, quality, interactions))
        stored = plan_of(engagement.user_monthly_engagement(
            viewing, users, quality, interactions, engagement.quality_by_user(quality).limit(5)))
    shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert not any("year" in keys or "month" in keys for keys in shuffles)
    # Two each for sessions, interactions and profiles, one each for quality and what is known per user.
    assert len(shuffles) == 8
    assert "GlobalLimit" in stored


def test_staged_keys_are_counted_as_numbers(frame):
    from sluice.operators.matching import violation_counts

    df = frame("u INT, c BIGINT", (1, 5), (2, None), (None, 7))
    counted = violation_counts(df, {"u": ("u", frame("u BIGINT", (1,))), "c": ("c", frame("c SMALLINT", (5,), (7,)))})
    assert "as string" not in plan_of(counted)
    assert tuples(counted) == [("c", 1), ("u", 2)]
