"""Quality gates over the landing data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.operators.checks import Measured, rule_violations
from sluice.operators.matching import violation_counts

# The order in which broken rules end a run, and the rules that never do.
GATES = (
    "viewing_range",
    "viewing_unknown_user",
    "viewing_unknown_content",
    "quality_range",
    "interaction_unknown_user",
)
REPORTED_ONLY = ("viewing_range",)


class QualityGateError(ValueError):
    """A rule that must hold for the run to go on is broken."""

    def __init__(self, rule: str, violations: int):
        super().__init__(f"{rule}: {violations} rows break this rule")
        self.rule, self.violations = rule, violations


def viewing_range():
    watched_too_long = F.col("duration_watched_min") > F.col("total_duration_min")
    pct = F.col("completion_pct")
    return watched_too_long | (pct < 0) | (pct > 100)


def quality_range():
    return (
        (F.col("buffering_events") < 0)
        | (F.col("avg_bitrate_mbps") <= 0)
        | (F.col("resolution_changes") < 0)
        | (F.col("latency_ms") < 0)
    )


def row_rules() -> dict[str, dict[str, Column]]:
    """Rules that a row breaks by itself, by dataset; they can be counted while it is written."""
    return {"viewing-history": {"viewing_range": viewing_range()},
            "streaming-quality": {"quality_range": quality_range()}}


def quality_report(viewing: DataFrame, users: DataFrame, catalog: DataFrame,
                   quality: DataFrame, interactions: DataFrame) -> DataFrame:
    """(gate_order, rule, violations, fatal, passed), one row per rule.

    Gates are judged in ``gate_order``. The range of viewing rows is reported
    but lets the run go on, because cleaning repairs such rows.
    """
    rules = row_rules()
    return _judged(reduce(DataFrame.unionByName, [
        violation_counts(viewing, _viewing_keys(users, catalog), rules["viewing-history"]),
        rule_violations(quality, rules["streaming-quality"]),
        violation_counts(interactions, {"interaction_unknown_user": ("user_id", users)}),
    ]))


def measured_report(measured: dict[str, Measured], tables: dict[str, DataFrame]) -> DataFrame:
    """The same report of staged tables whose row rules were counted while they were written.

    Only keys are read once more, for the rules on other tables' keys.
    """
    users, catalog = tables["user-profiles"], tables["content-catalog"]
    counted = [row for m in measured.values() for row in m.violations()]
    return _judged(reduce(DataFrame.unionByName, [
        users.sparkSession.createDataFrame(counted, "rule STRING, violations BIGINT"),
        violation_counts(tables["viewing-history"], _viewing_keys(users, catalog)),
        violation_counts(tables["user-interactions"], {"interaction_unknown_user": ("user_id", users)}),
    ]))


def _viewing_keys(users: DataFrame, catalog: DataFrame) -> dict[str, tuple[str, DataFrame]]:
    return {"viewing_unknown_user": ("user_id", users), "viewing_unknown_content": ("content_id", catalog)}


def _judged(counted: DataFrame) -> DataFrame:
    position = F.coalesce(*[
        F.when(F.col("rule") == rule, F.lit(i)) for i, rule in enumerate(GATES, start=1)
    ])
    fatal = ~F.col("rule").isin(*REPORTED_ONLY)
    return counted.select(
        position.alias("gate_order"), "rule", "violations", fatal.alias("fatal"),
        (~fatal | (F.col("violations") == 0)).alias("passed"),
    )


def enforce(report: DataFrame) -> list:
    """Run the gates; raise for the first broken one, else return the report's rows.

    The report has one row per rule, so it is small whatever the data.
    """
    rows = report.orderBy("gate_order").collect()
    for row in rows:
        if not row["passed"]:
            raise QualityGateError(row["rule"], row["violations"])
    return rows
