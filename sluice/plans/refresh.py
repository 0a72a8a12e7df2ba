"""Tables by month of which only the months that changed are computed and written anew."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.cleaning import event_time
from sluice.operators.checks import open_if_there
from sluice.plans import engagement
from sluice.session import discard

#: Year and month as one number; what has no readable time has this one.
NO_MONTH = -1
#: What each month of a table was made from, beside its partitions.
MARKS = "_marks"


def month_number(when: str) -> Column:
    moment = event_time(F.col(when))
    return F.coalesce(F.year(moment) * 100 + F.month(moment), F.lit(NO_MONTH))


def of_months(when: str, months: list[int]) -> Column:
    """Rows whose time ``when`` falls in one of some months, as ``month_number`` numbers them."""
    return month_number(when).isin(months)


def _mark(*columns: str) -> list[Column]:
    """A count and a sum of row hashes: they don't depend on the order of rows, but on each of them."""
    return [F.count("*").alias("n"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("h")]


def engagement_marks(viewing: DataFrame, users: DataFrame, quality: DataFrame,
                     interactions: DataFrame) -> DataFrame:
    """(month, mark): what the engagement of each month with sessions follows from.

    Sessions and interactions count for their month; profiles and delivery quality, which are
    known per user only, for every month. One aggregation a table, with one row a month of it.
    """
    sessions = viewing.groupBy(month_number("start_time").alias("month")).agg(*_mark(
        "user_id", "content_id", "duration_watched_min", "completion_pct"))
    clicks = interactions.groupBy(month_number("timestamp").alias("at")).agg(*_mark("user_id", "content_id"))

    def whole(df: DataFrame, *columns: str) -> Column:
        """The mark of a whole table, as a scalar subquery."""
        return df.agg(*_mark(*columns)).select(F.concat_ws(":", "n", "h")).scalar()

    people = whole(users, "user_id", "plan_type", "is_churned")
    delivery = whole(quality, "user_id", *engagement.QUALITY_METRICS)
    joined = sessions.select("month", F.concat_ws(":", "n", "h").alias("s")).join(
        clicks.select("at", F.concat_ws(":", "n", "h").alias("c")), F.col("month") == F.col("at"), "left")
    return joined.select("month", F.sha2(F.concat_ws(
        "|", "s", F.coalesce("c", F.lit("")), people, delivery), 256).alias("mark"))


def refresh_months(spark: SparkSession, path: str, marks: DataFrame,
                   build: Callable[[list[int]], DataFrame]) -> list[int]:
    """Bring a table partitioned by year and month up to date; returns the months that were written.

    A month is written if its mark isn't the one it was written under, and removed if it has
    none any more; the files of all others stay. ``build`` gives the rows of some months. Marks
    are written last, so a run that ended early is made up for by the next. What is collected is
    one short row a month.
    """
    now = {r["month"]: r["mark"] for r in marks.collect()}
    stored = open_if_there(spark, f"{path}/{MARKS}")
    then = {} if stored is None else {r["month"]: r["mark"] for r in stored.collect()}
    touched = sorted(m for m in now if then.get(m) != now[m])
    gone = [m for m in then if m not in now]
    if touched:
        rows = build(touched).hint("rebalance", "year", "month")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(path)
    for month in gone:
        discard(spark, f"{path}/{_partition(month)}")
    if touched or gone or stored is None:
        spark.createDataFrame(sorted(now.items()), "month INT, mark STRING").coalesce(1).write.mode(
            "overwrite").parquet(f"{path}/{MARKS}")
    return touched


def _partition(month: int) -> str:
    if month == NO_MONTH:
        return "year=__HIVE_DEFAULT_PARTITION__/month=__HIVE_DEFAULT_PARTITION__"
    return f"year={month // 100}/month={month % 100}"


def refresh_engagement(spark: SparkSession, path: str, viewing: DataFrame, users: DataFrame,
                       quality: DataFrame, interactions: DataFrame, by_user: DataFrame | None = None) -> list[int]:
    """Bring the monthly engagement table up to date; only changed months are computed."""
    def build(months: list[int]) -> DataFrame:
        return engagement.user_monthly_engagement(
            viewing.where(of_months("start_time", months)), users, quality,
            interactions.where(of_months("timestamp", months)), by_user)

    return refresh_months(spark, path, engagement_marks(viewing, users, quality, interactions), build)


def refresh_copy(spark: SparkSession, source: str, path: str) -> list[int]:
    """Bring a copy of a refreshed table up to date, by the marks of its source."""
    marks = spark.read.parquet(f"{source}/{MARKS}")
    table = spark.read.parquet(source)

    def build(months: list[int]) -> DataFrame:
        # Partition values, so that only the folders of these months are read.
        known = [(F.col("year") == m // 100) & (F.col("month") == m % 100) for m in months if m != NO_MONTH]
        if NO_MONTH in months:
            known.append(F.col("year").isNull())
        return table.where(reduce(Column.__or__, known))

    return refresh_months(spark, path, marks, build)
