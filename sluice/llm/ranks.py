"""Ranks and running sums over groups that may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that one sorted run of a group should hold.
RUN_ROWS = 50_000


def runs_for(rows: int, run_rows: int = RUN_ROWS) -> int:
    """Number of runs into which a group is split, from a count over all rows."""
    return max(1, -(-int(rows) // run_rows))


def running_sum(df: DataFrame, group: list[str], run: Column, order: list[Column], amount: str,
                name: str) -> DataFrame:
    """Add the sum of ``amount`` over the rows of a group up to and including each row.

    A group is ordered by ``run``, a whole number, then by ``order``. Only rows of one run meet
    in a task; the runs' totals, one row for each group and run, are summed up separately.
    """
    parts = [*group, "_run"]
    rows = df.withColumn("_run", run)
    totals = rows.groupBy(*parts).agg(F.sum(amount).alias("_sum"))
    before = Window.partitionBy(*group).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*parts, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_own", F.sum(amount).over(inside))
    same = [rows[c].eqNullSafe(totals[c]) for c in parts]
    joined = rows.join(totals, same)
    return joined.select(*[rows[c] for c in df.columns],
                         (rows["_own"] + totals["_before"]).alias(name))
