"""Exact distinct counts whose rows are shuffled once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Column that says which part of its group's values a row has.
PART = "value_part"
#: Parts of a group; as many tasks at most share the rows of a hot one.
PARTS = 16


def dealt_by_value(df: DataFrame, group: list[str], value: str, parts: int = PARTS) -> DataFrame:
    """Rows dealt over tasks by group and by a part of the hash of ``value``, which ``PART`` names.

    Equal values of a group share a part, so that the distinct values of a group are the sum of
    those of its parts, and neither grouping by parts nor by (part, value) shuffles rows again.
    """
    part = F.pmod(F.xxhash64(value), F.lit(parts)).cast("int")
    return df.withColumn(PART, part).repartition(*group, PART)
