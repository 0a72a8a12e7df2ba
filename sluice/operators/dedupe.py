"""Union of shards and duplicate removal."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_shards(shards: dict[str, DataFrame]) -> DataFrame:
    """All rows of all shards (UNION ALL); ``shard`` and ``shard_order`` say where from."""
    tagged = [
        df.withColumns({"shard": F.lit(name), "shard_order": F.lit(position)})
        for position, (name, df) in enumerate(shards.items())
    ]
    return reduce(DataFrame.unionByName, tagged)


def shard_clashes(merged: DataFrame, key: str) -> DataFrame:
    """Keys that more than one shard holds; loading them keeps the last shard's row."""
    return (
        merged.groupBy(key)
        .agg(F.count_distinct("shard").alias("shards"))
        .where(F.col("shards") > 1)
    )


def replica_difference(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows in which two copies of a replicated table differ, with the copy that has them."""
    second = second.select(first.columns)
    return (
        first.exceptAll(second).withColumn("only_in", F.lit("first"))
        .unionByName(second.exceptAll(first).withColumn("only_in", F.lit("second")))
    )


def first_per_key(df: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """One row per key: the smallest by ``order``, ties settled by the other columns.

    The minimum of a struct is partly aggregated before the shuffle, so each
    task sends at most one row per key, however often the key occurs.
    """
    order = order or []
    rest = [c for c in df.columns if c != key and c not in order]
    first = F.min(F.struct(*order, *rest)).alias("first")
    return df.groupBy(key).agg(first).select(
        *[F.col(c) if c == key else F.col("first")[c].alias(c) for c in df.columns]
    )


def dedupe_first(df: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """One row per key; rows without key are not copies of each other and all stay."""
    keyed = first_per_key(df.where(F.col(key).isNotNull()), key, order)
    return keyed.unionByName(df.where(F.col(key).isNull()))
