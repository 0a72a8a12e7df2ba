"""Which rows have a partner in another table, and which do not."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def orphans(df: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``reference``.

    A null key matches nothing, so such rows are orphans. ``df`` is read once;
    a task with too many rows of one key, or of none, is split at run time.
    """
    return df.join(reference.select(key), key, "left_anti").select(df.columns)


#: Types of whole numbers.
WHOLE = {"tinyint", "smallint", "int", "bigint"}


def comparable(value: Column, one: str, two: str) -> Column:
    """A key as text that is equal where keys of both types are equal."""
    kinds = {one.split("(")[0], two.split("(")[0]}
    if one != two and kinds <= WHOLE | {"float", "double", "decimal"}:
        if kinds & {"float", "double"}:
            value = value.cast("double")
        elif "decimal" in kinds:
            # As many decimals as the finer type has.
            scale = max(int(t.rstrip(")").split(",")[1]) for t in (one, two) if t.startswith("decimal"))
            value = value.cast(f"decimal(38,{scale})")
    return value.cast("string")


def violation_counts(
    df: DataFrame,
    references: dict[str, tuple[str, DataFrame]],
    rules: dict[str, Column] | None = None,
) -> DataFrame:
    """(rule, violations) for orphan rules and row rules together, in one pass over ``df``.

    ``references`` maps a rule name to (key column, table that must hold it),
    ``rules`` a rule name to the condition of a broken row.

    Every row is counted under each of its keys, and rows are added up per key
    before anything is joined: a key that holds a large share of the table is
    one row in the join. All keys then meet all reference keys in one join on
    (rule, key), where a rule is its position and keys that are all whole numbers
    stay numbers. A null key is among the orphans.
    """
    rules, kinds = rules or {}, dict(df.dtypes)
    pairs = {(kinds[column], dict(table.dtypes)[column]) for column, table in references.values()}
    whole = {kind for pair in pairs for kind in pair} <= WHOLE

    def key(value: Column, one: str, two: str) -> Column:
        return value.cast("bigint") if whole else comparable(value, one, two)

    broken = [F.when(condition, 1).otherwise(0) for condition in rules.values()]
    under_each_key = F.array(*[
        F.struct(
            F.lit(place).alias("rule"),
            key(F.col(column), kinds[column], dict(table.dtypes)[column]).alias("key"),
            # A row's rules count once, under its first key.
            *[(flag if place == 0 else F.lit(0)).alias(f"broken_{i}")
              for i, flag in enumerate(broken)],
        )
        for place, (column, table) in enumerate(references.values())
    ])
    per_key = df.select(F.inline(under_each_key)).groupBy("rule", "key").agg(
        F.count("*").alias("n"),
        *[F.sum(f"broken_{i}").alias(f"broken_{i}") for i in range(len(rules))],
    )
    known = reduce(DataFrame.unionByName, [
        table.select(F.lit(place).alias("rule"), key(
            F.col(column), dict(table.dtypes)[column], kinds[column]).alias("key"))
        for place, (column, table) in enumerate(references.values())
    ]).distinct().withColumn("known", F.lit(True))
    judged = per_key.join(known, ["rule", "key"], "left")
    unknown = F.when(F.col("known").isNull(), F.col("n"))
    totals = [F.sum(f"broken_{i}") for i in range(len(rules))]
    totals += [F.sum(F.when(F.col("rule") == place, unknown)) for place in range(len(references))]
    names = [*rules, *references]
    wide = judged.agg(*[
        F.coalesce(total, F.lit(0)).cast("long").alias(name)
        for name, total in zip(names, totals, strict=True)
    ])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(name).alias("violations")) for name in names
    ])))


def repeats_folded(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct rows over ``columns`` and how often each occurs, as ``copies``."""
    return df.groupBy(*columns).agg(F.count("*").alias("copies"))


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return repeats_folded(df, [key]).where(F.col("copies") > 1)
