"""Loads that can be repeated: upsert and insert-ignore."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.operators.dedupe import first_per_key
from sluice.operators.keys import assign_keys, highest_key


def upsert(
    existing: DataFrame | None,
    incoming: DataFrame,
    natural_key: str,
    surrogate: str,
    precedence: str | None = None,
    stripes: int = 64,
    after: Column | None = None,
) -> DataFrame:
    """New state of a dimension.

    An incoming row replaces all attributes of the existing row with the same
    natural key (nulls too) and keeps its surrogate key; new natural keys get
    new surrogate keys; other rows stay. If the batch holds a natural key more
    than once, the row with the highest ``precedence`` wins, then the greatest. New keys start
    above ``after``, by default the highest of ``existing``.

    Old and new rows are merged by one aggregation instead of a join: repeated
    keys shrink before the shuffle. The branch for new rows reads the same
    shuffle as the branch for kept rows.
    """
    rank = F.lit(0) if precedence is None else F.col(precedence)
    attributes = [c for c in incoming.columns if c not in (natural_key, precedence)]
    versions = incoming.select(
        natural_key,
        F.lit(None).cast("long").alias(surrogate),
        F.struct(rank.cast("int").alias("rank"), *attributes).alias("row"),
    )
    if existing is not None:
        before_any = F.lit(-1).alias("rank")
        versions = existing.select(
            natural_key, surrogate, F.struct(before_any, *attributes).alias("row")
        ).unionByName(versions)
    merged = (
        versions.groupBy(natural_key)
        .agg(F.max(surrogate).alias(surrogate), F.max("row").alias("row"))
        .select(surrogate, natural_key, *[F.col("row")[c].alias(c) for c in attributes])
    )
    fresh = merged.where(F.col(surrogate).isNull()).drop(surrogate)
    after = highest_key(existing, surrogate) if after is None else after
    fresh = assign_keys(fresh, surrogate, natural_key, after, stripes)
    if existing is None:
        return fresh
    return merged.where(F.col(surrogate).isNotNull()).unionByName(fresh)


def bucket_of(key: Column, buckets: int) -> Column:
    """Folder number of a natural key, the same in every run."""
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def upsert_buckets(existing: Callable[[list[int] | None], DataFrame | None], incoming: DataFrame, natural_key: str,
                   surrogate: str, precedence: str | None = None, stripes: int = 64,
                   buckets: int = 64) -> DataFrame:
    """New rows of those buckets of a dimension that the batch has keys of, with their ``bucket``.

    ``existing`` gives the rows of some buckets, or of all, and None if there are none. Buckets
    without a key of the batch are neither read nor to be written; only their surrogate keys are
    read, of which the highest is needed. The outcome is that of ``upsert`` over the whole
    dimension. The numbers of the buckets touched are collected.
    """
    place = bucket_of(F.col(natural_key), buckets)
    touched = sorted(r[0] for r in incoming.select(place.alias("bucket")).distinct().collect())
    highest = highest_key(existing(None), surrogate)
    merged = upsert(existing(touched), incoming, natural_key, surrogate, precedence, stripes, highest)
    return merged.withColumn("bucket", place)


def keys_present(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Those keys of ``incoming`` that ``existing`` already holds.

    The batch sits on the right-hand side: a batch under the broadcast
    threshold is sent to the scan of the existing table, which then is not
    shuffled at all.
    """
    return existing.select(key).join(incoming.select(key), key, "left_semi").distinct()


def keyless_balance(existing: DataFrame | None, incoming: DataFrame, key: str,
                    alike: list[str]) -> DataFrame:
    """Kinds of rows without key: ``alike`` columns, ``batch`` and ``present`` rows, one row of the batch.

    A kind is all rows that are equal in ``alike``. Both tables are added up in one aggregation;
    of ``existing`` only rows without key are read.
    """
    rest = [c for c in incoming.columns if c not in alike]
    keyless = incoming.where(F.col(key).isNull())
    both = keyless.select(*alike, F.struct(*rest).alias("row"), F.lit(1).alias("new"))
    if existing is not None:
        both = both.unionByName(existing.where(F.col(key).isNull()).select(
            *alike, F.lit(None).cast(both.schema["row"].dataType).alias("row"), F.lit(0).alias("new")))
    return both.groupBy(*alike).agg(
        F.sum("new").alias("batch"), (F.count("*") - F.sum("new")).alias("present"),
        F.min("row").alias("row"),
    ).where(F.col("batch") > 0)


def insert_ignore(existing: DataFrame | None, incoming: DataFrame, key: str,
                  order: list[str] | None = None, batch_keys: DataFrame | None = None,
                  alike: list[str] | None = None) -> DataFrame:
    """Rows of the batch to append: one per key, and only keys not loaded before.

    ``batch_keys`` may hold the keys of the batch (or more) where they are had
    more cheaply than from ``incoming``, which would be computed twice.

    No key tells rows without one apart. Of each kind of them, rows equal in ``alike`` (all
    columns if not given), as many are appended as the batch has more than the table. So none
    is lost, and a batch that comes again appends none.
    """
    alike = alike or [c for c in incoming.columns if c != key]
    kinds = keyless_balance(existing, incoming, key, alike)
    copies = F.explode(F.sequence(F.lit(1), (F.col("batch") - F.col("present")).cast("int")))
    keyless = kinds.where(F.col("batch") > F.col("present")).withColumn("copy", copies).select(*[
        F.col(c) if c in alike else F.col("row")[c].alias(c) for c in incoming.columns])
    batch = first_per_key(incoming.where(F.col(key).isNotNull()), key, order)
    if existing is None:
        return batch.unionByName(keyless)
    present = keys_present(existing, incoming if batch_keys is None else batch_keys, key)
    return batch.join(present, key, "left_anti").select(incoming.columns).unionByName(keyless)
