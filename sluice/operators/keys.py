"""Surrogate keys without a global sort: in stripes with gaps, or dense in load order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def stripe_of(key: Column, stripes: int) -> Column:
    """Even spread of a unique key over ``stripes`` numbers, the same in every run."""
    head = F.conv(F.substring(F.md5(key.cast("string")), 1, 6), 16, 10)
    return head.cast("long") % stripes


def highest_key(existing: DataFrame | None, key: str) -> Column:
    """Largest key handed out so far, 0 for none, as a scalar subquery."""
    if existing is None:
        return F.lit(0).cast("long")
    return F.coalesce(existing.agg(F.max(key)).scalar(), F.lit(0)).cast("long")


def assign_keys(
    rows: DataFrame,
    surrogate: str,
    natural_key: str,
    after: Column,
    stripes: int,
) -> DataFrame:
    """Number new rows above ``after``.

    Rows are spread over stripes by a hash of their natural key, and stripe s of
    S counts s+1, s+1+S, s+1+2S, ... So keys are unique and repeatable, and no
    task sorts more than one stripe. As with a database sequence, some numbers
    stay unused: stripes do not all get the same number of rows.
    """
    stripe = stripe_of(F.col(natural_key), stripes)
    position = F.row_number().over(Window.partitionBy(stripe).orderBy(natural_key))
    number = after + (position.cast("long") - 1) * stripes + stripe + 1
    return rows.select(number.alias(surrogate), "*")


#: Ranges into which one group's rows are cut for numbering.
PIECES = 64


def key_ranges(rows: DataFrame, group: str, key: str, pieces: int = PIECES) -> DataFrame:
    """(group, limits): values of ``key`` that cut each group into parts of about equal length.

    One approximate quantile sketch a group, partly aggregated. Whatever the limits are, the
    numbers that ``dense_keys`` gives are the same; but it has to see the same limits wherever
    it reads them, so the result belongs in a stored table.
    """
    shares = [k / pieces for k in range(1, pieces)]
    return rows.groupBy(F.col(group).alias("group")).agg(
        F.percentile_approx(key, shares, 1000).alias("limits"))


def _placed(rows: DataFrame, group: str, key: str, rest: list[str], ranges: DataFrame, pieces: int) -> DataFrame:
    """Rows with the number of their range within the group, ``_piece``; rows without key by hash behind them."""
    limits = F.coalesce(ranges["limits"], F.array().cast("array<bigint>"))
    keyless = pieces + F.pmod(F.xxhash64(*[rows[c] for c in rest]), F.lit(pieces)).cast("int")
    piece = F.when(rows[key].isNull(), keyless).otherwise(F.size(F.filter(limits, lambda x: x < rows[key])))
    return rows.join(ranges, rows[group].eqNullSafe(ranges["group"]), "left").select(
        *[rows[c] for c in rows.columns], piece.alias("_piece"))


def key_starts(rows: DataFrame, group: str, key: str, rest: list[str], ranges: DataFrame,
               pieces: int = PIECES) -> DataFrame:
    """(at, piece, start): how many rows stand before each range of each group (``dense_keys``).

    At most two times ``pieces`` rows a group. Read from a stored table it is known to be small, so
    that the rows need not be shuffled once more to meet it.
    """
    counts = _placed(rows, group, key, rest, ranges, pieces).groupBy(
        F.col(group).alias("at"), F.col("_piece").alias("piece")).agg(F.count("*").alias("n"))
    whole = counts.groupBy("at").agg(F.sum("n").alias("n"))

    def earlier(by: Window) -> Column:
        return F.coalesce(F.sum("n").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    # One row a group in one task; then at most two times ``pieces`` rows a group.
    groups = whole.select(F.col("at").alias("group_at"),
                          earlier(Window.orderBy(F.asc_nulls_last("at"))).alias("groups_before"))
    inside = counts.select("at", "piece", earlier(Window.partitionBy("at").orderBy("piece")).alias("pieces_before"))
    return inside.join(groups, inside["at"].eqNullSafe(groups["group_at"])).select(
        "at", "piece", (F.col("groups_before") + F.col("pieces_before")).alias("start"))


def dense_keys(rows: DataFrame, surrogate: str, group: str, key: str, rest: list[str], after: Column,
               ranges: DataFrame, pieces: int = PIECES, starts: DataFrame | None = None) -> DataFrame:
    """Number rows after+1, after+2, ... by ``group``, then ``key``, without gaps.

    Rows go to buckets of one group and one range of keys (``ranges`` from ``key_ranges``), are
    put in order within their bucket only, and start after the rows of all buckets before it
    (``starts`` from ``key_starts``, if stored): a group that holds most rows is sorted by many
    tasks. What is summed up over all buckets is a count for each. Nulls come last. Rows without
    key stand behind the others of their group, in buckets by hash, and are put in order by
    ``rest``, which also settles equal keys.
    """
    if starts is None:
        starts = key_starts(rows, group, key, rest, ranges, pieces)
    placed = _placed(rows, group, key, rest, ranges, pieces)
    order = [F.asc_nulls_last(c) for c in rest]
    position = F.row_number().over(Window.partitionBy(group, "_piece").orderBy(key, *order))
    numbered = placed.withColumn("_position", position)
    found = numbered.join(starts, numbered[group].eqNullSafe(starts["at"]) & (numbered["_piece"] == starts["piece"]))
    return found.select((after + starts["start"] + numbered["_position"]).cast("long").alias(surrogate),
                        *[numbered[c] for c in rows.columns])
