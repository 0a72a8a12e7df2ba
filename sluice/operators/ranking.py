"""Exact ranks over a whole table without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Octaves of a double are cut into this many bins, which bounds the number of
# bins by the range of the type, not by the data.
BINS_PER_OCTAVE = 16


def magnitude_bin(value: Column) -> Column:
    """Order-preserving bin of a number >= 0; zero has a bin below all others."""
    return F.when(
        value > 0, F.floor(F.log2(value) * BINS_PER_OCTAVE)
    ).otherwise(F.lit(-(2 ** 20)))


def rank_from_top(df: DataFrame, value: str, count: str) -> DataFrame:
    """Add ``above`` (rows with a greater value) and ``of_total`` (all rows).

    ``df`` has one row per distinct value, ``count`` saying how many rows share
    it. Totals per bin are summed over the few bins; only within a bin are
    values put in order, so each task sorts the distinct values of some bins.
    """
    binned = df.withColumn("bin", magnitude_bin(F.col(value)))
    all_bins = Window.orderBy(F.desc("bin"))  # one task, but a bounded number of bins
    bins = (
        binned.groupBy("bin").agg(F.sum(count).alias("in_bin"))
        .select(
            "bin",
            (F.sum("in_bin").over(all_bins) - F.col("in_bin")).alias("in_higher_bins"),
            F.sum("in_bin").over(Window.partitionBy()).alias("of_total"),
        )
    )
    same_bin = Window.partitionBy("bin").orderBy(F.desc(value))
    higher = same_bin.rowsBetween(Window.unboundedPreceding, -1)
    return (
        binned.join(bins, "bin")
        .withColumn(
            "above", F.col("in_higher_bins") + F.coalesce(F.sum(count).over(higher), F.lit(0))
        )
        .drop("bin", "in_higher_bins")
    )
