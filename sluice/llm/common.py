"""Words, row keys, written intermediates and batch sizes that the operators share."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import discard, scratch_path

SPACES = r"[\x20\x09-\x0D]+"
#: Rows in one Arrow batch; texts are long, so that batches stay at a few MB.
BATCH_ROWS = 256


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Let Arrow batches hold so many rows at most; their memory is that of so many texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Maximal runs of characters other than the six ASCII white spaces; null has none."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACES)
    return F.array_remove(parts, "")


def text_key(text: Column) -> Column:
    """128 bits that stand for a text: two hashes of it with different seeds."""
    return F.struct(
        F.xxhash64(text).alias("a"), F.xxhash64(F.lit(7), text, F.length(text)).alias("b")
    )


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    Unlike a cached or locally checkpointed frame it outlives the executors that made it,
    and unlike the plan behind it, it is computed once. ``unstaged`` removes it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{name}-{uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.staged_path = path
    return table


def unstaged(*tables: DataFrame) -> None:
    """Remove staged tables from which all that was wanted has been written to others."""
    for table in tables:
        discard(table.sparkSession, table.staged_path)


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns whose names an operator is about to give to its own, in any case."""
    taken = {n.lower() for n in names}
    return df.select(*[f"`{c}`" for c in df.columns if c.lower() not in taken])
