"""Where streams go. Each stream has its own checkpoint folder on shared storage."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from sluice.session import discard, list_names, read_text, replace_text


def _writer(stream: DataFrame, mode: str, checkpoint: str, name: str | None,
            every: str | None) -> DataStreamWriter:
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    # Without an interval: take in all that is there, then end.
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def to_table(stream: DataFrame, path: str, checkpoint: str, name: str | None = None,
             every: str | None = None) -> StreamingQuery:
    """Append finished rows to a Parquet table, each exactly once."""
    return _writer(stream, "append", checkpoint, name, every).format("parquet").start(path)


#: Names the version of a snapshot table that readers see.
POINTER = "_current"


def to_snapshot(stream: DataFrame, path: str, checkpoint: str, name: str | None = None,
                every: str | None = None) -> StreamingQuery:
    """Keep a table equal to the whole current result (complete mode); ``read_snapshot`` reads it.

    Each batch writes a folder of its own, then one small file that names it is replaced, which
    file systems do at once. So a reader sees the table of one batch or of the next one, whole.
    The version before the current one stays for readers that have begun with it, older ones are
    removed. A batch that is repeated after it was published is published again, with equal rows.
    """
    spark = stream.sparkSession

    def publish(result: DataFrame, batch: int) -> None:
        before = read_text(spark, f"{path}/{POINTER}")
        version = f"version-{batch}-{uuid4().hex}"
        result.write.parquet(f"{path}/{version}")
        replace_text(spark, f"{path}/{POINTER}", version)
        for old in list_names(spark, path):
            if old.startswith("version-") and old not in (before, version):
                discard(spark, f"{path}/{old}")

    return _writer(stream, "complete", checkpoint, name, every).foreachBatch(publish).start()


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``to_snapshot`` last published under ``path``."""
    version = read_text(spark, f"{path}/{POINTER}")
    if version is None:
        raise FileNotFoundError(f"no snapshot under {path}")
    return spark.read.parquet(f"{path}/{version}")


def to_changes(stream: DataFrame, path: str, checkpoint: str, name: str | None = None,
               every: str | None = None) -> StreamingQuery:
    """Keep the changed rows of each batch in a folder ``batch=<n>`` (update mode).

    A repeated batch replaces its own folder. The latest state of a key is its
    row with the highest batch.
    """
    def keep(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return _writer(stream, "update", checkpoint, name, every).foreachBatch(keep).start()


def to_parsed_and_rejected(messages: DataFrame, path: str, checkpoint: str, name: str | None = None,
                           every: str | None = None) -> StreamingQuery:
    """Keep readable messages and broken ones, each exactly once, from one pass over a batch.

    ``messages`` come from ``activity.judge_messages``. A batch is written at once, to a folder of its own
    that a repeated batch replaces; in it each status has a folder. ``kept`` reads either.
    """
    def keep(judged: DataFrame, batch: int) -> None:
        judged.write.mode("overwrite").partitionBy("status").parquet(f"{path}/batch={batch}")

    return _writer(messages, "append", checkpoint, name, every).foreachBatch(keep).start()


def kept(spark: SparkSession, path: str, status: str, schema) -> DataFrame:
    """Messages of one status that ``to_parsed_and_rejected`` has written, in ``judge_messages`` columns."""
    stored = spark.read.schema(schema).parquet(path)
    return stored.where(F.col("status") == status).drop("status")


def latest(changes: DataFrame, *keys: str) -> DataFrame:
    """The current row of each key in a table that ``to_changes`` keeps."""
    values = [c for c in changes.columns if c not in (*keys, "batch")]
    return changes.groupBy(*keys).agg(*[F.max_by(v, "batch").alias(v) for v in values])


def to_console(stream: DataFrame, checkpoint: str, mode: str = "append",
               every: str | None = None) -> StreamingQuery:
    """Show rows while developing."""
    return (
        _writer(stream, mode, checkpoint, None, every)
        .format("console").option("truncate", False).start()
    )


def to_memory(stream: DataFrame, name: str, mode: str = "append") -> StreamingQuery:
    """Small results only: the table is held by the driver. Meant for tests."""
    return (
        stream.writeStream.outputMode(mode).format("memory").queryName(name)
        .trigger(availableNow=True).start()
    )


def finish(query: StreamingQuery, seconds: float | None = None) -> None:
    """Wait until the stream ends, or stop it after ``seconds``."""
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()
