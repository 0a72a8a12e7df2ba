"""What the watermark drops, and how far it lags, batch by batch."""

from __future__ import annotations

import datetime as dt
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from sluice.session import list_names

PROGRESS = ("name STRING, run STRING, batch BIGINT, at TIMESTAMP, input_rows BIGINT, watermark TIMESTAMP, "
            "newest_event TIMESTAMP, dropped BIGINT, state_rows BIGINT, lag_seconds DOUBLE")


def _time(text: str | None) -> dt.datetime | None:
    return None if text is None else dt.datetime.fromisoformat(text.replace("Z", "+00:00"))


def progress_row(progress) -> tuple:
    """One batch as a row of ``PROGRESS``.

    ``dropped`` are rows that came to a stateful operator for state the watermark had closed;
    a windowed count adds events up by key first, so there it counts windows by key, not events
    (``late_events`` counts those). The lag is how far the watermark is behind the batch's time.
    """
    times = progress.eventTime
    at, watermark = _time(progress.timestamp), _time(times.get("watermark"))
    known = watermark is not None and watermark.timestamp() > 0
    operators = progress.stateOperators
    return (
        progress.name, str(progress.runId), progress.batchId, at, progress.numInputRows,
        watermark if known else None, _time(times.get("max")),
        sum(o.numRowsDroppedByWatermark for o in operators), sum(o.numRowsTotal for o in operators),
        (at - watermark).total_seconds() if known else None)


class ProgressLog(StreamingQueryListener):
    """Writes a row for each batch of the queries that it is told of, as Parquet under ``path``.

    A few numbers a batch reach the driver, never data. Rows are written when a query ends and
    after every ``each`` batches, a file each time; a run writes a folder of its own.
    """

    def __init__(self, spark: SparkSession, path: str, each: int = 100):
        self.spark, self.path, self.each = spark, path, each
        self._rows: dict[str, list[tuple]] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def watch(self, query: StreamingQuery) -> StreamingQuery:
        """Wait for this query's last row in ``close``."""
        self._end_of(str(query.runId))
        return query

    def _end_of(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end_of(str(event.runId))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        with self._lock:
            rows = self._rows.setdefault(run, [])
            rows.append(progress_row(event.progress))
            full = len(rows) >= self.each
        if full:
            self._flush(run)

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        try:
            self._flush(run)
        finally:
            self._end_of(run).set()

    def _flush(self, run: str) -> None:
        with self._lock:
            rows = self._rows.pop(run, [])
        if rows:
            self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(f"{self.path}/run={run}")

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *problem) -> None:
        self.close()

    def close(self, seconds: float = 60) -> None:
        """Wait until every query seen has ended and its rows are written, then stop listening."""
        for end in list(self._ended.values()):
            end.wait(seconds)
        self.spark.streams.removeListener(self)

    def table(self) -> DataFrame:
        return self.spark.read.schema(PROGRESS).parquet(self.path)


LATE = "batch BIGINT, events BIGINT, late BIGINT, without_time BIGINT, newest_event TIMESTAMP, watermark TIMESTAMP"


def late_events(events: DataFrame, path: str, checkpoint: str, late: str = "30 minutes") -> StreamingQuery:
    """Count the events of each batch, and those older than the watermark, exactly.

    The watermark of a batch is the newest time of all batches before it less ``late``, which is
    that of a query over the same batches; to the millisecond, as Spark keeps it. A batch writes
    one row to a folder of its own, so that a repeated batch changes nothing. The newest time is
    taken from the rows of earlier batches: one row, however many there were.
    """
    spark = events.sparkSession

    def count(batch: DataFrame, number: int) -> None:
        newest = None
        if any(name.startswith("batch=") for name in list_names(spark, path)):
            newest = spark.read.schema(LATE).parquet(path).where(F.col("batch") < number).agg(F.max("newest_event")).first()[0]
        watermark = F.date_trunc("millisecond", F.lit(newest).cast("timestamp")) - F.expr(f"INTERVAL {late}")
        batch.agg(
            F.count("*").alias("events"),
            F.count_if(F.col("event_time") < watermark).alias("late"),
            F.count_if(F.col("event_time").isNull()).alias("without_time"),
            F.max("event_time").alias("newest_event"),
        ).withColumn("watermark", watermark).coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = events.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).foreachBatch(count).start()
