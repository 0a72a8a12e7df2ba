"""Decoding of activity messages and the measures of the stream itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice import schemas
from sluice.functions.cleaning import event_time


def _payload() -> Column:
    return F.from_json(F.col("value").cast("string"), schemas.ACTIVITY)


def parse_activity(raw: DataFrame) -> DataFrame:
    """Messages as columns, with ``event_time`` read from the text time.

    A message that is no JSON object gives a row of nulls, an unreadable time a
    null ``event_time``; ``decode_report`` counts both.
    """
    # ``inline`` parses each message once; as plain columns, every filter on a field
    # would be moved below the parsing and parse the message again.
    fields = raw.select(F.inline(F.array(_payload())))
    return fields.withColumn("event_time", event_time(F.col("event_ts")))


#: Why a message is rejected, in the order in which the reasons are looked for.
REJECTED = ("no value", "broken JSON", "no known field", "no usable time")


def judge_messages(raw: DataFrame) -> DataFrame:
    """Every message with a ``status``, parsed or rejected, from one parse.

    Columns are those of ``parse_activity``, null where a message is rejected, then ``reason``,
    ``key`` and ``value`` (the message as it came, null where it is parsed), ``status``.
    """
    text = F.col("value").cast("string")
    schema = f"{schemas.ACTIVITY}, _broken STRING"
    read = F.from_json(text, schema, {"columnNameOfCorruptRecord": "_broken"})
    fields = [f.strip().split(" ")[0] for f in schemas.ACTIVITY.split(",")]
    opened = raw.select("key", "value", F.inline(F.array(read))).withColumn(
        "event_time", event_time(F.col("event_ts")))
    reason = (
        F.when(F.col("value").isNull(), REJECTED[0])
        .when(F.col("_broken").isNotNull(), REJECTED[1])
        .when(F.coalesce(*fields).isNull(), REJECTED[2])
        .when(F.col("event_time").isNull(), REJECTED[3])
    )
    judged = opened.withColumn("reason", reason)
    good = F.col("reason").isNull()
    return judged.select(
        *[F.when(good, F.col(c)).alias(c) for c in (*fields, "event_time")], "reason",
        *[F.when(~good, F.col(c)).alias(c) for c in ("key", "value")],
        F.when(good, "parsed").otherwise("rejected").alias("status"))


def decode_report(raw: DataFrame) -> DataFrame:
    """One row: messages, messages without any field, and messages without a usable time."""
    parsed = parse_activity(raw)
    fields = [F.col(c) for c in parsed.columns if c != "event_time"]
    empty = F.coalesce(*fields).isNull()
    return parsed.agg(
        F.count("*").alias("messages"),
        F.count_if(empty).alias("undecoded"),
        F.count_if(F.col("event_time").isNull()).alias("without_time"),
    )


def stream_freshness(events: DataFrame, as_of: Column, key: str = "action") -> DataFrame:
    """Newest event per key and its age in seconds at ``as_of``."""
    newest = events.groupBy(key).agg(
        F.max("event_time").alias("newest_event"), F.count("*").alias("events")
    )
    age = F.unix_timestamp(as_of) - F.unix_timestamp("newest_event")
    return newest.withColumn("lag_seconds", age)
