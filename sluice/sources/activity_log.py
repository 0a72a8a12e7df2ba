"""The activity log as a stream of (key, value) messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice import schemas


def kafka_options(servers: str, topic: str, max_per_trigger: int | None = None) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def read_topic(spark: SparkSession, servers: str, topic: str,
               max_per_trigger: int | None = None) -> DataFrame:
    """A topic from its earliest message on (needs the Kafka package of Spark)."""
    reader = spark.readStream.format("kafka")
    return reader.options(**kafka_options(servers, topic, max_per_trigger)).load()


def read_message_files(spark: SparkSession, path: str,
                       files_per_trigger: int | None = None) -> DataFrame:
    """Messages kept as Parquet files with binary ``key`` and ``value``."""
    reader = spark.readStream.schema(schemas.RAW_MESSAGE)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
