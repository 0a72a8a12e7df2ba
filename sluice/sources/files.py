"""File sources and sinks of the lake: CSV and JSON landing data, Parquet tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sluice import schemas

# Landing datasets: format and schema.
LANDING = {
    "viewing-history": ("csv", schemas.VIEWING_HISTORY),
    "content-catalog": ("json", schemas.CONTENT_CATALOG),
    "user-profiles": ("csv", schemas.USER_PROFILES),
    "user-interactions": ("json", schemas.USER_INTERACTIONS),
    "streaming-quality": ("csv", schemas.STREAMING_QUALITY),
}
ZONES = ("landing", "curated", "analytics")


def zone_path(root: str, zone: str, dataset: str) -> str:
    if zone not in ZONES:
        raise ValueError(f"unknown zone {zone!r}")
    return f"{root.rstrip('/')}/{zone}/{dataset}"


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON object per line."""
    return spark.read.schema(schema).json(path)


def by_name(df: DataFrame, schema: str) -> DataFrame:
    """Text columns under declared names and types, wherever they stand, then all others.

    A value that isn't of the declared type becomes null. A declared column that isn't there is
    an error.
    """
    declared = StructType.fromDDL(schema)
    absent = [f.name for f in declared if f.name not in df.columns]
    if absent:
        raise ValueError(f"columns {', '.join(absent)} are not there")
    typed = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in declared]
    return df.select(*typed, *[F.col(f"`{c}`") for c in df.columns if c not in declared.names])


#: JSON fields that a schema doesn't name, as one variant column.
UNDECLARED = "undeclared"


def _json_text(name: str) -> Column:
    """A field of the parsed line as text, null if it isn't there."""
    quoted = name.replace("\\", "\\\\").replace("'", "\\'")
    return F.try_variant_get(F.col("line"), f"$['{quoted}']", "string")


def _json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of JSON files, each parsed once: (value, line)."""
    text = spark.read.text(path).where(F.trim("value") != "")
    return text.select("value", F.try_parse_json("value").alias("line"))


def read_json_named(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines by field name in one pass: declared columns, then ``undeclared``.

    Each line is parsed into a variant, from which the declared fields are cast; numbers read as
    text are in plain form (1.50 is 1.5). What is left of the object is kept as one variant, null
    if nothing is; its fields can be had with ``variant_get``. A line that is no JSON object, or
    holds a field twice, has no fields and is kept there as text.
    """
    declared = StructType.fromDDL(schema)
    # One step each, so that the fields of a line are taken apart and sorted out once.
    lines = _json_lines(spark, path).withColumn("fields", F.expr("try_cast(line AS map<string, variant>)"))
    rest = F.map_filter("fields", lambda name, _: ~name.isin(*declared.names))
    lines = lines.withColumn("rest", rest)
    undeclared = F.when(F.col("fields").isNull(), F.col("value").cast("variant")).when(
        F.size("rest") > 0, F.to_variant_object("rest"))
    return lines.select(
        *[_json_text(f.name).try_cast(f.dataType).alias(f.name) for f in declared],
        undeclared.alias(UNDECLARED))


def read_named(spark: SparkSession, path: str, fmt: str, schema: str) -> DataFrame:
    """CSV or JSON by column name, with all its columns, in one pass over the data.

    The names of CSV columns come from the header line; JSON fields that aren't declared are one
    column (``read_json_named``). A folder without files has the declared columns and no rows.
    """
    if fmt == "json":
        return read_json_named(spark, path, schema)
    try:
        names = spark.read.option("header", True).csv(path).columns
    except AnalysisException as problem:
        if problem.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return spark.createDataFrame([], schema)
    text = StructType([StructField(n, StringType()) for n in names])
    # Other files of the folder must have the same header.
    df = spark.read.schema(text).option("header", True).option("enforceSchema", False).csv(path)
    return by_name(df, schema)


def uncast(df: DataFrame, path: str, fmt: str, schema: str) -> DataFrame:
    """One row: for each declared column, the values of the source that were not of its type."""
    spark = df.sparkSession
    declared = StructType.fromDDL(schema)
    if fmt == "json":
        raw = _json_lines(spark, path).select(*[_json_text(f.name).alias(f.name) for f in declared])
    else:
        raw = spark.read.option("header", True).csv(path)
    return raw.agg(*[
        F.count_if(F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull()).alias(f.name)
        for f in declared if f.name in raw.columns
    ])


def read_landing(spark: SparkSession, root: str, dataset: str,
                 spread: int | None = None, schema: str | None = None) -> DataFrame:
    """A landing dataset: its declared columns by name, then any others.

    ``schema`` replaces the declared types, for example where ids are text. A gzip file is read
    by one task. With few large files, ``spread`` deals the rows out to that many tasks for the
    work that follows.
    """
    fmt, declared = LANDING[dataset]
    df = read_named(spark, zone_path(root, "landing", dataset), fmt, schema or declared)
    return df.repartition(spread) if spread else df


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = (),
                mode: str = "overwrite", gathered: bool = False) -> None:
    """Full refresh of a Parquet table (or an append).

    With partition columns the rows are gathered by them first, so a partition
    becomes few files; REBALANCE splits a partition that holds too much for one
    task, which a plain repartition would not. Rows that are ``gathered`` by these
    columns already, as those of a table stored by them, are written without a shuffle.
    """
    if partition_by and not gathered:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """Full refresh of a CSV report with a header line."""
    df.write.mode("overwrite").option("header", True).csv(path)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows, for looking at."""
    return df.limit(n)


def as_json_lines(df: DataFrame, key: str) -> DataFrame:
    """Rows as (key, value) messages: the key as UTF-8 bytes, the row as JSON."""
    return df.select(
        F.col(key).cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*df.columns)).cast("binary").alias("value"),
    )
