"""Data-quality measures, each computed in one pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException


def _tall(wide: DataFrame, names: list[str], label: str, fields: list[str]) -> DataFrame:
    """Turn the one-row frame of structs ``names`` into one row per struct."""
    entries = [F.struct(F.lit(n).alias(label), *[F.col(n)[f].alias(f) for f in fields])
               for n in names]
    return wide.select(F.inline(F.array(*entries)))


def rule_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows breaking each rule: (rule, violations). A null condition is not a violation."""
    counts = [
        F.struct(F.count_if(broken).alias("violations")).alias(name)
        for name, broken in rules.items()
    ]
    return _tall(df.agg(*counts), list(rules), "rule", ["violations"])


def null_rates(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Nulls per column: (column_name, null_count, row_count, null_rate)."""
    columns = columns or df.columns
    counts = [
        F.struct(
            F.count_if(F.col(c).isNull()).alias("null_count"),
            F.count("*").alias("row_count"),
        ).alias(c)
        for c in columns
    ]
    tall = _tall(df.agg(*counts), columns, "column_name", ["null_count", "row_count"])
    rate = F.round(F.try_divide(F.col("null_count"), F.col("row_count")), 6)
    return tall.withColumn("null_rate", rate)


def dataset_presence(tables: dict[str, DataFrame | None], spark: SparkSession) -> DataFrame:
    """Row count of each expected dataset; a missing one has no count.

    (dataset, row_count, present). Counting Parquet rows reads footers only.
    """
    rows = []
    for name, df in tables.items():
        if df is None:
            rows.append(spark.range(1).select(
                F.lit(name).alias("dataset"), F.lit(None).cast("long").alias("row_count")
            ))
        else:
            rows.append(df.agg(F.count("*").alias("row_count")).select(
                F.lit(name).alias("dataset"), "row_count"
            ))
    return reduce(DataFrame.unionByName, rows).withColumn(
        "present", F.coalesce(F.col("row_count") > 0, F.lit(False))
    )


def open_if_there(spark: SparkSession, path: str, fmt: str = "parquet",
                  schema: str | None = None) -> DataFrame | None:
    """The dataset under ``path``, or None if nothing is there."""
    reader = spark.read.format(fmt)
    if schema:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    try:
        return reader.load(path)
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


class Measured:
    """Row count, nulls by column and broken rules of a table, counted while it is written.

    The figures ride along with the tasks that write the table, so that they cost no further
    pass. ``table`` is what has to be written; after that the figures can be had.
    """

    def __init__(self, df: DataFrame, columns: list[str] | None = None, rules: dict[str, Column] | None = None):
        self.columns, self.rules = columns or df.columns, list(rules or {})
        self._seen = Observation()
        self.table = df.observe(
            self._seen, F.count("*").alias("rows"),
            *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"null {i}") for i, c in enumerate(self.columns)],
            *[F.count_if(broken).alias(f"rule {i}") for i, broken in enumerate((rules or {}).values())])

    @property
    def rows(self) -> int:
        return self._seen.get["rows"]

    def violations(self) -> list[tuple[str, int]]:
        return [(name, self._seen.get[f"rule {i}"]) for i, name in enumerate(self.rules)]

    def nulls(self) -> list[tuple[str, int, int]]:
        """(column, nulls, rows), one for each column."""
        return [(c, self._seen.get[f"null {i}"], self.rows) for i, c in enumerate(self.columns)]


def null_rates_of(measured: dict[str, Measured], spark: SparkSession) -> DataFrame:
    """Null rates of measured datasets: (dataset, column_name, null_count, row_count, null_rate)."""
    rows = [(name, *row) for name, m in measured.items() for row in m.nulls()]
    table = spark.createDataFrame(rows, "dataset STRING, column_name STRING, null_count BIGINT, row_count BIGINT")
    return table.withColumn("null_rate", F.round(F.try_divide(F.col("null_count"), F.col("row_count")), 6))
