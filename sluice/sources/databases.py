"""Scans of the operational databases.

The scans are parallel range reads, so no database is drained through one
connection. Drivers are external jars named at spark-submit; they are not part
of this package.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

# Columns of each operational table, and the key by which its scan is cut.
SALES_TABLES = {
    "customers": (
        ("customer_id", "first_name", "last_name", "email", "city", "state"), "customer_id"),
    "products": (
        ("product_id", "product_name", "category", "unit_price"), "product_id"),
    "orders": (
        ("order_id", "customer_id", "product_id", "quantity", "total_price", "order_date"),
        "order_id"),
}
HR_TABLES = {
    "employees": (
        ("employee_id", "first_name", "last_name", "email", "job_title", "department_id"),
        "employee_id"),
    "departments": (
        ("department_id", "department_name", "location"), "department_id"),
}
ORDER_COLUMNS = SALES_TABLES["orders"][0]


@dataclass(frozen=True)
class Database:
    """Where a database is and how wide its scans are."""

    url: str
    user: str
    password: str
    driver: str = "org.postgresql.Driver"
    scan_tasks: int = 16
    fetch_rows: int = 10_000

    def reader(self, spark: SparkSession) -> DataFrameReader:
        return spark.read.format("jdbc").options(
            url=self.url, user=self.user, password=self.password,
            driver=self.driver, fetchsize=str(self.fetch_rows),
        )


def scan_options(db: Database, table: str, key: str, low: int, high: int) -> dict[str, str]:
    """Options of a scan cut into ranges of ``key``; rows outside [low, high] are read too."""
    return {
        "dbtable": table,
        "partitionColumn": key,
        "lowerBound": str(low),
        "upperBound": str(high + 1),
        "numPartitions": str(db.scan_tasks),
    }


def scan_table(spark: SparkSession, db: Database, table: str,
               columns: tuple[str, ...], key: str) -> DataFrame:
    """A table's columns, read in parallel ranges between its smallest and largest key."""
    ends = (
        db.reader(spark)
        .option("query", f"SELECT MIN({key}) AS low, MAX({key}) AS high FROM {table}")
        .load().first()
    )
    reader = db.reader(spark)
    if ends is None or ends[0] is None:
        return reader.option("dbtable", table).load().select(*columns)
    options = scan_options(db, table, key, int(ends[0]), int(ends[1]))
    return reader.options(**options).load().select(*columns)


def sales_shard(spark: SparkSession, db: Database) -> dict[str, DataFrame]:
    """Customers, products and orders of one sales shard."""
    return {t: scan_table(spark, db, t, *spec) for t, spec in SALES_TABLES.items()}


def hr_tables(spark: SparkSession, db: Database) -> dict[str, DataFrame]:
    return {t: scan_table(spark, db, t, *spec) for t, spec in HR_TABLES.items()}


def customer_order_options(hosts: str, keyspace: str, port: int = 9042) -> dict[str, str]:
    return {
        "spark.cassandra.connection.host": hosts,
        "spark.cassandra.connection.port": str(port),
        "keyspace": keyspace,
        "table": "orders_by_customer",
    }


def scan_customer_orders(spark: SparkSession, hosts: str, keyspace: str) -> DataFrame:
    """All orders of the wide-column table, token range by token range (needs its connector)."""
    rows = (
        spark.read.format("org.apache.spark.sql.cassandra")
        .options(**customer_order_options(hosts, keyspace)).load()
    )
    return typed_orders(rows)


def typed_orders(rows: DataFrame) -> DataFrame:
    """Order columns with the warehouse's types, whichever store they come from."""
    casts = {"quantity": "int", "total_price": "decimal(12,2)", "order_date": "date"}
    return rows.select(*[
        F.col(c).cast(casts[c]).alias(c) if c in casts else F.col(c) for c in ORDER_COLUMNS
    ])
