"""Revenue queries over the star schema and over the operational tables.

Facts and orders are added up by their join key first. What is joined to a
dimension afterwards is at most as long as that dimension, and a key holding a
large part of the facts is one row by then.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _per_key(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n"), F.sum("total_price").alias("amount")
    )


def monthly_sales(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    days = dim_date.select("date_key", "year", "month", "month_name")
    return (
        _per_key(fact, "date_key").join(days, "date_key")
        .groupBy("year", "month", "month_name")
        .agg(F.sum("n").alias("total_orders"), F.sum("amount").alias("total_revenue"))
        .orderBy("year", "month")
        .select("month_name", "year", "total_orders", "total_revenue")
    )


def customer_spend(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Customers by amount spent; namesakes stay apart because the key is their own."""
    names = dim_customer.select("customer_key", "first_name", "last_name")
    return (
        _per_key(fact, "customer_key").join(names, "customer_key")
        .select(
            "first_name", "last_name",
            F.col("n").alias("number_of_orders"),
            F.col("amount").alias("total_amount_spent"),
        )
        .orderBy(F.desc("total_amount_spent"), "first_name", "last_name")
    )


def category_month_revenue(fact: DataFrame, dim_product: DataFrame,
                           dim_date: DataFrame) -> DataFrame:
    days = dim_date.select("date_key", "year", "month", "month_name")
    categories = dim_product.select("product_key", "category")
    return (
        _per_key(fact, "product_key", "date_key")
        .join(days, "date_key")
        .groupBy("product_key", "year", "month", "month_name")
        .agg(F.sum("amount").alias("amount"))
        .join(categories, "product_key")
        .groupBy("category", "year", "month", "month_name")
        .agg(F.sum("amount").alias("total_revenue"))
        .orderBy("year", "month", "category")
        .select("category", "month_name", "year", "total_revenue")
    )


def category_revenue_dw(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    return _by_group(fact, dim_product.select("product_key", "category"),
                     "product_key", "category")


def category_revenue_oltp(orders: DataFrame, products: DataFrame) -> DataFrame:
    return _by_group(orders, products.select("product_id", "category"),
                     "product_id", "category")


def _by_group(rows: DataFrame, labels: DataFrame, key: str, group: str) -> DataFrame:
    return (
        _per_key(rows, key).join(labels, key)
        .groupBy(group)
        .agg(F.sum("n").alias("order_count"), F.sum("amount").alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), group)
    )


def state_revenue(orders: DataFrame, customers: DataFrame,
                  shard: str | None = None) -> DataFrame:
    """Revenue by customer state, of one shard's customers if ``shard`` is given.

    Orders that say their shard count on that shard only, so that an id on both isn't mixed up.
    """
    if shard is not None:
        customers = customers.where(F.col("shard") == shard)
        if "shard" in orders.columns:
            orders = orders.where(F.col("shard") == shard)
    return _by_group(orders, customers.select("customer_id", "state"),
                     "customer_id", "state").drop("order_count")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count("*").alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def latest_sales(fact: DataFrame, dim_date: DataFrame, dim_customer: DataFrame,
                 dim_product: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` facts with the greatest sale keys, spelled out.

    Only facts whose date, product and customer are known count. Semi-joins with the keys alone
    find them; a measured dimension under the broadcast threshold leaves the facts unshuffled.
    """
    known = fact.select("sale_key", "date_key", "customer_key", "product_key",
                        "quantity", "total_price")
    for dimension, key in ((dim_date, "date_key"), (dim_product, "product_key"),
                           (dim_customer, "customer_key")):
        known = known.join(dimension.select(key), key, "left_semi")
    return (
        known.orderBy(F.desc("sale_key")).limit(n)
        .join(dim_date.select("date_key", "full_date"), "date_key")
        .join(dim_product.select("product_key", "product_name"), "product_key")
        .join(dim_customer.select("customer_key", "first_name", "last_name"), "customer_key")
        .orderBy(F.desc("sale_key"))
        .select("sale_key", "full_date", "first_name", "last_name",
                "product_name", "quantity", "total_price")
    )
