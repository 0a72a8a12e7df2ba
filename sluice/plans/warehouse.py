"""Star schema: date, customer, product and employee dimensions and the sales fact."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.calendar import calendar_columns, date_key
from sluice.operators.keys import dense_keys, highest_key, key_ranges, key_starts
from sluice.operators.loading import insert_ignore, keyless_balance, keys_present, upsert, upsert_buckets
from sluice.session import stored

# Stripes bound the rows that one task numbers (operators/keys.py): ten billion
# customers make stripes of 2.5 million rows.
DIMENSION_STRIPES = 4096


# -- dimensions ---------------------------------------------------------------

def dim_date(bounds: DataFrame) -> DataFrame:
    """One row per day from ``first_day`` to ``last_day`` of the one-row frame ``bounds``."""
    days = bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("day"))
    return days.select(*calendar_columns(F.col("day")))


def whole_years(df: DataFrame, day: str) -> DataFrame:
    """Bounds of the calendar years that the dates in ``df`` fall in."""
    ends = df.agg(F.min(day).alias("low"), F.max(day).alias("high"))
    return ends.select(
        F.make_date(F.year("low"), F.lit(1), F.lit(1)).alias("first_day"),
        F.make_date(F.year("high"), F.lit(12), F.lit(31)).alias("last_day"),
    )


def load_dates(existing: DataFrame | None, days: DataFrame) -> DataFrame:
    """Dates to append to the date dimension; those already there stay untouched."""
    return insert_ignore(existing, days, "date_key")


@dataclass(frozen=True)
class Dimension:
    """How a dimension's rows are told apart and numbered."""

    natural_key: str
    surrogate: str
    precedence: str | None = None

    def upsert(self, existing: DataFrame | None, incoming: DataFrame) -> DataFrame:
        return upsert(existing, incoming, self.natural_key, self.surrogate, self.precedence, DIMENSION_STRIPES)

    def upsert_buckets(self, existing: Callable[[list[int] | None], DataFrame | None], incoming: DataFrame,
                       buckets: int) -> DataFrame:
        return upsert_buckets(existing, incoming, self.natural_key, self.surrogate, self.precedence,
                              DIMENSION_STRIPES, buckets)


DIMENSIONS = {
    "dim_customer": Dimension("source_customer_id", "customer_key", "shard_order"),
    "dim_product": Dimension("source_product_id", "product_key"),
    "dim_employee": Dimension("source_employee_id", "employee_key"),
}


def customer_rows(customers: DataFrame) -> DataFrame:
    return customers.select(
        F.col("customer_id").alias("source_customer_id"),
        "first_name", "last_name", "email", "city", "state", "shard_order",
    )


def product_rows(products: DataFrame) -> DataFrame:
    return products.select(
        F.col("product_id").alias("source_product_id"),
        "product_name", "category", "unit_price",
    )


def load_customers(existing: DataFrame | None, customers: DataFrame) -> DataFrame:
    """Customer dimension from merged shards; on a clash the later shard's row counts."""
    return DIMENSIONS["dim_customer"].upsert(existing, customer_rows(customers))


def load_products(existing: DataFrame | None, products: DataFrame) -> DataFrame:
    """Product dimension from one copy of the replicated product table."""
    return DIMENSIONS["dim_product"].upsert(existing, product_rows(products))


def denormalize_employees(employees: DataFrame, departments: DataFrame) -> DataFrame:
    """Employees with the name and place of their department; those without one drop out."""
    named = departments.select(
        "department_id", "department_name", F.col("location").alias("department_location")
    )
    return employees.join(named, "department_id").select(
        F.col("employee_id").alias("source_employee_id"),
        "first_name", "last_name", "email", "job_title",
        "department_name", "department_location",
    )


def load_employees(existing: DataFrame | None, employees: DataFrame,
                   departments: DataFrame) -> DataFrame:
    return DIMENSIONS["dim_employee"].upsert(existing, denormalize_employees(employees, departments))


# -- fact ---------------------------------------------------------------------

def _customer_lookup(dim_customer: DataFrame) -> DataFrame:
    return dim_customer.select(F.col("source_customer_id").alias("customer_id"), "customer_key")


def _product_lookup(dim_product: DataFrame) -> DataFrame:
    return dim_product.select(
        F.col("source_product_id").alias("product_id"), "product_key", "unit_price"
    )


def looked_up(orders: DataFrame, dim_customer: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Orders with surrogate keys and the current unit price; null where a dimension lacks the row.

    Facts, audit and gap report all follow from this table, so a load writes it once.
    """
    from_shard = F.col("shard_order") if "shard_order" in orders.columns else F.lit(0)
    known = orders.select("order_id", "customer_id", "product_id", "quantity", "total_price",
                          "order_date", from_shard.alias("shard_order"))
    return known.join(_product_lookup(dim_product), "product_id", "left").join(
        _customer_lookup(dim_customer), "customer_id", "left")


def fact_lines(orders: DataFrame, dim_customer: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Orders with surrogate keys; an order without a customer or product row is left out.

    The unit price is the dimension's current one, the total comes from the order.
    """
    return lines_of(looked_up(orders, dim_customer, dim_product))


def lines_of(found: DataFrame) -> DataFrame:
    """Fact lines of the looked-up orders that have all their keys."""
    return (
        found.where(F.col("product_key").isNotNull() & F.col("customer_key").isNotNull())
        .select(
            date_key(F.col("order_date")).alias("date_key"),
            "customer_key", "product_key",
            F.col("order_id").alias("source_order_id"),
            "quantity", "unit_price", "total_price", "shard_order",
        )
    )


# Columns that make two orders without id the same, and settle which row of an id counts.
FACT_SEQUENCE = ["date_key", "customer_key", "product_key", "quantity", "total_price"]


def new_facts(existing: DataFrame | None, lines: DataFrame,
              batch_keys: DataFrame | None = None) -> DataFrame:
    """Lines to append, without their sale key.

    One per order id not loaded yet, of the first shard that has it; and orders without id,
    unless the same were loaded before (``insert_ignore``).
    """
    return insert_ignore(existing, lines, "source_order_id", ["shard_order", *FACT_SEQUENCE], batch_keys,
                         FACT_SEQUENCE).drop("shard_order")


def number_facts(facts: DataFrame, after: Column) -> DataFrame:
    """Facts under dense sale keys above ``after``, in load order: by date, then order id.

    The new facts are stored, as they are ranged, counted and numbered.
    """
    kept = stored(facts, "new-facts")
    rest = ["customer_key", "product_key", "quantity", "total_price", "unit_price"]
    ranges = stored(key_ranges(kept, "date_key", "source_order_id"), "fact-ranges")
    starts = stored(key_starts(kept, "date_key", "source_order_id", rest, ranges), "fact-starts")
    return dense_keys(kept, "sale_key", "date_key", "source_order_id", rest, after, ranges, starts=starts)


def load_facts(orders: DataFrame, dim_customer: DataFrame, dim_product: DataFrame,
               existing: DataFrame | None = None) -> DataFrame:
    """Fact rows to append: looked up, reduced to new orders, and numbered.

    The looked-up orders are stored, as their keys, kinds and first rows are each read from them.
    """
    return facts_of(stored(looked_up(orders, dim_customer, dim_product), "order-lookup"), existing)


def facts_of(found: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Fact rows to append, from looked-up orders."""
    fresh = new_facts(existing, lines_of(found), _order_ids(found))
    return number_facts(fresh, highest_key(existing, "sale_key"))


def _order_ids(orders: DataFrame) -> DataFrame:
    return orders.select(F.col("order_id").alias("source_order_id"))


def missing_dimensions(orders: DataFrame, dim_customer: DataFrame,
                       dim_product: DataFrame) -> DataFrame:
    """Order rows that cannot be loaded, once per dimension they miss."""
    gaps = F.array_compact(F.array(
        F.when(F.col("customer_key").isNull(), F.lit("dim_customer")),
        F.when(F.col("product_key").isNull(), F.lit("dim_product")),
    ))
    return looked_up(orders, dim_customer, dim_product).select(
        "order_id", "customer_id", "product_id", F.explode(gaps).alias("missing_dimension")
    )


def load_audit(orders: DataFrame, dim_customer: DataFrame, dim_product: DataFrame,
               existing: DataFrame | None = None) -> DataFrame:
    """One row: order rows inserted, skipped because already there, and unmatched."""
    return audit_of(looked_up(orders, dim_customer, dim_product), existing)


def audit_of(found: DataFrame, existing: DataFrame | None = None, added: DataFrame | None = None) -> DataFrame:
    """The audit row of looked-up orders.

    ``added``, if given, is what the load of these orders appended: rows that match and rows that
    don't are counted where they are, and of those that match, the ones not appended were there.
    """
    matched = F.col("customer_key").isNotNull() & F.col("product_key").isNotNull()
    if added is not None:
        counted = found.select(
            F.lit(0).cast("long").alias("inserted"), matched.cast("int").alias("loadable"),
            (~matched).cast("int").alias("unmatched"),
        ).unionByName(added.select(
            F.lit(1).cast("long").alias("inserted"), F.lit(0).alias("loadable"), F.lit(0).alias("unmatched")))
    else:
        known = found.where(F.col("order_id").isNotNull())
        per_order = (
            known.groupBy(F.col("order_id").alias("source_order_id"))
            .agg(F.count_if(matched).alias("loadable"), F.count_if(~matched).alias("unmatched"))
        )
        if existing is None:
            per_order = per_order.withColumn("present", F.lit(False))
        else:
            there = keys_present(existing, _order_ids(known), "source_order_id")
            per_order = per_order.join(
                there.withColumn("present", F.lit(True)), "source_order_id", "left"
            ).withColumn("present", F.coalesce("present", F.lit(False)))
        inserts = F.when((F.col("loadable") > 0) & ~F.col("present"), 1).otherwise(0)
        # Orders without id, by kind, as ``new_facts`` takes them.
        kinds = keyless_balance(existing, lines_of(found), "source_order_id", FACT_SEQUENCE)
        extra = F.greatest(F.col("batch") - F.col("present"), F.lit(0))
        without_id = found.where(F.col("order_id").isNull() & ~matched).select(
            F.lit(0).alias("inserted"), F.lit(0).alias("loadable"), F.lit(1).alias("unmatched"))
        counted = per_order.select(inserts.alias("inserted"), "loadable", "unmatched").unionByName(
            kinds.select(extra.alias("inserted"), F.col("batch").alias("loadable"), F.lit(0).alias("unmatched"))
        ).unionByName(without_id)

    def total(column: Column) -> Column:
        return F.coalesce(F.sum(column), F.lit(0)).cast("long")

    return counted.agg(
        total(F.col("inserted")).alias("inserted"),
        total(F.col("loadable") - F.col("inserted")).alias("already_present"),
        total(F.col("unmatched")).alias("unmatched"),
    )
