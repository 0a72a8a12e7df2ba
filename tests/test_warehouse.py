import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import tuples
from sluice import schemas
from sluice.operators.dedupe import (
    dedupe_first,
    merge_shards,
    replica_difference,
    shard_clashes,
)
from sluice.operators.keys import assign_keys, dense_keys, key_ranges, key_starts, stripe_of
from sluice.operators.loading import insert_ignore, upsert
from sluice.plans import sales, warehouse

PERSON = "source_customer_id BIGINT, first_name STRING, city STRING"


def people(frame, *rows):
    return frame("id BIGINT, name STRING, city STRING, rank INT", *rows)


def merge(existing, incoming):
    return upsert(existing, incoming, "id", "sk", precedence="rank", stripes=4)


def test_upsert_replaces_whole_rows_and_keeps_keys(frame):
    first = merge(None, people(frame, (1, "a", "x", 0), (2, "b", "y", 0), (3, "c", "z", 0)))
    keys = {r["id"]: r["sk"] for r in first.collect()}
    second = merge(first, people(frame, (2, "B", None, 0), (4, "d", "w", 0)))
    rows = {r["id"]: r for r in second.collect()}
    assert set(rows) == {1, 2, 3, 4}
    assert all(rows[i]["sk"] == keys[i] for i in keys)
    assert rows[4]["sk"] > max(keys.values())
    assert (rows[2]["name"], rows[2]["city"]) == ("B", None)  # an incoming null overwrites
    assert (rows[1]["name"], rows[1]["city"]) == ("a", "x")


def test_upsert_again_changes_nothing(frame):
    batch = people(frame, (1, "a", "x", 0), (2, "b", None, 1))
    once = merge(None, batch)
    assert tuples(merge(once, batch)) == tuples(once)


def test_later_shard_wins_and_clash_is_reported(frame):
    schema = schemas.CUSTOMERS
    se = frame(schema, (1, "a", "b", "e", "c", "FL"), (2, "a", "b", "e", "c", "GA"))
    ne = frame(schema, (2, "a", "b", "e", "c", "NY"))
    merged = merge_shards({"SE": se, "NE": ne})
    assert merged.count() == 3
    dim = warehouse.load_customers(None, merged)
    assert tuples(dim, "source_customer_id", "state") == [(1, "FL"), (2, "NY")]
    assert tuples(shard_clashes(merged, "customer_id")) == [(2, 2)]


@pytest.mark.parametrize("stripes", [1, 4, 64])
def test_keys_are_unique_repeatable_and_close_together(spark, stripes):
    rows = spark.range(5000).select((F.col("id") * 7).alias("id"))
    keyed = assign_keys(rows, "sk", "id", F.lit(100), stripes)
    got = tuples(keyed, "sk", "id")
    numbers = [k for k, _ in got]
    assert len(set(numbers)) == 5000 and min(numbers) > 100
    assert max(numbers) < 100 + 2 * 5000
    assert got == tuples(assign_keys(rows.repartition(7), "sk", "id", F.lit(100), stripes), "sk", "id")


def test_stripes_are_even(spark):
    counts = (
        spark.range(20000).groupBy(stripe_of(F.col("id"), 16).alias("s")).count()
        .agg(F.min("count"), F.max("count")).first()
    )
    assert counts[0] > 1000 and counts[1] < 1500


def dense(rows, pieces, after=0):
    ranges = key_ranges(rows, "day", "id", pieces)
    return dense_keys(rows, "sk", "day", "id", ["v", "w"], F.lit(after), ranges, pieces)


@pytest.mark.parametrize("pieces", [1, 3, 64])
def test_dense_keys_follow_group_and_key(frame, pieces):
    rng = random.Random(pieces)
    # Nine of ten rows on one day, ids far apart, repeated, negative and missing; a day missing.
    rows = [(rng.choice([1] * 18 + [2, None]), rng.choice([None, 7, -3, 10**17, rng.randrange(500), rng.randrange(10**6)]),
             rng.randrange(5), rng.randrange(3)) for _ in range(900)]
    df = frame("day INT, id BIGINT, v INT, w INT", *rows).repartition(7)
    got = dense(df, pieces, 1000).collect()
    assert sorted(r["sk"] for r in got) == list(range(1001, 1901))
    last = 10**18

    def order(r):
        return (r["day"] is None, r["day"] or 0, r["id"] is None, last if r["id"] is None else r["id"])

    by_key = sorted(got, key=lambda r: r["sk"])
    assert [order(r) for r in by_key] == sorted(order(r) for r in got)
    with_id = [(*order(r), r["v"], r["w"]) for r in by_key if r["id"] is not None]
    assert with_id == sorted(with_id)
    assert sorted(map(tuple, got)) == sorted(map(tuple, dense(df.repartition(3), pieces, 1000).collect()))


def test_dense_keys_of_nothing(frame):
    assert dense(frame("day INT, id BIGINT, v INT, w INT"), 4).collect() == []


def test_dedupe_takes_the_first_by_order_then_by_the_rest(frame):
    df = frame("id INT, at INT, v STRING", (1, 2, "a"), (1, 1, "z"), (1, 1, "b"), (2, 5, None),
               (None, 1, "n"), (None, 2, "m"))
    assert tuples(dedupe_first(df, "id", ["at"])) == [
        (None, 1, "n"), (None, 2, "m"), (1, 1, "b"), (2, 5, None)]  # rows without key all stay


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(1000).select(F.lit(1).alias("id"), F.col("id").alias("v"))
    plan = dedupe_first(df, "id")._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def test_replicas_differ_row_by_row(frame):
    first = frame("id INT, p INT", (1, 1), (2, 2), (2, 2))
    second = frame("p INT, id INT", (1, 1), (2, 2), (3, 3))
    assert tuples(replica_difference(first, second)) == [(2, 2, "first"), (3, 3, "second")]


def test_dates(spark):
    bounds = spark.sql("SELECT DATE'2024-01-01' AS first_day, DATE'2024-12-31' AS last_day")
    dates = {r["full_date"]: r for r in warehouse.dim_date(bounds).collect()}
    assert len(dates) == 366
    leap = dates[dt.date(2024, 2, 29)]
    assert leap["date_key"] == 20240229 and leap["month_name"] == "February"
    assert leap["quarter"] == 1 and leap["day_of_month"] == 29
    for day, row in dates.items():
        assert row["date_key"] == int(day.strftime("%Y%m%d"))
        assert row["day_of_week"] == day.weekday()
        assert row["day_name"] == day.strftime("%A")
        assert row["is_weekend"] == (day.weekday() >= 5)
        assert row["quarter"] == (day.month - 1) // 3 + 1


def test_years_are_taken_whole_and_loaded_once(frame):
    df = frame("d DATE", (dt.date(2023, 6, 1),), (dt.date(2024, 6, 1),))
    days = warehouse.dim_date(warehouse.whole_years(df, "d"))
    loaded = warehouse.load_dates(None, days)
    assert loaded.count() == 365 + 366
    assert warehouse.load_dates(loaded, days).count() == 0


def test_employees_without_department_drop_out(frame):
    employees = frame(schemas.EMPLOYEES, (1, "a", "b", "e", "j", 10), (2, "a", "b", "e", "j", 99),
                      (3, "a", "b", "e", "j", None))
    departments = frame(schemas.DEPARTMENTS, (10, "HR", "Tampa"))
    dim = warehouse.load_employees(None, employees, departments)
    assert tuples(dim, "source_employee_id", "department_name", "department_location") == [
        (1, "HR", "Tampa")]


DAY = dt.date(2026, 3, 4)


@pytest.fixture
def star(frame):
    customers = frame(schemas.CUSTOMERS, (1, "Ann", "A", "e", "c", "FL"), (2, "Bob", "B", "e", "c", "GA"))
    products = frame(schemas.PRODUCTS, (10, "pen", "office", Decimal(2)),
                     (20, "mug", "kitchen", Decimal(5)))
    return (warehouse.load_customers(None, merge_shards({"SE": customers})),
            warehouse.load_products(None, products))


def orders(frame, *rows):
    return frame(schemas.SALES_ORDERS, *[(*r[:4], Decimal(r[4]), r[5]) for r in rows])


def test_fact_load(frame, star):
    batch = orders(
        frame,
        (100, 1, 10, 3, 6, DAY),
        (100, 1, 10, 3, 9, DAY),     # same order again: the first stays
        (101, 2, 20, 1, 5, DAY),
        (102, 7, 10, 1, 2, DAY),     # unknown customer
        (103, 1, 70, 1, 2, DAY),     # unknown product
        (104, 7, 70, 1, 2, DAY),     # both
        (105, None, 10, 1, 2, DAY),  # no customer
    )
    facts = warehouse.load_facts(batch, *star)
    assert tuples(facts, "source_order_id", "date_key", "total_price", "unit_price") == [
        (100, 20260304, 6, 2), (101, 20260304, 5, 5)]
    missing = warehouse.missing_dimensions(batch, *star)
    assert tuples(missing, "order_id", "missing_dimension") == [
        (102, "dim_customer"), (103, "dim_product"), (104, "dim_customer"), (104, "dim_product"),
        (105, "dim_customer")]
    assert tuples(warehouse.load_audit(batch, *star)) == [(2, 1, 4)]

    again = warehouse.load_facts(batch, *star, facts)
    assert again.count() == 0
    assert tuples(warehouse.load_audit(batch, *star, facts)) == [(0, 3, 4)]

    later = orders(frame, (100, 2, 20, 1, 77, DAY), (106, 2, 10, 1, 2, DAY))
    added = warehouse.load_facts(later, *star, facts)
    assert tuples(added, "source_order_id") == [(106,)]
    assert added.first()["sale_key"] > facts.agg(F.max("sale_key")).first()[0]


def test_an_order_is_taken_from_its_first_row_that_can_be_loaded(frame, star):
    batch = orders(frame, (1, 7, 10, 1, 1, DAY), (1, 2, 10, 1, 3, DAY))
    assert tuples(warehouse.load_facts(batch, *star), "source_order_id", "total_price") == [(1, 3)]
    assert tuples(warehouse.load_audit(batch, *star)) == [(1, 0, 1)]


def test_orders_without_id_are_loaded_once_each(frame, star):
    same = (None, 1, 10, 3, 6, DAY)
    batch = orders(frame, same, same, (None, 2, 20, 1, 5, DAY), (None, 7, 20, 1, 5, DAY), (100, 1, 10, 3, 6, DAY))
    facts = warehouse.load_facts(batch, *star)
    assert tuples(facts, "source_order_id", "total_price") == [(None, 5), (None, 6), (None, 6), (100, 6)]
    assert tuples(facts, "sale_key") == [(1,), (2,), (3,), (4,)]
    assert tuples(warehouse.load_audit(batch, *star)) == [(4, 0, 1)]
    # The same batch again adds nothing; one more of a kind adds one.
    assert warehouse.load_facts(batch, *star, facts).count() == 0
    assert tuples(warehouse.load_audit(batch, *star, facts)) == [(0, 4, 1)]
    more = batch.union(orders(frame, same))
    assert tuples(warehouse.load_facts(more, *star, facts), "sale_key", "total_price") == [(5, 6)]
    assert tuples(warehouse.load_audit(more, *star, facts)) == [(1, 4, 1)]


def test_an_id_on_both_shards_is_loaded_from_the_first(frame, star):
    merged = merge_shards({"SE": orders(frame, (1, 2, 20, 9, 9, DAY)),
                           "NE": orders(frame, (1, 1, 10, 1, 1, DAY), (2, 1, 10, 1, 4, DAY))})
    assert tuples(warehouse.load_facts(merged, *star), "sale_key", "source_order_id", "total_price") == [(1, 1, 9), (2, 2, 4)]


def test_insert_ignore_does_not_shuffle_the_existing_table(spark):
    existing = spark.range(100000).withColumn("v", F.lit(1))
    batch = spark.range(99990, 100010).withColumn("v", F.lit(2))
    fresh = insert_ignore(existing, batch, "id")
    assert fresh.count() == 10
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    big = [i for i, line in enumerate(plan.splitlines()) if "Range (0, 100000" in line]
    assert big and "BroadcastHashJoin" in plan


def test_sales_queries_on_random_facts(spark, frame):
    """Group-first plans against joins of every fact."""
    rng = random.Random(5)
    fact = frame(
        "sale_key BIGINT, date_key INT, customer_key BIGINT, product_key BIGINT, quantity INT, "
        "total_price INT",
        *[(i, rng.choice([20260101, 20260131, 20260201, 19990101]),
           1 if rng.random() < 0.4 else rng.randrange(6), rng.randrange(6), 1, rng.randrange(100))
          for i in range(400)],
    )
    bounds = spark.sql("SELECT DATE'2026-01-01' AS first_day, DATE'2026-12-31' AS last_day")
    dates = warehouse.dim_date(bounds)
    customers = frame("customer_key BIGINT, first_name STRING, last_name STRING",
                      *[(i, "same" if i < 2 else f"n{i}", "x") for i in range(5)])
    products = frame("product_key BIGINT, product_name STRING, category STRING",
                     *[(i, f"p{i}", f"c{i % 2}") for i in range(5)])
    joined = fact.join(dates, "date_key")
    month = joined.groupBy("month_name", "year").agg(F.count("*"), F.sum("total_price"))
    assert tuples(sales.monthly_sales(fact, dates)) == tuples(month)
    spend = fact.join(customers, "customer_key").groupBy(
        "customer_key", "first_name", "last_name").agg(F.count("*"), F.sum("total_price"))
    got = sales.customer_spend(fact, customers)
    assert tuples(got) == tuples(spend.drop("customer_key"))
    amounts = [r["total_amount_spent"] for r in got.collect()]
    assert amounts == sorted(amounts, reverse=True)
    category = joined.join(products, "product_key").groupBy("category", "month_name", "year").agg(
        F.sum("total_price"))
    assert tuples(sales.category_month_revenue(fact, products, dates)) == tuples(category)
    revenue = fact.join(products, "product_key").groupBy("category").agg(
        F.count("*"), F.sum("total_price"))
    assert tuples(sales.category_revenue_dw(fact, products)) == tuples(revenue)
    latest = sales.latest_sales(fact, dates, customers, products).collect()
    known = [r["sale_key"] for r in joined.join(customers, "customer_key")
             .join(products, "product_key").orderBy(F.desc("sale_key")).limit(3).collect()]
    assert [r["sale_key"] for r in latest] == known


def test_state_revenue_takes_one_shard(frame):
    batch = orders(frame, (1, 1, 10, 1, 5, DAY), (2, 2, 10, 1, 7, DAY), (3, 3, 10, 1, 1, DAY))
    customers = frame("customer_id BIGINT, state STRING, shard STRING",
                      (1, "FL", "SE"), (2, "GA", "SE"), (3, "NY", "NE"))
    got = [tuple(r) for r in sales.state_revenue(batch, customers, "SE").collect()]
    assert got == [("GA", 7), ("FL", 5)]
    assert tuples(sales.table_counts({"orders": batch, "none": batch.limit(0)})) == [
        ("none", 0), ("orders", 3)]


def test_audit_from_the_rows_appended_equals_the_count_by_id(spark, frame, star):
    customers, products = star
    day = dt.date(2020, 5, 1)
    orders = frame(schemas.SALES_ORDERS, *[
        (i, c, p, 1, Decimal(1), day) for i, c, p in
        [(1, 1, 10), (1, 1, 10), (2, 1, 10), (3, 99, 10), (None, 1, 10), (None, 1, 10), (None, 99, 10)]])
    found = warehouse.looked_up(orders, customers, products)
    for existing in (None, warehouse.load_facts(orders.where("order_id = 2 OR order_id IS NULL").limit(2), customers, products)):
        added = warehouse.facts_of(found, existing)
        by_id = warehouse.audit_of(found, existing)
        assert tuples(warehouse.audit_of(found, existing, added)) == tuples(by_id)
        assert by_id.first()["inserted"] == added.count()


def test_stored_starts_number_alike_and_leave_one_shuffle(spark, frame, tmp_path):
    rows = frame("day INT, id BIGINT, v INT, w INT", *[(i % 3, None if i % 7 == 0 else i, i, 0) for i in range(60)])
    rows.write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    key_ranges(rows, "day", "id", 4).write.parquet(f"{tmp_path}/ranges")
    ranges = spark.read.parquet(f"{tmp_path}/ranges")
    key_starts(rows, "day", "id", ["v", "w"], ranges, 4).write.parquet(f"{tmp_path}/starts")
    starts = spark.read.parquet(f"{tmp_path}/starts")
    args = rows, "sk", "day", "id", ["v", "w"], F.lit(5), ranges, 4
    numbered = dense_keys(*args, starts=starts)
    assert numbered._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert tuples(numbered) == tuples(dense_keys(*args))
    assert sorted(r["sk"] for r in numbered.collect()) == list(range(6, 66))
