"""The batch runs from end to end, on files."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import tuples
from sluice import schemas
from sluice.operators.dedupe import merge_shards
from sluice.operators import checks
from sluice.plans import batch, engagement, quality, refresh, warehouse
from sluice.plans.quality import QualityGateError
from sluice.session import list_names, scratch_path
from sluice.sources import files
from sluice.sources.files import read_csv, zone_path


def write_landing(frame, root, viewing_user=1):
    tables = {
        "viewing-history": frame(
            schemas.VIEWING_HISTORY,
            (viewing_user, 1, 90.0, 60.0, 120.0, "Smart TV", "2026-01-05 10:00:00"),
            (1, 2, 30.0, 60.0, 50.0, "web", "2026-02-05 10:00:00"),
            (2, 2, 600.0, 700.0, 80.0, None, "2026-02-05 10:00:00")),
        "content-catalog": frame(schemas.CONTENT_CATALOG, (1, "a", 2000, 7.0, 10.0),
                                 (2, "b", 2001, 8.0, 21.0)),
        "user-profiles": frame(schemas.USER_PROFILES, (1, "basic", True), (2, "max", False)),
        "user-interactions": frame(schemas.USER_INTERACTIONS,
                                   (1, 1, "2026-01-06 00:00:00", None)),
        "streaming-quality": frame(schemas.STREAMING_QUALITY,
                                   (1, "s1", "eu", "x", 4, 3.0, 1, 20.0),
                                   (2, "s2", "us", "x", 0, 3.0, 1, 20.0)),
    }
    for name, df in tables.items():
        path = zone_path(root, "landing", name)
        writer = df.write.mode("overwrite").option("compression", "gzip")
        if name in ("content-catalog", "user-interactions"):
            writer.json(path)
        else:
            writer.option("header", True).csv(path)


def test_lake_run(spark, frame, tmp_path):
    root = str(tmp_path)
    write_landing(frame, root)
    lake = batch.Lake(spark, root, spread=2)
    for _ in range(2):  # a second run replaces everything by the same
        batch.run_lake(lake)
        monthly = lake.table("analytics", "user-monthly-engagement")
        assert tuples(monthly, "user_id", "year", "month", "total_watch_hours",
                      "interaction_count", "plan_type") == [
            (1, 2026, 1, 1.0, 1, "basic"), (1, 2026, 2, 0.5, 0, "basic"),
            (2, 2026, 2, 10.0, 0, "max")]
        assert tuples(lake.table("analytics", "content-performance"), "content_id",
                      "total_viewing_hours", "cost_per_viewing_hour") == [
            (1, 1.0, 10.0), (2, 10.5, 2.0)]
        assert tuples(lake.table("curated", "enriched-viewing-sessions"), "user_id", "title",
                      "device_standardized", "avg_buffering_events") == [
            (1, "a", "TV", 4.0), (1, "b", "Web", 4.0), (2, "b", "Other", 0.0)]
        assert tuples(lake.table("analytics", "churn-risk"), "user_id", "month",
                      "churn_risk_segment") == [
            (1, 1, "High Risk"), (1, 2, "High Risk"), (2, 2, "Low Risk")]
    report = zone_path(root, "analytics", "reports/top-content")
    assert read_csv(spark, report, lake.table("analytics", "content-performance").schema).count() == 2


def test_broken_gate_stops_the_run_before_anything_is_written(spark, frame, tmp_path):
    root = str(tmp_path)
    write_landing(frame, root, viewing_user=99)
    with pytest.raises(QualityGateError, match="viewing_unknown_user"):
        batch.run_lake(batch.Lake(spark, root))
    assert not (tmp_path / "curated").exists()


def test_missing_landing_data_stops_the_run(spark, tmp_path):
    with pytest.raises(batch.MissingDataError, match="content-catalog, streaming-quality"):
        batch.run_lake(batch.Lake(spark, str(tmp_path)))


def test_warehouse_loads(spark, frame, tmp_path):
    wh = batch.Warehouse(spark, str(tmp_path))
    days = spark.sql("SELECT DATE'2026-01-01' AS first_day, DATE'2026-12-31' AS last_day")
    employees = frame(schemas.EMPLOYEES, (1, "a", "b", "e", "j", 10))
    departments = frame(schemas.DEPARTMENTS, (10, "HR", "Tampa"))
    products = frame(schemas.PRODUCTS, (10, "pen", "office", Decimal(2)))

    def run(number, people, orders):
        customers = merge_shards({"SE": frame(schemas.CUSTOMERS, *people)})
        sales = frame(schemas.SALES_ORDERS, *[
            (*o, Decimal(5), dt.date(2026, 3, 4)) for o in orders])
        return tuple(wh.load(number, customers, products, employees, departments, sales, days).first())

    ann, bob = (1, "Ann", "A", "e", "c", "FL"), (2, "Bob", "B", "e", "c", "GA")
    assert run(1, [ann], [(100, 1, 10, 1), (101, 2, 10, 1)]) == (1, 0, 1)
    first_key = wh.whole("dim_customer", 1).first()["customer_key"]
    moved = (1, "Ann", "A", "e", "c", "NY")
    for _ in range(2):  # a load that is run again has the same result
        assert run(2, [moved, bob], [(100, 1, 10, 1), (101, 2, 10, 1)]) == (1, 1, 0)
        assert tuples(wh.grown("fact_sales", 2), "source_order_id", "date_key") == [
            (100, 20260304), (101, 20260304)]
        keys = tuples(wh.grown("fact_sales", 2), "sale_key")
        assert len(set(keys)) == 2
        assert tuples(wh.whole("dim_customer", 2), "source_customer_id", "state") == [
            (1, "NY"), (2, "GA")]
        assert wh.whole("dim_customer", 2).where("source_customer_id = 1").first()[
            "customer_key"] == first_key
        assert wh.grown("dim_date", 2).count() == 365
        assert wh.whole("dim_employee", 2).count() == 1
    joined = wh.grown("fact_sales", 2).join(wh.whole("dim_customer", 2), "customer_key")
    assert joined.where(F.col("state") == "NY").count() == 1


def test_shards_and_order_log(spark, frame, tmp_path):
    """Two shards, one product copy, staff, and orders on the shards and in a log."""
    wh = batch.Warehouse(spark, str(tmp_path))
    days = spark.sql("SELECT DATE'2026-01-01' AS first_day, DATE'2026-12-31' AS last_day")
    staff = frame(schemas.EMPLOYEES, (1, "a", "b", "e", "j", 10)), frame(schemas.DEPARTMENTS, (10, "HR", "Tampa"))
    products = frame(schemas.PRODUCTS, (10, "pen", "office", Decimal(2)))

    def orders(*rows):
        return frame(schemas.SALES_ORDERS, *[(*o, Decimal(5), dt.date(2026, 3, day)) for *o, day in rows])

    se = batch.Shard(frame(schemas.CUSTOMERS, (1, "Ann", "A", "e", "c", "FL")), products,
                     orders((1, 1, 10, 1, 9), (2, 1, 10, 1, 4)))
    ne = batch.Shard(frame(schemas.CUSTOMERS, (2, "Bob", "B", "e", "c", "NY")), products.limit(0),
                     orders((3, 2, 10, 1, 5), (1, 2, 10, 77, 1)))
    for _ in range(2):
        assert tuple(wh.load_shards(1, {"SE": se, "NE": ne}, *staff, days).first()) == (3, 1, 0)
    facts = wh.grown("fact_sales", 1)
    assert tuples(facts, "sale_key", "source_order_id", "quantity") == [(1, 2, 1), (2, 3, 1), (3, 1, 1)]
    log = orders((4, 2, 10, 1, 1), (4, 2, 10, 8, 2), (2, 1, 10, 1, 4), (None, 1, 10, 6, 7))
    both = {"SE": batch.Shard(se.customers, products), "NE": batch.Shard(ne.customers, products)}
    for _ in range(2):
        assert tuple(wh.load_shards(2, both, *staff, days, log).first()) == (2, 1, 0)
        assert tuples(wh.grown("fact_sales", 2).where("sale_key > 3"), "sale_key", "source_order_id", "quantity") == [
            (4, 4, 1), (5, None, 6)]


def parts(path):
    """Data files by folder, marks left out."""
    return {str(f.relative_to(path)) for f in path.rglob("*.parquet") if refresh.MARKS not in str(f)}


def test_only_changed_months_are_written(spark, frame, tmp_path):
    users = frame(schemas.USER_PROFILES, (1, "basic", True), (2, "max", False))
    delivery = frame(schemas.STREAMING_QUALITY, (1, "s1", "eu", "x", 4, 3.0, 1, 20.0))
    clicks = [(1, 1, "2026-01-06 00:00:00", None), (2, 5, "2026-03-01 00:00:00", None)]
    sessions = [(1, 1, 90.0, 100.0, 50.0, "web", "2026-01-05 10:00:00"), (2, 2, 30.0, 60.0, 50.0, "web", "2026-02-05 10:00:00"),
                (2, 2, 60.0, 60.0, 50.0, "web", "2026-03-05 10:00:00"), (2, 2, 60.0, 60.0, 50.0, "web", None)]

    def run(rows, seen=clicks, people=users):
        tables = frame(schemas.VIEWING_HISTORY, *rows), people, delivery, frame(schemas.USER_INTERACTIONS, *seen)
        months = refresh.refresh_engagement(spark, str(path), *tables)
        wanted = engagement.user_monthly_engagement(*tables)
        assert tuples(spark.read.parquet(str(path)).select(wanted.columns)) == tuples(wanted)
        copied = refresh.refresh_copy(spark, str(path), str(tmp_path / "copy"))
        assert tuples(spark.read.parquet(str(tmp_path / "copy")).select(wanted.columns)) == tuples(wanted)
        assert copied == months
        return months

    path = tmp_path / "engagement"
    assert run(sessions) == [refresh.NO_MONTH, 202601, 202602, 202603]
    first = parts(path)
    assert run(list(reversed(sessions))) == [] and parts(path) == first  # the order of rows doesn't matter
    changed = [sessions[0], (2, 2, 31.0, 60.0, 50.0, "web", "2026-02-05 10:00:00"), *sessions[2:]]
    assert run(changed) == [202602]
    assert {f for f in first if "month=2/" not in f} == {f for f in parts(path) if "month=2/" not in f}
    assert run(changed, clicks + clicks[1:]) == [202603]
    assert run(changed[:2], clicks + clicks[1:]) == []  # two months are gone
    assert len(parts(path)) == 2
    everyone = frame(schemas.USER_PROFILES, (1, "basic", False), (2, "max", False))
    assert run(changed[:2], clicks, everyone) == [202601, 202602]


def test_lake_run_by_month(spark, frame, tmp_path):
    root = str(tmp_path)
    write_landing(frame, root)
    lake = batch.Lake(spark, root, by_month=True)
    batch.run_lake(lake)
    report = tmp_path / "analytics" / "reports" / "daily-user-engagement"
    first = parts(report)
    assert lake.table("analytics", "user-monthly-engagement").count() == 3 and len(first) == 2
    batch.run_lake(batch.Lake(spark, root, by_month=True))
    assert parts(report) == first
    assert lake.measured["viewing-history"].rows == 3 and lake.measured["viewing-history"].violations() == [("viewing_range", 1)]
    assert ("device", 1, 3) in lake.measured["viewing-history"].nulls()


def test_staged_gates_equal_the_plain_report(spark, frame, tmp_path):
    root = str(tmp_path)
    write_landing(frame, root, viewing_user=99)
    lake = batch.Lake(spark, root)
    staged = lake.staged()
    plain = quality.quality_report(staged["viewing-history"], staged["user-profiles"], staged["content-catalog"],
                                   staged["streaming-quality"], staged["user-interactions"])
    assert tuples(quality.measured_report(lake.measured, staged)) == tuples(plain)
    rates = checks.null_rates_of(lake.measured, spark)
    for name, df in staged.items():
        declared = [c for c in df.columns if c != files.UNDECLARED]
        assert tuples(rates.where(F.col("dataset") == name).drop("dataset")) == tuples(checks.null_rates(df, declared))
    scratch = lake._scratch
    assert list_names(spark, scratch)
    lake.release()
    assert list_names(spark, scratch) == []


def test_only_touched_buckets_are_written(spark, frame, tmp_path):
    """The buckets together are what one upsert of the whole dimension gives."""
    wh = batch.Warehouse(spark, str(tmp_path), buckets=8)
    person = "customer_id BIGINT, first_name STRING, last_name STRING, email STRING, city STRING, state STRING, shard_order INT"

    def rows(*people):
        return warehouse.customer_rows(frame(person, *[(i, "a", "b", "e", city, "FL", 0) for i, city in people]))

    plain, files_of = None, {}
    batches = [[(i, "old") for i in range(40)], [(3, "new"), (3, "newer"), (100, "x")], [], [(101, "y")]]
    for load, people in enumerate(batches, start=1):
        for _ in range(2):  # run again, with the same result
            incoming = rows(*people)
            got = wh.upsert("dim_customer", load, incoming)
        plain = warehouse.DIMENSIONS["dim_customer"].upsert(plain, incoming)
        assert tuples(got, *plain.columns) == tuples(plain)
        files_of[load] = {f.parent.name for f in (tmp_path / "dim_customer" / f"load={load}").rglob("*.parquet")}
    assert len(files_of[1]) == 8 and 1 <= len(files_of[2]) <= 2 and not files_of[3] and len(files_of[4]) == 1
    assert wh.whole("dim_customer", 4, [0]).count() < 12
    empty = wh.upsert("dim_product", 1, warehouse.product_rows(frame(schemas.PRODUCTS)))
    assert empty.count() == 0 and wh.whole("dim_product", 1) is None


def test_tables_of_sessions_are_made_one_at_a_time(spark, frame, tmp_path, monkeypatch):
    """By then the staged tables that are read no more are gone."""
    root = str(tmp_path)
    write_landing(frame, root)
    seen, running, store = {}, [], batch.Lake.store

    def watched(lake, zone, dataset, df, partition_by=()):
        seen[dataset] = list_names(spark, lake._scratch) if lake._scratch else [], list(running)
        running.append(dataset)
        try:
            return store(lake, zone, dataset, df, partition_by)
        finally:
            running.remove(dataset)

    monkeypatch.setattr(batch.Lake, "store", watched)
    shared = scratch_path(spark, "")
    before = set(list_names(spark, shared))
    lake = batch.Lake(spark, root)
    batch.run_lake(lake)
    assert set(list_names(spark, shared)) <= before  # nothing staged is left behind
    for dataset in ("user-monthly-engagement", "content-performance", "enriched-viewing-sessions"):
        assert seen[dataset] == (["content-catalog", "quality-by-user", "user-profiles"], [])
    report = lake.table("analytics", "reports/daily-user-engagement")
    assert tuples(report) == tuples(lake.table("analytics", "user-monthly-engagement"))


def test_released_tables_are_staged_anew(spark, frame, tmp_path):
    root = str(tmp_path)
    write_landing(frame, root)
    lake = batch.Lake(spark, root)
    first = {name: tuples(df.drop(files.UNDECLARED)) for name, df in lake.staged().items()}
    kept = set(lake.staged()["user-profiles"].inputFiles())
    lake.release("viewing-history", "user-interactions")
    assert list_names(spark, lake._scratch) == ["content-catalog", "streaming-quality", "user-profiles"]
    again = lake.staged()
    assert {name: tuples(df.drop(files.UNDECLARED)) for name, df in again.items()} == first
    assert set(again["user-profiles"].inputFiles()) == kept
    lake.release()


def test_a_table_stored_by_month_is_copied_without_a_shuffle(spark, frame, tmp_path):
    rows = frame("user_id INT, year INT, month INT", *[(i, 2026, i % 3 + 1) for i in range(30)], (30, None, None))
    files.write_table(rows, str(tmp_path / "table"), partition_by=("year", "month"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("copying", "one stage")
    try:
        files.write_table(spark.read.parquet(str(tmp_path / "table")), str(tmp_path / "copy"),
                          partition_by=("year", "month"), gathered=True)
        stages = [s for job in tracker.getJobIdsForGroup("copying") for s in tracker.getJobInfo(job).stageIds]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(stages) <= 2  # one lists the folders of many months
    table, copy = (spark.read.parquet(str(tmp_path / name)) for name in ("table", "copy"))
    assert tuples(copy) == tuples(table) == tuples(rows.select(table.columns))
    assert len(copy.inputFiles()) == len(table.inputFiles()) == 4
