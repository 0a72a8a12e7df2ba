"""Every operator and query over the test tables, by name."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.operators import checks, cleaning, dedupe, matching
from sluice.plans import batch, engagement, findings, quality, refresh, reports, sales, scoring, warehouse
from sluice.session import prepare, scratch_path, stored
from sluice.sources import files
from sluice.streaming import activity, alerts, lateness, sinks, spikes
from sluice.views import TestTables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = "2025-01-01 00:00:00"


# Whole numbers that may be null; local data frames show them as floating point.
NULLABLE = {
    "clean_interactions": ["content_id"],
    "dataset_presence": ["row_count"],
    "landing_interactions": ["content_id"],
    "viewer_growth": ["previous_viewer_count"],
    "warehouse_two_loads": ["sale_key", "source_order_id"],
}


def _plain(df: DataFrame, nullable: list[str]) -> DataFrame:
    """Results in types that are alike in both engines: money as double, times without zone."""
    casts = {"decimal": "double", "timestamp": "timestamp_ntz"}
    target = {name: casts.get(kind.split("(")[0]) for name, kind in df.dtypes}
    target |= dict.fromkeys(nullable, "double")
    return df.select(*[
        F.col(name).cast(kind).alias(name) if kind else F.col(name)
        for name, kind in target.items()
    ])


def query(plan: Callable[[TestTables], DataFrame]) -> Callable[[TestTables], DataFrame]:
    """Register a plan over the test tables under its function name."""
    name = plan.__name__

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _plain(plan(TestTables(prepare(spark), folder)), NULLABLE.get(name, []))

    QUERIES[name] = run
    return plan


# -- warehouse ----------------------------------------------------------------

def both_shards(t: TestTables) -> DataFrame:
    return dedupe.merge_shards({"SE": t.shard("SE"), "NE": t.shard("NE")})


def customer_dimension(t: TestTables) -> DataFrame:
    return warehouse.load_customers(None, both_shards(t))


def product_dimension(t: TestTables) -> DataFrame:
    return warehouse.load_products(None, t.products)


def fact_lines(t: TestTables) -> DataFrame:
    return warehouse.fact_lines(t.sales_orders, customer_dimension(t), product_dimension(t))


def facts(t: TestTables) -> DataFrame:
    """Fact rows without sale key, for queries that do not show it."""
    return warehouse.new_facts(None, fact_lines(t))


@query
def dim_date(t):
    return warehouse.load_dates(
        None, warehouse.dim_date(warehouse.whole_years(t.sales_orders, "order_date"))
    )


@query
def dim_date_extension(t):
    """All years of the orders added to a dimension that has only the first of them."""
    first = t.sales_orders.agg(F.min("order_date").alias("day"))
    existing = warehouse.dim_date(warehouse.whole_years(first, "day"))
    years = warehouse.whole_years(t.sales_orders, "order_date")
    return warehouse.load_dates(existing, warehouse.dim_date(years))


@query
def dim_customer_upsert(t):
    """Both shards arrive; the south-eastern customers were loaded before with another city."""
    before = t.shard("SE").withColumn("city", F.concat(F.lit("old "), "city"))
    existing = warehouse.load_customers(None, dedupe.merge_shards({"SE": before}))
    return warehouse.load_customers(existing, both_shards(t))


@query
def dim_customer_buckets(t):
    """Customers in bucket folders; a second load brings only those of one nation, who moved."""
    house = batch.Warehouse(t.spark, scratch_path(t.spark, f"buckets-{uuid4().hex}"), buckets=8)
    moved = t.shard("NE").where(F.col("state") == "NATION_12").withColumn("city", F.lit("moved"))
    house.upsert("dim_customer", 1, warehouse.customer_rows(both_shards(t)))
    return house.upsert("dim_customer", 2, warehouse.customer_rows(dedupe.merge_shards({"NE": moved})))


@query
def dim_product_upsert(t):
    """All products arrive; those of one category were loaded before at no price."""
    before = t.products.where(F.col("category") == "ECONOMY").withColumn(
        "unit_price", F.lit(None).cast("decimal(12,2)")
    )
    return warehouse.load_products(warehouse.load_products(None, before), t.products)


@query
def dim_employee(t):
    return warehouse.load_employees(None, t.employees, t.departments)


@query
def fact_sales(t):
    return warehouse.load_facts(t.sales_orders, customer_dimension(t), product_dimension(t))


@query
def fact_sales_rerun(t):
    """What a load of all orders appends after the south-eastern orders were loaded."""
    t.keep("sales_orders")
    customers = stored(customer_dimension(t), "dim-customer")
    products = stored(product_dimension(t), "dim-product")
    of_shard = t.shard("SE").select(F.col("customer_id").alias("source_customer_id"))
    loaded = warehouse.load_facts(
        t.sales_orders, customers.join(of_shard, "source_customer_id", "left_semi"), products
    )
    existing = stored(loaded, "fact-sales")
    return warehouse.load_facts(t.sales_orders, customers, products, existing)


def _partial_dimensions(t: TestTables) -> tuple[DataFrame, DataFrame]:
    """Dimensions in which one shard's customers and one product category are missing."""
    customers = warehouse.load_customers(None, dedupe.merge_shards({"NE": t.shard("NE")}))
    products = t.products.where(F.col("category") != "ECONOMY")
    return customers, warehouse.load_products(None, products)


def two_loads(t: TestTables) -> batch.Warehouse:
    """A warehouse loaded twice, by shard.

    First the orders of the early years: those of south-eastern customers on one shard, the
    others on the other one, which also has every tenth order of the first at quantity 0. Then
    all customers, those of one nation moved, and all orders again from the order log, which
    holds those of the first line of an order twice, and those of the last lines without id too.
    """
    t.keep("sales_orders")
    root = scratch_path(t.spark, f"warehouse-{uuid4().hex}")
    house = batch.Warehouse(t.spark, root)
    days = warehouse.whole_years(t.sales_orders, "order_date")
    of_se = t.shard("SE").select("customer_id")
    early = t.sales_orders.where(F.year("order_date") < EARLY)
    se = early.join(of_se, "customer_id", "left_semi")
    repeated = se.where(F.col("order_id") % 10 == 1).withColumn("quantity", F.lit(0))
    ne = early.join(of_se, "customer_id", "left_anti").select(se.columns).unionByName(repeated)
    house.load_shards(1, {"SE": batch.Shard(t.shard("SE"), t.products, se),
                          "NE": batch.Shard(t.shard("NE"), t.products, ne)}, t.employees, t.departments, days)
    moved = t.shard("NE").withColumn("city", F.when(F.col("state") == "NATION_12", "moved").otherwise(F.col("city")))
    first = t.sales_orders.where(F.col("order_id") % 10 == 1)
    without_id = t.sales_orders.where(F.col("order_id") % 10 == 7).withColumn("order_id", F.lit(None).cast("bigint"))
    log = t.sales_orders.unionByName(first).unionByName(without_id)
    for _ in range(2):  # the second load is run again, and changes nothing
        house.load_shards(2, {"SE": batch.Shard(t.shard("SE"), t.products), "NE": batch.Shard(moved, t.products)},
                          t.employees, t.departments, days, log)
    return house


EARLY = 1997


@query
def warehouse_two_loads(t):
    """Facts of two loads with the present city of their customers.

    Orders without id stand last of their day; which of them has which key isn't shown.
    """
    house = two_loads(t)
    facts = t.spark.read.parquet(f"{house.root}/fact_sales")
    people = house.whole("dim_customer", 2).select("customer_key", "source_customer_id", "city")
    return facts.join(people, "customer_key").select(
        F.col("load").cast("int").alias("load"), F.when(F.col("source_order_id").isNotNull(), F.col("sale_key")).alias("sale_key"),
        "date_key", "source_customer_id", "city", "source_order_id", "quantity", "total_price")


@query
def warehouse_audits(t):
    """What two loads inserted, found present and could not match."""
    return t.spark.read.parquet(f"{two_loads(t).root}/load_audit").withColumn("load", F.col("load").cast("int"))


@query
def fact_load_audit(t):
    customers, products = _partial_dimensions(t)
    existing = facts(t).join(
        product_dimension(t).where(F.col("category") == "STANDARD").select("product_key"),
        "product_key", "left_semi",
    )
    return warehouse.load_audit(t.sales_orders, customers, products, existing)


@query
def fact_missing_dimension(t):
    return warehouse.missing_dimensions(t.sales_orders, *_partial_dimensions(t))


@query
def order_dedupe(t):
    return dedupe.dedupe_first(t.sales_orders, "order_id", ["order_date"])


@query
def shard_union(t):
    return both_shards(t)


@query
def shard_clashes(t):
    """The second shard also holds the customers of the AMERICA nations of the first."""
    shared = t.customers.where(F.col("state").isin("NATION_1", "NATION_2")).drop("shard")
    second = t.shard("NE").unionByName(shared)
    return dedupe.shard_clashes(
        dedupe.merge_shards({"SE": t.shard("SE"), "NE": second}), "customer_id"
    )


@query
def replica_difference(t):
    """Two copies of the product table; in the second one a category was repriced."""
    price = F.when(F.col("category") == "PROMO", F.lit(1)).otherwise(F.col("unit_price"))
    second = t.products.withColumn("unit_price", price.cast("decimal(12,2)"))
    return dedupe.replica_difference(t.products, second)


# -- sales queries ------------------------------------------------------------

@query
def monthly_sales(t):
    return sales.monthly_sales(facts(t), dim_date(t))


@query
def customer_spend(t):
    return sales.customer_spend(facts(t), customer_dimension(t))


@query
def category_month_revenue(t):
    return sales.category_month_revenue(facts(t), product_dimension(t), dim_date(t))


@query
def table_counts(t):
    return sales.table_counts({
        "dim_customer": customer_dimension(t),
        "dim_product": product_dimension(t),
        "fact_sales": facts(t),
    })


@query
def latest_sales(t):
    t.keep("sales_orders")
    customers = stored(customer_dimension(t), "dim-customer")
    products = stored(product_dimension(t), "dim-product")
    return sales.latest_sales(warehouse.load_facts(t.sales_orders, customers, products), dim_date(t), customers, products)


@query
def state_revenue_se(t):
    return sales.state_revenue(t.sales_orders, t.customers, "SE")


@query
def state_revenue_ne(t):
    return sales.state_revenue(t.sales_orders, t.customers, "NE")


@query
def category_revenue_oltp(t):
    return sales.category_revenue_oltp(t.sales_orders, t.products)


@query
def category_revenue_dw(t):
    return sales.category_revenue_dw(facts(t), product_dimension(t))


# -- lake ---------------------------------------------------------------------

@query
def clean_viewing(t):
    return cleaning.clean_viewing(t.viewing_history)


@query
def clean_viewing_distinct(t):
    """A landing zone that holds every session twice."""
    return cleaning.clean_viewing(t.viewing_history.union(t.viewing_history), distinct=True)


@query
def clean_interactions(t):
    return cleaning.clean_interactions(t.user_interactions)


@query
def quality_by_user(t):
    return engagement.quality_by_user(t.streaming_quality)


@query
def enriched_sessions(t):
    return engagement.enrich_sessions(
        clean_viewing(t), t.content_catalog, t.user_profiles, t.streaming_quality
    )


@query
def monthly_interactions(t):
    return engagement.monthly_interactions(clean_interactions(t))


@query
def user_monthly_engagement(t):
    return engagement.user_monthly_engagement(
        clean_viewing(t), t.user_profiles, t.streaming_quality, clean_interactions(t)
    )


@query
def content_performance(t):
    return engagement.content_performance(clean_viewing(t), t.content_catalog)


@query
def viewers_by_quarter_sketch(t):
    """Viewers of each quarter from stored sketches of its months, held against exact counts."""
    sketches = stored(engagement.viewer_sketches(t.viewing_history), "viewer-sketches")
    exact = engagement.quarterly_viewers(t.viewing_history)
    return engagement.sketched_viewers(sketches, "year", "quarter").withColumnRenamed("viewers", "estimate").join(
        exact, ["year", "quarter"]).select(
        "year", "quarter", "sessions", "viewers",
        (F.abs(F.col("estimate") - F.col("viewers")) <= F.col("viewers") * engagement.sketch_error()).alias("close"))


@query
def quality_region_isp(t):
    return engagement.quality_by_region_isp(t.streaming_quality)


@query
def churn_risk(t):
    return scoring.churn_risk(user_monthly_engagement(t))


@query
def churn_risk_double(t):
    """The score added up in doubles."""
    return scoring.churn_risk(user_monthly_engagement(t), exact=False)


@query
def high_risk_users(t):
    return reports.high_risk_users(churn_risk(t))


@query
def top_content(t):
    return reports.top_content(content_performance(t))


@query
def worst_quality_regions(t):
    return reports.worst_quality(quality_region_isp(t))


@query
def daily_user_engagement(t):
    """The engagement table as the daily report keeps it, partitioned by year and month."""
    path = scratch_path(t.spark, f"daily-user-engagement-{uuid4().hex}")
    files.write_table(user_monthly_engagement(t), path, partition_by=("year", "month"))
    return files.read_table(t.spark, path)


@query
def engagement_two_runs(t):
    """The engagement table after a second run, before which the sessions of one month changed."""
    t.keep_lines()
    t.keep("viewing_history")
    path = scratch_path(t.spark, f"engagement-runs-{uuid4().hex}")
    before = t.viewing_history
    changed_month = refresh.of_months("start_time", [CHANGED_MONTH])
    after = before.withColumn("duration_watched_min", F.when(
        changed_month, F.col("duration_watched_min") / 2).otherwise(F.col("duration_watched_min")))
    for viewing in (before, after):
        refresh.refresh_engagement(t.spark, path, cleaning.clean_viewing(viewing), t.user_profiles,
                                   t.streaming_quality, clean_interactions(t))
    return files.read_table(t.spark, path)


CHANGED_MONTH = 199803


@query
def top_content_csv(t):
    """The report written as CSV and read again."""
    report = top_content(t)
    path = scratch_path(t.spark, f"top-content-{uuid4().hex}")
    files.write_report(report, path)
    return files.read_csv(t.spark, path, report.schema)


@query
def landing_csv(t):
    """Profiles through a gzip CSV landing file."""
    root = scratch_path(t.spark, f"csv-{uuid4().hex}")
    path = files.zone_path(root, "landing", "user-profiles")
    t.user_profiles.write.option("header", True).option("compression", "gzip").csv(path)
    return files.read_landing(t.spark, root, "user-profiles")


@query
def landing_json(t):
    """The catalog through a gzip JSON landing file."""
    root = scratch_path(t.spark, f"json-{uuid4().hex}")
    path = files.zone_path(root, "landing", "content-catalog")
    t.content_catalog.write.option("compression", "gzip").json(path)
    return files.read_landing(t.spark, root, "content-catalog").drop(files.UNDECLARED)


def land(df: DataFrame, root: str, dataset: str) -> None:
    """Write gzip landing files of the dataset's format."""
    writer = df.write.option("compression", "gzip")
    path = files.zone_path(root, "landing", dataset)
    if files.LANDING[dataset][0] == "json":
        writer.json(path)
    else:
        writer.option("header", True).csv(path)


def land_all(t: TestTables, raw: dict[str, DataFrame], root: str) -> None:
    """Land all datasets at the same time, so that one with few tasks leaves no core idle."""
    batch.together(t.spark, *[partial(land, df, root, dataset) for dataset, df in raw.items()])


def untidy_landing(t: TestTables, dataset: str, df: DataFrame, spoilt: str) -> DataFrame:
    """Through landing files with columns in another order, one column more, and in some rows of
    the column ``spoilt`` a value that isn't of its type."""
    root = scratch_path(t.spark, f"untidy-{uuid4().hex}")
    broken = F.when(F.col("user_id") % 97 == 0, "n/a").otherwise(F.col(spoilt).cast("string"))
    build = F.concat(F.lit("b"), F.col("user_id") % 3).alias("app_build")
    land(df.withColumn(spoilt, broken).select(build, *reversed(df.columns)), root, dataset)
    landed = files.read_landing(t.spark, root, dataset)
    if files.UNDECLARED not in landed.columns:
        return landed
    read = F.variant_get(files.UNDECLARED, "$.app_build", "string")
    return landed.withColumn("app_build", read).drop(files.UNDECLARED)


def day_text(viewing: DataFrame) -> DataFrame:
    return viewing.withColumn("start_time", F.col("start_time").cast("date").cast("string"))


@query
def landing_viewing(t):
    return untidy_landing(t, "viewing-history", day_text(t.viewing_history), "completion_pct")


@query
def landing_quality(t):
    return untidy_landing(t, "streaming-quality", t.streaming_quality, "latency_ms")


@query
def landing_interactions(t):
    return untidy_landing(t, "user-interactions", t.user_interactions, "content_id")


@query
def lake_run(t):
    """Landing files through gates, zones, scores and reports: rows and hours of each output.

    Negative latencies and bit rates land as none and the least, as the gates would stop the run.
    """
    root = scratch_path(t.spark, f"lake-{uuid4().hex}")
    delivery = t.streaming_quality.withColumns({
        "latency_ms": F.greatest("latency_ms", F.lit(0.0)),
        "avg_bitrate_mbps": F.greatest("avg_bitrate_mbps", F.lit(0.01)),
    })
    raw = {**landing_tables(t), "streaming-quality": delivery,
           "viewing-history": day_text(t.viewing_history)}
    land_all(t, raw, root)
    lake = batch.Lake(t.spark, root)
    batch.run_lake(lake)
    hours = {"viewing-history": "duration_watched_min", "user-monthly-engagement": "total_watch_hours",
             "content-performance": "total_viewing_hours"}
    outputs = {name: lake.table("curated", name) for name in batch.CURATED}
    outputs |= {name: lake.table("analytics", name) for name in (*batch.ANALYTICS, "churn-risk")}
    for name in ("high-risk-users", "top-content", "worst-quality-region-isp"):
        path = files.zone_path(root, "analytics", f"reports/{name}")
        outputs[f"report {name}"] = t.spark.read.option("header", True).csv(path)
    outputs["report daily-user-engagement"] = lake.table("analytics", "reports/daily-user-engagement")
    return reduce(DataFrame.unionByName, [
        df.agg(F.count("*").alias("row_count"), F.sum(
            F.col(hours[name]).cast("decimal(18,2)") if name in hours else F.lit(None).cast("decimal(18,2)")
        ).alias("total_time")).select(F.lit(name).alias("dataset"), "*")
        for name, df in outputs.items()
    ])


# -- quality gates ------------------------------------------------------------

@query
def dq_report(t):
    return quality.quality_report(
        t.viewing_history, t.user_profiles, t.content_catalog,
        t.streaming_quality, t.user_interactions,
    )


def retained_profiles(t: TestTables) -> DataFrame:
    return t.user_profiles.where(~F.col("is_churned"))


@query
def dq_report_lost_profiles(t):
    """The gates when the profiles of churned users and the old titles are gone."""
    titles = t.content_catalog.where(F.col("release_year") > 1980)
    return quality.quality_report(
        t.viewing_history, retained_profiles(t), titles,
        t.streaming_quality, t.user_interactions,
    )


@query
def dq_first_failure(t):
    """Which rule ends a run without the profiles of churned users, and after how many broken rows."""
    try:
        quality.enforce(dq_report_lost_profiles(t))
    except quality.QualityGateError as failure:
        found = [(failure.rule, failure.violations)]
    else:
        found = []
    return t.spark.createDataFrame(found, "rule STRING, violations BIGINT")


@query
def dq_null_rates(t):
    return reduce(DataFrame.unionByName, [
        checks.null_rates(df).select(F.lit(name).alias("dataset"), "*")
        for name, df in landing_tables(t).items()
    ])


def landing_tables(t: TestTables) -> dict[str, DataFrame]:
    return {
        "viewing-history": t.viewing_history,
        "content-catalog": t.content_catalog,
        "user-profiles": t.user_profiles,
        "user-interactions": t.user_interactions,
        "streaming-quality": t.streaming_quality,
    }


def landed(t: TestTables) -> batch.Lake:
    """A lake whose landing files hold the tables as they are."""
    root = scratch_path(t.spark, f"measured-{uuid4().hex}")
    land_all(t, {**landing_tables(t), "viewing-history": day_text(t.viewing_history)}, root)
    return batch.Lake(t.spark, root)


@query
def dq_report_staged(t):
    """The gates over landing files, with row rules counted while the files are staged."""
    lake = landed(t)
    tables = lake.staged()
    return quality.measured_report(lake.measured, tables)


@query
def dq_null_rates_staged(t):
    """Null rates of landing files, counted while the files are staged."""
    lake = landed(t)
    lake.staged()
    return checks.null_rates_of(lake.measured, t.spark)


@query
def dataset_presence(t):
    return checks.dataset_presence({**landing_tables(t), "ratings": None}, t.spark)


@query
def orphan_sessions(t):
    return matching.orphans(t.viewing_history, retained_profiles(t), "user_id")


@query
def repeated_orders(t):
    return matching.repeated_keys(t.sales_orders, "order_id")


# -- activity stream ----------------------------------------------------------

def activity_events(t: TestTables) -> DataFrame:
    return activity.parse_activity(t.messages())


@query
def parse_events(t):
    return activity_events(t)


@query
def decode_report(t):
    return activity.decode_report(t.messages())


@query
def concurrent_viewers(t):
    return alerts.concurrent_viewers(activity_events(t))


@query
def poor_sessions(t):
    return alerts.poor_sessions(activity_events(t))


@query
def poor_sessions_by_day(t):
    return alerts.poor_sessions(activity_events(t), threshold=2, window="1 day")


@query
def viewer_windows(t):
    return alerts.viewer_windows(activity_events(t))


@query
def viewer_growth(t):
    return alerts.viewer_growth(viewer_windows(t))


@query
def trending_spikes(t):
    return alerts.trending_spikes(viewer_windows(t))


@query
def trending_spikes_adjacent(t):
    return alerts.trending_spikes(viewer_windows(t), mode="adjacent")


@query
def adjacent_spikes(t):
    return alerts.adjacent_spikes(activity_events(t))


@query
def stream_freshness(t):
    return activity.stream_freshness(activity_events(t), F.lit(AS_OF).cast("timestamp"))


# The same plans run by Structured Streaming over all events that are there.

def event_stream(t: TestTables) -> DataFrame:
    # The pattern also matches when the table is a single file.
    source = (
        t.spark.readStream.schema(t.base("events").schema)
        .parquet(f"{t.folder}/events.parque[t]")
    )
    return activity.parse_activity(t.messages(source))


def run_stream(t: TestTables, name: str, sink, stream: DataFrame) -> str:
    """Run a stream to its end; the path of what it wrote."""
    base = scratch_path(t.spark, f"{name}-{uuid4().hex}")
    sinks.finish(sink(stream, f"{base}/data", f"{base}/checkpoint"))
    return f"{base}/data"


def written(t: TestTables, path: str, stream: DataFrame) -> DataFrame:
    return t.spark.read.schema(stream.schema).parquet(path)


@query
def stream_parse_events(t):
    stream = event_stream(t)
    return written(t, run_stream(t, "parsed", sinks.to_table, stream), stream)


def changed(t: TestTables, name: str, stream: DataFrame, *keys: str) -> DataFrame:
    """The latest state of each key of a stream that ran in update mode."""
    path = run_stream(t, name, sinks.to_changes, stream)
    return sinks.latest(written(t, path, stream.withColumn("batch", F.lit(0))), *keys)


WINDOW_KEYS = ("window_start", "window_end", "content_id", "title")


@query
def stream_concurrent_viewers(t):
    """Counts as each batch changes them, those of open windows too."""
    return changed(t, "concurrent", alerts.concurrent_viewers(event_stream(t)), *WINDOW_KEYS)


@query
def stream_closed_viewers(t):
    """Windows that were closed by the watermark when the input ended."""
    stream = alerts.concurrent_viewers(event_stream(t))
    return written(t, run_stream(t, "concurrent", sinks.to_table, stream), stream)


@query
def stream_viewer_windows(t):
    return changed(t, "windows", alerts.viewer_windows(event_stream(t)), *WINDOW_KEYS)


# Events that arrive in several parts, each taken in by a stream that goes on where it was.

BY_TIME = ["day(ts) <= 10", "day(ts) > 10 AND day(ts) <= 20", "day(ts) > 20"]
LATE_LAST = ["day(ts) <= 15 AND event_id % 10 <> 0", "day(ts) > 15 AND event_id % 10 <> 0", "event_id % 10 = 0"]


def run_parts(t: TestTables, name: str, parts: list[str], start) -> str:
    """Run ``start(messages, data, checkpoint)`` to its end after each part of the events arrives."""
    base = scratch_path(t.spark, f"{name}-{uuid4().hex}")
    events = t.base("events")
    for part in parts:
        events.where(part).write.mode("append").parquet(f"{base}/arrived")
        source = t.spark.readStream.schema(events.schema).parquet(f"{base}/arrived")
        sinks.finish(start(t.messages(source), f"{base}/data", f"{base}/checkpoint"))
    return f"{base}/data"


@query
def stream_viewer_snapshot(t):
    """The whole window table after several batches, each of which publishes it anew."""
    def start(messages, data, checkpoint):
        return sinks.to_snapshot(alerts.viewer_windows(activity.parse_activity(messages)), data, checkpoint)

    return sinks.read_snapshot(t.spark, run_parts(t, "snapshot", BY_TIME, start))


@query
def stream_last_seen_spikes(t):
    """Spikes against the last window seen, from state that the stream keeps between batches."""
    plans = []

    def start(messages, data, checkpoint):
        plans.append(spikes.last_seen_spikes(activity.parse_activity(messages)))
        return sinks.to_table(plans[-1], data, checkpoint)

    path = run_parts(t, "spikes", BY_TIME, start)
    return written(t, path, plans[-1])


GAP = "6 hours"


@query
def poor_sessions_gap(t):
    return alerts.poor_gap_sessions(activity_events(t), threshold=1, gap=GAP)


@query
def stream_poor_sessions_gap(t):
    """Poor sessions that were over when the input ended."""
    stream = alerts.poor_gap_sessions(event_stream(t), threshold=1, gap=GAP)
    return written(t, run_stream(t, "gap-sessions", sinks.to_table, stream), stream)


@query
def stream_lateness(t):
    """What the windowed count reports of three parts of the events, of which the last is late."""
    base = scratch_path(t.spark, f"lateness-{uuid4().hex}")
    with lateness.ProgressLog(t.spark, f"{base}/progress") as log:
        def start(messages, data, checkpoint):
            return log.watch(sinks.to_changes(
                alerts.viewer_windows(activity.parse_activity(messages)), data, checkpoint, name="viewer windows"))

        run_parts(t, "late-windows", LATE_LAST, start)
    seen = log.table().where((F.col("name") == "viewer windows") & (F.col("input_rows") > 0))
    return seen.select(
        F.row_number().over(Window.orderBy("batch")).alias("part"), "input_rows", "dropped", since_epoch("watermark"))


def since_epoch(name: str):
    """A time, or the first one there is if it isn't known."""
    return F.coalesce(name, F.lit("1970-01-01 00:00:00").cast("timestamp")).alias(name)


@query
def stream_late_events(t):
    """Events of each batch that were older than the watermark, counted one by one."""
    def start(messages, data, checkpoint):
        return lateness.late_events(activity.parse_activity(messages), data, checkpoint)

    path = run_parts(t, "late-events", LATE_LAST, start)
    found = t.spark.read.schema(lateness.LATE).parquet(path)
    return found.select("batch", "events", "late", "without_time", since_epoch("watermark"))


def spoilt_messages(messages: DataFrame) -> DataFrame:
    """Messages some of which are cut off, empty, of another kind or without a usable time."""
    text = F.col("value").cast("string")
    number = F.get_json_object(text, "$.event_id").cast("bigint")
    broken = (
        F.when(number % 7 == 0, F.concat(F.lit('{"event_id": "'), number))
        .when(number % 11 == 0, F.lit(None))
        .when(number % 13 == 0, F.concat(F.lit('{"other": '), number, F.lit("}")))
        .when(number % 17 == 0, F.concat(F.lit('{"event_id": "'), number, F.lit('", "event_ts": "noon"}')))
        .otherwise(text)
    )
    return messages.withColumn("value", broken.cast("binary"))


@query
def stream_rejected(t):
    """Readable and broken messages of a stream in three batches, from the tables it keeps."""
    plans = []

    def start(messages, data, checkpoint):
        plans.append(activity.judge_messages(spoilt_messages(messages)))
        return sinks.to_parsed_and_rejected(plans[-1], data, checkpoint)

    path = run_parts(t, "judged", BY_TIME, start)
    both = [sinks.kept(t.spark, path, status, plans[-1].schema).withColumn("status", F.lit(status))
            for status in ("parsed", "rejected")]
    return both[0].unionByName(both[1]).select(
        "status", "reason", "event_id", "event_time", F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"))


@query
def stream_trending_spikes(t):
    return alerts.trending_spikes(stream_viewer_windows(t))


@query
def stream_poor_sessions(t):
    """The last state of each session that was ever reported."""
    return changed(t, "sessions", alerts.poor_sessions(event_stream(t)), "session_id")


# -- findings -----------------------------------------------------------------

@query
def cost_decile_share(t):
    return findings.cost_decile_share(stored(content_performance(t), "content-performance"))


@query
def cost_spread(t):
    return findings.cost_spread(content_performance(t))


@query
def churn_cohorts(t):
    return findings.churn_cohorts(user_monthly_engagement(t))


@query
def quality_spread(t):
    return findings.quality_spread(t.streaming_quality)


@query
def quality_corr(t):
    return findings.quality_corr(clean_viewing(t), t.streaming_quality)
