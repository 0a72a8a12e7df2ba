"""The batch runs: landing data to reports, and operational tables to the star schema.

Each step writes its table, and later steps read that table instead of
computing it again, so a lost executor costs the running step only.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.operators.checks import Measured, open_if_there
from sluice.operators.cleaning import clean_interactions, clean_viewing
from sluice.operators.dedupe import dedupe_first, merge_shards
from sluice.operators.loading import insert_ignore
from sluice.plans import engagement, quality, reports, scoring, warehouse
from sluice.plans.refresh import refresh_copy, refresh_engagement
from sluice.session import discard, list_names, scratch_path
from sluice.sources.files import LANDING, read_named, read_table, write_report, write_table, zone_path


class MissingDataError(RuntimeError):
    """An expected dataset is absent or empty."""


def together(spark: SparkSession, *steps: Callable[[], DataFrame]) -> list[DataFrame]:
    """Run independent writes at the same time, so that one with few tasks leaves no core idle."""
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
        return [step.result() for step in running]


def require(tables: dict[str, DataFrame | None]) -> None:
    """Stop unless every dataset is there and has a row; looks for one row, counts nothing."""
    absent = [name for name, df in tables.items() if df is None or df.isEmpty()]
    if absent:
        raise MissingDataError(", ".join(sorted(absent)))


@dataclass
class Lake:
    """The zones under one root folder."""

    spark: SparkSession
    root: str
    # Tasks among which the rows of a few large gzip files are dealt out.
    spread: int | None = None
    # Declared columns of landing datasets where they differ from the usual ones.
    schemas: dict[str, str] = field(default_factory=dict)
    # Keep viewing rows that agree in all columns after cleaning once.
    distinct_viewing: bool = False
    # Compute and write only the months of the engagement table that changed since the last run.
    by_month: bool = False
    # Row counts, nulls and broken row rules of the landing data, counted while they were staged.
    measured: dict[str, Measured] = field(default_factory=dict, repr=False)
    _staged: dict[str, DataFrame] = field(default_factory=dict, repr=False)
    _scratch: str | None = field(default=None, repr=False)

    def landing(self) -> dict[str, DataFrame]:
        found = {
            name: self._landed(name, fmt, self.schemas.get(name, schema))
            for name, (fmt, schema) in LANDING.items()
        }
        require(found)
        return {n: df.repartition(self.spread) if self.spread else df for n, df in found.items()}

    def _landed(self, name: str, fmt: str, schema: str) -> DataFrame | None:
        path = zone_path(self.root, "landing", name)
        there = open_if_there(self.spark, path, "text")
        return None if there is None or there.isEmpty() else read_named(self.spark, path, fmt, schema)

    def staged(self) -> dict[str, DataFrame]:
        """The landing data as columnar tables of this application.

        Gates and plans read the landing data several times; the compressed text
        is read and parsed for the first time only. Tables that were released are staged anew.
        """
        if len(self._staged) < len(LANDING):
            self._scratch = self._scratch or scratch_path(self.spark, f"landing-{uuid4().hex}")
            rules = quality.row_rules()

            def stage(name: str, df: DataFrame) -> DataFrame:
                declared = StructType.fromDDL(self.schemas.get(name, LANDING[name][1])).names
                self.measured[name] = Measured(df, declared, rules.get(name))
                return self.keep(name, self.measured[name].table, df.schema)

            raw = {name: df for name, df in self.landing().items() if name not in self._staged}
            tables = together(self.spark, *[partial(stage, n, df) for n, df in raw.items()])
            self._staged |= dict(zip(raw, tables, strict=True))
        return dict(self._staged)

    def keep(self, name: str, df: DataFrame, schema: StructType | None = None) -> DataFrame:
        """Write a table that several steps read beside the staged ones; it goes when the lake is released."""
        path = f"{self._scratch}/{name}"
        write_table(df, path)
        return read_table(self.spark, path, schema)

    def release(self, *names: str) -> None:
        """Remove staged tables, by default all that is kept; a later run stages them anew."""
        if self._scratch:
            for name in names or [""]:
                discard(self.spark, f"{self._scratch}/{name}".rstrip("/"))
        if names:
            self._staged = {name: df for name, df in self._staged.items() if name not in names}
        else:
            self._staged, self._scratch = {}, None

    def store(self, zone: str, dataset: str, df: DataFrame,
              partition_by: tuple[str, ...] = ()) -> DataFrame:
        path = zone_path(self.root, zone, dataset)
        write_table(df, path, partition_by)
        return read_table(self.spark, path)

    def table(self, zone: str, dataset: str) -> DataFrame:
        return read_table(self.spark, zone_path(self.root, zone, dataset))


def gate(lake: Lake) -> list:
    staged = lake.staged()
    return quality.enforce(quality.measured_report(lake.measured, staged))


def transform(lake: Lake) -> None:
    """Curated and analytics tables from the landing data.

    Tables that shuffle whole sessions are made one after another, and staged tables go as soon as
    nothing reads them any more, so that the disk holds the shuffles of one of them at a time.
    """
    raw = lake.staged()
    users, catalog = raw["user-profiles"], raw["content-catalog"]
    delivery = raw["streaming-quality"]
    viewing, interactions, by_user, _ = together(
        lake.spark,
        partial(lake.store, "curated", "viewing-history", clean_viewing(raw["viewing-history"], distinct=lake.distinct_viewing)),
        partial(lake.store, "curated", "user-interactions",
                clean_interactions(raw["user-interactions"])),
        partial(lake.keep, "quality-by-user", engagement.quality_by_user(delivery)),
        partial(lake.store, "analytics", "streaming-quality-region-isp",
                engagement.quality_by_region_isp(delivery)),
    )
    lake.release("viewing-history", "user-interactions")
    if lake.by_month:
        refresh_engagement(lake.spark, zone_path(lake.root, "analytics", "user-monthly-engagement"),
                           viewing, users, delivery, interactions, by_user)
    lake.release("streaming-quality")
    if not lake.by_month:
        lake.store("analytics", "user-monthly-engagement",
                   engagement.user_monthly_engagement(viewing, users, delivery, interactions, by_user),
                   partition_by=("year", "month"))
    lake.store("analytics", "content-performance", engagement.content_performance(viewing, catalog))
    lake.store("curated", "enriched-viewing-sessions",
               engagement.enrich_sessions(viewing, catalog, users, delivery, by_user))


CURATED = ("viewing-history", "user-interactions", "enriched-viewing-sessions")
ANALYTICS = ("user-monthly-engagement", "content-performance", "streaming-quality-region-isp")


def check_outputs(lake: Lake) -> None:
    expected = [("curated", n) for n in CURATED] + [("analytics", n) for n in ANALYTICS]
    require({
        f"{zone}/{name}": open_if_there(lake.spark, zone_path(lake.root, zone, name))
        for zone, name in expected
    })


def score(lake: Lake) -> DataFrame:
    return lake.store("analytics", "churn-risk",
                      scoring.churn_risk(lake.table("analytics", "user-monthly-engagement")))


def export(lake: Lake) -> None:
    """The daily reports: three CSV extracts and a copy of the engagement table."""
    def path(name: str) -> str:
        return zone_path(lake.root, "analytics", f"reports/{name}")

    together(
        lake.spark,
        partial(write_report, reports.high_risk_users(lake.table("analytics", "churn-risk")),
                path("high-risk-users")),
        partial(write_report, reports.top_content(lake.table("analytics", "content-performance")),
                path("top-content")),
        partial(write_report, reports.worst_quality(lake.table("analytics", "streaming-quality-region-isp")),
                path("worst-quality-region-isp")),
        partial(refresh_copy, lake.spark, zone_path(lake.root, "analytics", "user-monthly-engagement"),
                path("daily-user-engagement")) if lake.by_month else
        partial(write_table, lake.table("analytics", "user-monthly-engagement"),
                path("daily-user-engagement"), partition_by=("year", "month"), gathered=True),
    )


def run_lake(lake: Lake) -> None:
    """Landing data through gates, zones, scores and reports."""
    try:
        gate(lake)
        transform(lake)
    finally:
        lake.release()
    check_outputs(lake)
    score(lake)
    export(lake)


@dataclass(frozen=True)
class Shard:
    """The tables of one sales database. Orders may be kept elsewhere, in the order log."""

    customers: DataFrame
    products: DataFrame
    orders: DataFrame | None = None


def shard_orders(shards: dict[str, Shard], order_log: DataFrame | None = None) -> DataFrame:
    """Orders of all shards, then those of the order log; ``shard_order`` says who comes first.

    An id that several hold is loaded from the first that has it. The log may hold an order more
    than once; its first row counts. Orders without id are all kept.
    """
    sources = {name: shard.orders for name, shard in shards.items() if shard.orders is not None}
    if order_log is not None:
        sources["order log"] = dedupe_first(order_log, "order_id", ["order_date"])
    return merge_shards(sources)


@dataclass
class Warehouse:
    """Star schema under one root folder; every load writes folders of its own.

    Dimensions are dealt over buckets by natural key; a load writes those buckets that it has
    keys of, as ``<table>/load=<n>/bucket=<b>``, and the table is the latest folder of each
    bucket. Dates and facts only grow, so a load adds what is new and all its folders together
    are the table. A load that is run again replaces its own folders and nothing else.
    """

    spark: SparkSession
    root: str
    # Folders of a dimension; the rows of one should be a few files. Fixed for a warehouse.
    buckets: int = 64

    def whole(self, table: str, load: int, buckets: list[int] | None = None) -> DataFrame | None:
        """A dimension, or some buckets of it, after ``load``; None if there are no rows.

        It is an error if that load was never run. Only folders are listed to find the latest
        version of each bucket.
        """
        if not load:
            return None
        place = f"{self.root}/{table}"
        if f"load={load}" not in list_names(self.spark, place):
            raise MissingDataError(f"{table} of load {load}")
        latest: dict[str, int] = {}
        for n in range(1, load + 1):
            latest |= dict.fromkeys((name for name in list_names(self.spark, f"{place}/load={n}")
                                     if name.startswith("bucket=")), n)
        wanted = None if buckets is None else {f"bucket={b}" for b in buckets}
        paths = [f"{place}/load={n}/{name}" for name, n in latest.items() if wanted is None or name in wanted]
        return self.spark.read.parquet(*paths) if paths else None

    def upsert(self, table: str, load: int, incoming: DataFrame) -> DataFrame:
        """Write the buckets of a dimension that a batch touches; the whole dimension after it."""
        rows = warehouse.DIMENSIONS[table].upsert_buckets(
            partial(self.whole, table, load - 1), incoming, self.buckets)
        path = f"{self.root}/{table}/load={load}"
        write_table(rows, path, partition_by=("bucket",))
        found = self.whole(table, load)
        return rows.drop("bucket").limit(0) if found is None else found

    def grown(self, table: str, load: int) -> DataFrame | None:
        """Rows that loads up to ``load`` have added."""
        if not load:
            return None
        return read_table(self.spark, f"{self.root}/{table}").where(F.col("load") <= load).drop(
            "load")

    def save(self, table: str, load: int, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{table}/load={load}"
        write_table(df, path)
        return read_table(self.spark, path)

    def load_shards(self, load: int, shards: dict[str, Shard], employees: DataFrame,
                    departments: DataFrame, days: DataFrame,
                    order_log: DataFrame | None = None) -> DataFrame:
        """Run load ``load`` from the shards, the staff tables and, if given, the order log.

        Customers of all shards are merged, the last shard's row counting. The product table is
        the same on all shards; the first shard's copy is taken.
        """
        customers = merge_shards({name: shard.customers for name, shard in shards.items()})
        products = next(iter(shards.values())).products
        return self.load(load, customers, products, employees, departments,
                         shard_orders(shards, order_log), days)

    def load(self, load: int, customers: DataFrame, products: DataFrame, employees: DataFrame,
             departments: DataFrame, orders: DataFrame, days: DataFrame) -> DataFrame:
        """Run load number ``load`` (1, 2, ...), dimensions first; returns its audit row."""
        before = load - 1
        if open_if_there(self.spark, f"{self.root}/fact_sales/load={load + 1}") is not None:
            raise ValueError(f"load {load} can't be run again: load {load + 1} builds on it")
        dim_customer, dim_product, *_ = together(
            self.spark,
            partial(self.upsert, "dim_customer", load, warehouse.customer_rows(customers)),
            partial(self.upsert, "dim_product", load, warehouse.product_rows(products)),
            partial(self.upsert, "dim_employee", load, warehouse.denormalize_employees(employees, departments)),
            partial(self.save, "dim_date", load, insert_ignore(
                self.grown("dim_date", before), warehouse.dim_date(days), "date_key")),
        )
        existing = self.grown("fact_sales", before)
        # Looked up once for facts and audit; the next load writes its own over it.
        lookup = f"{self.root}/order_lookup"
        write_table(warehouse.looked_up(orders, dim_customer, dim_product), lookup)
        found = read_table(self.spark, lookup)
        added = self.save("fact_sales", load, warehouse.facts_of(found, existing))
        return self.save("load_audit", load, warehouse.audit_of(found, existing, added))
