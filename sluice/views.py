"""The domain tables seen in the test tables.

Each view is a list of ``name: expression`` over joined base tables. The
expressions are valid in Spark SQL and in ANSI SQL engines alike, so a checking
engine can be given the same inputs; ``view_sql`` spells a view out as SQL.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import stored
from sluice.sources.files import as_json_lines


@dataclass(frozen=True)
class View:
    base: str
    columns: dict[str, str]
    # joined table -> (left key, right key)
    joins: dict[str, tuple[str, str]] = field(default_factory=dict)


_ORDER = {"orders": ("l_orderkey", "o_orderkey")}
# What the views need of a line and its order.
LINE_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                "l_discount", "l_shipdate", "o_custkey", "o_orderdate")

VIEWS = {
    "viewing_history": View(
        "lineitem",
        {
            "user_id": "o_custkey",
            "content_id": "l_partkey",
            "duration_watched_min": "l_quantity * 10",
            "total_duration_min": "cast(p_size * 10 as double)",
            "completion_pct": "cast(100 as double) * l_quantity / p_size - 10",
            "device": "case l_linenumber when 1 then 'Smart TV' when 2 then 'iPhone' "
                      "when 3 then 'mobile_android' when 4 then 'Tablet' when 5 then 'web' "
                      "when 6 then 'Desktop' else 'console' end",
            "start_time": "l_shipdate",
        },
        {**_ORDER, "part": ("l_partkey", "p_partkey")},
    ),
    "content_catalog": View("part", {
        "content_id": "p_partkey",
        "title": "p_name",
        "release_year": "1970 + p_size",
        "imdb_score": "cast(p_size as double) / 5",
        "license_cost_monthly": "p_retailprice",
    }),
    "user_profiles": View("customer", {
        "user_id": "c_custkey",
        "plan_type": "c_mktsegment",
        "is_churned": "c_acctbal < 0",
    }),
    "user_interactions": View(
        "lineitem",
        {
            "user_id": "o_custkey",
            "content_id": "case when l_linenumber = 7 then null else l_partkey end",
            "timestamp": "cast(o_orderdate as string)",
            "search_query": "case when l_linenumber = 7 then '  padded query ' "
                            "when l_linenumber = 6 then '' else null end",
        },
        _ORDER,
    ),
    "streaming_quality": View(
        "lineitem",
        {
            "user_id": "o_custkey",
            "session_id": "cast(l_orderkey as string)",
            "cdn_region": "r_name",
            "isp": "s_name",
            "buffering_events": "case when l_linenumber > 3 then l_linenumber - 3 else 0 end",
            "avg_bitrate_mbps": "l_extendedprice / 10000",
            "resolution_changes": "l_linenumber - 1",
            "latency_ms": "l_discount * 1000 - 10",
        },
        {
            **_ORDER,
            "supplier": ("l_suppkey", "s_suppkey"),
            "nation": ("s_nationkey", "n_nationkey"),
            "region": ("n_regionkey", "r_regionkey"),
        },
    ),
    "customers": View(
        "customer",
        {
            "customer_id": "c_custkey",
            "first_name": "split_part(c_name, '#', 1)",
            "last_name": "split_part(c_name, '#', 2)",
            "email": "concat(c_name, '@example.com')",
            "city": "n_name",
            "state": "n_name",
            "shard": "case when n_regionkey in (0, 1) then 'SE' else 'NE' end",
        },
        {"nation": ("c_nationkey", "n_nationkey")},
    ),
    "products": View("part", {
        "product_id": "p_partkey",
        "product_name": "p_name",
        "category": "p_type",
        "unit_price": "cast(p_retailprice as decimal(12,2))",
    }),
    "sales_orders": View(
        "lineitem",
        {
            "order_id": "l_orderkey * 10 + l_linenumber",
            "customer_id": "o_custkey",
            "product_id": "l_partkey",
            "quantity": "cast(l_quantity as int)",
            "total_price": "cast(l_extendedprice as decimal(12,2))",
            "order_date": "cast(o_orderdate as date)",
        },
        _ORDER,
    ),
    "employees": View("supplier", {
        "employee_id": "s_suppkey",
        "first_name": "split_part(s_name, '#', 1)",
        "last_name": "split_part(s_name, '#', 2)",
        "email": "concat(s_name, '@example.com')",
        "job_title": "case when s_acctbal < 0 then 'Analyst' else 'Manager' end",
        "department_id": "s_nationkey",
    }),
    "departments": View(
        "nation",
        {
            "department_id": "n_nationkey",
            "department_name": "n_name",
            "location": "r_name",
        },
        {"region": ("n_regionkey", "r_regionkey")},
    ),
}


class TestTables:
    """Base tables of one folder and the domain tables over them."""

    __test__ = False

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}
        self._lines: DataFrame | None = None
        self._kept: dict[str, DataFrame] = {}

    def keep_lines(self) -> None:
        """Put lines and orders together once; the views over both read that table from here on."""
        if self._lines is None:
            left, right = _ORDER["orders"]
            both = self.base("lineitem").join(self.base("orders"), F.col(left) == F.col(right))
            self._lines = stored(both.select(*LINE_COLUMNS), "lines")

    def keep(self, *views: str) -> None:
        """Write views once that a plan reads more than once; they are read from there from here on."""
        for name in views:
            if name not in self._kept:
                self._kept[name] = stored(getattr(self, name), name)

    def base(self, table: str) -> DataFrame:
        # One reader per table: each reader looks the schema up in the files.
        if table not in self._tables:
            self._tables[table] = self.spark.read.parquet(f"{self.folder}/{table}.parquet")
        return self._tables[table]

    def __getattr__(self, name: str) -> DataFrame:
        if name not in VIEWS:
            raise AttributeError(name)
        if name in self._kept:
            return self._kept[name]
        view, joins = VIEWS[name], dict(VIEWS[name].joins)
        df = self.base(view.base)
        if self._lines is not None and view.base == "lineitem" and joins.pop("orders", None):
            df = self._lines
        for table, (left, right) in joins.items():
            df = df.join(self.base(table), F.col(left) == F.col(right))
        return df.select(*[F.expr(e).alias(c) for c, e in view.columns.items()])

    def shard(self, name: str) -> DataFrame:
        """Customers of one sales shard, as that shard's own table."""
        return self.customers.where(F.col("shard") == name).drop("shard")

    def messages(self, events: DataFrame | None = None) -> DataFrame:
        """The events as binary (key, value) messages with a JSON value."""
        return as_json_lines(activity_fields(
            self.base("events") if events is None else events
        ), "session_id")


def activity_fields(events: DataFrame) -> DataFrame:
    number = F.get_json_object("props", "$.k").cast("int") % 2
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.concat_ws("-", F.col("user_id").cast("string"), F.col("ts").cast("date").cast("string"))
        .alias("session_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_ts"),
        F.when(F.col("event_type").isin("view", "click", "purchase"), "play")
        .when(F.col("event_type") == "error", "buffering")
        .otherwise("pause").alias("action"),
        number.cast("string").alias("content_id"),
        F.concat(F.lit("title "), number.cast("string")).alias("title"),
        F.lit("smart_tv").alias("device"),
    )


def view_sql(name: str) -> str:
    view = VIEWS[name]
    columns = ", ".join(f'{e} AS "{c}"' for c, e in view.columns.items())
    joins = " ".join(f"JOIN {t} ON {left} = {right}" for t, (left, right) in view.joins.items())
    return f"SELECT {columns} FROM {view.base} {joins}".strip()
