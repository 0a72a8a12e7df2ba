import gzip
import json

import pytest
from pyspark.sql import functions as F

from helpers import tuples
from sluice import schemas, session
from sluice.sources import databases, files


def test_landing_csv_and_json(spark, tmp_path):
    profiles = tmp_path / "landing" / "user-profiles"
    profiles.mkdir(parents=True)
    with gzip.open(profiles / "user-profiles.csv.gz", "wt") as out:
        out.write("user_id,plan_type,is_churned\n1,basic,true\n2,,false\n")
    catalog = tmp_path / "landing" / "content-catalog"
    catalog.mkdir()
    with gzip.open(catalog / "content-catalog.json.gz", "wt") as out:
        for i in range(3):
            out.write(json.dumps({"content_id": i, "title": f"t{i}", "imdb_score": 5.5}) + "\n")
    df = files.read_landing(spark, str(tmp_path), "user-profiles")
    assert tuples(df) == [(1, "basic", True), (2, None, False)]
    df = files.read_landing(spark, str(tmp_path), "content-catalog", spread=3)
    assert df.rdd.getNumPartitions() == 3
    assert tuples(df, "content_id", "title", "imdb_score", "release_year") == [
        (i, f"t{i}", 5.5, None) for i in range(3)]


def test_landing_schemas_are_never_guessed(spark, tmp_path):
    """Schemas come from the package, so a read of nothing has all columns."""
    for name, (_, schema) in files.LANDING.items():
        (tmp_path / "landing" / name).mkdir(parents=True)
        df = files.read_landing(spark, str(tmp_path), name)
        assert df.drop(files.UNDECLARED).schema == spark.createDataFrame([], schema).schema
        assert (files.UNDECLARED in df.columns) == (files.LANDING[name][0] == "json")


def test_zone_names():
    assert files.zone_path("/lake/", "curated", "x") == "/lake/curated/x"
    with pytest.raises(ValueError):
        files.zone_path("/lake", "other", "x")


def test_partitioned_table(spark, tmp_path):
    df = spark.range(1000).select(
        "id", F.lit(2024).alias("year"),
        F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 12).cast("int").alias("month"))
    path = str(tmp_path / "t")
    files.write_table(df, path, partition_by=("year", "month"))
    back = files.read_table(spark, path)
    assert tuples(back, *df.columns) == tuples(df)
    plan = back.where("month = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    files.write_table(df.limit(5), path)  # a full refresh leaves nothing of the old state
    assert files.read_table(spark, path).count() == 5


def test_append(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_table(spark.range(3), path)
    files.write_table(spark.range(3, 5), path, mode="append")
    assert tuples(files.read_table(spark, path)) == [(i,) for i in range(5)]


def test_report_has_a_header(spark, frame, tmp_path):
    path = tmp_path / "report"
    files.write_report(frame("a INT, b STRING", (1, "x,y"), (2, None)), str(path))
    files.write_report(frame("a INT, b STRING", (1, "x,y"), (2, None)), str(path))
    texts = [p.read_text() for p in path.glob("*.csv")]
    assert all(t.startswith("a,b\n") for t in texts if t)
    assert tuples(files.read_csv(spark, str(path), "a INT, b STRING")) == [(1, "x,y"), (2, None)]


def test_preview(spark):
    assert files.preview(spark.range(100), 7).count() == 7


def test_parallel_database_scan_options():
    db = databases.Database("jdbc:postgresql://host/sales", "u", "p", scan_tasks=8)
    assert databases.scan_options(db, "orders", "order_id", 1, 1000) == {
        "dbtable": "orders", "partitionColumn": "order_id", "lowerBound": "1",
        "upperBound": "1001", "numPartitions": "8"}


def test_customer_order_options():
    options = databases.customer_order_options("a,b", "shop")
    assert options["keyspace"] == "shop" and options["table"] == "orders_by_customer"


def test_orders_get_the_types_of_the_warehouse(frame):
    df = frame("order_date STRING, order_id BIGINT, customer_id BIGINT, product_id BIGINT, "
               "quantity BIGINT, total_price DOUBLE", ("2026-01-02", 1, 2, 3, 4, 5.678))
    typed = databases.typed_orders(df)
    assert typed.schema == frame(schemas.SALES_ORDERS).schema
    assert str(typed.first()["total_price"]) == "5.68"


def test_shared_folder_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_folder(spark) == named
    assert session.scratch_path(spark, "x").startswith(named)


def test_shared_folder_must_be_named_on_a_cluster():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())
