"""Landing files are read by column name; other faults that the test tables don't show."""

import pytest
from pyspark.sql import functions as F

from helpers import tuples
from sluice.operators.matching import orphans, violation_counts
from sluice.plans import findings, scoring
from sluice.plans.batch import MissingDataError, Warehouse
from sluice.sources import files
from sluice.streaming import alerts


def _landing(tmp_path, dataset, name, text):
    folder = tmp_path / "landing" / dataset
    folder.mkdir(parents=True)
    (folder / name).write_text(text)


def test_csv_by_name_with_other_columns_and_a_bad_value(spark, tmp_path):
    _landing(tmp_path, "user-profiles", "a.csv",
             "country,plan_type,user_id,is_churned\nUS,basic,1,true\nDE,,x2,false\n")
    df = files.read_landing(spark, str(tmp_path), "user-profiles")
    assert df.columns == ["user_id", "plan_type", "is_churned", "country"]
    assert tuples(df) == [(None, None, False, "DE"), (1, "basic", True, "US")]
    fmt, schema = files.LANDING["user-profiles"]
    counted = files.uncast(df, str(tmp_path / "landing/user-profiles"), fmt, schema).first()
    assert counted["user_id"] == 1 and counted["is_churned"] == 0
    as_text = files.read_landing(spark, str(tmp_path), "user-profiles",
                                 schema="user_id STRING, plan_type STRING, is_churned BOOLEAN")
    assert {r["user_id"] for r in as_text.collect()} == {"1", "x2"}


def test_missing_column_is_an_error(spark, tmp_path):
    _landing(tmp_path, "user-profiles", "a.csv", "user_id,plan_type\n1,basic\n")
    with pytest.raises(ValueError, match="is_churned"):
        files.read_landing(spark, str(tmp_path), "user-profiles")


def test_json_keeps_other_fields(spark, tmp_path):
    _landing(tmp_path, "user-interactions", "a.json", "\n".join([
        '{"user_id": 1, "content_id": 5, "timestamp": "t", "interaction_type": "like", "at": {"x": [1, null]}}',
        '{"user_id": "2", "content_id": "n/a", "search_query": 7.50}',
        '{"user_id": 1.5, "content_id": null, "search_query": "é \\"q\\""}', "", "broken {", "[3]",
        '{"user_id": 4, "user_id": 5}']))
    path = str(tmp_path / "landing/user-interactions")
    df = files.read_landing(spark, str(tmp_path), "user-interactions")
    declared = ["user_id", "content_id", "timestamp", "search_query"]
    assert df.columns == [*declared, files.UNDECLARED]
    rest = F.col(files.UNDECLARED)
    got = tuples(df.select(*declared, F.variant_get(rest, "$.interaction_type", "string").alias("kind"),
                           F.to_json(rest).alias("rest")))
    assert got == [
        (None, None, None, None, None, '"[3]"'), (None, None, None, None, None, '"broken {"'),
        (None, None, None, None, None, '"{\\"user_id\\": 4, \\"user_id\\": 5}"'),
        (None, None, None, 'é "q"', None, None), (1, 5, "t", None, "like", '{"at":{"x":[1,null]},"interaction_type":"like"}'),
        (2, None, None, "7.5", None, None)]
    counted = files.uncast(df, path, *files.LANDING["user-interactions"]).first()
    assert (counted["user_id"], counted["content_id"]) == (1, 1)
    df.write.parquet(str(tmp_path / "kept"))  # the variant can be stored
    assert spark.read.parquet(str(tmp_path / "kept")).where(F.variant_get(rest, "$.at.x[0]", "int") == 1).count() == 1


def test_json_is_read_in_one_pass(spark, tmp_path):
    _landing(tmp_path, "user-interactions", "a.json", '{"user_id": 1}\n')
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("reading", "no job before the read itself")
    try:
        df = files.read_landing(spark, str(tmp_path), "user-interactions")
        assert list(jobs.getJobIdsForGroup("reading")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("parseJson") == 1


def test_json_folder_without_files(spark, tmp_path):
    (tmp_path / "landing" / "user-interactions").mkdir(parents=True)
    assert files.read_landing(spark, str(tmp_path), "user-interactions").count() == 0


def test_loads_refuse_missing_and_later_loads(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    with pytest.raises(MissingDataError):
        wh.whole("dim_customer", 1)
    spark.range(1).write.parquet(str(tmp_path / "fact_sales" / "load=2"))
    with pytest.raises(ValueError, match="load 2"):
        wh.load(1, None, None, None, None, None, None)


def test_adjacent_spikes_of_a_renamed_title(frame):
    at = "TIMESTAMP '2025-01-01 00:{}:00'"
    rows = [(t, n, a, b) for t, n, a, b in [("old", 1, "00", "15"), ("old", 4, "15", "30"), ("new", 9, "15", "30")]]
    windows = frame("content_id STRING, title STRING, viewer_count LONG", *[("c", t, n) for t, n, _, _ in rows])
    when = F.when(F.col("viewer_count") == 1, F.expr(at.format("00"))).otherwise(F.expr(at.format("15")))
    windows = windows.withColumn("window_start", when).withColumn("window_end", when + F.expr("INTERVAL 15 minutes"))
    found = alerts.trending_spikes(windows, mode="adjacent")
    assert tuples(found, "title", "viewer_count", "previous_viewer_count") == [("old", 4, 1)]


def test_keys_of_different_types(frame):
    doubles = frame("k DOUBLE, v STRING", (1.0, "a"), (2.0, "b"), (3.5, "c"), (None, "d"))
    known = frame("k LONG", (1,), (2,))
    assert tuples(violation_counts(doubles, {"unknown": ("k", known)})) == [("unknown", 2)]
    assert tuples(orphans(doubles, known, "k"), "v") == [("c",), ("d",)]
    exact = doubles.withColumn("k", F.col("k").cast("decimal(10,2)"))
    finer = known.withColumn("k", F.col("k").cast("decimal(20,4)"))
    for table in (known, finer, known.withColumn("k", F.col("k").cast("int"))):
        assert tuples(violation_counts(exact, {"unknown": ("k", table)})) == [("unknown", 2)]


def test_parameters_keep_their_digits(frame):
    row = frame("total_watch_hours DOUBLE, avg_completion_pct DOUBLE, avg_buffering_events DOUBLE, "
                "interaction_count LONG", (1.0, 1.0, 5.0, 0))
    scored = scoring.churn_risk(row, weights=(0.125, 0.125, 0.125, 0.125)).first()
    assert scored["churn_risk_score"] == 0.5
    titles = frame("cost_per_viewing_hour DOUBLE, license_cost_monthly DOUBLE",
                   *[(float(i), 1.0) for i in range(1000)])
    assert findings.cost_decile_share(titles, share=0.005).first()["worst_titles"] == 5


def test_fields_of_a_json_line_are_taken_apart_once(spark, tmp_path):
    _landing(tmp_path, "content-catalog", "a.json", '{"content_id": 1, "extra": 2}\nno object\n')
    df = files.read_landing(spark, str(tmp_path), "content-catalog")
    assert tuples(df.select("content_id", F.to_json(files.UNDECLARED))) == [(None, '"no object"'), (1, '{"extra":2}')]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("as map<string,variant>") == 1
