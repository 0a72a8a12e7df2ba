import pytest
from pyspark.sql import functions as F

from helpers import tuples
from sluice import schemas
from sluice.operators.checks import dataset_presence, null_rates, open_if_there, rule_violations
from sluice.operators.matching import orphans, repeated_keys, violation_counts
from sluice.plans.quality import QualityGateError, enforce, quality_range, quality_report


def view(frame, *rows):
    return frame(schemas.VIEWING_HISTORY, *rows)


def test_orphans_include_null_keys(frame):
    df = frame("k INT, v STRING", (1, "a"), (2, "b"), (None, "c"), (None, "d"))
    known = frame("k INT", (1,), (1,), (None,))
    assert tuples(orphans(df, known, "k"), "v") == [("b",), ("c",), ("d",)]
    counted = violation_counts(df, {"unknown": ("k", known)}, {"is_b": F.col("v") == "b"})
    assert tuples(counted) == [("is_b", 1), ("unknown", 3)]


def test_counts_of_an_empty_table_are_zero(frame):
    df = frame("k INT")
    counted = violation_counts(df, {"unknown": ("k", df)}, {"rule": F.col("k") > 1})
    assert tuples(counted) == [("rule", 0), ("unknown", 0)]


def test_keys_of_different_columns_do_not_mix(frame):
    df = frame("u INT, c STRING", (1, "x"), (2, "1"))
    counted = violation_counts(
        df, {"u": ("u", frame("u INT", (1,))), "c": ("c", frame("c STRING", ("x",)))})
    assert tuples(counted) == [("c", 1), ("u", 1)]


def test_quality_ranges(frame):
    rows = [(1, "s", "r", "i", 0, 0.1, 0, 0.0), (1, "s", "r", "i", -1, 1.0, 0, 1.0),
            (1, "s", "r", "i", 0, 0.0, 0, 1.0), (1, "s", "r", "i", 0, 1.0, -1, 1.0),
            (1, "s", "r", "i", 0, 1.0, 0, -0.1), (1, "s", "r", "i", None, None, None, None)]
    df = frame(schemas.STREAMING_QUALITY, *rows)
    assert tuples(rule_violations(df, {"q": quality_range()})) == [("q", 4)]


def report(frame, viewing=(), quality=(), interactions=()):
    return quality_report(
        view(frame, (1, 1, 1.0, 2.0, 50.0, "tv", None), *viewing),
        frame(schemas.USER_PROFILES, (1, "basic", False)),
        frame(schemas.CONTENT_CATALOG, (1, "t", 2000, 1.0, 1.0)),
        frame(schemas.STREAMING_QUALITY, (1, "s", "r", "i", 0, 1.0, 0, 1.0), *quality),
        frame(schemas.USER_INTERACTIONS, (1, 1, "t", None), *interactions),
    )


def test_clean_data_passes(frame):
    assert len(enforce(report(frame))) == 5


def test_range_of_viewing_is_only_reported(frame):
    bad = [(1, 1, 9.0, 2.0, 50.0, "tv", None), (1, 1, 1.0, 2.0, -1.0, "tv", None),
           (1, 1, 1.0, 2.0, 101.0, "tv", None), (1, 1, None, None, None, "tv", None)]
    rows = enforce(report(frame, viewing=bad))
    assert (rows[0]["rule"], rows[0]["violations"], rows[0]["passed"]) == ("viewing_range", 3, True)


def test_first_broken_gate_is_raised(frame):
    bad_user = (9, 1, 1.0, 2.0, 50.0, "tv", None)
    bad_title = (1, 9, 1.0, 2.0, 50.0, "tv", None)
    bad_quality = (1, "s", "r", "i", -1, 1.0, 0, 1.0)
    bad_interaction = (None, 1, "t", None)
    cases = [
        ("viewing_unknown_user", dict(viewing=[bad_user, bad_title], quality=[bad_quality])),
        ("viewing_unknown_content", dict(viewing=[bad_title], quality=[bad_quality])),
        ("quality_range", dict(quality=[bad_quality], interactions=[bad_interaction])),
        ("interaction_unknown_user", dict(interactions=[bad_interaction])),
    ]
    for rule, tables in cases:
        with pytest.raises(QualityGateError, match=rule):
            enforce(report(frame, **tables))


def test_null_rates(frame):
    df = frame("a INT, b STRING", (1, None), (None, None), (3, "x"))
    assert tuples(null_rates(df)) == [("a", 1, 3, 0.333333), ("b", 2, 3, 0.666667)]
    assert tuples(null_rates(df.limit(0), ["a"])) == [("a", 0, 0, None)]


def test_presence(spark, frame, tmp_path):
    df = frame("a INT", (1,))
    df.write.parquet(str(tmp_path / "t"))
    tables = {"t": open_if_there(spark, str(tmp_path / "t")),
              "gone": open_if_there(spark, str(tmp_path / "gone")), "empty": df.limit(0)}
    assert tuples(dataset_presence(tables, spark)) == [
        ("empty", 0, False), ("gone", None, False), ("t", 1, True)]


def test_repeated_keys(frame):
    df = frame("k INT", (1,), (1,), (2,), (None,), (None,))
    assert tuples(repeated_keys(df, "k")) == [(None, 2), (1, 2)]
