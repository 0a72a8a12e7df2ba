from pyspark.sql import functions as F

from helpers import tuples
from sluice import schemas
from sluice.functions.cleaning import device_class, event_time
from sluice.functions.numbers import growth, ratio_if_positive, rounded
from sluice.operators.cleaning import clean_interactions, clean_viewing


def viewing(frame, *rows):
    return frame(schemas.VIEWING_HISTORY, *rows)


def test_rows_without_a_key_are_dropped(frame):
    df = viewing(
        frame,
        (None, 1, 1.0, 2.0, 50.0, "tv", None),
        (1, None, 1.0, 2.0, 50.0, "tv", None),
        (1, 1, 1.0, 2.0, 50.0, "tv", None),
    )
    assert clean_viewing(df).count() == 1


def test_watched_is_capped_unless_a_side_is_null(frame):
    df = viewing(
        frame,
        (1, 1, 9.0, 5.0, 50.0, "tv", None),
        (2, 1, 4.0, 5.0, 50.0, "tv", None),
        (3, 1, None, 5.0, 50.0, "tv", None),
        (4, 1, 9.0, None, 50.0, "tv", None),
    )
    assert tuples(clean_viewing(df), "user_id", "duration_watched_min") == [
        (1, 5.0), (2, 4.0), (3, None), (4, 9.0)]


def test_percentage_is_clamped_and_null_stays(frame):
    values = [None, -1.0, 0.0, 50.0, 100.0, 101.0]
    df = viewing(frame, *[(i, 1, 1.0, 2.0, v, "tv", None) for i, v in enumerate(values)])
    got = [r[1] for r in tuples(clean_viewing(df), "user_id", "completion_pct")]
    assert got == [None, 0.0, 0.0, 50.0, 100.0, 100.0]


def test_device_classes_first_match_wins(frame):
    cases = {
        "Smart TV": "TV", "WEB TV": "TV", "iPhone": "Mobile", "headphones": "Mobile",
        "mobile_android": "Mobile", "Tablet": "Tablet", "web": "Web", "DESKTOP": "Web",
        "game_console": "Other", "": "Other",
    }
    df = frame("device STRING", *[(d,) for d in cases], (None,))
    got = dict(df.select("device", device_class(F.col("device"))).collect())
    assert got == {**cases, None: "Other"}


def test_search_text(frame):
    df = frame(schemas.USER_INTERACTIONS,
               (1, 1, "t", None), (2, 1, "t", ""), (3, 1, "t", "  x y "), (4, None, "t", "z"))
    got = tuples(clean_interactions(df), "user_id", "search_query")
    assert got == [(1, "no_search_query"), (2, ""), (3, "x y"), (4, "z")]


def test_unreadable_time_is_null(frame):
    df = frame("t STRING", ("2024-02-29 10:00:00",), ("2024-02-29T10:00:00.5",), ("xx",), (None,))
    got = [r[0] for r in df.select(event_time(F.col("t")).cast("string")).collect()]
    assert got == ["2024-02-29 10:00:00", "2024-02-29 10:00:00.5", None, None]


def test_rounding_is_half_up_and_total(frame):
    values = [1.005, 0.145, 1.025, 1.0249999999999999, -1.005, 1e30, float("nan"), None]
    df = frame("x DOUBLE", *[(v,) for v in values])
    got = [r[0] for r in df.select(rounded(F.col("x"))).collect()]
    assert got[:6] == [1.01, 0.15, 1.03, 1.03, -1.01, 1e30]
    assert got[6] != got[6] and got[7] is None


def test_ratio_and_growth(frame):
    df = frame("a DOUBLE, b DOUBLE", (10.0, 4.0), (10.0, 0.0), (10.0, -1.0), (None, 2.0), (1.0, None))
    assert [r[0] for r in df.select(ratio_if_positive(F.col("a"), F.col("b"))).collect()] == [
        2.5, None, None, None, None]
    assert [r[0] for r in df.select(growth(F.col("a"), F.col("b"))).collect()] == [
        1.5, None, -11.0, None, None]
