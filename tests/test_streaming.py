"""The activity plans on batches and on streams of message files."""

import json

import pytest
from pyspark.sql import functions as F

from helpers import tuples
from sluice import schemas
from sluice.session import discard, list_names, scratch_path
from sluice.sources.activity_log import kafka_options, read_message_files
from sluice.sources.files import as_json_lines
from sluice.streaming import activity, alerts, lateness, sinks, spikes

FIELDS = ["event_id", "user_id", "session_id", "event_ts", "action", "content_id", "title", "device"]


def event(time, action="play", user="u", session="s", content="c", title="t", number=0):
    day_time = time if "T" in time else f"2026-01-01T{time}"
    return json.dumps(dict(zip(FIELDS, [
        f"e{number}", user, session, day_time, action, content, title, "mobile"])))


class Log:
    """A folder of message files that grows file by file."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, str(path / "messages")
        self.stores = str(path / "stores")

    def add(self, *values):
        rows = [(b"k", v.encode()) for v in values]
        frame = self.spark.createDataFrame(rows, schemas.RAW_MESSAGE)
        frame.coalesce(1).write.mode("append").parquet(self.path)

    def batch(self):
        return activity.parse_activity(self.spark.read.schema(schemas.RAW_MESSAGE).parquet(self.path))

    def stream(self):
        return activity.parse_activity(read_message_files(self.spark, self.path, 1))

    def run(self, name, sink, plan):
        """Run ``plan`` over what is new since the last run; the path of its output."""
        base = f"{self.stores}/{name}"
        sinks.finish(sink(plan(self.stream()), f"{base}/data", f"{base}/checkpoint"))
        return f"{base}/data"


@pytest.fixture
def log(spark, tmp_path):
    return Log(spark, tmp_path)


def clock(df, *columns):
    """Timestamps as hh:mm text, so that rows are easy to compare."""
    return tuples(df.select(*[
        F.date_format(c, "HH:mm").alias(c) if c.startswith("window_") else c for c in columns]))


def test_decode(log, spark):
    log.add(event("10:00:00.123456"), "no json", '{"user_id": "u2"}', event("not a time", number=1))
    rows = {r["event_id"]: r for r in log.batch().collect() if r["event_id"]}
    assert str(rows["e0"]["event_time"]) == "2026-01-01 10:00:00.123456"
    assert rows["e1"]["event_time"] is None and rows["e1"]["action"] == "play"
    raw = spark.read.parquet(log.path)
    assert tuples(activity.decode_report(raw)) == [(4, 1, 3)]
    assert log.batch().columns == [*FIELDS, "event_time"]
    assert log.batch().where("event_id IS NULL").count() == 2


def test_message_without_value(spark, frame):
    raw = frame(schemas.RAW_MESSAGE, (None, None), (b"k", event("10:00:00").encode()))
    assert activity.parse_activity(raw).count() == 2
    assert tuples(activity.decode_report(raw)) == [(2, 1, 1)]


def test_a_message_is_parsed_once(log):
    log.add(event("10:00:00"))
    plan = alerts.viewer_windows(log.batch())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_encode_and_decode_are_inverse(frame):
    df = frame(schemas.ACTIVITY, ("1", "u", "s", "2026-01-01T10:00:00", "play", "c", 'a "t"', None))
    back = activity.parse_activity(as_json_lines(df, "session_id")).drop("event_time")
    assert tuples(back) == tuples(df)
    assert as_json_lines(df, "session_id").first()["key"] == b"s"


def test_sliding_count(log):
    log.add(
        event("10:05:00"),                  # on an edge: in the windows 10:01 ... 10:05
        event("10:05:59", user=None),       # no user: its windows exist but count nothing more
        event("10:05:30", action="pause"),
        event("bad time"),
    )
    got = clock(alerts.concurrent_viewers(log.batch()),
                "window_start", "window_end", "concurrent_viewers")
    assert got == [(f"10:0{m}", f"10:{m + 5:02d}", 1) for m in range(1, 6)]


def test_windows_by_title(log):
    log.add(event("10:00:00"), event("10:14:59"), event("10:15:00"), event("10:01:00", title="new"))
    got = clock(alerts.viewer_windows(log.batch()), "window_start", "title", "viewer_count")
    assert got == [("10:00", "new", 1), ("10:00", "t", 2), ("10:15", "t", 1)]


def test_poor_sessions_need_more_than_three(log):
    log.add(*[event("10:00:00", "buffering", session="three")] * 3,
            *[event("10:00:00", "buffering", session="four")] * 4,
            *[event("10:00:00", session="none")] * 9)
    assert tuples(alerts.poor_sessions(log.batch())) == [("four", 4)]
    assert tuples(alerts.poor_sessions(log.batch(), threshold=2)) == [("four", 4), ("three", 3)]


SPIKES = [
    ("a", ["10:00:00"] * 1 + ["10:15:00"] * 3),                        # ratio 2.0: no alert
    ("b", ["10:00:00"] * 1 + ["10:15:00"] * 4),                        # ratio 3.0: alert
    ("c", ["10:00:00"] * 1 + ["11:15:00"] * 5),                        # alert after a gap
    ("d", ["10:00:00"] * 9),                                           # first window
    ("e", ["10:00:00"] * 4 + ["10:15:00"] * 1 + ["10:30:00"] * 4),     # down, then up
]


def add_spikes(log):
    log.add(*[event(t, content=c, title=c) for c, times in SPIKES for t in times])


def test_spikes_against_the_last_window_seen(log):
    add_spikes(log)
    got = clock(alerts.trending_spikes(alerts.viewer_windows(log.batch())),
                "content_id", "window_start", "viewer_count", "previous_viewer_count", "growth_ratio")
    assert got == [("b", "10:15", 4, 1, 3.0), ("c", "11:15", 5, 1, 4.0), ("e", "10:30", 4, 1, 3.0)]


def test_spikes_against_the_adjacent_window(log):
    add_spikes(log)
    columns = ("content_id", "window_start", "viewer_count", "previous_viewer_count", "growth_ratio")
    by_table = clock(
        alerts.trending_spikes(alerts.viewer_windows(log.batch()), mode="adjacent"), *columns)
    assert by_table == [("b", "10:15", 4, 1, 3.0), ("e", "10:30", 4, 1, 3.0)]
    assert clock(alerts.adjacent_spikes(log.batch()), *columns) == by_table


def test_a_window_without_users_is_no_base(log):
    log.add(event("10:00:00", user=None), *[event("10:15:00")] * 4)
    windows = alerts.viewer_windows(log.batch())
    assert sorted(r["viewer_count"] for r in windows.collect()) == [0, 4]
    assert alerts.trending_spikes(windows).count() == 0


def test_growth_of_a_retitled_item_compares_with_the_row_before(log):
    log.add(event("10:00:00", title="old"), event("10:15:00", title="new"),
            *[event("10:15:00", title="old")] * 6)
    got = clock(alerts.viewer_growth(alerts.viewer_windows(log.batch())),
                "window_start", "title", "viewer_count", "previous_viewer_count")
    assert got == [("10:00", "old", 1, None), ("10:15", "new", 1, 1), ("10:15", "old", 6, 1)]


def test_unknown_mode(log):
    add_spikes(log)
    with pytest.raises(ValueError):
        alerts.viewer_growth(alerts.viewer_windows(log.batch()), mode="other")


def test_freshness(log):
    log.add(event("10:00:00"), event("10:00:30"), event("10:01:00", "pause"))
    as_of = F.lit("2026-01-01 10:02:00").cast("timestamp")
    got = activity.stream_freshness(log.batch(), as_of).drop("newest_event")
    assert tuples(got) == [("pause", 1, 60), ("play", 2, 90)]


# -- as streams ---------------------------------------------------------------

def test_pass_through_stream_equals_batch(log, spark):
    log.add(event("10:00:00"), event("10:01:00", number=1))
    path = log.run("preview", sinks.to_table, lambda ev: ev)
    assert tuples(spark.read.parquet(path)) == tuples(log.batch())


def test_window_table_survives_a_restart(log, spark):
    log.add(event("10:00:00"), event("10:16:00"))
    path = log.run("windows", sinks.to_snapshot, alerts.viewer_windows)
    assert clock(sinks.read_snapshot(spark, path), "window_start", "viewer_count") == [
        ("10:00", 1), ("10:15", 1)]
    log.add(event("10:17:00"), event("10:01:00"))
    log.run("windows", sinks.to_snapshot, alerts.viewer_windows)
    again = sinks.read_snapshot(spark, path)
    assert clock(again, "window_start", "viewer_count") == [("10:00", 2), ("10:15", 2)]
    assert tuples(again) == tuples(alerts.viewer_windows(log.batch()))


def test_spikes_over_a_stored_window_table(log, spark):
    add_spikes(log)
    path = log.run("windows", sinks.to_snapshot, alerts.viewer_windows)
    got = alerts.trending_spikes(sinks.read_snapshot(spark, path))
    assert tuples(got) == tuples(alerts.trending_spikes(alerts.viewer_windows(log.batch())))


def test_a_reader_always_sees_one_whole_snapshot(log, spark):
    """A reader that began before a batch goes on with its version; only older ones are removed."""
    readers = []
    for k in range(4):
        log.add(event(f"10:{15 * k:02d}:00"))
        path = log.run("windows", sinks.to_snapshot, alerts.viewer_windows)
        readers.append(sinks.read_snapshot(spark, path))
        assert readers[-1].count() == k + 1
        assert readers[k - 1].count() == (k if k else 1)  # the version before is still there
    versions = [n for n in list_names(spark, path) if n.startswith("version-")]
    assert len(versions) == 2


def take_back_last_commit(log, name):
    """As if the driver had died before its last commit: the batch runs again."""
    commits = f"{log.stores}/{name}/checkpoint/commits"
    last = max(int(n) for n in list_names(log.spark, commits) if n.isdigit())
    discard(log.spark, f"{commits}/{last}")


def test_a_repeated_batch_leaves_the_snapshot_as_it_is(log, spark, monkeypatch):
    log.add(event("10:00:00"))
    path = log.run("windows", sinks.to_snapshot, alerts.viewer_windows)
    before = sinks.read_snapshot(spark, path)
    take_back_last_commit(log, "windows")
    log.run("windows", sinks.to_snapshot, alerts.viewer_windows)
    assert tuples(sinks.read_snapshot(spark, path)) == tuples(before)
    assert len([n for n in list_names(spark, path) if n.startswith("version-")]) == 2
    with pytest.raises(FileNotFoundError):
        sinks.read_snapshot(spark, f"{path}-other")


def test_a_failed_batch_keeps_the_snapshot_before(log, spark, monkeypatch):
    log.add(event("10:00:00"))
    path = log.run("windows", sinks.to_snapshot, alerts.viewer_windows)
    log.add(event("10:15:00"))

    def fails(*_):
        raise RuntimeError("no pointer")

    with monkeypatch.context() as patched:
        patched.setattr(sinks, "replace_text", fails)
        with pytest.raises(Exception, match="no pointer"):
            log.run("windows", sinks.to_snapshot, alerts.viewer_windows)
    assert sinks.read_snapshot(spark, path).count() == 1  # the new version was written, but not published
    log.run("windows", sinks.to_snapshot, alerts.viewer_windows)
    assert sinks.read_snapshot(spark, path).count() == 2


def test_gap_sessions_end_and_their_state_goes(log, spark):
    def plan(events):
        return alerts.poor_gap_sessions(events, gap="10 minutes", late="5 minutes")

    def state_rows(name):
        with lateness.ProgressLog(spark, f"{log.stores}/progress-{name}") as seen:
            path = log.run("gaps", lambda *a: seen.watch(sinks.to_table(*a)), plan)
        return path, seen.table().orderBy(F.desc("batch")).first()["state_rows"]

    log.add(*[event(f"10:0{m}:00", "buffering", session="long") for m in range(5)],
            *[event("10:01:00", "buffering", session="short")] * 3)
    path, rows = state_rows("one")
    assert rows == 2 and spark.read.parquet(path).count() == 0
    # "long" comes back after its gap: a session of its own; all sessions of before are over.
    log.add(event("10:30:00", "buffering", session="long"), event("10:31:00", session="other"))
    path, rows = state_rows("two")
    got = spark.read.parquet(path)
    assert clock(got, "session_id", "buffering_count", "events") == [("long", 5, 5)] and rows == 2
    assert str(got.first()["session_end"]) == "2026-01-01 10:14:00"
    # Later events close the rest; their own window is never a session, as they have none to count.
    log.add(event("12:00:00", session=None))
    _, rows = state_rows("three")
    assert rows == 1
    assert tuples(spark.read.parquet(path), "session_id", "buffering_count") == [("long", 5)]
    batch = alerts.gap_sessions(log.batch().where("session_id IS NOT NULL"), gap="10 minutes")
    assert tuples(batch, "session_id", "buffering_count", "events") == [
        ("long", 1, 1), ("long", 5, 5), ("other", 0, 1), ("short", 3, 3)]


def spike_rows(df):
    return clock(df, "content_id", "window_start", "viewer_count", "previous_viewer_count")


def test_last_seen_spikes_in_a_stream(log, spark):
    """The state carries the last window over batches; results are those of the stored table."""
    by_time = sorted((t, c) for c, times in SPIKES for t in times)
    for part in ([x for x in by_time if x[0] < "10:15"], [x for x in by_time if "10:15" <= x[0] < "10:30"],
                 [x for x in by_time if x[0] >= "10:30"], [("13:00:00", "end")]):
        log.add(*[event(t, content=c, title=c) for t, c in part])
        path = log.run("spikes", sinks.to_table, spikes.last_seen_spikes)
    got = spike_rows(spark.read.parquet(path))
    assert got == [("b", "10:15", 4, 1), ("c", "11:15", 5, 1), ("e", "10:30", 4, 1)]
    assert got == spike_rows(alerts.trending_spikes(alerts.viewer_windows(log.batch())))


def test_a_content_without_plays_is_forgotten(log, spark):
    def plan(events):
        return spikes.last_seen_growth(events, late="0 minutes", forget_after=3600)

    for part in (["10:00:00"], ["10:20:00"], ["10:50:00"], ["15:00:00"], ["16:00:00"]):
        log.add(*[event(t) for t in part])
        path = log.run("forget", sinks.to_table, plan)
    # The window of 15:00 comes after the timer of 10:45 + 1 hour.
    assert clock(spark.read.parquet(path), "window_start", "previous_viewer_count") == [
        ("10:00", None), ("10:15", 1), ("10:45", 1), ("15:00", None)]


def test_late_rows_are_counted(log, spark):
    def run(k):
        with lateness.ProgressLog(spark, f"{log.stores}/progress") as seen:
            log.run("windows", lambda *a: seen.watch(sinks.to_changes(*a, name="windows")), alerts.viewer_windows)
            log.run("late", lambda ev, data, cp: lateness.late_events(ev, data, cp), lambda ev: ev)
        return seen.table().where("name = 'windows' AND input_rows > 0")

    log.add(event("12:00:00"), event("11:45:00"))
    run(1)
    # Four events for two closed windows, one for an open window, one pause before the watermark.
    log.add(*[event("10:00:00")] * 3, event("10:00:00", content="d"), event("11:46:00"), event("09:00:00", "pause"))
    rows = [(r["input_rows"], r["dropped"], r["watermark"]) for r in run(2).orderBy("batch").collect()]
    assert [r[:2] for r in rows] == [(2, 0), (6, 2)]
    assert rows[0][2] is None and str(rows[1][2]) == "2026-01-01 11:30:00"
    late = spark.read.schema(lateness.LATE).parquet(f"{log.stores}/late/data").orderBy("batch").collect()
    assert [(r["events"], r["late"]) for r in late] == [(2, 0), (6, 5)]
    assert str(late[1]["watermark"]) == "2026-01-01 11:30:00" and late[0]["watermark"] is None


def test_broken_messages_are_kept(log, spark, frame):
    good = [event("10:00:00", number=i) for i in range(3)]
    bad = ["", "no json", '{"user_id": "u2"', '{"other": 1}', "{}", event("noon", number=9), '[1, 2]', '"text"']
    plans = []

    def plan(_):
        raw = read_message_files(spark, log.path, 1)
        plans.append(activity.judge_messages(raw))
        return plans[-1]

    log.add(*good[:1], *bad[:4])
    path = log.run("judged", sinks.to_parsed_and_rejected, plan)
    frame(schemas.RAW_MESSAGE, (b"k", None), (None, b"{")).coalesce(1).write.mode("append").parquet(log.path)
    log.add(*good[1:], *bad[4:])
    log.run("judged", sinks.to_parsed_and_rejected, plan)
    schema = plans[-1].schema
    parsed, rejected = (sinks.kept(spark, path, s, schema) for s in ("parsed", "rejected"))
    assert parsed.count() + rejected.count() == len(good) + len(bad) + 2
    assert tuples(parsed.select(*FIELDS, "event_time")) == tuples(log.batch().where("event_id < 'e9' AND event_time IS NOT NULL"))
    assert parsed.where("reason IS NOT NULL OR value IS NOT NULL").count() == 0
    texts = rejected.select("reason", F.col("value").cast("string").alias("value"))
    got = {(r["value"], r["reason"]) for r in texts.collect()}
    broken, none, unknown, time = "broken JSON", "no value", "no known field", "no usable time"
    assert {("no json", broken), ('{"user_id": "u2"', broken), ('{"other": 1}', unknown), ("{}", unknown), (None, none),
            ("{", broken), (bad[5], time)} <= got
    # A batch that runs again replaces its own folder.
    before = tuples(rejected)
    take_back_last_commit(log, "judged")
    log.run("judged", sinks.to_parsed_and_rejected, plan)
    assert tuples(sinks.kept(spark, path, "rejected", schema)) == before


def last_changes(spark, path, *keys, value):
    changes = spark.read.parquet(path)
    return changes.groupBy(*keys).agg(F.max_by(value, "batch").alias(value))


def test_late_rows_of_closed_sliding_windows_are_dropped(log, spark):
    """14 minutes late still counts, 16 minutes and more does not (the watermark is 15)."""
    log.add(event("10:20:00"))
    log.run("sliding", sinks.to_changes, alerts.concurrent_viewers)
    log.add(event("10:06:00", content="in time"), event("09:59:00", content="late"))
    path = log.run("sliding", sinks.to_changes, alerts.concurrent_viewers)
    got = last_changes(spark, path, "window_start", "content_id", value="concurrent_viewers")
    per_content = dict(got.groupBy("content_id").count().collect())
    # The watermark is 10:05, and a window is over once it ends at or before it.
    assert per_content == {"c": 5, "in time": 5}


def test_sessions_are_never_dropped_without_a_window(log, spark):
    log.add(*[event("10:00:00", "buffering", session="old")] * 3)
    log.run("sessions", sinks.to_changes, alerts.poor_sessions)
    log.add(event("15:00:00", session="new"))
    log.run("sessions", sinks.to_changes, alerts.poor_sessions)
    log.add(event("10:00:01", "buffering", session="old"))
    path = log.run("sessions", sinks.to_changes, alerts.poor_sessions)
    assert tuples(last_changes(spark, path, "session_id", value="buffering_count")) == [("old", 4)]


def test_sessions_expire_with_a_window(log, spark):
    def plan(events):
        return alerts.poor_sessions(events, window="1 hour")

    log.add(*[event("10:00:00", "buffering", session="old")] * 3)
    log.run("hourly", sinks.to_changes, plan)
    log.add(event("15:00:00", session="new"))
    log.run("hourly", sinks.to_changes, plan)
    log.add(event("10:00:01", "buffering", session="old"),
            *[event("15:10:00", "buffering", session="now")] * 5)
    path = log.run("hourly", sinks.to_changes, plan)
    got = last_changes(spark, path, "session_id", value="buffering_count")
    assert tuples(got) == [("now", 5)]


def test_adjacent_spikes_in_a_stream_keep_thirty_minutes_of_lateness(log, spark):
    log.add(event("10:00:00"), *[event("10:15:00")] * 2)
    log.run("adjacent", sinks.to_changes, alerts.adjacent_spikes)
    log.add(event("10:44:00"), event("10:16:00"), event("10:17:00"))
    log.run("adjacent", sinks.to_changes, alerts.adjacent_spikes)
    log.add(event("12:00:00", content="other"))
    path = log.run("adjacent", sinks.to_changes, alerts.adjacent_spikes)
    got = last_changes(spark, path, "window_start", "content_id", value="viewer_count")
    assert clock(got, "window_start", "content_id", "viewer_count") == [("10:15", "c", 4)]


def test_memory_and_console_sinks(log, spark):
    log.add(event("10:00:00"))
    sinks.finish(sinks.to_memory(log.stream(), "seen"), 60)
    assert spark.table("seen").count() == 1
    query = sinks.to_console(log.stream(), scratch_path(spark, "console"))
    sinks.finish(query, 60)
    assert query.exception() is None
    assert sum(progress["numInputRows"] for progress in query.recentProgress) == 1


def test_a_running_stream_is_stopped_after_its_time(log, tmp_path):
    log.add(event("10:00:00"))
    query = sinks.to_table(log.stream(), str(tmp_path / "out"), str(tmp_path / "cp"), every="1 second")
    sinks.finish(query, 5)
    assert not query.isActive


def test_topic_options():
    assert kafka_options("a:1,b:2", "activity", 500) == {
        "kafka.bootstrap.servers": "a:1,b:2", "subscribe": "activity",
        "startingOffsets": "earliest", "maxOffsetsPerTrigger": "500"}
