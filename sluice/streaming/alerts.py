"""Viewer counts per time window and the alerts made from the stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.numbers import growth as relative_growth

# Fixed values of the rules.
COUNT_WINDOW, COUNT_SLIDE, COUNT_LATENESS = "5 minutes", "1 minute", "15 minutes"
TREND_WINDOW, TREND_LATENESS = "15 minutes", "30 minutes"
SESSION_LATENESS = "30 minutes"
SESSION_GAP = "30 minutes"
BUFFERING_LIMIT = 3
GROWTH_LIMIT = 2.0


def _plays_per_window(events: DataFrame, window: Column, late: str, name: str) -> DataFrame:
    counts = (
        events.where(F.col("action") == "play")
        .withWatermark("event_time", late)
        .groupBy(window.alias("window"), "content_id", "title")
        .agg(F.count("user_id").alias(name))
    )
    return counts.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "content_id", "title", name,
    )


def concurrent_viewers(events: DataFrame, size: str = COUNT_WINDOW, slide: str = COUNT_SLIDE,
                       late: str = COUNT_LATENESS) -> DataFrame:
    """Play events of known users per title in sliding windows."""
    return _plays_per_window(
        events, F.window("event_time", size, slide), late, "concurrent_viewers"
    )


def viewer_windows(events: DataFrame, size: str = TREND_WINDOW,
                   late: str = TREND_LATENESS) -> DataFrame:
    """Play events of known users per title in back-to-back windows."""
    return _plays_per_window(events, F.window("event_time", size), late, "viewer_count")


def session_buffering(events: DataFrame, late: str = SESSION_LATENESS,
                      window: str | None = None) -> DataFrame:
    """Buffering events per session.

    Without ``window`` a session counts for as long as the stream runs, and its
    state is never dropped. With ``window`` it counts per time window, and the
    watermark drops the state of windows that are over.
    """
    keys = [F.col("session_id")]
    if window:
        keys.insert(0, F.window("event_time", window).alias("window"))
    flag = F.when(F.col("action") == "buffering", 1).otherwise(0)
    counts = (
        events.withWatermark("event_time", late)
        .groupBy(*keys).agg(F.sum(flag).alias("buffering_count"))
    )
    if not window:
        return counts
    return counts.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "session_id", "buffering_count",
    )


def poor_sessions(events: DataFrame, threshold: int = BUFFERING_LIMIT,
                  late: str = SESSION_LATENESS, window: str | None = None) -> DataFrame:
    """Sessions with more than ``threshold`` buffering events."""
    return session_buffering(events, late, window).where(F.col("buffering_count") > threshold)


def gap_sessions(events: DataFrame, gap: str = SESSION_GAP, late: str = SESSION_LATENESS) -> DataFrame:
    """Buffering events per session, where a session ends once nothing came for ``gap``.

    An id that comes back later is a session of its own. The watermark ends sessions, so that a
    stream (append mode) reports each one once and keeps only sessions that may still go on.
    """
    flag = F.when(F.col("action") == "buffering", 1).otherwise(0)
    counts = (
        events.withWatermark("event_time", late)
        .groupBy(F.session_window("event_time", gap).alias("window"), "session_id")
        .agg(F.sum(flag).alias("buffering_count"), F.count("*").alias("events"))
    )
    return counts.select(
        F.col("window.start").alias("session_start"), F.col("window.end").alias("session_end"),
        "session_id", "buffering_count", "events",
    )


def poor_gap_sessions(events: DataFrame, threshold: int = BUFFERING_LIMIT, gap: str = SESSION_GAP,
                      late: str = SESSION_LATENESS) -> DataFrame:
    """Sessions by gap with more than ``threshold`` buffering events."""
    return gap_sessions(events, gap, late).where(F.col("buffering_count") > threshold)


def viewer_growth(windows: DataFrame, mode: str = "last_seen") -> DataFrame:
    """Each window's count beside the one before it for the same content, and the growth.

    ``last_seen`` compares with the last window that had plays, however long
    ago; ``adjacent`` only with the same title's window that ended when this one began. The
    windows of one content are put in order by one task: their number is bounded
    by the time covered, not by the number of plays.
    """
    if mode not in ("last_seen", "adjacent"):
        raise ValueError(f"unknown mode {mode!r}")
    same = ["content_id", "title"] if mode == "adjacent" else ["content_id"]
    by_time = Window.partitionBy(*same).orderBy("window_start", "title")
    previous = F.lag("viewer_count").over(by_time)
    if mode == "adjacent":
        touches = F.lag("window_end").over(by_time) == F.col("window_start")
        previous = F.when(touches, previous)
    return windows.withColumn("previous_viewer_count", previous).withColumn(
        "growth_ratio", relative_growth(F.col("viewer_count"), F.col("previous_viewer_count"))
    )


def trending_spikes(windows: DataFrame, growth: float = GROWTH_LIMIT,
                    mode: str = "last_seen") -> DataFrame:
    """Windows whose count grew by more than ``growth`` times the count before."""
    has_base = F.col("previous_viewer_count") > 0  # null, and so false, for a first window
    return viewer_growth(windows, mode).where(has_base & (F.col("growth_ratio") > growth))


def adjacent_spikes(events: DataFrame, size: str = TREND_WINDOW,
                    late: str = "45 minutes", growth: float = GROWTH_LIMIT) -> DataFrame:
    """Spikes against the adjacent window, computed in the stream itself.

    Each play counts in its own window as current and in the next window as
    previous, so one windowed aggregation sees both counts and no stored
    snapshot is needed. The shifted copies move the watermark ahead by one
    window, which ``late`` has to make up for: 45 minutes keep 30 of lateness.
    """
    shift = F.expr(f"INTERVAL {size}")
    play = F.col("action") == "play"
    roles = F.array(
        F.struct(F.col("event_time").alias("at"), F.lit(1).alias("current")),
        F.struct((F.col("event_time") + shift).alias("at"), F.lit(0).alias("current")),
    )
    counted = (
        events.where(play & F.col("user_id").isNotNull())
        .select("content_id", "title", F.inline(roles))
        .withWatermark("at", late)
        .groupBy(F.window("at", size).alias("window"), "content_id", "title")
        .agg(
            F.count_if(F.col("current") == 1).alias("viewer_count"),
            F.count_if(F.col("current") == 0).alias("previous_viewer_count"),
        )
    )
    ratio = relative_growth(F.col("viewer_count"), F.col("previous_viewer_count"))
    return counted.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "content_id", "title", "viewer_count", "previous_viewer_count",
        ratio.alias("growth_ratio"),
    ).where((F.col("viewer_count") > 0) & (F.col("growth_ratio") > growth))
