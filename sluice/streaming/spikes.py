"""Spikes against the last window seen, found inside the stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sluice.functions.numbers import growth as relative_growth
from sluice.streaming.alerts import GROWTH_LIMIT, TREND_LATENESS, TREND_WINDOW

_GROWN = ("window_start timestamp, window_end timestamp, content_id string, title string, "
          "viewer_count bigint, previous_viewer_count bigint")


class _LastSeen(StatefulProcessor):
    """Each closed window of a content beside the window before it; the state is one count."""

    def __init__(self, forget_after: float | None):
        self.forget_after = forget_after

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "viewer_count bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # The windows of a content that one watermark has closed: few, as each is a row.
        closed = pd.concat(list(rows)).sort_values(["window_start", "title"])
        counts = closed["viewer_count"].astype("Int64")
        previous = counts.shift(1)
        if self.last.exists():
            previous.iloc[0] = self.last.get()[0]
        self.last.update((int(counts.iloc[-1]),))
        if self.forget_after is not None:
            # One timer a content, moved on by each window.
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            over = closed["window_end"].iloc[-1].timestamp() + self.forget_after
            self.handle.registerTimer(int(over * 1000))
        yield closed.assign(previous_viewer_count=previous)[[
            "window_start", "window_end", "content_id", "title", "viewer_count", "previous_viewer_count"]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        yield pd.DataFrame()

    def close(self) -> None:
        pass


def last_seen_growth(events: DataFrame, size: str = TREND_WINDOW, late: str = TREND_LATENESS,
                     forget_after: float | None = None) -> DataFrame:
    """A stream of closed windows, each beside the last window of its content that had plays.

    The watermark closes windows in order of their end, so the state of a content is one number:
    the count of its last closed window. It goes to the next batch that closes a window of the
    content. What reaches Python is one row per content and window, not the plays. A content
    without plays for ``forget_after`` seconds is forgotten by a timer, and its next window has
    nothing to compare with; without that, its number is kept for as long as the stream runs.
    """
    windows = (
        events.where(F.col("action") == "play").withWatermark("event_time", late)
        .groupBy(F.window("event_time", size).alias("window"), "content_id", "title")
        .agg(F.count("user_id").alias("viewer_count"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                F.window_time("window").alias("at"), "content_id", "title", "viewer_count")
    )
    grown = windows.groupBy("content_id").transformWithStateInPandas(
        _LastSeen(forget_after), _GROWN, "append", "None" if forget_after is None else "EventTime")
    return grown.withColumn(
        "growth_ratio", relative_growth(F.col("viewer_count"), F.col("previous_viewer_count")))


def last_seen_spikes(events: DataFrame, size: str = TREND_WINDOW, late: str = TREND_LATENESS,
                     growth: float = GROWTH_LIMIT, forget_after: float | None = None) -> DataFrame:
    """Closed windows whose count grew by more than ``growth`` times the count before."""
    grown = last_seen_growth(events, size, late, forget_after)
    return grown.where((F.col("previous_viewer_count") > 0) & (F.col("growth_ratio") > growth))
