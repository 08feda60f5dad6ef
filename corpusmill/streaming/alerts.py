"""Alerts on streams: conditions that must hold for a time, and absence of events, with one state per rule.

Events are counted in windows first, spread over all tasks; only the few closed windows of a rule reach its state. Times are
event times: a rule is judged up to the watermark and no further, so a restart from the checkpoint repeats nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from corpusmill.streaming.streams import error_rates

ALERT_DDL = "rule string, fired_at timestamp"
# The state store that arbitrary state with timers needs.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _millis(value) -> int:
    # Naive times are UTC, as sessions of this library are.
    stamp = pd.Timestamp(value)
    return int((stamp.tz_localize("UTC") if stamp.tzinfo is None else stamp).timestamp() * 1000)


def _fired(rule: str, times: list[int]) -> pd.DataFrame:
    return pd.DataFrame({"rule": [rule] * len(times), "fired_at": [datetime.fromtimestamp(t / 1000, timezone.utc).replace(tzinfo=None) for t in times]})


class HeldCondition(StatefulProcessor):
    """Rows (rule, window_end, breach) of closed windows: fires at each window end up to which the breach has held.

    State of a rule: the last breached window end and the first one of the unbroken run it belongs to. A window that does not
    breach, and one without rows, end the run.
    """

    def __init__(self, slide_seconds: int, hold_seconds: int):
        self.slide, self.hold = slide_seconds * 1000, hold_seconds // slide_seconds * slide_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.run = handle.getValueState("run", "since long, last long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        windows = sorted((_millis(end), bool(breach)) for frame in rows for end, breach in zip(frame["window_end"], frame["breach"]))
        since, last = self.run.get() if self.run.exists() else (None, None)
        fired = []
        for end, breach in windows:
            if not breach:
                since = last = None
                continue
            if last is None or end != last + self.slide:
                since = end
            last = end
            if end - since >= self.hold:
                fired.append(end)
        if since is None:
            self.run.clear()
        else:
            self.run.update((since, last))
        if fired:
            yield _fired(key[0], fired)

    def close(self) -> None:
        pass


class Absence(StatefulProcessor):
    """Rows (rule, window_end, successes) of closed windows with events: fires at each window end before which no success was seen
    for the whole hold.

    Windows without any event have no rows, so time is told by a timer on the watermark: when it passes the next window end, all windows
    up to the watermark are judged one after the other. State of a rule: the next window end to judge, the number of empty windows so
    far, and the ends of windows with successes that are not judged yet.
    """

    def __init__(self, slide_seconds: int, hold_seconds: int):
        self.slide, self.steps = slide_seconds * 1000, hold_seconds // slide_seconds + 1

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.clock = handle.getValueState("clock", "next long, empty long")
        self.good = handle.getMapState("good", "end long", "seen boolean")

    def _judge(self, key, watermark: int) -> Iterator[pd.DataFrame]:
        at, empty = self.clock.get()
        before, fired = at, []
        while at <= watermark:
            if self.good.containsKey((at,)):
                self.good.removeKey((at,))
                empty = 0
            else:
                empty += 1
                if empty >= self.steps:
                    fired.append(at)
            at += self.slide
        self.clock.update((at, empty))
        if at != before:
            self.handle.registerTimer(at)
        if fired:
            yield _fired(key[0], fired)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for frame in rows:
            for end, successes in zip(frame["window_end"], frame["successes"]):
                end = _millis(end)
                first = end if first is None else min(first, end)
                if successes > 0:
                    self.good.updateValue((end,), (True,))
        if not self.clock.exists():
            self.clock.update((first, 0))
            self.handle.registerTimer(first)
        yield from self._judge(key, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._judge(key, timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def error_rate_alert_stream(
    events: DataFrame, success: Column, error: Column, width: str, slide: str, delay: str, slide_seconds: int, hold_seconds: int,
    limit: float = 0.2, rule: str = "error_rate", ts: str = "ts",
) -> DataFrame:
    """(rule, fired_at) as :func:`error_rate_alerts` of the batch form gives, as soon as the watermark has passed the window."""
    rates = error_rates(events, success, error, width, slide, delay, ts)
    judged = rates.select(F.lit(rule).alias("rule"), "window_end", (F.col("error_rate") > limit).alias("breach"))
    return judged.groupBy("rule").transformWithStateInPandas(HeldCondition(slide_seconds, hold_seconds), ALERT_DDL, "Append", "None")


def stall_alert_stream(
    events: DataFrame, success: Column, slide_seconds: int, hold_seconds: int, delay: str, heartbeat: DataFrame | None = None,
    rule: str = "stall", ts: str = "ts",
) -> DataFrame:
    """(rule, fired_at) for each end of a window of ``slide_seconds`` up to which there was no success for the whole hold.

    ``heartbeat`` is a stream of times (column ``timestamp``, as the ``rate`` source gives) that moves the watermark on when no events
    come at all; without it other events must.
    """
    rows = events.select(F.col(ts).alias("at"), F.when(success, 1).otherwise(0).alias("ok"))
    if heartbeat is not None:
        rows = rows.unionByName(heartbeat.select(F.col("timestamp").alias("at"), F.lit(0).alias("ok")))
    window = F.window("at", f"{slide_seconds} seconds")
    counts = rows.withWatermark("at", delay).groupBy(window).agg(F.sum("ok").alias("successes"))
    closed = counts.select(F.lit(rule).alias("rule"), F.col("window.end").alias("window_end"), "successes")
    return closed.groupBy("rule").transformWithStateInPandas(Absence(slide_seconds, hold_seconds), ALERT_DDL, "Append", "EventTime")


def with_state_store(spark: SparkSession, run):
    """``run()`` with the state store that these streams need; the session's own setting comes back afterwards."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, STATE_STORE)
    try:
        return run()
    finally:
        spark.conf.set(name, before)
