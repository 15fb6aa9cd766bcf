"""Keyed state with timers: the quarantine and the redelivery of work items as streams.

The reference keeps failed files in an expiring cache and leaves redelivery to its
broker; here both are state of a stream, one small value per path or work item in
the state store, with a timer of its own.  State and timers are in the checkpoint,
so a restarted stream goes on where it was: nothing is released early or delivered
once more than it may be.

Both read rows with an event time and answer by it: timers fire when the watermark
(the latest event time less ``lateness``) has reached them, so a replayed input
gives the same rows.  With ``clock="processing"`` they fire by the wall clock.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from intake.functions.ids import epoch_micros

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_CLOCKS = {"event": "EventTime", "processing": "ProcessingTime"}


@contextlib.contextmanager
def timed_state(spark: SparkSession):
    """Start streams of this module within: the state store that keeps timers, set back afterwards
    (a started stream has its own copy of the settings)."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


def _replace_timer(handle, at_us: int) -> None:
    """One timer per key, in milliseconds, not before ``at_us``."""
    for old in list(handle.listTimers()):
        handle.deleteTimer(old)
    handle.registerTimer(-(-at_us // 1000))


def _drop_timers(handle) -> None:
    for old in list(handle.listTimers()):
        handle.deleteTimer(old)


# ---- quarantine ----------------------------------------------------------------------------------

STAYS = "path string, quarantined_at long, released_at long, n_failures long, reason string"


class QuarantineState(StatefulProcessor):
    """A path is quarantined from its first failure until ``ttl`` after its last one."""

    def __init__(self, ttl_us: int):
        self.ttl = ttl_us

    def init(self, handle) -> None:
        self.handle = handle
        self.stay = handle.getValueState("stay", "first long, last long, n long, reason string")

    def _row(self, key, stay) -> dict:
        first, last, n, reason = stay
        return {"path": key[0], "quarantined_at": first, "released_at": last + self.ttl, "n_failures": n, "reason": reason}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        stay = self.stay.get() if self.stay.exists() else None
        over = []
        new = pd.concat(list(rows)).sort_values(["at", "reason"], na_position="first")
        for at, reason in zip(new["at"].tolist(), new["reason"]):
            reason = None if pd.isna(reason) else reason
            if stay and at >= stay[1] + self.ttl:      # over before this failure
                over.append(self._row(key, stay))
                stay = None
            if not stay:
                stay = (at, at, 1, reason)
            else:
                # a failure that comes late does not shorten the stay
                newest = (at, reason or "") >= (stay[1], stay[3] or "")
                stay = (min(stay[0], at), max(stay[1], at), stay[2] + 1, reason if newest else stay[3])
        self.stay.update(tuple(stay))
        _replace_timer(self.handle, stay[1] + self.ttl)
        if over:
            yield pd.DataFrame(over)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.stay.exists():
            yield pd.DataFrame([self._row(key, self.stay.get())])
            self.stay.clear()

    def close(self) -> None:
        pass


def quarantine_stays(failures: DataFrame, ttl_ms: int, lateness: str = "10 minutes", clock: str = "event") -> DataFrame:
    """The ended stays in quarantine (``path, quarantined_at, released_at, n_failures, reason`` of the newest failure)
    from a stream of failures (``path, failed_at, reason``).

    A row comes out when the path is released, ``ttl_ms`` after its last failure: a failure within the
    interval restarts it, one at its very end begins a new stay.  Failures that come later than
    ``lateness`` are not seen; those without path or time are left out."""
    from pyspark.sql import types as T

    rows = (failures.where("path is not null and failed_at is not null")
            .select("path", F.timestamp_micros(epoch_micros("failed_at")).alias("_time"), epoch_micros("failed_at").alias("at"), "reason")
            .withWatermark("_time", lateness))
    out = rows.groupBy("path").transformWithStateInPandas(
        QuarantineState(ttl_ms * 1000), T._parse_datatype_string(STAYS), "Append", _CLOCKS[clock])
    return out.select("path", *[_ntz(c) for c in ("quarantined_at", "released_at")], "n_failures", "reason")


def _ntz(c: str):
    """Microseconds since 1970 as ``timestamp_ntz``, free of the session's time zone."""
    from intake.functions.ids import epoch_ntz

    return (epoch_ntz() + F.make_dt_interval(secs=(F.col(c) / F.lit(1_000_000)).cast("decimal(18,6)"))).alias(c)


# ---- redelivery -----------------------------------------------------------------------------------

ACTIONS = "work_id string, action string, attempt int, at long"


class RedeliveryState(StatefulProcessor):
    """Attempts of a work item: failed ones are delivered again after a pause, until done or dead."""

    def __init__(self, max_attempts: int, backoff_us: Callable[[int], int]):
        self.most, self.backoff = max_attempts, backoff_us

    def init(self, handle) -> None:
        self.handle = handle
        # attempt: the greatest seen; due: when the next one goes out (0: none waits); over: done or dead
        self.item = handle.getValueState("item", "attempt int, due long, over boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        attempt, due, over = self.item.get() if self.item.exists() else (0, 0, False)
        new = pd.concat(list(rows)).sort_values(["attempt", "at"])
        out = []
        for n, at, ok in zip(new["attempt"].tolist(), new["at"].tolist(), new["ok"].tolist()):
            if over:
                continue                       # reported again
            if ok:
                attempt, due, over = max(attempt, n), 0, True
                out.append((key[0], "done", n, at))
            elif n >= self.most:
                attempt, due, over = n, 0, True
                out.append((key[0], "dead_letter", n, at))
            elif n > attempt:                  # a new failure, not one reported twice
                attempt, due = n, at + self.backoff(n)
        self.item.update((attempt, due, over))
        if due:
            _replace_timer(self.handle, due)
        else:
            _drop_timers(self.handle)
        if out:
            yield pd.DataFrame(out, columns=["work_id", "action", "attempt", "at"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        attempt, due, over = self.item.get()
        if due and not over:
            self.item.update((attempt, 0, False))
            yield pd.DataFrame([(key[0], "deliver", attempt + 1, due)], columns=["work_id", "action", "attempt", "at"])

    def close(self) -> None:
        pass


def doubling_backoff(first_ms: int, most_ms: int) -> Callable[[int], int]:
    """Pause in microseconds after attempt n: ``first_ms`` doubled each time, at most ``most_ms``."""
    return lambda n: 1000 * min(most_ms, first_ms << min(n - 1, 40))


def redelivery_actions(outcomes: DataFrame, max_attempts: int, backoff_us: Callable[[int], int],
                       lateness: str = "10 minutes", clock: str = "event") -> DataFrame:
    """What to do with work items (``work_id, action, attempt, at``) from a stream of their outcomes
    (``work_id, attempt, at, status``): ``done`` at the first ``ok``, ``dead_letter`` at a failure from
    ``max_attempts`` on, and in between ``deliver`` attempt n + 1 when ``backoff_us(n)`` has passed since
    attempt n failed.  An item is delivered at most ``max_attempts`` times however often outcomes are
    reported, and not at all once it is done or dead."""
    from pyspark.sql import types as T

    if max_attempts < 1:
        raise ValueError("max_attempts must be at least 1")
    rows = (outcomes.where("work_id is not null and attempt is not null and at is not null")
            .select("work_id", F.col("attempt").cast("int").alias("attempt"), F.timestamp_micros(epoch_micros("at")).alias("_time"),
                    epoch_micros("at").alias("at"), (F.col("status") == "ok").alias("ok"))
            .withWatermark("_time", lateness))
    out = rows.groupBy("work_id").transformWithStateInPandas(
        RedeliveryState(max_attempts, backoff_us), T._parse_datatype_string(ACTIONS), "Append", _CLOCKS[clock])
    return out.select("work_id", "action", "attempt", _ntz("at"))


def run_to_table(rows: DataFrame, folder: str, checkpoint: str, available_now: bool = True,
                 trigger_ms: int = 5000) -> StreamingQuery:
    """Start a stream of this module that appends its rows to Parquet files below ``folder``, each once."""
    with timed_state(rows.sparkSession):
        writer = rows.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).outputMode("append")
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{int(trigger_ms)} milliseconds")
        return writer.start()
