"""Retries as keyed state: attempts are counted per item, spaced by a pause, and given up after a limit.

An item's first attempt opens a round. A success ends it (``done``), so does the last failure allowed (``given_up``);
either way the item's state is dropped, and a later attempt opens a new round. Between, each failure sets when the next
attempt is due, and a timer reports the item once that time has come. Rows of one batch may come in any order; batches
must follow each other in time. Every change is one output row, so the newest row of a round tells how it stands.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

# Attempts before an item is given up, and milliseconds between two of them.
ATTEMPTS, PAUSE_MS = 6, 10_000

CHANGES = "item string, since long, attempts int, at long, due long, state string"


@dataclass(frozen=True)
class Round:
    """Where an item stands: id of the first attempt, attempts so far, time of the last one (milliseconds)."""

    since: int
    attempts: int
    at: int

    def after(self, at: int, ok: bool, limit: int) -> tuple[Round, str]:
        now = Round(self.since, self.attempts + 1, at)
        return now, "done" if ok else "given_up" if now.attempts >= limit else "waiting"


class Retries(StatefulProcessor):
    """Rows (item, id, at, ok) to changes of state."""

    def __init__(self, limit: int = ATTEMPTS, pause_ms: int = PAUSE_MS):
        self.limit, self.pause = limit, pause_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("round", "since long, attempts int, at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        every = pd.concat(list(rows)).sort_values(["at", "id"])
        now = Round(*self.state.get()) if self.state.exists() else None
        out = []
        for number, at, ok in zip(every["id"].tolist(), every["at"].tolist(), every["ok"].tolist(), strict=True):
            now, state = (now or Round(number, 0, at)).after(at, ok, self.limit)
            due = at + self.pause if state == "waiting" else None
            out.append((key[0], now.since, now.attempts, at, due, state))
            if state != "waiting":
                now = None
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if now is None:
            self.state.clear()
        else:
            self.state.update((now.since, now.attempts, now.at))
            self.handle.registerTimer(now.at + self.pause)
        yield _frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if self.state.exists():
            now = Round(*self.state.get())
            yield _frame([(key[0], now.since, now.attempts, now.at, now.at + self.pause, "due")])

    def close(self) -> None:
        pass


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["item", "since", "attempts", "at", "due", "state"])
    return frame.astype({"since": "int64", "attempts": "int32", "at": "int64", "due": "Int64"})


def retry_changes(stream: DataFrame, limit: int = ATTEMPTS, pause_ms: int = PAUSE_MS, delay: str = "10 minutes") -> DataFrame:
    """Changes of state for a stream of attempts: item (string), id (long, rising with time), at (milliseconds), ok.

    State lies in the state store and is dropped when a round ends, so it is bounded by the items that wait. Time is that
    of the attempts: an item is due when attempts ``delay`` after its pause were seen. An attempt that comes later than
    ``delay`` behind the newest is passed over, as what followed it was counted already."""
    timed = stream.select("item", "id", "at", "ok", F.timestamp_millis("at").alias("time")).withWatermark("time", delay)
    return timed.groupBy("item").transformWithStateInPandas(
        statefulProcessor=Retries(limit, pause_ms), outputStructType=CHANGES, outputMode="Append", timeMode="EventTime"
    )


def standing(changes: DataFrame) -> DataFrame:
    """The newest row of each round: item, since, attempts, due, state. A due item still waits, so both are ``waiting``."""
    state = F.when(F.col("state") == "due", "waiting").otherwise(F.col("state")).alias("state")
    last = F.max(F.struct("attempts", "due", state)).alias("_last")
    return changes.groupBy("item", "since").agg(last).select("item", "since", "_last.attempts", "_last.due", "_last.state")


def rounds(attempts: DataFrame, limit: int = ATTEMPTS, pause_ms: int = PAUSE_MS) -> DataFrame:
    """The same for a stored table of attempts, from windows alone: what a stream over it arrives at.

    A success closes the failures before it; of these every ``limit`` in a row are a round given up. One item's attempts
    are one window, sorted and read one by one."""
    order = Window.partitionBy("item").orderBy("at", "id")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    marked = attempts.withColumn("part", F.coalesce(F.sum(F.col("ok").cast("long")).over(before), F.lit(0)))
    inside = Window.partitionBy("item", "part").orderBy("at", "id")
    marked = marked.withColumn("round", F.call_function("div", F.row_number().over(inside) - 1, F.lit(limit)))
    found = marked.groupBy("item", "part", "round").agg(
        F.min_by("id", F.struct("at", "id")).alias("since"), F.count("*").cast("int").alias("attempts"),
        F.max("at").alias("at"), F.bool_or("ok").alias("ok"),
    )
    state = F.when(F.col("ok"), "done").when(F.col("attempts") >= limit, "given_up").otherwise("waiting")
    return found.select(
        "item", "since", "attempts", F.when(state == "waiting", F.col("at") + pause_ms).alias("due"), state.alias("state")
    )
