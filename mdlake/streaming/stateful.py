"""Stateful stream operators: batch clocks and the metric throttle.

State is one small row per key.  The logic is the batch operators' own
(``number_run``), so a stream and a batch over the same messages agree.

Clocks are arrival clocks, as nothing may be lost for being late: a message
counts at its own time or at the latest time its key has seen, whichever is
later, and so joins the batch that is open when it arrives.  No watermark is
used.  In a stream that runs on, timers on processing time close a batch that no
message closes.  A stream that processes what has landed and stops goes without
(Spark would keep it running for their sake); what it leaves open is read from
its state (``open_batches``).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from mdlake.operators.batching import NEVER, Limits, Open, number_run

# Sent to the executors by value, like the batch functions it uses.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OPEN_SCHEMA = "rows BIGINT, first_ms BIGINT, last_ms BIGINT, number BIGINT, messages BIGINT, due BIGINT"
SERIES_KEPT_MS = 86_400_000  # how long a silent series is remembered
CLOSED_SCHEMA = (
    "key STRING, batch_no BIGINT, messages BIGINT, record_count BIGINT, first_ms BIGINT, last_ms BIGINT, reason STRING"
)
PUBLISHED_SCHEMA = "key STRING, ts_ms BIGINT, id BIGINT"


def _in_order(frames: Iterator[pd.DataFrame]) -> pd.DataFrame:
    """The key's messages of one micro-batch, oldest first."""
    return pd.concat(list(frames), ignore_index=True).sort_values(["ts_ms", "id"], ignore_index=True)


class BatchClock(StatefulProcessor):
    """Emit a key's batches as they close, by count, age or silence.

    A timer at the open batch's deadline closes it when no later message does.
    """

    def __init__(self, limits: Limits, timers: bool) -> None:
        self.limits = limits
        self.timers = timers

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", OPEN_SCHEMA)

    def _load(self) -> tuple[Open, int, int]:
        if not self.open.exists():
            return Open(), 0, 0
        rows, first_ms, last_ms, number, messages, due = self.open.get()
        return Open(rows, first_ms, last_ms, number), messages, due

    def _store(self, state: Open, messages: int, due: int) -> None:
        self.open.update((state.rows, state.first_ms, state.last_ms, state.number, messages, due))

    def _row(self, key: str, number: int, messages: int, rows: int, first_ms: int, last_ms: int, reason: str) -> dict:
        return {
            "key": key, "batch_no": number, "messages": messages, "record_count": rows,
            "first_ms": first_ms, "last_ms": last_ms, "reason": reason,
        }

    def _wait(self, state: Open) -> int:
        """How long after its last message the open batch closes without another."""
        return min(state.first_ms + self.limits.age_ms - state.last_ms, self.limits.idle_ms + 1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = _in_order(rows)
        state, messages, _ = self._load()
        before = Open(**vars(state))
        ms, sizes = np.maximum(frame["ts_ms"].to_numpy(), state.last_ms), frame["rows"].to_numpy()
        numbers = number_run(state, self.limits, ms, sizes)
        # Numbers only rise, so every batch is one stretch of the run.
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(numbers)) + 1))
        ends = np.append(cuts[1:], len(ms))
        totals = np.add.reduceat(sizes, cuts)
        closed = []
        if messages and numbers[0] != before.number:
            closed.append(
                self._row(key[0], before.number, messages, before.rows, before.first_ms, before.last_ms, "message")
            )
        for low, high, total in zip(cuts.tolist(), ends.tolist(), totals.tolist()):
            number, count, first = int(numbers[low]), high - low, int(ms[low])
            if number == before.number:
                count, total, first = count + messages, total + before.rows, before.first_ms
            if number < state.number:
                closed.append(self._row(key[0], number, count, total, first, int(ms[high - 1]), "message"))
            else:
                messages = count
        due = 0
        if state.rows >= self.limits.rows:
            closed.append(
                self._row(key[0], state.number, messages, state.rows, state.first_ms, state.last_ms, "full")
            )
            # Full batches stay in the state as closed: the next message opens one.
            messages, state.rows = 0, NEVER
        elif self.timers and self._wait(state) < NEVER // 2:
            due = timerValues.getCurrentProcessingTimeInMs() + max(0, self._wait(state))
            self.handle.registerTimer(due)
        self._store(state, messages, due)
        yield pd.DataFrame(closed, columns=[c.split()[0] for c in CLOSED_SCHEMA.split(", ")])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state, messages, due = self._load()
        closed = []
        if messages and expiredTimerInfo.getExpiryTimeInMs() >= due:
            closed.append(
                self._row(key[0], state.number, messages, state.rows, state.first_ms, state.last_ms, "timer")
            )
            state.rows = NEVER
            self._store(state, 0, 0)
        yield pd.DataFrame(closed, columns=[c.split()[0] for c in CLOSED_SCHEMA.split(", ")])

    def close(self) -> None:
        pass


class Throttle(StatefulProcessor):
    """Emit a series' first event and then one per interval."""

    def __init__(self, interval_ms: int, kept_ms: int | None) -> None:
        self.limits = Limits(age_ms=interval_ms)
        self.kept_ms = kept_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "published_ms BIGINT", self.kept_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = _in_order(rows)
        state = Open()
        if self.last.exists():
            published = self.last.get()[0]
            state = Open(0, published, published, 0)
        before = state.number
        ones = np.ones(len(frame), dtype=np.int64)
        numbers = number_run(state, self.limits, frame["ts_ms"].to_numpy(), ones)
        opens = np.diff(numbers, prepend=before) > 0
        self.last.update((state.first_ms,))
        yield frame.loc[opens, ["key", "ts_ms", "id"]]

    def close(self) -> None:
        pass


def closed_batches(messages: DataFrame, limits: Limits, timers: bool = False) -> DataFrame:
    """Stream of closed batches; every message is in exactly one batch.

    ``messages`` has ``key``, ``ts_ms``, ``id`` and ``rows``.  Set ``timers``
    for a stream that runs on.
    """
    return messages.groupBy("key").transformWithStateInPandas(
        statefulProcessor=BatchClock(limits, timers),
        outputStructType=CLOSED_SCHEMA,
        outputMode="append",
        timeMode="ProcessingTime" if timers else "None",
    )


def open_batches(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The batches that a stopped ``closed_batches`` stream has left open: the final flush."""
    state = spark.read.format("statestore").option("stateVarName", "open").load(checkpoint)
    return state.filter("value.messages > 0").select(
        F.col("key.key").alias("key"),
        F.col("value.number").alias("batch_no"),
        "value.messages",
        F.col("value.rows").alias("record_count"),
        "value.first_ms",
        "value.last_ms",
        F.lit("drain").alias("reason"),
    )


def throttled(events: DataFrame, interval_ms: int = 60_000, kept_ms: int | None = None) -> DataFrame:
    """Stream of published events; ``events`` has ``key``, ``ts_ms``, ``id``.

    A stream that runs on can forget a series ``kept_ms`` after its last event
    (``SERIES_KEPT_MS``), which takes processing time.
    """
    return events.groupBy("key").transformWithStateInPandas(
        statefulProcessor=Throttle(interval_ms, kept_ms),
        outputStructType=PUBLISHED_SCHEMA,
        outputMode="append",
        timeMode="None" if kept_ms is None else "ProcessingTime",
    )
