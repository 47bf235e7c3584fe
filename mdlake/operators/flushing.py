"""Flushes of one buffer that all messages share.

The buffer is written once it holds ``rows`` rows, or at the first tick of a
clock at which it holds any and ``interval_ms`` have passed since it was last
written.  There is no key to deal the work by, and each flush depends on the one
before; still no task sees all rows:

1. rows are dealt by time into chunks (``batching.in_chunks``, by day, so that
   even the counts of cells are in no single window);
2. between two rows all that matters is how many rows the buffer holds and how
   many ticks are left until its age is enough.  These are few values, so a chunk
   is a table from the state at its begin to the state at its end;
3. tables compose: those of a span of days become one, the spans are chained, and
   the states found there go down to the chunks;
4. each chunk numbers its own rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mdlake.functions.clock import DAY_MS
from mdlake.operators import batching

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TICK_MS = 1_000
SPAN_DAYS = 32
FIRST_DAY = 1_000_000_000  # makes the number of any day positive, so its text sorts like it


@dataclass(frozen=True)
class Clock:
    """When the buffer is written."""

    rows: int
    interval_ms: int
    tick_ms: int = TICK_MS

    @property
    def ticks(self) -> int:
        """Ticks from one written at a tick to the next."""
        return -(-self.interval_ms // self.tick_ms)

    @property
    def states(self) -> int:
        """How many buffers differ in what becomes of them: by rows held and ticks left, at most one more than ``ticks``."""
        return (self.ticks + 2) * self.rows

    def due(self, ms):
        """The first tick at which a buffer last written at ``ms`` is old enough."""
        return -(-(ms + self.interval_ms) // self.tick_ms)


@dataclass
class Buffers:
    """Possible buffers, moved together over the same rows.

    ``cell`` is the tick interval reached: all ticks up to its begin have passed.
    """

    rows: np.ndarray
    due: np.ndarray
    done: np.ndarray
    cell: int

    def tick_to(self, clock: Clock, cell: int) -> None:
        at = np.maximum(self.due, self.cell + 1)
        fires = (self.rows > 0) & (at <= cell)
        self.rows = np.where(fires, 0, self.rows)
        # How long a deadline has passed makes no difference.
        self.due = np.maximum(np.where(fires, at + clock.ticks, self.due), cell)
        self.done = self.done + fires
        self.cell = cell

    def append(self, clock: Clock, ms: np.ndarray) -> None:
        """Rows of the present cell, in order."""
        total = self.rows + len(ms)
        full = total // clock.rows
        last = np.maximum(full * clock.rows - self.rows - 1, 0)
        self.due = np.where(full > 0, clock.due(ms[last]), self.due)
        self.rows, self.done = total % clock.rows, self.done + full

    def distinct(self, clock: Clock) -> np.ndarray:
        """Keep equal buffers once; gives the new place of each."""
        state = (self.due - self.cell) * clock.rows + self.rows
        _, first, place = np.unique(self.done * clock.states + state, return_index=True, return_inverse=True)
        self.rows, self.due, self.done = self.rows[first], self.due[first], self.done[first]
        return place


@dataclass
class FlushMap:
    """What a run of rows makes of every possible buffer.

    States are numbered by ticks left and rows held; run j of equal outcomes
    begins at state ``begins[j]``.
    """

    first_ms: int
    last_cell: int
    begins: np.ndarray
    rows: np.ndarray
    due: np.ndarray
    done: np.ndarray

    @classmethod
    def of_run(cls, clock: Clock, ms: np.ndarray) -> FlushMap:
        cells = ms // clock.tick_ms
        first = int(cells[0])
        state = np.arange(clock.states)
        moved = Buffers(state % clock.rows, first + state // clock.rows, np.zeros_like(state), first)
        place = state
        for low, high in batching._runs(cells):
            moved.tick_to(clock, int(cells[low]))
            moved.append(clock, ms[low:high])
            if len(moved.rows) > 1:
                place = moved.distinct(clock)[place]
        begins = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        at = place[begins]
        return cls(int(ms[0]), moved.cell, begins, moved.rows[at], moved.due[at], moved.done[at])

    def apply(self, clock: Clock, before: Buffers) -> Buffers:
        first = self.first_ms // clock.tick_ms
        before.tick_to(clock, first)
        state = np.minimum(before.due - first, clock.ticks + 1) * clock.rows + before.rows
        at = np.searchsorted(self.begins, state, side="right") - 1
        return Buffers(self.rows[at], self.due[at], before.done + self.done[at], self.last_cell)

    def then(self, clock: Clock, after: FlushMap) -> FlushMap:
        out = after.apply(clock, Buffers(self.rows, self.due, self.done, self.last_cell))
        shown = np.stack((out.rows, out.due, out.done))
        keep = np.append(True, (shown[:, 1:] != shown[:, :-1]).any(axis=0))
        return FlushMap(self.first_ms, after.last_cell, self.begins[keep], out.rows[keep], out.due[keep], out.done[keep])

    @classmethod
    def of_row(cls, row: dict) -> FlushMap:
        return cls(int(row["first_ms"]), int(row["last_cell"]), *(np.asarray(row[c], dtype=np.int64) for c in ARRAYS))


ARRAYS = ("begins", "rows", "due", "done")
MAP_SCHEMA = "first_ms BIGINT, last_cell BIGINT, " + ", ".join(f"{c} ARRAY<BIGINT>" for c in ARRAYS)
ENTRY = ("in_rows", "in_due", "in_done", "in_cell")
ENTRY_SCHEMA = ", ".join(f"{c} BIGINT" for c in ENTRY)


def _joined(clock: Clock, group: list[str], maps):
    """Neighbouring maps of a group as one; ``maps`` gives those of a frame in order, with their group."""

    def join(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, made = None, None
        for frame in frames:
            for here, more in maps(frame):
                if here != at:
                    if made is not None:
                        yield pd.DataFrame([{**dict(zip(group, at)), **vars(made)}])
                    at, made = here, None
                made = more if made is None else made.then(clock, more)
        if made is not None:
            yield pd.DataFrame([{**dict(zip(group, at)), **vars(made)}])

    return join


def _maps_of_rows(clock: Clock):
    def maps(frame: pd.DataFrame):
        keys, chunks, ms = (frame[c].to_numpy() for c in ("key", "chunk", "ts_ms"))
        for low, high in batching._runs(keys, chunks) if len(frame) else ():
            yield (keys[low], chunks[low]), FlushMap.of_run(clock, ms[low:high])

    return maps


def _maps_of_chunks(frame: pd.DataFrame):
    for row in frame.to_dict("records"):
        yield (row["span"],), FlushMap.of_row(row)


def _entered(clock: Clock, columns: list[str]):
    """The state in which each map is entered, in the order of the rows.

    A row of kind 0 gives the state for those after it; without any the buffer
    counts as written at the very first row.
    """

    def chain(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = None
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                if row["kind"] == 0:
                    rows, due, done, cell = (int(row[c]) for c in ENTRY)
                    state = Buffers(np.array([rows]), np.array([due]), np.array([done]), cell)
                    continue
                made = FlushMap.of_row(row)
                if state is None:
                    zero = np.zeros(1, dtype=np.int64)
                    state = Buffers(zero, zero + clock.due(made.first_ms), zero, made.first_ms // clock.tick_ms)
                out.append((*(row[c] for c in columns), *(int(x[0]) for x in (state.rows, state.due, state.done)), state.cell))
                state = made.apply(clock, state)
            yield pd.DataFrame(out, columns=[*columns, *ENTRY])

    return chain


def _number_rows(clock: Clock, columns: list[str]):
    def number(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, state = None, None
        for frame in frames:
            if frame.empty:
                continue
            keys, chunks, ms = (frame[c].to_numpy() for c in ("key", "chunk", "ts_ms"))
            numbers = np.empty(len(frame), dtype=np.int64)
            for low, high in batching._runs(keys, chunks, ms // clock.tick_ms):
                if (keys[low], chunks[low]) != at:
                    at = (keys[low], chunks[low])
                    rows, due, done, cell = (int(frame[c].iloc[low]) for c in ENTRY)
                    state = Buffers(np.array([rows]), np.array([due]), np.array([done]), cell)
                state.tick_to(clock, int(ms[low]) // clock.tick_ms)
                numbers[low:high] = state.done[0] + (state.rows[0] + np.arange(high - low)) // clock.rows
                state.append(clock, ms[low:high])
            yield frame[columns].assign(batch_no=numbers)

    return number


def number_flushes(rows: DataFrame, clock: Clock, chunk_rows: int = batching.CHUNK_ROWS) -> DataFrame:
    """Rows with the number of the flush that writes them, from 0.

    ``rows`` has ``ts_ms`` and ``id``, which order it; further columns pass
    through.  Rows equal in both may change places.  What the last flush leaves
    is written at the end of the input, under the next number.
    """
    names = rows.columns
    day = F.floor(F.col("ts_ms") / DAY_MS) + FIRST_DAY
    parts = batching.in_chunks(rows.withColumn("key", F.lpad(day.cast("string"), 12, "0")), chunk_rows)
    maps = parts.mapInPandas(_joined(clock, ["key", "chunk"], _maps_of_rows(clock)), f"key STRING, chunk BIGINT, {MAP_SCHEMA}")
    spans = (
        maps.withColumn("span", F.floor(F.col("key").cast("bigint") / SPAN_DAYS))
        .repartition("span")
        .sortWithinPartitions("span", "key", "chunk")
    )
    # One map for each span of days: the only rows that meet in one task.
    wide = spans.mapInPandas(_joined(clock, ["span"], _maps_of_chunks), f"span BIGINT, {MAP_SCHEMA}")
    chained = wide.withColumn("kind", F.lit(1)).select("*", *[F.lit(None).cast("bigint").alias(c) for c in ENTRY])
    heads = chained.repartition(1).sortWithinPartitions("span").mapInPandas(_entered(clock, ["span"]), f"span BIGINT, {ENTRY_SCHEMA}")
    both = (
        spans.withColumn("kind", F.lit(1))
        .unionByName(heads.withColumn("kind", F.lit(0)), allowMissingColumns=True)
        .repartition("span")
        .sortWithinPartitions("span", "kind", "key", "chunk")
    )
    entries = both.mapInPandas(_entered(clock, ["key", "chunk"]), f"key STRING, chunk BIGINT, {ENTRY_SCHEMA}")
    started = parts.join(entries, ["key", "chunk"]).sortWithinPartitions("key", "chunk", "ts_ms", "id")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", batch_no BIGINT"
    return started.mapInPandas(_number_rows(clock, names), schema)


def liq_flush(
    rows: DataFrame,
    max_rows: int = batching.LIQUIDATION_ROWS,
    interval_ms: int = batching.LIQUIDATION_INTERVAL_MS,
    tick_ms: int = TICK_MS,
    chunk_rows: int = batching.CHUNK_ROWS,
) -> DataFrame:
    """Liquidation files: the shared buffer of all exchanges, one file per flush and exchange.

    ``rows`` has ``exchange``, ``ts_ms`` (arrival) and ``id``.  Rows without an
    exchange fill the buffer but are written nowhere.
    """
    numbered = number_flushes(rows.select("exchange", "ts_ms", "id"), Clock(max_rows, interval_ms, tick_ms), chunk_rows)
    return numbered.filter(F.col("exchange") != "").groupBy("batch_no", "exchange").agg(
        F.count(F.lit(1)).alias("records"), F.min("ts_ms").alias("first_ms"), F.max("ts_ms").alias("last_ms")
    )
