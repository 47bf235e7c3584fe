"""Grouping of messages into per-instrument batches.

Three clocks close a batch: its row count, its age since its first message, and
the silence since its last one.  A whole message is appended before the count is
tested, so boundaries always fall on messages.

Silence alone needs no ordered pass (``gap_batches``).  Count and age depend on
where the previous batch ended, which is sequential per instrument; here that
chain is cut so that an instrument holding most of the data is still processed
by many tasks:

1. messages are dealt by (key, minute), and counted there; running counts over
   the minutes of a key cut it into chunks of about ``CHUNK_ROWS`` messages;
2. each chunk is reduced to its state map: what becomes of any batch that is
   open when the chunk begins;
3. state maps compose, so ``FAN`` neighbouring ones become one, the maps of a key
   are chained, and the states found there go down to the chunks again;
4. each chunk numbers its own messages from its entry state.

Only the chain of step 3 is sequential: one map for ``FAN * CHUNK_ROWS`` messages
of a key.  Nothing runs before the result is asked for, and all steps read the
same two exchanges of the narrow messages.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The small functions below run inside tasks; sending them by value means that
# executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Default processor and writer limits.
PROCESSOR_ROWS = 100
PROCESSOR_TIMEOUT_MS = 5_000
WRITER_INTERVAL_MS = 180_000
INDICATOR_WRITER_ROWS = 512
LIQUIDATION_ROWS = 2000
LIQUIDATION_INTERVAL_MS = 15_000

NEVER = np.iinfo(np.int64).max // 4


@dataclass(frozen=True)
class Limits:
    """When a batch closes; an unset clock never fires."""

    rows: int = NEVER
    age_ms: int = NEVER
    idle_ms: int = NEVER


@dataclass
class Open:
    """The batch being filled: its rows, first and last time, and number."""

    rows: int = NEVER
    first_ms: int = -NEVER
    last_ms: int = -NEVER
    number: int = -1


# --- one run of messages of one key, in order ---------------------------------


def first_start(state: Open, limits: Limits, total: np.ndarray, ms: np.ndarray, quiet: np.ndarray) -> int:
    """Position of the first message that does not fit the open batch.

    ``total`` is the running row count and ``quiet`` the positions that follow
    a long silence inside the run.
    """
    if not len(ms) or state.rows >= limits.rows or ms[0] - state.last_ms > limits.idle_ms:
        return 0
    full = int(np.searchsorted(total, limits.rows - state.rows)) + 1
    old = int(np.searchsorted(ms, state.first_ms + limits.age_ms))
    silent = int(quiet[0]) if len(quiet) else len(ms)
    return min(full, old, silent, len(ms))


def quiet_positions(ms: np.ndarray, limits: Limits) -> np.ndarray:
    return np.flatnonzero(np.diff(ms) > limits.idle_ms) + 1


def follow_starts(limits: Limits, total: np.ndarray, ms: np.ndarray, quiet: np.ndarray) -> np.ndarray:
    """For a batch started at each position, where the following one starts."""
    n = len(ms)
    before = np.concatenate(([0], total[:-1]))
    full = np.searchsorted(total, before + limits.rows) + 1
    old = np.searchsorted(ms, ms + limits.age_ms)
    after = np.searchsorted(quiet, np.arange(n), side="right")
    silent = np.append(quiet, n)[after]
    return np.minimum(np.minimum(full, old), np.minimum(silent, n))


def number_run(state: Open, limits: Limits, ms: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Batch number of each message; ``state`` moves to the end of the run."""
    total, quiet = np.cumsum(rows), quiet_positions(ms, limits)
    starts = []
    at = first_start(state, limits, total, ms, quiet)
    if at < len(ms):
        follow = follow_starts(limits, total, ms, quiet)
        while at < len(ms):
            starts.append(at)
            at = int(follow[at])
    marks = np.zeros(len(ms), dtype=np.int64)
    marks[starts] = 1
    numbers = state.number + np.cumsum(marks)
    if starts:
        last = starts[-1]
        state.rows, state.first_ms = int(total[-1] - total[last] + rows[last]), int(ms[last])
        state.number += len(starts)
    else:
        state.rows += int(total[-1])
    state.last_ms = int(ms[-1])
    return numbers


@dataclass
class StateMap:
    """What a run of messages makes of any batch that is open when it begins.

    The open batch decides which message is the first that starts a batch; from
    there on all is fixed.  Starts with the same outcome are one class, in order
    of position: class j is the last one with ``rows_before[j]`` below the rows
    that still fit and ``ms_before[j]`` before the deadline.  Where ``passes``
    is set, the last class holds the batches that stay open to the end; its exit
    adds to the state instead of replacing it.

    There are at most as many classes as rows fit in a batch, or as milliseconds
    in its age, whatever the length of the run.
    """

    start_ms: int
    end_ms: int
    total_rows: int
    passes: bool
    rows_before: np.ndarray
    ms_before: np.ndarray
    exit_rows: np.ndarray
    exit_first_ms: np.ndarray
    exit_starts: np.ndarray

    @classmethod
    def of_run(cls, limits: Limits, ms: np.ndarray, rows: np.ndarray) -> StateMap:
        n = len(ms)
        total, quiet = np.cumsum(rows), quiet_positions(ms, limits)
        follow = follow_starts(limits, total, ms, quiet)
        # A batch carried in closes no later than one started at the first message would.
        latest = int(follow[0])
        last = np.where(follow < n, follow, np.arange(n))
        starts = (follow < n).astype(np.int64)
        while True:
            further = last[last]
            if np.array_equal(further, last):
                break
            starts, last = starts + starts[last], further
        at = np.arange(min(latest, n - 1) + 1)
        last, passes = last[at], latest == n
        at = np.append(at, n) if passes else at
        made = cls(
            start_ms=int(ms[0]),
            end_ms=int(ms[-1]),
            total_rows=int(total[-1]),
            passes=passes,
            rows_before=np.where(at == 0, -NEVER, np.where(at == 1, 0, total[np.maximum(at, 2) - 2])),
            ms_before=np.where(at == 0, -NEVER, ms[np.maximum(at, 1) - 1]),
            exit_rows=_with_pass(total[-1] - total[last] + rows[last], passes, int(total[-1])),
            exit_first_ms=_with_pass(ms[last], passes, 0),
            exit_starts=_with_pass(starts[: len(last)] + 1, passes, 0),
        )
        return made._merged()

    def _merged(self) -> StateMap:
        """Neighbouring classes of one outcome as one."""
        out = np.stack((self.exit_rows, self.exit_first_ms, self.exit_starts))
        keep = np.append(True, (out[:, 1:] != out[:, :-1]).any(axis=0))
        if self.passes:
            keep[-1] = True
        for name in CLASS_COLUMNS:
            setattr(self, name, getattr(self, name)[keep])
        return self

    def _class_of(self, limits: Limits, rows: np.ndarray, first_ms: np.ndarray, last_ms: int) -> np.ndarray:
        if self.start_ms - last_ms > limits.idle_ms:
            return np.zeros(len(rows), dtype=np.int64)
        by_rows = np.searchsorted(self.rows_before, limits.rows - rows) - 1
        by_age = np.searchsorted(self.ms_before, first_ms + limits.age_ms) - 1
        return np.maximum(np.minimum(by_rows, by_age), 0)

    def _exits(self, chosen: np.ndarray, rows: np.ndarray, first_ms: np.ndarray, starts: np.ndarray) -> tuple:
        stays = (chosen == len(self.exit_rows) - 1) & self.passes
        return (
            self.exit_rows[chosen] + np.where(stays, rows, 0),
            np.where(stays, first_ms, self.exit_first_ms[chosen]),
            starts + self.exit_starts[chosen],
        )

    def apply(self, limits: Limits, state: Open) -> None:
        """Move ``state`` over the run."""
        rows, first, starts = (np.array([x], dtype=np.int64) for x in (state.rows, state.first_ms, state.number))
        chosen = self._class_of(limits, rows, first, state.last_ms)
        state.rows, state.first_ms, state.number = (int(x[0]) for x in self._exits(chosen, rows, first, starts))
        state.last_ms = self.end_ms

    def then(self, limits: Limits, after: StateMap) -> StateMap:
        """The map of this run followed by ``after``."""
        own = len(self.exit_rows) - int(self.passes)
        rows, first, starts = self.exit_rows[:own], self.exit_first_ms[:own], self.exit_starts[:own]
        chosen = after._class_of(limits, rows, first, self.end_ms)
        columns = [(self.rows_before[:own], self.ms_before[:own], *after._exits(chosen, rows, first, starts))]
        passes = False
        if self.passes:
            silent = after.start_ms - self.end_ms > limits.idle_ms
            on = 1 if silent else len(after.exit_rows)  # after a silence all open a new batch
            passes = after.passes and not silent
            rows_before = np.append(self.rows_before[-1], after.rows_before[1:on] + self.total_rows)
            ms_before = np.append(self.ms_before[-1], after.ms_before[1:on])
            exit_rows = after.exit_rows[:on].copy()
            if passes:
                exit_rows[-1] += self.total_rows
            columns.append((rows_before, ms_before, exit_rows, after.exit_first_ms[:on], after.exit_starts[:on]))
        joined = [np.concatenate(c) for c in zip(*columns)]
        made = StateMap(self.start_ms, after.end_ms, self.total_rows + after.total_rows, passes, *joined)
        return made._merged()

    def row(self) -> dict:
        return vars(self)

    @classmethod
    def of_row(cls, row: dict) -> StateMap:
        plain = {n: row[n] for n in ("start_ms", "end_ms", "total_rows", "passes")}
        return cls(**plain, **{n: np.asarray(row[n], dtype=np.int64) for n in CLASS_COLUMNS})


CLASS_COLUMNS = ("rows_before", "ms_before", "exit_rows", "exit_first_ms", "exit_starts")


def _with_pass(values: np.ndarray, passes: bool, last: int) -> np.ndarray:
    return np.append(values, last) if passes else values


# --- the same over Spark partitions ---------------------------------------------

CELL_MS = 60_000
CHUNK_ROWS = 1 << 16
FAN = 256

MAP_SCHEMA = "start_ms BIGINT, end_ms BIGINT, total_rows BIGINT, passes BOOLEAN, " + ", ".join(
    f"{c} ARRAY<BIGINT>" for c in CLASS_COLUMNS
)
ENTRY = {"in_rows": "rows", "in_first_ms": "first_ms", "in_last_ms": "last_ms", "in_number": "number"}
ENTRY_SCHEMA = ", ".join(f"{c} BIGINT" for c in ENTRY)


def _runs(*columns: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of rows that agree in all columns."""
    change = np.zeros(max(0, len(columns[0]) - 1), dtype=bool)
    for values in columns:
        change |= values[1:] != values[:-1]
    edges = [0, *(np.flatnonzero(change) + 1).tolist(), len(columns[0])]
    return list(zip(edges[:-1], edges[1:]))


def _count_cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        yield frame.groupby(["key", "cell"], sort=False).size().reset_index(name="n")


def _report_maps(limits: Limits):
    """The state map of each chunk, composed batch by batch as its rows stream in."""

    def report(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, made = None, None
        for frame in frames:
            if frame.empty:
                continue
            keys, chunks = frame["key"].to_numpy(), frame["chunk"].to_numpy()
            ms, rows = frame["ts_ms"].to_numpy(), frame["rows"].to_numpy()
            out = []
            for low, high in _runs(keys, chunks):
                if (keys[low], chunks[low]) != at:
                    if made is not None:
                        out.append({"key": at[0], "chunk": at[1], **made.row()})
                    at, made = (keys[low], chunks[low]), None
                more = StateMap.of_run(limits, ms[low:high], rows[low:high])
                made = more if made is None else made.then(limits, more)
            if out:
                yield pd.DataFrame(out)
        if made is not None:
            yield pd.DataFrame([{"key": at[0], "chunk": at[1], **made.row()}])

    return report


def _compose_maps(limits: Limits):
    """Neighbouring maps of a group as one."""

    def compose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, made = None, None
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                if (row["key"], row["span"]) != at:
                    if made is not None:
                        out.append({"key": at[0], "span": at[1], **made.row()})
                    at, made = (row["key"], row["span"]), None
                more = StateMap.of_row(row)
                made = more if made is None else made.then(limits, more)
            if out:
                yield pd.DataFrame(out)
        if made is not None:
            yield pd.DataFrame([{"key": at[0], "span": at[1], **made.row()}])

    return compose


def _chain_maps(limits: Limits, group: list[str], place: str):
    """The state in which each map of a group is entered.

    A group may begin with a row that gives its own entry state.
    """

    def chain(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, state = None, Open()
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                here = tuple(row[c] for c in group)
                if here != at:
                    at, state = here, Open()
                if row["kind"] == 0:
                    state = Open(*(int(row[c]) for c in ENTRY))
                    continue
                out.append((row["key"], row[place], state.rows, state.first_ms, state.last_ms, state.number))
                StateMap.of_row(row).apply(limits, state)
            yield pd.DataFrame(out, columns=["key", place, *ENTRY])

    return chain


def _number_messages(limits: Limits, columns: list[str]):
    def number(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, state = None, Open()
        for frame in frames:
            if frame.empty:
                continue
            keys, chunks = frame["key"].to_numpy(), frame["chunk"].to_numpy()
            ms, rows = frame["ts_ms"].to_numpy(), frame["rows"].to_numpy()
            numbers = np.empty(len(frame), dtype=np.int64)
            for low, high in _runs(keys, chunks):
                if (keys[low], chunks[low]) != at:
                    at = (keys[low], chunks[low])
                    state = Open(*(int(frame[c].iloc[low]) for c in ENTRY))
                numbers[low:high] = number_run(state, limits, ms[low:high], rows[low:high])
            yield frame[columns].assign(batch_no=numbers)

    return number


def in_chunks(messages: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Messages with ``chunk``, which rises with time in a key, dealt and sorted by it.

    A chunk ends with the minute in which its ``chunk_rows`` messages are full.
    The counts come from the exchange that the messages go through anyway.
    """
    # Joins drop nulls below the exchange of their own side only; dropped here, both readers share one exchange.
    timed = messages.withColumn("cell", F.floor(F.col("ts_ms") / CELL_MS))
    dealt = timed.filter(F.col("key").isNotNull() & F.col("cell").isNotNull()).repartition("key", "cell")
    counts = dealt.mapInPandas(_count_cells, "key STRING, cell BIGINT, n BIGINT").groupBy("key", "cell").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy("key").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    chunks = counts.select("key", "cell", F.floor(before / chunk_rows).cast("bigint").alias("chunk"))
    marked = dealt.join(chunks, ["key", "cell"]).select(*messages.columns, "chunk").filter(F.col("chunk").isNotNull())
    return marked.repartition("key", "chunk").sortWithinPartitions("key", "chunk", "ts_ms", "id")


def _entries(maps: DataFrame, limits: Limits, fan: int) -> DataFrame:
    """(key, chunk, entry state) of every chunk from (key, chunk, its state map)."""
    names = [f.split(" ")[0] for f in MAP_SCHEMA.split(", ")]
    spans = (
        maps.withColumn("span", F.floor(F.col("chunk") / fan))
        .repartition("key", "span")
        .sortWithinPartitions("key", "span", "chunk")
    )
    wide = spans.mapInPandas(_compose_maps(limits), f"key STRING, span BIGINT, {MAP_SCHEMA}")
    wide = wide.withColumn("kind", F.lit(1)).repartition("key").sortWithinPartitions("key", "span")
    heads = wide.mapInPandas(_chain_maps(limits, ["key"], "span"), f"key STRING, span BIGINT, {ENTRY_SCHEMA}")
    none = [F.lit(None).cast("bigint").alias(c) for c in ENTRY]
    both = spans.select("key", "span", F.lit(1).alias("kind"), "chunk", *names, *none).unionByName(
        heads.withColumn("kind", F.lit(0)), allowMissingColumns=True
    )
    both = both.repartition("key", "span").sortWithinPartitions("key", "span", "kind", "chunk")
    return both.mapInPandas(_chain_maps(limits, ["key", "span"], "chunk"), f"key STRING, chunk BIGINT, {ENTRY_SCHEMA}")


def number_batches(messages: DataFrame, limits: Limits, chunk_rows: int = CHUNK_ROWS, fan: int = FAN) -> DataFrame:
    """Number the batches of every key.

    ``messages`` has ``key``, ``ts_ms``, ``id`` (unique in a key and time) and
    ``rows``; further columns pass through.  Adds ``batch_no``, from 0 per key.
    """
    parts = in_chunks(messages, chunk_rows)
    maps = parts.mapInPandas(_report_maps(limits), f"key STRING, chunk BIGINT, {MAP_SCHEMA}")
    started = parts.join(_entries(maps, limits, fan), ["key", "chunk"])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in messages.schema) + ", batch_no BIGINT"
    order = ["key", "chunk", "ts_ms", "id"]
    return started.sortWithinPartitions(*order).mapInPandas(_number_messages(limits, messages.columns), schema)


def batch_sizes(numbered: DataFrame, max_rows: int | None = None) -> DataFrame:
    """One row per batch; ``complete`` tells a full batch from a drained one."""
    sizes = numbered.groupBy("key", "batch_no").agg(
        F.count(F.lit(1)).alias("messages"),
        F.sum("rows").alias("record_count"),
        F.min("ts_ms").alias("first_ms"),
        F.max("ts_ms").alias("last_ms"),
    )
    if max_rows is None:
        return sizes
    return sizes.withColumn("complete", F.col("record_count") >= max_rows)


def count_batches(messages: DataFrame, max_rows: int = PROCESSOR_ROWS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Close a batch once it holds ``max_rows`` rows."""
    return number_batches(messages, Limits(rows=max_rows), chunk_rows)


def same_time_once(messages: DataFrame) -> DataFrame:
    """Messages of a key and millisecond as one; they share any age batch.

    Aggregated before the shuffle, so a burst costs one row per millisecond.
    """
    return messages.groupBy("key", "ts_ms").agg(
        F.min("id").alias("id"), F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("messages")
    )


def age_batches(messages: DataFrame, max_age_ms: int, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Batches that close ``max_age_ms`` after their first message.

    One row per batch.
    """
    numbered = number_batches(same_time_once(messages), Limits(age_ms=max_age_ms), chunk_rows)
    return numbered.groupBy("key", "batch_no").agg(
        F.sum("messages").alias("messages"),
        F.sum("rows").alias("record_count"),
        F.min("ts_ms").alias("first_ms"),
        F.max("ts_ms").alias("last_ms"),
    )


def key_flush(
    messages: DataFrame,
    max_rows: int = INDICATOR_WRITER_ROWS,
    max_age_ms: int = WRITER_INTERVAL_MS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Writer buffers: closed by size or by age since the first row."""
    return number_batches(messages, Limits(rows=max_rows, age_ms=max_age_ms), chunk_rows)


def count_or_idle_batches(
    messages: DataFrame,
    max_rows: int = PROCESSOR_ROWS,
    idle_ms: int = PROCESSOR_TIMEOUT_MS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Processor buffers: closed by size or by a silence longer than ``idle_ms``."""
    return number_batches(messages, Limits(rows=max_rows, idle_ms=idle_ms), chunk_rows)


def gap_cells(messages: DataFrame, idle_ms: int = PROCESSOR_TIMEOUT_MS) -> DataFrame:
    """Messages of a key in one cell of ``idle_ms``, which always belong together.

    Cells of parts of the input add up to the cells of the whole.
    """
    cell = F.floor(F.col("ts_ms") / idle_ms)
    return messages.groupBy("key", cell.alias("cell")).agg(
        F.min("ts_ms").alias("first_ms"),
        F.max("ts_ms").alias("last_ms"),
        F.count(F.lit(1)).alias("messages"),
        F.sum("rows").alias("record_count"),
    )


def sessions(cells: DataFrame, idle_ms: int = PROCESSOR_TIMEOUT_MS) -> DataFrame:
    """Batches from one row per key and cell: a silence longer than ``idle_ms`` parts them.

    The ordered pass sees one row per active cell, however busy the key is.
    """
    in_order = Window.partitionBy("key").orderBy("cell")
    silent = F.col("first_ms") - F.lag("last_ms").over(in_order) > idle_ms
    return (
        cells.withColumn("opens", F.coalesce(silent, F.lit(True)).cast("bigint"))
        .withColumn("batch_no", F.sum("opens").over(in_order) - 1)
        .groupBy("key", "batch_no")
        .agg(
            F.sum("messages").alias("messages"),
            F.sum("record_count").alias("record_count"),
            F.min("first_ms").alias("first_ms"),
            F.max("last_ms").alias("last_ms"),
        )
    )


def merge_cells(cells: DataFrame) -> DataFrame:
    """Cells of several parts of the input as cells of the whole."""
    return cells.groupBy("key", "cell").agg(
        F.min("first_ms").alias("first_ms"),
        F.max("last_ms").alias("last_ms"),
        F.sum("messages").alias("messages"),
        F.sum("record_count").alias("record_count"),
    )


def gap_batches(messages: DataFrame, idle_ms: int = PROCESSOR_TIMEOUT_MS) -> DataFrame:
    """Batches separated by a silence longer than ``idle_ms``."""
    return sessions(gap_cells(messages, idle_ms), idle_ms)


def interval_flush(messages: DataFrame, interval_ms: int = WRITER_INTERVAL_MS) -> DataFrame:
    """One batch per key and tick of a global clock."""
    tick = F.col("ts_ms") - F.pmod(F.col("ts_ms"), F.lit(interval_ms).cast("bigint")) + interval_ms
    return messages.groupBy("key", tick.alias("flush_ms")).agg(
        F.count(F.lit(1)).alias("messages"), F.sum("rows").alias("record_count")
    )


def drain(numbered: DataFrame, max_rows: int = PROCESSOR_ROWS) -> DataFrame:
    """The partial batch each key is left with when the input ends."""
    return batch_sizes(numbered, max_rows).filter(~F.col("complete")).drop("complete")


def batch_envelope(numbered: DataFrame, entry_columns: list[str]) -> DataFrame:
    """Batches with their entries, bounded by the batch size.

    ``batch_id`` is a digest of key and number, so a rerun gives the same ids.
    """
    return (
        numbered.groupBy("key", "batch_no")
        .agg(
            F.sort_array(F.collect_list(F.struct("ts_ms", "id", *entry_columns))).alias("entries"),
            F.sum("rows").alias("record_count"),
            F.max("ts_ms").alias("timestamp_ms"),
        )
        .withColumn("batch_id", F.sha2(F.concat_ws("#", "key", F.col("batch_no").cast("string")), 256))
    )


def throttle(events: DataFrame, interval_ms: int = 60_000, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Per series, the first event and then the next one at least
    ``interval_ms`` after the last published one.

    Published events are the openers of age batches.  ``events`` has ``key``,
    ``ts_ms`` and ``id``; of events in one millisecond the lowest id stands for
    all, since no other can be published.
    """
    ones = events.select("key", "ts_ms", "id", F.lit(1).cast("bigint").alias("rows"))
    numbered = number_batches(same_time_once(ones), Limits(age_ms=interval_ms), chunk_rows)
    return numbered.groupBy("key", "batch_no").agg(
        F.min(F.struct("ts_ms", "id")).alias("first")
    ).select("key", "first.ts_ms", "first.id")
