"""Streaming pipelines: landing table to published tables and roll-ups."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from mdlake.functions import paths
from mdlake.operators import batching, books, catalog, deltas, indicators, liquidations, quarantine, tables, telemetry
from mdlake.sources import frames, universe

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class Feed:
    """How one feed becomes a table."""

    rows: Callable[[DataFrame], DataFrame]
    ms: str
    table: Callable[[DataFrame], DataFrame]
    name: str
    keys: tuple[str, ...] = tables.TABLE_KEYS
    template: str = paths.DEFAULT_TIME_TEMPLATE


def _liquidations(raw: DataFrame) -> DataFrame:
    return liquidations.liq_normalize(raw).withColumn("market", F.lit("liquidation"))


FEEDS = {
    "fobs": Feed(books.book_flatten, "ts_ms", tables.snapshot_table, "snapshot"),
    "fobd": Feed(deltas.delta_flatten, "received_time", tables.delta_table, "delta"),
    "foi": Feed(lambda raw: indicators.oi_normalize(indicators.decode_oi(raw)), "received_time", tables.open_interest_table, "open_interest"),
    "pi": Feed(lambda raw: indicators.pi_normalize(indicators.decode_pi(raw)), "event_time", tables.premium_index_table, "premium_index"),
    "liq": Feed(_liquidations, "time_ms", tables.liquidation_table, "liquidation", tables.LIQUIDATION_KEYS, tables.HOURLY),
}


def published_rows(raw: DataFrame, feed: str, allowed: DataFrame | None = None, template: str | None = None) -> DataFrame:
    """Rows of a feed's table with its partition columns.

    Control frames, and symbols off the ``allowed`` list where one is given, go
    before anything is decoded.  The time folders (``template``, by default the
    feed's own) are those of each row's own time in UTC.
    """
    spec = FEEDS[feed]
    wanted = frames.keep_data_frames(raw)
    if allowed is not None:
        wanted = universe.keep_allowed(wanted, allowed)
    template = template or spec.template
    rows = tables.with_time_folders(spec.rows(wanted), spec.ms, template)
    return spec.table(rows, extra=(*spec.keys, *paths.time_folders(template)))


def commit_feed(
    rows: DataFrame, feed: str, table_path: str, manifest_path: str, number: int, commit_ms: int, codec: str = "snappy",
    template: str | None = None,
) -> None:
    """One commit of a feed's table in its own folders."""
    spec = FEEDS[feed]
    time = list(paths.time_folders(template or spec.template))
    chosen = tables.select_codec(spec.name, codec)
    catalog.commit_rows(rows, table_path, manifest_path, number, commit_ms, chosen, spec.keys, time)


def table_writer(
    raw: DataFrame,
    feed: str,
    table_path: str,
    manifest_path: str,
    checkpoint: str,
    clock_ms: Callable[[int], int],
    codec: str = "snappy",
    allowed: DataFrame | None = None,
    template: str | None = None,
    rejects_path: str | None = None,
) -> DataStreamWriter:
    """Writer of one feed's table: every micro-batch is one commit.

    The micro-batch number is the commit id, so a replayed batch replaces its
    own files.  ``clock_ms`` gives a commit's time from its number.  Messages
    that cannot be decoded go to ``rejects_path``, where one is given, before
    the commit; read them with ``read_parts``.
    """

    def commit(batch: DataFrame, number: int) -> None:
        if rejects_path:
            quarantine.rejects(batch).write.mode("overwrite").parquet(f"{rejects_path}/batch_id={number}")
        rows = published_rows(batch, feed, allowed, template)
        commit_feed(rows, feed, table_path, manifest_path, number, clock_ms(number), codec, template)

    return raw.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint)


def run_interval(writer: DataStreamWriter, every: str = "3 minutes") -> StreamingQuery:
    """Flush on a clock: one commit per interval."""
    return writer.trigger(processingTime=every).start()


def drain(writer: DataStreamWriter) -> None:
    """Process everything that has landed and stop."""
    writer.trigger(availableNow=True).start().awaitTermination()


def parts_writer(
    rows: DataFrame, parts: Callable[[DataFrame], DataFrame], path: str, checkpoint: str
) -> DataStreamWriter:
    """Writer of mergeable parts: each micro-batch aggregates its own rows.

    Parts are merged when they are read, so a row counts however late it comes;
    a replayed micro-batch replaces its own folder.
    """

    def write(batch: DataFrame, number: int) -> None:
        parts(batch).write.mode("overwrite").parquet(f"{path}/batch_id={number}")

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch_id")


def rollup_writer(events: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Parts of the per-minute roll-up; read with ``rollup_60s``."""
    return parts_writer(events, lambda b: telemetry.rollup_parts(telemetry.metric_events(b)), path, checkpoint)


def rollup_60s(spark: SparkSession, path: str) -> DataFrame:
    """The roll-up of everything that has arrived, by the batch rule."""
    return telemetry.merge_rollup(read_parts(spark, path))


def gap_writer(messages: DataFrame, path: str, checkpoint: str, idle_ms: int = batching.PROCESSOR_TIMEOUT_MS) -> DataStreamWriter:
    """Parts of the batches separated by silence; read with ``gap_batches``."""
    return parts_writer(messages, lambda b: batching.gap_cells(b, idle_ms), path, checkpoint)


def gap_batches(spark: SparkSession, path: str, idle_ms: int = batching.PROCESSOR_TIMEOUT_MS) -> DataFrame:
    """The batches of everything that has arrived, by the batch rule."""
    return batching.sessions(batching.merge_cells(read_parts(spark, path)), idle_ms)


def counted(rows: DataFrame, stage: str) -> DataFrame:
    """Rows with a live counter named after their stage.

    The counts show up in the query's progress as observed metrics.
    """
    return rows.observe(stage, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("exchange") == "").alias("blank"))


def progress_rows(query: StreamingQuery) -> list[dict]:
    """Rows and duration of the query's recent commits, for ``upload_stats``."""
    return [
        {"commit_id": p["batchId"], "records": p["numInputRows"], "duration_ms": p["durationMs"].get("triggerExecution", 0)}
        for p in query.recentProgress
    ]
