"""Jobs over the pipeline's own metric, log, resource and stage tables.

A metric event keeps the types it was emitted with: ``number`` is its value if
that was a number (``value`` is the value as text, whatever it was), ``fields``
holds its text fields and ``numbers`` its numeric ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mdlake.functions import clock

# Metric names behind each feature switch, fields that are never
# dimensions, drop counters by feed and stage, the drop report's categories, and
# the charted buffers.
USED_WEIGHT_METRICS = ["used_weight"]
CHANNEL_SIZE_METRICS = [
    "fobs_raw_buffer_length", "fobs_norm_buffer_length", "fobd_raw_buffer_length", "fobd_norm_buffer_length",
]
RESERVED_FIELDS = ["metric", "metric_type", "value", "unit"]
DROP_COUNTERS = {
    ("fobs", "raw"): "snapshot_messages_dropped",
    ("fobd", "raw"): "delta_messages_dropped",
    ("fobd", "norm"): "delta_norm_messages_dropped",
    ("liq", "raw"): "liquidation_messages_dropped",
    ("foi", "raw"): "open_interest_messages_dropped",
    ("pi", "raw"): "premium_index_messages_dropped",
}
OTHER_DROPS = "other_messages_dropped"
DROP_CATEGORIES = {
    "snapshot_messages_dropped": "snapshot",
    "delta_messages_dropped": "delta",
    "delta_norm_messages_dropped": "delta_norm",
    "liquidation_messages_dropped": "liquidation",
}
CHARTED_BUFFERS = CHANNEL_SIZE_METRICS + ["liq_raw_buffer_length"]
RESOURCE_METRICS = ["cpu_percent", "mem_used_percent", "disk_used_percent"]


def metric_events(events: DataFrame, used_weight: bool = True, channel_size: bool = True) -> DataFrame:
    """Accepted metric events: named, typed and not switched off."""
    off = ([] if used_weight else USED_WEIGHT_METRICS) + ([] if channel_size else CHANNEL_SIZE_METRICS)
    named = events.filter(F.coalesce(F.col("name"), F.lit("")) != "")
    if off:
        named = named.filter(~F.col("name").isin(off))
    kind = F.when(F.coalesce(F.col("type"), F.lit("")) == "", "counter").otherwise(F.col("type"))
    return named.withColumn("type", kind)


def metric_numeric(events: DataFrame) -> DataFrame:
    """Events whose value was emitted as a number; text that looks like one is none."""
    return events.filter(F.col("number").isNotNull())


def metric_unit(unit: Column) -> Column:
    return F.when(F.lower(unit) == "percent", "Percent").otherwise("Count")


def metric_dimensions(component: Column, fields: Column) -> Column:
    """Component plus every non-blank text field that is not reserved."""
    kept = F.map_filter(fields, lambda k, v: ~k.isin(RESERVED_FIELDS) & (k != "component") & (v != ""))
    return F.map_concat(F.create_map(F.lit("component"), component), F.coalesce(kept, F.create_map().cast("MAP<STRING, STRING>")))


def render_dimensions(dimensions: Column) -> Column:
    """``name=value`` parts in sorted order, joined by ``|``."""
    parts = F.transform(F.map_entries(dimensions), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.array_join(F.array_sort(parts), "|")


def series_key(component: Column, name: Column, dimensions: Column, unit: Column) -> Column:
    return F.concat_ws("|", component, name, render_dimensions(dimensions), F.concat(F.lit("unit="), unit))


def metric_datums(events: DataFrame) -> DataFrame:
    """Numeric events with unit, dimensions and their series key."""
    unit = metric_unit(F.element_at("fields", "unit"))
    dims = metric_dimensions(F.col("component"), F.col("fields"))
    rows = metric_numeric(events).withColumns({"unit": unit, "dimensions": dims})
    return rows.withColumn("series", series_key(F.col("component"), F.col("name"), F.col("dimensions"), F.col("unit")))


def rollup_parts(events: DataFrame, ms: str = "ts_ms", width_ms: int = 60_000) -> DataFrame:
    """Sums, counts and maxima per minute and series, which add up to roll-ups."""
    name = F.col("name")
    stat = F.when(name.isin(CHARTED_BUFFERS), "avg").when(name.isin(USED_WEIGHT_METRICS + RESOURCE_METRICS), "max")
    return (
        metric_numeric(events)
        .withColumn("stat", stat)
        .filter(F.col("stat").isNotNull())
        .groupBy(
            clock.bucket_ms(F.col(ms), width_ms).alias("minute_ms"),
            "component",
            "name",
            "stat",
            F.coalesce(F.element_at("fields", "ip"), F.lit("")).alias("ip"),
        )
        .agg(F.sum("number").alias("total"), F.max("number").alias("highest"), F.count(F.lit(1)).alias("samples"))
    )


ROLLUP_KEY = ["minute_ms", "component", "name", "ip", "stat"]


def merge_rollup(parts: DataFrame) -> DataFrame:
    """Per-minute average of buffer gauges and maximum of usage gauges."""
    merged = parts.groupBy(*ROLLUP_KEY).agg(
        F.sum("total").alias("total"), F.max("highest").alias("highest"), F.sum("samples").alias("samples")
    )
    value = F.when(F.col("stat") == "avg", F.col("total") / F.col("samples")).otherwise(F.col("highest"))
    return merged.select(*ROLLUP_KEY, F.round(value, 6).alias("value"), "samples")


def rollup_60s(events: DataFrame, ms: str = "ts_ms", width_ms: int = 60_000) -> DataFrame:
    """Per-minute roll-up of all events."""
    return merge_rollup(rollup_parts(events, ms, width_ms))


# --- drops and channel accounting --------------------------------------------


def drop_counter(feed: Column, stage: Column) -> Column:
    name = F.lit(OTHER_DROPS)
    for (f, s), counter in DROP_COUNTERS.items():
        name = F.when((feed == f) & (stage == s), counter).otherwise(name)
    return name


def drop_events(stages: DataFrame) -> DataFrame:
    """One counter event of value 1 per dropped message; blank labels left out."""
    labels = F.create_map(
        F.lit("exchange"), F.col("exchange"), F.lit("market"), F.col("market"),
        F.lit("symbol"), F.col("symbol"), F.lit("stage"), F.col("stage"),
    )
    return stages.filter(F.col("outcome") == "dropped").select(
        "ts_ms",
        F.lit("channel_drops").alias("component"),
        drop_counter(F.col("feed"), F.col("stage")).alias("name"),
        F.lit("1").alias("value"),
        F.lit(1.0).alias("number"),
        F.lit("counter").alias("type"),
        F.map_filter(labels, lambda _k, v: v.isNotNull() & (v != "")).alias("fields"),
    )


def drop_summary(drops: DataFrame) -> DataFrame:
    """Dropped messages by exchange and category, with a grand total row.

    Only the charted counters take part; a missing or blank exchange counts as
    ``unknown``, a value that is no finite number as 0; fractions add up.
    ``delta_total`` adds raw and normalised delta drops.
    """
    category = F.element_at(
        F.create_map(*[F.lit(x) for item in DROP_CATEGORIES.items() for x in item]), F.col("name")
    )
    exchange = F.coalesce(F.nullif(F.element_at("fields", "exchange"), F.lit("")), F.lit("unknown"))
    value = F.when(F.abs("number") < float("inf"), F.col("number")).otherwise(0.0)

    def total(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("category") == kind, F.col("dropped"))), F.lit(0.0)).alias(kind)

    rows = drops.select(exchange.alias("exchange"), category.alias("category"), value.alias("dropped")).filter(
        F.col("category").isNotNull()
    )
    pivoted = rows.rollup("exchange").agg(
        *[total(k) for k in DROP_CATEGORIES.values()], F.sum("dropped").alias("total")
    )
    return pivoted.select(
        F.coalesce("exchange", F.lit("ALL")).alias("exchange"),
        "snapshot",
        "delta",
        "delta_norm",
        (F.col("delta") + F.col("delta_norm")).alias("delta_total"),
        "liquidation",
        "total",
    )


def channel_stats(stages: DataFrame) -> DataFrame:
    """Sent and dropped counters of each feed's raw and norm stage."""

    def n(stage: str, outcome: str) -> Column:
        return F.count_if((F.col("stage") == stage) & (F.col("outcome") == outcome)).alias(f"{stage}_{outcome}")

    return stages.groupBy("feed").agg(n("raw", "sent"), n("norm", "sent"), n("raw", "dropped"), n("norm", "dropped"))


# Default sizes of the raw and norm buffers.
BUFFER_SIZES = {"raw": 10_000, "norm": 2_000}


def buffer_flow(stages: DataFrame, taken: DataFrame) -> DataFrame:
    """What enters (+1) and leaves (-1) each (feed, stage) buffer.

    A message sent to the raw buffer stays until the processor has turned it
    into a norm message, sent or dropped; that one stays until a writer takes
    it (``taken``: one row per message, with ``feed`` and ``ts_ms``).
    """
    into, out = F.lit(1).alias("change"), F.lit(-1).alias("change")
    sent = stages.filter(F.col("outcome") == "sent").select("feed", "stage", "ts_ms", into)
    turned = stages.filter(F.col("stage") == "norm").select("feed", F.lit("raw").alias("stage"), "ts_ms", out)
    written = taken.select("feed", F.lit("norm").alias("stage"), "ts_ms", out)
    return sent.unionByName(turned).unionByName(written)


def buffer_capacities(events: DataFrame) -> DataFrame:
    """(feed, stage, ts_ms, event_id, capacity) of every sample that reports a buffer's size."""
    feed, stage = (F.regexp_extract("name", "^([a-z]+)_(raw|norm)_buffer_length$", i) for i in (1, 2))
    reported = events.select(
        feed.alias("feed"), stage.alias("stage"), "ts_ms", "event_id", F.element_at("numbers", "capacity").alias("capacity")
    )
    return reported.filter((F.col("stage") != "") & F.col("capacity").isNotNull())


def buffer_occupancy(flow: DataFrame, capacities: DataFrame, width_ms: int = 1000) -> DataFrame:
    """Backlog of each (feed, stage) buffer at the end of every second with a change, and its capacity then.

    The capacity is the last one reported up to the end of that second, or the
    default size before the first report.  Changes and reports are first reduced
    to one row per second, then to one per day; sums and last values run inside
    a day on top of those of the days before, so no window spans a feed's whole
    history.
    """
    key = ["feed", "stage"]
    second = clock.bucket_ms(F.col("ts_ms"), width_ms).alias("second_ms")
    moved = flow.select(*key, second, F.col("change").cast("bigint").alias("change"), F.lit(None).cast("struct<ts_ms: bigint, event_id: bigint, capacity: bigint>").alias("seen"))
    told = capacities.select(
        *key, second, F.lit(None).cast("bigint").alias("change"),
        F.struct("ts_ms", "event_id", F.col("capacity").cast("bigint").alias("capacity")).alias("seen"),
    )
    seconds = moved.unionByName(told).groupBy(*key, "second_ms").agg(F.sum("change").alias("change"), F.max("seen").alias("seen"))
    # The days are summed from the same seconds: one exchange serves both.
    day = clock.bucket_ms(F.col("second_ms"), clock.DAY_MS)
    before = Window.partitionBy(*key).orderBy("day_ms").rowsBetween(Window.unboundedPreceding, -1)
    days = (
        seconds.groupBy(*key, day.alias("day_ms"))
        .agg(F.sum("change").alias("change"), F.max("seen").alias("seen"))
        .select(*key, "day_ms", F.coalesce(F.sum("change").over(before), F.lit(0)).alias("carried"), F.max("seen").over(before).alias("carried_seen"))
    )
    within = Window.partitionBy(*key, "day_ms").orderBy("second_ms").rowsBetween(Window.unboundedPreceding, 0)
    default = F.when(F.col("stage") == "raw", BUFFER_SIZES["raw"]).otherwise(BUFFER_SIZES["norm"]).cast("bigint")
    return (
        seconds.withColumn("day_ms", day)
        .join(days, [*key, "day_ms"])
        .select(
            *key,
            "second_ms",
            "change",
            (F.col("carried") + F.coalesce(F.sum("change").over(within), F.lit(0))).alias("backlog"),
            F.coalesce(F.max("seen").over(within)["capacity"], F.col("carried_seen.capacity"), default).alias("capacity"),
        )
        .filter(F.col("change").isNotNull())
        .drop("change")
    )


# --- latest-N views -----------------------------------------------------------


def latest(rows: DataFrame, n: int = 200, order: tuple[str, str] = ("ts_ms", "event_id")) -> DataFrame:
    """The most recent ``n`` rows, oldest first; each task keeps only its top n."""
    newest = [F.col(c).desc() for c in order]
    return rows.orderBy(*newest).limit(n).orderBy(*order)


def latest_per_series(events: DataFrame, n: int = 150) -> DataFrame:
    """The last ``n`` finite samples of each charted buffer."""
    finite = metric_numeric(events).filter(
        F.col("name").isin(CHARTED_BUFFERS) & (F.abs("number") < float("inf"))
    )
    newest = Window.partitionBy("name").orderBy(F.col("ts_ms").desc(), F.col("event_id").desc())
    return (
        finite.withColumn("rn", F.row_number().over(newest))
        .filter(F.col("rn") <= n)
        .select("name", "event_id", "ts_ms", F.col("number").alias("value"))
    )


def latest_capacity(events: DataFrame) -> DataFrame:
    """Last seen capacity of each charted buffer."""
    return (
        metric_numeric(events)
        .withColumn("capacity", F.element_at("numbers", "capacity"))
        .filter(F.col("name").isin(CHARTED_BUFFERS) & F.col("capacity").isNotNull())
        .groupBy("name")
        .agg(F.max_by("capacity", F.struct("ts_ms", "event_id")).alias("capacity"))
    )


def log_records(entries: DataFrame) -> DataFrame:
    """Log rows with the component taken out of the fields."""
    return entries.select(
        "event_id",
        "ts_ms",
        "level",
        F.coalesce(F.element_at("fields", "component"), F.lit("")).alias("component"),
        "message",
        F.map_filter("fields", lambda k, _v: k != "component").alias("fields"),
    )


def resource_latest(samples: DataFrame, keep: int = 200, chart: int = 180) -> DataFrame:
    """The charted tail of the kept samples; the newest row is the summary.

    Samples that are not numbers count as 0.
    """
    tail = min(keep, chart)
    percents = {
        c: F.when(F.isnan(c) | F.col(c).isNull(), 0.0).otherwise(F.col(c))
        for c in ("cpu_percent", "memory_percent", "disk_percent")
    }
    top = latest(samples, tail).withColumns(percents)
    newest = F.max(F.struct("ts_ms", "event_id")).over(Window.partitionBy(F.lit(1)))
    return top.withColumn("is_summary", F.struct("ts_ms", "event_id") == newest)


def upload_stats(writes: DataFrame) -> DataFrame:
    """Throughput of each write, where its duration is known."""
    rate = F.when(F.col("duration_ms") > 0, F.round(F.col("bytes") / (F.col("duration_ms") / 1000.0), 6))
    return writes.withColumn("bytes_per_sec", rate)
