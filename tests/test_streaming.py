import pytest
from pyspark.sql import functions as F

from mdlake.operators import batching, quarantine, telemetry
from mdlake.operators.batching import Limits
from mdlake.plans import fixtures as fx
from mdlake.plans import queries
from mdlake.sources import landing
from mdlake.streaming import jobs, stateful


def stream(spark, path):
    """Read the files one per micro-batch, oldest rows first."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def collect(spark, df, name, tmp_path, mode="append"):
    query = (
        df.writeStream.format("memory").queryName(name).outputMode(mode)
        .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.table(name)


@pytest.fixture(scope="module")
def oi_messages(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("messages") / "oi")
    headers = queries.oi_headers(spark, sf_dir).coalesce(1).sortWithinPartitions("ts_ms", "id")
    # One file per week, written in order so that they are read in order.
    for week in range(5):
        low, high = (1704067200000 + w * 7 * 86_400_000 for w in (week, week + 1))
        headers.filter((F.col("ts_ms") >= low) & (F.col("ts_ms") < high)).write.mode("append").parquet(path)
    return path


def test_table_job_equals_batch(spark, sf_dir, tmp_path):
    raw = fx.oi_messages(spark, sf_dir).select([F.col(f.name) if f.name != "message_type" else F.lit(None).cast("string").alias("message_type") for f in landing.RAW_SCHEMA])
    path = str(tmp_path / "landing")
    raw.repartition(4).write.partitionBy("feed").parquet(path)
    source = landing.stream_landing(spark, path, feed="foi", max_files_per_trigger=1)
    table, manifest = str(tmp_path / "table"), str(tmp_path / "manifest")
    rejects = str(tmp_path / "rejects")
    writer = jobs.table_writer(
        source, "foi", table, manifest, str(tmp_path / "checkpoint"), clock_ms=lambda n: n * 180_000, rejects_path=rejects
    )
    jobs.drain(writer)
    jobs.drain(writer)  # nothing new has landed
    want = jobs.published_rows(landing.scan_landing(spark, path, feed="foi"), "foi")
    got = spark.read.parquet(table)
    assert spark.read.parquet(manifest).select("commit_id").distinct().count() == 4
    columns = sorted(want.columns)

    def plain(df):
        return df.select([F.col(c).cast("string") for c in columns])

    assert plain(got).exceptAll(plain(want)).count() == 0 and got.count() == want.count()
    assert spark.read.parquet(manifest).agg(F.sum("record_count")).first()[0] == want.count()
    broken = quarantine.rejects(landing.scan_landing(spark, path, feed="foi"))
    kept = jobs.read_parts(spark, rejects).select(broken.columns)
    assert broken.count() > 0 and kept.exceptAll(broken).count() == 0 and kept.count() == broken.count()


@pytest.mark.parametrize("name, limits", [("rows", Limits(rows=10)), ("age", Limits(age_ms=6 * 3_600_000)), ("both", Limits(rows=5, age_ms=86_400_000)), ("idle", Limits(rows=7, idle_ms=7_200_000))])
def test_closed_batches_equal_the_batch_operator(spark, oi_messages, tmp_path, name, limits):
    closed = collect(spark, stateful.closed_batches(stream(spark, oi_messages), limits), f"closed_{name}", tmp_path)
    numbered = batching.number_batches(spark.read.parquet(oi_messages), limits)
    want = {(r["key"], r["batch_no"]): (r["messages"], r["record_count"], r["first_ms"], r["last_ms"]) for r in batching.batch_sizes(numbered).collect()}
    rows = closed.collect()
    got = {(r["key"], r["batch_no"]): (r["messages"], r["record_count"], r["first_ms"], r["last_ms"]) for r in rows}
    assert len(rows) == len(got)
    assert got.items() <= want.items()
    # Only the batch each key was left with may still be open.
    last = {key: max(n for k, n in want if k == key) for key, _ in want}
    assert all(number == last[key] for key, number in want.keys() - got.keys())


def test_throttle_equals_the_batch_operator(spark, sf_dir, tmp_path):
    events = telemetry.metric_datums(telemetry.metric_events(fx.metric_rows(spark, sf_dir))).select(
        F.col("series").alias("key"), "ts_ms", F.col("event_id").alias("id")
    )
    path = str(tmp_path / "events")
    begin = events.agg(F.min("ts_ms")).first()[0]
    for part in range(3):
        at = F.col("ts_ms") - begin
        chosen = events.filter((at >= part * 900_000) & (at < (part + 1) * 900_000))
        chosen.coalesce(1).write.mode("append").parquet(path)
    published = collect(spark, stateful.throttled(stream(spark, path)), "published", tmp_path)
    want = batching.throttle(spark.read.parquet(path))
    assert want.count() > 0 and published.exceptAll(want.select("key", "ts_ms", "id")).count() == 0
    assert published.count() == want.count()


def test_late_and_early_messages_are_in_one_batch_each(spark, tmp_path):
    """Files out of time order over two keys: every message ends up in exactly one batch."""
    path = str(tmp_path / "messages")
    schema = "key STRING, ts_ms BIGINT, id BIGINT, rows BIGINT"
    files = [[("a", t, i, 1) for i, t in enumerate((100_000, 100_001, 100_003))], [("b", 60_000, 10, 1), ("b", 60_001, 11, 1)], [("a", 50_000, 20, 1), ("b", 10, 21, 1), ("a", 100_004, 22, 1)], [("b", 60_002, 30, 1)]]
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    closed = collect(spark, stateful.closed_batches(stream(spark, path), Limits(rows=2, age_ms=3_600_000)), "late", tmp_path)
    left = stateful.open_batches(spark, str(tmp_path / "checkpoint"))
    every = closed.unionByName(left).collect()
    sizes = {}
    for r in every:
        sizes.setdefault(r["key"], []).append((r["batch_no"], r["messages"]))
    assert {k: sum(n for _, n in v) for k, v in sizes.items()} == {"a": 5, "b": 4}
    assert all(len({b for b, _ in v}) == len(v) for v in sizes.values())
    assert [n for _, n in sorted(sizes["a"])] == [2, 2, 1] and [n for _, n in sorted(sizes["b"])] == [2, 2]


def test_drained_stream_equals_the_batch_operator(spark, oi_messages, tmp_path):
    limits = Limits(rows=10)
    closed = collect(spark, stateful.closed_batches(stream(spark, oi_messages), limits), "drained", tmp_path)
    columns = ["key", "batch_no", "messages", "record_count", "first_ms", "last_ms"]
    got = closed.select(columns).unionByName(stateful.open_batches(spark, str(tmp_path / "checkpoint")).select(columns))
    want = batching.batch_sizes(batching.number_batches(spark.read.parquet(oi_messages), limits)).select(columns)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_rollup_counts_late_events(spark, sf_dir, tmp_path):
    path, parts = str(tmp_path / "metrics"), str(tmp_path / "parts")
    rows = fx.metric_rows(spark, sf_dir)
    for chosen in (F.col("event_id") % 2 == 1, F.col("event_id") % 2 == 0):  # the second file is late throughout
        rows.filter(chosen).coalesce(1).write.mode("append").parquet(path)
    jobs.drain(jobs.rollup_writer(stream(spark, path), parts, str(tmp_path / "checkpoint")))
    want = telemetry.rollup_60s(telemetry.metric_events(rows))
    got = jobs.rollup_60s(spark, parts)
    assert want.count() > 0 and got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_sessions_count_late_messages(spark, oi_messages, tmp_path):
    parts, hour = str(tmp_path / "parts"), 3_600_000
    jobs.drain(jobs.gap_writer(stream(spark, oi_messages), parts, str(tmp_path / "checkpoint"), hour))
    want = batching.gap_batches(spark.read.parquet(oi_messages), hour)
    got = jobs.gap_batches(spark, parts, hour).select(want.columns)
    assert want.count() > 0 and got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_live_counters(spark, oi_messages, tmp_path):
    rows = stream(spark, oi_messages).withColumn("exchange", F.substring_index("key", "_", 1))
    query = (
        jobs.counted(rows, "norm_sent").writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    counts = [p["observedMetrics"]["norm_sent"]["rows"] for p in query.recentProgress if p["observedMetrics"]]
    assert sum(counts) == spark.read.parquet(oi_messages).count()
    assert sum(p["records"] for p in jobs.progress_rows(query)) == sum(counts)
