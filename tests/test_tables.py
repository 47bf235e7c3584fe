import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from mdlake.operators import catalog, tables
from mdlake.plans import fixtures as fx
from mdlake.streaming import jobs


@pytest.fixture(scope="module")
def oi_raw(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("landing") / "foi")
    fx.oi_messages(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def paths(tmp_path):
    return str(tmp_path / "table"), str(tmp_path / "manifest")


def test_commits_manifest_and_time_travel(spark, oi_raw, tmp_path):
    table, manifest = paths(tmp_path)
    early = jobs.published_rows(oi_raw.filter("message_id < 500"), "foi")
    late = jobs.published_rows(oi_raw.filter("message_id >= 500"), "foi")
    catalog.commit_rows(early, table, manifest, 0, 1000)
    catalog.commit_rows(late, table, manifest, 1, 2000)
    catalog.commit_rows(late, table, manifest, 1, 2000)  # replayed after a failure

    listed = catalog.read_manifest(spark, manifest)
    assert listed.agg(F.sum("record_count")).first()[0] == early.count() + late.count()
    assert listed.filter("file_size <= 0 OR status <> 1").count() == 0
    assert set(listed.first()["partition"]) == {"exchange", "market", "symbol", "date"}
    log = catalog.snapshot_log(listed)
    assert sorted((r["snapshot_id"], r["timestamp_ms"]) for r in log.collect()) == [(1000 * 10**6, 1000), (2000 * 10**6 + 1, 2000)]
    assert catalog.current_snapshot(log).first()[0] == 2000 * 10**6 + 1
    assert catalog.read_as_of(spark, table, manifest, 999).count() == 0
    assert catalog.read_as_of(spark, table, manifest, 1500).count() == early.count()
    assert catalog.read_as_of(spark, table, manifest, 2000).count() == early.count() + late.count()
    # The first attempt of commit 1 left files that no manifest lists.
    left = catalog.unlisted_files(spark, table, listed)
    assert left.count() > 0 and left.filter("path LIKE '%/c1-%'").count() == left.count()


def test_commits_of_one_millisecond_stay_apart(spark):
    rows = [("p", 1, 10, 5, 0), ("q", 1, 20, 5, 1), ("r", 1, 30, 6, 2)]
    manifest = spark.createDataFrame(rows, "path STRING, status INT, record_count BIGINT, snapshot_ms BIGINT, commit_id BIGINT")
    log = sorted((r["snapshot_id"], r["records"]) for r in catalog.snapshot_log(manifest).collect())
    assert log == [(5 * 10**6, 10), (5 * 10**6 + 1, 20), (6 * 10**6 + 2, 30)]


def test_as_of_read_scans_listed_files_only(spark, oi_raw, tmp_path):
    table, manifest = paths(tmp_path)
    for number in range(3):
        rows = jobs.published_rows(oi_raw.filter(F.col("message_id") % 3 == number), "foi")
        catalog.commit_rows(rows, table, manifest, number, number)
    names = [f.rsplit("/", 1)[-1] for f in catalog.read_as_of(spark, table, manifest, 0).inputFiles()]
    assert names and all(n.startswith("c0-") for n in names)
    okx = catalog.read_as_of(spark, table, manifest, 1, F.col("partition")["exchange"] == "okx")
    assert okx.count() > 0 and all("/exchange=okx/" in f for f in okx.inputFiles())


# The given messages lie hours apart: a written table has a file for nearly each of these.
FEW = "message_id % 31 = 0"


def test_template_folders_are_pruned(spark, sf_dir, tmp_path):
    """Liquidations lie in year, month, day and hour folders, any table in those of a template."""
    table, manifest = paths(tmp_path)
    rows = jobs.published_rows(fx.liq_messages(spark, sf_dir).filter(FEW), "liq")
    jobs.commit_feed(rows, "liq", table, manifest, 0, 5)
    back = catalog.read_as_of(spark, table, manifest, 5)
    one = back.select("year", "month", "day").first()
    some = back.filter((F.col("year") == one.year) & (F.col("month") == one.month) & (F.col("day") == one.day))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and back.count() == rows.count()
    other = str(tmp_path / "other"), str(tmp_path / "other_manifest")
    template = "dt={year}{month}{day}/hh={hour}"
    deltas = jobs.published_rows(fx.delta_messages(spark, sf_dir).filter(FEW), "fobd", template=template)
    jobs.commit_feed(deltas, "fobd", *other, 0, 0, template=template)
    found = catalog.read_as_of(spark, *other, 0)
    assert found.count() == deltas.count() and {"dt", "hh"} < set(found.columns)


def test_empty_commit_and_null_time(spark, oi_raw, tmp_path):
    table, manifest = paths(tmp_path)
    rows = jobs.published_rows(oi_raw, "foi")
    catalog.commit_rows(rows.withColumn("date", F.lit(None).cast("string")), table, manifest, 0, 0)
    catalog.commit_rows(rows.limit(0), table, manifest, 1, 1)
    assert catalog.read_as_of(spark, table, manifest, 1).filter("date IS NULL").count() == rows.count()


@pytest.mark.parametrize(
    "feed, make, in_path",
    [("fobs", "book_messages", ["market"]), ("fobd", "delta_messages", ["exchange", "market"]), ("pi", "pi_messages", []), ("liq", "liq_messages", [])],
)
def test_written_tables(spark, sf_dir, tmp_path, feed, make, in_path):
    raw = getattr(fx, make)(spark, sf_dir).filter(FEW)
    table, manifest = paths(tmp_path)
    rows = jobs.published_rows(raw, feed)
    jobs.commit_feed(rows, feed, table, manifest, 0, 0)
    back = spark.read.parquet(table)
    assert back.count() == rows.count()
    assert set(back.columns) == set(rows.columns)
    some_file = spark.read.parquet(manifest).first()["path"].removeprefix("file://").removeprefix("file:")
    physical = pq.ParquetFile(some_file)
    types = {f.name: str(f.logical_type) for f in physical.schema}
    for name in ("event_time", "received_time", "time_millis"):
        if name in types:
            assert "timeUnit=milliseconds" in types[name]
    assert physical.metadata.row_group(0).column(0).compression == "SNAPPY"


def test_partition_folders_follow_event_time(spark, oi_raw, tmp_path):
    table, manifest = paths(tmp_path)
    catalog.commit_rows(jobs.published_rows(oi_raw, "foi"), table, manifest, 0, 0)
    rows = spark.read.parquet(table)
    wrong = rows.filter(F.to_date(F.to_utc_timestamp("received_time", F.current_timezone())) != F.col("date").cast("date"))
    assert wrong.count() == 0


def test_event_hour_columns(spark):
    row = tables.with_event_hour(spark.range(1).select(F.lit(1_754_400_305_000).alias("ms")), "ms").first()
    assert (row["year"], row["month"], row["day"], row["hour"]) == ("2025", "08", "05", "13")


def test_catalogue_entry(spark, oi_raw, tmp_path):
    table, manifest = paths(tmp_path)
    rows = jobs.published_rows(oi_raw, "foi")
    catalog.commit_rows(rows, table, manifest, 0, 0)
    try:
        assert catalog.register_table(spark, "oi_entry", table).count() == rows.count()
    finally:
        spark.sql("DROP TABLE IF EXISTS oi_entry")


def test_codecs():
    assert [tables.select_codec("snapshot", c) for c in ("snappy", "gzip", "", "zstd")] == ["snappy", "gzip", "none", "none"]
    assert [tables.select_codec("open_interest", c) for c in ("GZIP", "", "brotli")] == ["gzip", "snappy", "none"]
    assert tables.select_codec("delta", "gzip") == tables.select_codec("liquidation", "") == "snappy"
    with pytest.raises(ValueError):
        tables.select_codec("snapshot", "lzo")
