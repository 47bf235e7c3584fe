"""File manifest, snapshot log and as-of reads, kept as ordinary tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date, timedelta

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mdlake.operators.tables import TABLE_KEYS, write_table

# Fixed value: manifest status of a file that was added.
ADDED = 1

COMMIT = "commit_id"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # folder of a null


MANIFEST = (
    "path STRING, file_size BIGINT, record_count BIGINT, partition MAP<STRING, STRING>, snapshot_ms BIGINT, status INT, "
    f"{COMMIT} BIGINT"
)


def logical_manifest(rows: DataFrame, ms: str) -> DataFrame:
    """One row per logical file of laid-out rows, with its row count."""
    return (
        rows.groupBy("exchange", "market", "symbol", "folder", "file")
        .agg(F.count(F.lit(1)).alias("record_count"), F.max(ms).alias("snapshot_ms"))
        .withColumn("status", F.lit(ADDED))
    )


def as_declared(schema: T.StructType, layout: Sequence[str]) -> T.StructType:
    """The schema with its layout columns as text: folder names are not guessed at."""
    return T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in layout else f.dataType, f.nullable) for f in schema]
    )


def _between(low: str, high: str) -> list[str]:
    """The folder values from ``low`` to ``high``, or a star where they cannot be listed."""
    if low == high:
        return [low]
    if low.isdigit() and high.isdigit() and len(low) == len(high):
        return [str(n).zfill(len(low)) for n in range(int(low), int(high) + 1)]
    try:
        first, last = date.fromisoformat(low), date.fromisoformat(high)
    except ValueError:
        return ["*"]
    return [(first + timedelta(days=n)).isoformat() for n in range((last - first).days + 1)]


def _folders(keys: Sequence[str], spans: dict[str, tuple[str | None, str | None, bool]]) -> str:
    """A path pattern of the folders that rows with these first and last values, or nulls, fall in."""
    levels = [f"{k}=*" for k in keys]
    for name, (low, high, nulls) in spans.items():
        values = (_between(low, high) if low is not None else []) + ([NO_VALUE] if nulls else [])
        levels.append(f"{name}=*" if "*" in values or len(values) > 366 else f"{name}={{{','.join(values)}}}")
    return "/".join(levels)


def file_manifest(
    spark: SparkSession, table_path: str, folders: str, basename: str, layout: Sequence[str], commit_id: int, commit_ms: int
) -> DataFrame:
    """One row per physical file of a commit, from file metadata.

    Only ``folders`` are listed, and of the files in them only those of the
    commit, by name.  The scan has no data column, so Spark takes the record
    counts from the files' footers.
    """
    scan = spark.read.option("basePath", table_path).option("pathGlobFilter", f"{basename}-*")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in layout])
    files = scan.schema(schema).parquet(f"{table_path}/{folders}")
    # The path as a reader takes it: metadata gives it in the encoding of addresses.
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    pairs = [x for c in layout for x in (F.lit(c), F.col(c))]
    return (
        files.select(path.alias("path"), "_metadata.file_size", *layout)
        .groupBy("path", "file_size", *layout)
        .agg(F.count(F.lit(1)).alias("record_count"))
        .select(
            "path",
            "file_size",
            "record_count",
            F.create_map(*pairs).alias("partition"),
            F.lit(commit_ms).cast("bigint").alias("snapshot_ms"),
            F.lit(ADDED).alias("status"),
            F.lit(commit_id).cast("bigint").alias(COMMIT),
        )
    )


def _observed(observation: Observation) -> dict | None:
    """What a write observed.

    Nothing where Spark found at run time that no rows come: it then drops the
    observation with the rest of the plan, and asking for it fails.
    """
    try:
        return observation.get
    except Py4JJavaError:
        return None


def commit_rows(
    rows: DataFrame,
    table_path: str,
    manifest_path: str,
    commit_id: int,
    commit_ms: int,
    codec: str = "snappy",
    keys: Sequence[str] = TABLE_KEYS,
    time: Sequence[str] = ("date",),
) -> None:
    """Write one commit of a table in ``keys`` and ``time`` folders, and its manifest rows.

    The commit is named in its files, not in a folder, and each attempt has a
    name of its own.  The manifest rows of a commit replace those of an earlier
    attempt, so a batch that is retried after a failure leaves neither
    duplicates nor missing files in the table; what a failed attempt wrote is in
    no manifest (``unlisted_files``).
    """
    basename = f"c{commit_id}-{uuid.uuid4().hex[:12]}"
    written = Observation()
    spans = [x for c in time for x in (F.min(c).alias(f"low_{c}"), F.max(c).alias(f"high_{c}"), F.count_if(F.col(c).isNull()).alias(f"null_{c}"))]
    counted = rows.observe(written, F.count(F.lit(1)).alias("rows"), *spans)
    layout = [*keys, *time]
    write_table(counted, table_path, layout, codec, basename=basename)
    found = _observed(written)
    manifest = rows.sparkSession.createDataFrame([], MANIFEST)
    if found and found["rows"]:
        folders = _folders(keys, {c: (found[f"low_{c}"], found[f"high_{c}"], found[f"null_{c}"] > 0) for c in time})
        manifest = file_manifest(rows.sparkSession, table_path, folders, basename, layout, commit_id, commit_ms)
    manifest.drop(COMMIT).write.mode("overwrite").parquet(f"{manifest_path}/{COMMIT}={commit_id}")


def read_manifest(spark: SparkSession, manifest_path: str) -> DataFrame:
    """The files of every commit; ``path`` is found nowhere else."""
    return spark.read.schema(MANIFEST).option("basePath", manifest_path).parquet(manifest_path)


def unlisted_files(spark: SparkSession, table_path: str, manifest: DataFrame) -> DataFrame:
    """Paths of the table that no commit lists, left by attempts that failed."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(table_path)
    plain = lambda c: F.regexp_replace(c, "^file:/*", "/")
    return files.select(plain("path").alias("path")).join(manifest.select(plain("path").alias("path")), "path", "left_anti")


def snapshot_log(manifest: DataFrame) -> DataFrame:
    """One row per commit.

    An id is the commit time in nanoseconds plus the commit's number in its last
    six digits: commits of one millisecond follow each other, and a late one
    changes no id that is known already.
    """
    key = ["timestamp_ms", *([COMMIT] if COMMIT in manifest.columns else [])]
    number = F.pmod(F.col(COMMIT), F.lit(1_000_000)) if COMMIT in manifest.columns else F.lit(0)
    return (
        manifest.withColumnRenamed("snapshot_ms", "timestamp_ms")
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("files"), F.sum("record_count").alias("records"))
        .withColumn("snapshot_id", F.col("timestamp_ms") * 1_000_000 + number)
        .select("snapshot_id", "timestamp_ms", "files", "records")
    )


def current_snapshot(log: DataFrame) -> DataFrame:
    return log.agg(F.max("snapshot_id").alias("current_snapshot_id"))


def files_as_of(manifest: DataFrame, as_of_ms: int) -> DataFrame:
    """Files of every commit at or before a time."""
    return manifest.filter(F.col("snapshot_ms") <= as_of_ms)


def read_as_of(
    spark: SparkSession, table_path: str, manifest_path: str, as_of_ms: int, where: Column | None = None
) -> DataFrame:
    """The table as it stood at a time: a scan of just the files the manifest lists.

    ``where`` is a condition on the manifest's ``partition``, so that files are
    left out before the scan is planned.  Like any scan's, the file list is held
    by the driver; folders are not listed.
    """
    live = files_as_of(read_manifest(spark, manifest_path), as_of_ms)
    live = live.filter(where) if where is not None else live
    files = [r.path for r in live.select("path").collect()]
    base = spark.read.option("basePath", table_path)
    if not files:
        return base.parquet(table_path).limit(0)
    layout = list(live.select(F.map_keys("partition").alias("names")).first().names)
    schema = as_declared(base.parquet(files[0]).schema, layout)
    return spark.read.schema(schema).option("basePath", table_path).parquet(*files)


def catalog_entries(manifest: DataFrame, bucket: str, prefix: str = "") -> DataFrame:
    """(name, metadata_location) of every table that the manifest has files of."""
    location = F.concat(F.lit(f"s3://{bucket}/{prefix}"), F.col("table"), F.lit("/metadata/metadata.json"))
    return manifest.select("table").distinct().select(F.col("table").alias("name"), location.alias("metadata_location"))


def register_table(spark: SparkSession, name: str, location: str, partitioned: bool = True) -> DataFrame:
    """Catalogue entry: an external table over a written location."""
    spark.catalog.createTable(name, path=location, source="parquet")
    if partitioned:
        spark.catalog.recoverPartitions(name)
    return spark.table(name)
