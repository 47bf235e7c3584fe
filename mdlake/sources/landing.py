"""The raw landing table: one row per message exactly as a venue sent it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FEEDS = ("fobs", "fobd", "foi", "pi", "liq")
VENUES = ("binance", "bybit", "kucoin", "okx")

RAW_SCHEMA = T.StructType(
    [
        T.StructField("feed", T.StringType()),
        T.StructField("exchange", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("market", T.StringType()),
        T.StructField("data", T.StringType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("message_type", T.StringType()),
    ]
)


def scan_landing(spark: SparkSession, path: str, fmt: str = "parquet", feed: str | None = None) -> DataFrame:
    """Batch read with the declared schema; ``feed`` prunes the partition."""
    raw = spark.read.schema(RAW_SCHEMA).format(fmt).load(path)
    return raw if feed is None else raw.filter(F.col("feed") == feed)


def stream_landing(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    feed: str | None = None,
    max_files_per_trigger: int = 1000,
) -> DataFrame:
    """Streaming read of the same table; the file cap is the intake limit."""
    raw = (
        spark.readStream.schema(RAW_SCHEMA)
        .format(fmt)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(path)
    )
    return raw if feed is None else raw.filter(F.col("feed") == feed)


def from_venues(raw: DataFrame, venues: Sequence[str] = VENUES) -> DataFrame:
    """The messages of some venues of one landing table, in one scan."""
    return raw.filter(F.col("exchange").isin(*venues))


def fan_in(*sources: DataFrame) -> DataFrame:
    """Tables of several sources as one: union all, no dedup, no order."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)


def market_tag(exchange: Column, feed: Column) -> Column:
    """The market label of a venue and feed."""
    kind = F.when(exchange == "okx", "swap").otherwise("future")
    return (
        F.when(feed == "fobs", F.concat(kind, F.lit("-orderbook-snapshot")))
        .when(feed == "fobd", F.concat(kind, F.lit("-orderbook-delta")))
        .when(feed == "foi", F.lit("future-openinterest"))
        .when(feed == "pi", F.lit("pi"))
        .when(feed == "liq", F.lit("liquidation"))
    )
