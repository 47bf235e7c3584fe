"""Published tables: column sets, physical types, layout and writing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mdlake.functions import clock, paths

# Columns of each published table, in order.
SNAPSHOT_COLUMNS = ["exchange", "symbol", "timestamp", "last_update_id", "side", "price", "quantity", "level"]
DELTA_COLUMNS = [
    "symbol", "event_time", "update_id", "prev_update_id", "first_update_id", "side", "price", "quantity", "received_time",
]
OPEN_INTEREST_COLUMNS = ["exchange", "market", "symbol", "event_time", "open_interest", "received_time"]
PREMIUM_INDEX_COLUMNS = [
    "exchange", "market", "symbol", "event_time", "mark_price", "index_price", "estimated_settle_price",
    "funding_rate", "next_funding_time", "premium_index", "received_time",
]
LIQUIDATION_COLUMNS = [
    "exchange", "symbol", "side", "position_side", "order_type", "time_millis", "quantity", "price", "avg_price",
    "last_qty", "last_price", "trade_id", "is_maker", "is_reduce_only", "working_type", "original_type", "close_all",
    "realized_pnl",
]


def snapshot_valid_filter(levels: DataFrame) -> DataFrame:
    """Rows that carry a time, a side, a level, a price and a quantity."""
    return levels.filter(
        F.col("ts_ms").isNotNull()
        & (F.col("ts_ms") != clock.ABSENT_TIME_MS)
        & (F.col("price") != 0)
        & (F.col("quantity") != 0)
        & (F.col("side") != "")
        & (F.col("level") != 0)
    )


def _with_extra(rows: DataFrame, columns: dict[str, Column], extra: Sequence[str]) -> DataFrame:
    """The table's columns, then the partition columns it does not have."""
    more = [F.col(c) for c in extra if c not in columns]
    return rows.select(*[value.alias(name) for name, value in columns.items()], *more)


def _plain(*names: str) -> dict[str, Column]:
    return {n: F.col(n) for n in names}


def snapshot_table(levels: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Level rows to the snapshot table; the time stays BIGINT milliseconds.

    ``extra`` names partition columns to add, here and in the other tables.
    """
    columns = _plain("exchange", "symbol", "last_update_id", "side", "price", "quantity")
    columns |= {"timestamp": F.col("ts_ms"), "level": F.col("level").cast("int")}
    return _with_extra(snapshot_valid_filter(levels), {c: columns[c] for c in SNAPSHOT_COLUMNS}, extra)


def _two_times() -> dict[str, Column]:
    return {c: F.timestamp_millis(c) for c in ("event_time", "received_time")}


def delta_table(updates: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Updates to the delta table; both times become TIMESTAMP."""
    return _with_extra(updates, _plain(*DELTA_COLUMNS) | _two_times(), extra)


def open_interest_table(readings: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    columns = _plain(*OPEN_INTEREST_COLUMNS) | _two_times() | {"exchange": F.lower("exchange")}
    return _with_extra(readings, columns, extra)


def premium_index_table(readings: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Readings to the premium table.

    ``next_funding_time`` stays BIGINT; an absent one is stored as the epoch ms
    of year 1, the value existing readers of the table test for.
    """
    absent = F.lit(clock.ABSENT_TIME_MS).cast("bigint")
    columns = _plain(*PREMIUM_INDEX_COLUMNS) | _two_times()
    columns |= {"exchange": F.lower("exchange"), "next_funding_time": F.coalesce(F.col("next_funding_time"), absent)}
    return _with_extra(readings, columns, extra)


def liquidation_table(rows: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    columns = _plain(*LIQUIDATION_COLUMNS) | {"time_millis": F.timestamp_millis("time_ms")}
    return _with_extra(rows.filter(F.col("exchange") != ""), columns, extra)


# --- layout -----------------------------------------------------------------

FEED_TAG = {"fobs": "fobs", "fobd": "fobd", "foi": "foi", "pi": "pi"}


def with_layout(rows: DataFrame, feed: str, ms: str, template: str = paths.DEFAULT_TIME_TEMPLATE) -> DataFrame:
    """Add the partition folder and the logical file name of every row.

    Indicator feeds write the exchange in lower and the symbol in upper case.
    """
    cased = feed in ("foi", "pi")
    exchange = F.lower("exchange") if cased else F.col("exchange")
    symbol = F.upper("symbol") if cased else F.col("symbol")
    return rows.withColumns(
        {
            "folder": paths.partition_path(
                F.col("exchange"), F.col("market"), F.col("symbol"), F.col(ms),
                template=template, lower_exchange=cased, upper_symbol=cased,
            ),
            "file": paths.file_name(exchange, FEED_TAG[feed], symbol, F.col(ms)),
        }
    )


def batch_key(exchange: Column, market: Column, symbol: Column, style: str = "processor") -> Column:
    """The key one buffer holds.

    ``processor`` joins with ``_``; ``writer`` joins with ``|``; ``indicator``
    also trims and fixes the letter case.
    """
    if style == "processor":
        return F.concat_ws("_", exchange, market, symbol)
    if style == "writer":
        return F.concat_ws("|", exchange, market, symbol)
    return F.concat_ws("|", F.lower(F.trim(exchange)), F.lower(F.trim(market)), F.upper(F.trim(symbol)))


def codec_of(table: Column, configured: Column) -> Column:
    """``select_codec`` as a column; null where this Spark build has no such codec."""
    name = F.lower(configured)
    own = F.when(configured == "lzo", F.lit(None).cast("string")).otherwise(
        F.when(configured.isin("snappy", "gzip"), configured).otherwise("none")
    )
    other = F.when(name.isin("gzip", "snappy"), name).when(name == "", "snappy").otherwise("none")
    return F.when(table.isin("delta", "liquidation"), "snappy").when(table == "snapshot", own).otherwise(other)


def select_codec(table: str, configured: str) -> str:
    """Parquet compression of a table for a configured name."""
    if table in ("delta", "liquidation"):
        return "snappy"
    if table == "snapshot":
        if configured == "lzo":
            raise ValueError("parquet compression 'lzo' is not available in this Spark build")
        return configured if configured in ("snappy", "gzip") else "none"
    name = configured.lower()
    return {"gzip": "gzip", "snappy": "snappy", "": "snappy"}.get(name, "none")


# --- writing ----------------------------------------------------------------

MILLIS_CONF = "spark.sql.parquet.outputTimestampType"


def write_table(
    rows: DataFrame,
    path: str,
    partition_columns: list[str],
    codec: str = "snappy",
    mode: str = "append",
    max_records_per_file: int = 0,
    basename: str = "part",
) -> None:
    """Write Parquet under ``column=value`` folders.

    The rebalance hint lets Spark merge the small instruments of a write into
    few files and split a hot one over many tasks, both by measured size.
    File names begin with ``basename``.
    """
    conf = rows.sparkSession.conf
    before = conf.get(MILLIS_CONF)
    conf.set(MILLIS_CONF, "TIMESTAMP_MILLIS")
    try:
        (
            rows.hint("rebalance", *[F.col(c) for c in partition_columns])
            .write.mode(mode)
            .option("mapreduce.output.basename", basename)
            .option("compression", codec)
            .option("maxRecordsPerFile", max_records_per_file)
            .partitionBy(*partition_columns)
            .parquet(path)
        )
    finally:
        conf.set(MILLIS_CONF, before)


# Folders of the published tables by their rows' own time, and the keys above them.
HOURLY = "year={year}/month={month}/day={day}/hour={hour}"
TABLE_KEYS = ("exchange", "market", "symbol")
LIQUIDATION_KEYS = ("exchange",)


def with_time_folders(rows: DataFrame, ms: str, template: str = paths.DEFAULT_TIME_TEMPLATE) -> DataFrame:
    """A text column for each folder of the template, from each row's own time."""
    return rows.withColumns({name: paths.time_path(F.col(ms), pattern) for name, pattern in paths.time_folders(template).items()})


def with_event_hour(rows: DataFrame, ms: str) -> DataFrame:
    """Year, month, day and hour folders of each row's own event time."""
    return with_time_folders(rows, ms, HOURLY)
