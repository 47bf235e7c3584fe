"""One named query per operator, each over whole tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mdlake.functions import clock, paths
from mdlake.functions.parsing import parse_or_zero, parse_strict
from mdlake.functions.symbols import canonical_symbol
from mdlake.operators import batching, books, catalog, deltas, flushing, indicators, liquidations, quarantine, tables, telemetry, usage
from mdlake.plans import fixtures as fx
from mdlake.sources import frames, landing, universe
from mdlake.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the named queries; the oracles use the same numbers.
COUNT_ROWS = 40
MONTH_MS = 30 * clock.DAY_MS
AS_OF_MS = 1705276800000


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _text(levels: str) -> Column:
    """Level arrays as one text, for comparison."""
    return F.array_join(F.transform(F.col(levels), lambda v: F.array_join(v, "@")), ";").alias(levels)


def _typed_text(levels: str) -> Column:
    def number(x: Column) -> Column:
        return x.cast("decimal(18,2)").cast("string")

    return F.array_join(
        F.transform(F.col(levels), lambda v: F.concat(number(v["price"]), F.lit("@"), number(v["quantity"]))), ";"
    ).alias(levels)


def _ms(column: str) -> Column:
    return F.unix_millis(column).alias(column)


def _or_minus_one(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(-1)).alias(column)


# --- sources and routing ------------------------------------------------------


@query
def raw_landing_scan(spark: SparkSession, sf: str) -> DataFrame:
    feeds = [
        fx.book_messages(spark, sf),
        fx.delta_messages(spark, sf),
        fx.oi_messages(spark, sf),
        fx.pi_messages(spark, sf),
        fx.liq_messages(spark, sf),
    ]
    path = _folder(spark, "landing")
    columns = [F.col(f.name).cast(f.dataType) for f in landing.RAW_SCHEMA]
    landing.fan_in(*feeds).select(*columns).write.partitionBy("feed").parquet(path)
    raw = landing.scan_landing(spark, path)
    ms = clock.epoch_ms(F.col("ts"))
    return raw.groupBy("feed", "exchange", "market").agg(
        F.count(F.lit(1)).alias("messages"),
        F.min(ms).alias("first_ms"),
        F.max(ms).alias("last_ms"),
    )


@query
def feed_fan_in(spark: SparkSession, sf: str) -> DataFrame:
    return landing.from_venues(fx.oi_messages(spark, sf)).groupBy("exchange", "symbol").agg(
        F.count(F.lit(1)).alias("messages"), F.sum("message_id").alias("id_sum")
    )


@query
def market_tag(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.stage_rows(spark, sf).select(
        fx.venue_of(F.col("event_id")).alias("exchange"), "feed"
    )
    tag = landing.market_tag(F.col("exchange"), F.col("feed")).alias("market")
    return rows.groupBy("exchange", "feed", tag).agg(F.count(F.lit(1)).alias("n"))


@query
def control_frame_filter(spark: SparkSession, sf: str) -> DataFrame:
    return frames.keep_data_frames(fx.frame_messages(spark, sf)).select("message_id", "exchange", "feed")


@query
def topic_symbol(spark: SparkSession, sf: str) -> DataFrame:
    deltas_of = (F.col("feed") == "fobd") & F.col("exchange").isin("bybit", "kucoin")
    kept = frames.data_topics(fx.frame_messages(spark, sf).filter(deltas_of), keep=["message_id"])
    return kept.select("message_id", "exchange", frames.topic_symbol(F.col("exchange"), F.col("topic")).alias("symbol"))


@query
def instrument_validate(spark: SparkSession, sf: str) -> DataFrame:
    flagged = universe.flag_instruments(fx.requested_symbols(spark, sf), fx.instrument_rows(spark, sf))
    return flagged.groupBy("exchange", "symbol", "listed").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("k_sum"))


@query
def ticker_symbol_filter(spark: SparkSession, sf: str) -> DataFrame:
    readings = indicators.decode_oi(fx.oi_messages(spark, sf), keep=["message_id"]).filter(F.col("exchange") == "bybit")
    lower = readings.withColumn("symbol", F.lower("symbol"))
    configured = universe.symbol_universe(fx.allocation_rows(spark, sf)).filter(F.col("exchange") == "bybit")
    return universe.keep_tickers(lower, configured).select("message_id", "symbol", "oi_text")


@query
def poll_grid(spark: SparkSession, sf: str) -> DataFrame:
    """The book of each instrument at the end of every interval."""
    picked = books.poll_snapshots(fx.book_messages(spark, sf), 7 * clock.DAY_MS)
    return books.nested_snapshot(picked, keep=["bucket_ms", "polls"]).select(
        "bucket_ms", "polls", "exchange", "market_type", "symbol", "timestamp_ms", "last_update_id", _typed_text("bids"), _typed_text("asks")
    )


@query
def poll_overrun(spark: SparkSession, sf: str) -> DataFrame:
    return frames.poll_overrun(fx.header_rows(spark, sf)).select("event_id", "exchange", "duration_ms", "interval_ms")


# --- decoders -----------------------------------------------------------------


def _decoded_books(spark: SparkSession, sf: str, venue: str) -> DataFrame:
    raw = fx.book_messages(spark, sf).filter(F.col("exchange") == venue)
    return books.decode_books(raw).select(
        "exchange", "symbol", "market", "ts_ms", "last_update_id",
        F.size("bids").alias("n_bids"), F.size("asks").alias("n_asks"), _text("bids"), _text("asks"),
    )


def _decoded_deltas(spark: SparkSession, sf: str, venue: str) -> DataFrame:
    raw = fx.delta_messages(spark, sf).filter(F.col("exchange") == venue)
    return deltas.decode_deltas(raw).select(
        "exchange", "market", "symbol", "received_time", "event_time", "update_id", "prev_update_id", "first_update_id",
        F.size("bids").alias("n_bids"), F.size("asks").alias("n_asks"), _text("bids"), _text("asks"),
    )


def _decoded_oi(spark: SparkSession, sf: str, venue: str) -> DataFrame:
    return indicators.decode_oi(fx.oi_messages(spark, sf).filter(F.col("exchange") == venue))


def _decoded_pi(spark: SparkSession, sf: str, venue: str) -> DataFrame:
    rows = indicators.decode_pi(fx.pi_messages(spark, sf).filter(F.col("exchange") == venue))
    return rows.withColumn("next_funding_time", _or_minus_one("next_funding_time"))


for _venue in landing.VENUES:
    for _feed, _decoder in (
        ("book", _decoded_books),
        ("delta", _decoded_deltas),
        ("oi", _decoded_oi),
        ("pi", _decoded_pi),
    ):
        QUERIES[f"decode_{_feed}_{_venue}"] = lambda spark, sf, d=_decoder, v=_venue: d(spark, sf, v)


@query
def decode_liq_kucoin(spark: SparkSession, sf: str) -> DataFrame:
    return liquidations.kucoin_liquidations(fx.liq_messages(spark, sf)).drop("data")


@query
def liq_kucoin_filter(spark: SparkSession, sf: str) -> DataFrame:
    configured = universe.symbol_universe(fx.allocation_rows(spark, sf)).filter(F.col("exchange") == "kucoin")
    return liquidations.kucoin_liquidations(fx.liq_messages(spark, sf), configured).select("symbol", "topic", "ts_ms")


@query
def epoch_unit_infer(spark: SparkSession, sf: str) -> DataFrame:
    k, ms = F.col("event_id"), F.col("ms")
    raw = (
        F.when(k % 5 == 0, -(k % 2))
        .when(k % 5 == 1, F.call_function("div", ms, F.lit(1000)))
        .when(k % 5 == 2, ms)
        .when(k % 5 == 3, ms * 1_000_000 + 123_456)
        .otherwise(ms * 1000)
    )
    rows = fx.header_rows(spark, sf).select("event_id", "ms", raw.alias("raw"))
    return rows.select("event_id", "raw", clock.infer_epoch_ms(F.col("raw"), ms).alias("ts_ms"))


@query
def payload_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    feeds = [fx.book_messages, fx.delta_messages, fx.oi_messages, fx.pi_messages, fx.liq_messages]
    raw = landing.fan_in(*[f(spark, sf) for f in feeds])
    return quarantine.rejects(raw, keep=["message_id"]).select("feed", "exchange", "message_id")


# --- normalisers and scalar functions -------------------------------------------


@query
def canonical_symbol_map(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_id")
    venues = ["binance", "BYBIT", "kucoin", "okx", "coinbase", "kraken", "other"]
    symbols = ["1000BONKUSDT", "SHIB1000USDT", "XBT-USDTM", "BTC-USDT-SWAP", "BTC/USD-PERP", "ethPERPM", "1000SHIBUSDT", "SWAP-XBTMM"]
    rows = fx.header_rows(spark, sf).select(
        "event_id", fx.pick(k % 7, venues).alias("exchange"), fx.pick(k % 8, symbols).alias("symbol")
    )
    once = canonical_symbol(F.col("exchange"), F.col("symbol"))
    return rows.groupBy("exchange", "symbol", once.alias("canonical")).agg(F.count(F.lit(1)).alias("n"))


QUERIES["canonical_symbol"] = QUERIES.pop("canonical_symbol_map")


def _number_texts(spark: SparkSession, sf: str) -> DataFrame:
    k, v = F.col("k"), F.col("v")
    shapes = [
        v, F.concat(F.lit("+"), v), F.concat(F.lit("-"), v), F.concat(v, F.lit("e2")), F.concat(F.lit("."), (k % 100).cast("string")),
        F.concat((k % 100).cast("string"), F.lit(".")), F.concat(F.lit(" "), v), F.concat(v, F.lit("d")), F.concat(v, F.lit("F")),
        F.lit("1e400"), F.lit("1e-400"), F.lit(""), F.lit("abc"), F.lit("1,5"), F.lit("--1"), F.lit("."), F.lit(None).cast("string"),
    ]
    chosen = F.element_at(F.array(*shapes), (k % len(shapes) + 1).cast("int"))
    return fx.event_rows(spark, sf).select(F.col("k").alias("event_id"), chosen.alias("text"))


@query
def parse_strict_numbers(spark: SparkSession, sf: str) -> DataFrame:
    rows = _number_texts(spark, sf).withColumn("number", parse_strict(F.col("text")))
    return rows.filter(F.col("number").isNotNull()).select("event_id", "number")


@query
def parse_or_zero_numbers(spark: SparkSession, sf: str) -> DataFrame:
    return _number_texts(spark, sf).select("event_id", parse_or_zero(F.col("text")).alias("number"))


QUERIES["parse_strict"] = QUERIES.pop("parse_strict_numbers")
QUERIES["parse_or_zero"] = QUERIES.pop("parse_or_zero_numbers")


@query
def book_flatten(spark: SparkSession, sf: str) -> DataFrame:
    return books.book_flatten(fx.book_messages(spark, sf))


@query
def delta_flatten(spark: SparkSession, sf: str) -> DataFrame:
    return deltas.delta_flatten(fx.delta_messages(spark, sf))


def _oi(spark: SparkSession, sf: str, *keep: str) -> DataFrame:
    return indicators.oi_normalize(indicators.decode_oi(fx.oi_messages(spark, sf), keep=keep), keep=keep)


def _pi(spark: SparkSession, sf: str) -> DataFrame:
    return indicators.pi_normalize(indicators.decode_pi(fx.pi_messages(spark, sf)))


@query
def oi_normalize(spark: SparkSession, sf: str) -> DataFrame:
    return _oi(spark, sf)


@query
def pi_normalize(spark: SparkSession, sf: str) -> DataFrame:
    return _pi(spark, sf).withColumn("next_funding_time", _or_minus_one("next_funding_time"))


def _liq(spark: SparkSession, sf: str, venue: str | None = None, allowed: list[str] | None = None) -> DataFrame:
    raw = fx.liq_messages(spark, sf)
    raw = raw if venue is None else raw.filter(F.col("exchange") == venue)
    return liquidations.liq_normalize(raw, allowed)


@query
def liq_binance(spark: SparkSession, sf: str) -> DataFrame:
    return _liq(spark, sf, "binance")


@query
def liq_bybit(spark: SparkSession, sf: str) -> DataFrame:
    return _liq(spark, sf, "bybit").select("exchange", "symbol", "side", "time_ms", "quantity", "price")


@query
def liq_okx(spark: SparkSession, sf: str) -> DataFrame:
    return _liq(spark, sf, "okx").select("exchange", "symbol", "side", "position_side", "time_ms", "quantity", "price")


@query
def liq_unified(spark: SparkSession, sf: str) -> DataFrame:
    return _liq(spark, sf)


@query
def liq_allow_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = _liq(spark, sf, "okx", [" btc-usdt", "", "SOL-USDT"])
    return rows.groupBy("symbol", "side").agg(F.count(F.lit(1)).alias("n"), F.max("time_ms").alias("last_ms"))


@query
def side_norm(spark: SparkSession, sf: str) -> DataFrame:
    words = ["Buy", "sell", "LONG", "Short", "hold", ""]
    word = fx.pick(F.col("event_id") % 6, words)
    rows = fx.header_rows(spark, sf).select(word.alias("raw"), liquidations.side_norm(word).alias("side"))
    return rows.groupBy("raw", "side").agg(F.count(F.lit(1)).alias("n"))


@query
def symbol_universe(spark: SparkSession, sf: str) -> DataFrame:
    return universe.symbol_universe(fx.allocation_rows(spark, sf))


@query
def symbol_allow_filter(spark: SparkSession, sf: str) -> DataFrame:
    allowed = universe.allow_list(universe.symbol_universe(fx.allocation_rows(spark, sf)))
    kept = universe.keep_allowed(fx.oi_messages(spark, sf), allowed)
    return kept.groupBy("exchange", "symbol").agg(F.count(F.lit(1)).alias("n"), F.sum("message_id").alias("id_sum"))


@query
def batch_key(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.requested_symbols(spark, sf)
    exchange, symbol = F.col("exchange"), F.col("symbol")
    market = landing.market_tag(exchange, F.lit("fobd"))
    padded = [F.concat(F.lit(" "), F.upper(exchange)), F.concat(market, F.lit(" ")), F.lower(symbol)]
    return rows.groupBy(
        tables.batch_key(exchange, market, canonical_symbol(exchange, symbol)).alias("processor_key"),
        tables.batch_key(exchange, market, symbol, "writer").alias("writer_key"),
        tables.batch_key(*padded, "indicator").alias("indicator_key"),
    ).agg(F.count(F.lit(1)).alias("n"))


# --- batches --------------------------------------------------------------------


def book_headers(spark: SparkSession, sf: str) -> DataFrame:
    """One narrow row per snapshot message: its key, time, id and valid levels."""
    nested = books.nested_snapshot(fx.book_messages(spark, sf), keep=["message_id"])
    key = tables.batch_key(F.col("exchange"), F.col("market_type"), F.col("symbol"))
    return nested.select(
        key.alias("key"),
        F.col("timestamp_ms").alias("ts_ms"),
        F.col("message_id").alias("id"),
        (F.size("bids") + F.size("asks")).cast("bigint").alias("rows"),
    )


def oi_headers(spark: SparkSession, sf: str, *keep: str) -> DataFrame:
    """One row per open-interest reading, keyed for batching."""
    key = tables.batch_key(F.col("exchange"), F.col("market"), F.col("symbol"))
    return _oi(spark, sf, "message_id").select(
        key.alias("key"),
        F.col("received_time").alias("ts_ms"),
        F.col("message_id").alias("id"),
        F.lit(1).cast("bigint").alias("rows"),
        *keep,
    )


@query
def count_batches(spark: SparkSession, sf: str) -> DataFrame:
    return batching.count_batches(book_headers(spark, sf), COUNT_ROWS)


@query
def count_batches_single(spark: SparkSession, sf: str) -> DataFrame:
    return batching.count_batches(oi_headers(spark, sf), COUNT_ROWS).select("key", "ts_ms", "id", "batch_no")


@query
def batch_envelope(spark: SparkSession, sf: str) -> DataFrame:
    numbered = batching.count_batches(oi_headers(spark, sf, "open_interest"), COUNT_ROWS)
    envelopes = batching.batch_envelope(numbered, ["open_interest"])
    ids = F.array_join(F.transform("entries", lambda e: e["id"].cast("string")), ",")
    return envelopes.select("batch_id", "key", "batch_no", "record_count", "timestamp_ms", ids.alias("entry_ids"))


@query
def age_batches(spark: SparkSession, sf: str) -> DataFrame:
    return batching.age_batches(book_headers(spark, sf), MONTH_MS)


@query
def gap_batches(spark: SparkSession, sf: str) -> DataFrame:
    return batching.gap_batches(oi_headers(spark, sf), clock.HOUR_MS)


@query
def count_or_idle_batches(spark: SparkSession, sf: str) -> DataFrame:
    numbered = batching.count_or_idle_batches(oi_headers(spark, sf), 5, clock.HOUR_MS)
    return batching.batch_sizes(numbered)


@query
def interval_flush(spark: SparkSession, sf: str) -> DataFrame:
    return batching.interval_flush(oi_headers(spark, sf), clock.HOUR_MS)


@query
def key_flush(spark: SparkSession, sf: str) -> DataFrame:
    return batching.batch_sizes(batching.key_flush(oi_headers(spark, sf), 10, 6 * clock.HOUR_MS))


@query
def liq_flush(spark: SparkSession, sf: str) -> DataFrame:
    raw = fx.liq_messages(spark, sf).withColumns({"ts_ms": clock.epoch_ms(F.col("ts")), "id": F.col("message_id")})
    rows = liquidations.liq_normalize(raw, keep=["ts_ms", "id"])
    return flushing.liq_flush(rows, 10, 15 * clock.HOUR_MS, clock.HOUR_MS)


@query
def drain(spark: SparkSession, sf: str) -> DataFrame:
    return batching.drain(batching.count_batches(book_headers(spark, sf), COUNT_ROWS), COUNT_ROWS)


# --- published tables, layout and catalogue ---------------------------------------


@query
def snapshot_valid_filter(spark: SparkSession, sf: str) -> DataFrame:
    part = F.col("l_partkey")
    rows = fx.table(spark, sf, "lineitem").select(
        "l_orderkey",
        F.when(part % 11 == 0, F.lit(clock.ABSENT_TIME_MS).cast("bigint")).otherwise(clock.epoch_ms(F.col("l_shipdate"))).alias("ts_ms"),
        F.when(part % 5 == 0, 0.0).otherwise(F.col("l_extendedprice")).alias("price"),
        F.when(part % 7 == 0, 0.0).otherwise(F.col("l_quantity")).alias("quantity"),
        F.when(part % 3 == 0, "").otherwise("bid").alias("side"),
        (F.col("l_linenumber") - 1).alias("level"),
    )
    return tables.snapshot_valid_filter(rows).select("l_orderkey", "ts_ms", "price", "quantity", "side", "level")


@query
def sink_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return tables.snapshot_table(books.book_flatten(fx.book_messages(spark, sf)))


@query
def sink_delta(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.delta_table(deltas.delta_flatten(fx.delta_messages(spark, sf)))
    return rows.withColumns({"event_time": _ms("event_time"), "received_time": _ms("received_time")})


@query
def sink_open_interest(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.open_interest_table(_oi(spark, sf))
    return rows.withColumns({"event_time": _ms("event_time"), "received_time": _ms("received_time")})


@query
def sink_premium_index(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.premium_index_table(_pi(spark, sf))
    return rows.withColumns({"event_time": _ms("event_time"), "received_time": _ms("received_time")})


@query
def sink_liquidation(spark: SparkSession, sf: str) -> DataFrame:
    return tables.liquidation_table(_liq(spark, sf)).withColumn("time_millis", _ms("time_millis"))


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{named or tempfile.mkdtemp(prefix='mdlake-')}/{name}-{uuid.uuid4().hex}"


def _committed(spark: SparkSession, raw: DataFrame, feed: str, template: str | None = None, cuts: tuple[str, ...] = ()) -> str:
    """A table of the messages, written in one commit, or in one for each of the ``cuts`` of its messages, a day apart."""
    place = _folder(spark, feed)
    for number, part in enumerate([raw.filter(c) for c in cuts] or [raw]):
        rows = jobs.published_rows(part, feed, template=template)
        jobs.commit_feed(rows, feed, f"{place}/table", f"{place}/manifest", number, AS_OF_MS + number * clock.DAY_MS, template=template)
    return place


def _written_folders(spark: SparkSession, place: str) -> DataFrame:
    """Rows in each folder of a written table, by the manifest of its files."""
    inside = F.regexp_replace("path", f"^.*?{place.split('/')[-1]}/table/(.*)/[^/]*$", "$1")
    listed = catalog.read_manifest(spark, f"{place}/manifest")
    return listed.groupBy(inside.alias("folder")).agg(F.sum("record_count").alias("n"))


def _folders(rows: DataFrame, layout: list[str]) -> DataFrame:
    """Rows in each folder that a table job would write, from the columns it writes by.

    The given times lie so far apart that an hourly table of them is a file for
    every few rows; the folders on disk are tested with rows closer together.
    """
    levels = [F.concat(F.lit(f"{c}="), F.col(c)) for c in layout]
    return rows.groupBy(F.concat_ws("/", *levels).alias("folder")).agg(F.count(F.lit(1)).alias("n"))


HOURS = ["year", "month", "day", "hour"]


@query
def partition_layout(spark: SparkSession, sf: str) -> DataFrame:
    hourly = jobs.published_rows(fx.delta_messages(spark, sf), "fobd", template=tables.HOURLY)
    daily = _committed(spark, fx.oi_messages(spark, sf), "foi")
    return _folders(hourly, [*tables.TABLE_KEYS, *HOURS]).unionByName(_written_folders(spark, daily))


@query
def liq_layout(spark: SparkSession, sf: str) -> DataFrame:
    return _folders(jobs.published_rows(fx.liq_messages(spark, sf), "liq"), [*tables.LIQUIDATION_KEYS, *HOURS])


@query
def file_name(spark: SparkSession, sf: str) -> DataFrame:
    laid = tables.with_layout(_pi(spark, sf), "pi", "event_time")
    return laid.groupBy("file").agg(F.count(F.lit(1)).alias("n"))


def _manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Logical files of a table that commits once a day."""
    rows = _oi(spark, sf).withColumn(
        "commit_ms", clock.bucket_ms(F.col("received_time"), clock.DAY_MS) + clock.DAY_MS
    )
    return catalog.logical_manifest(tables.with_layout(rows, "foi", "commit_ms"), "commit_ms")


# Two commits of one table: messages with an even number, then those with an odd one.
HALVES = ("message_id % 2 = 0", "message_id % 2 = 1")


@query
def file_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Files that two commits really wrote, added up by folder."""
    listed = catalog.read_manifest(spark, f"{_committed(spark, fx.oi_messages(spark, sf), 'foi', cuts=HALVES)}/manifest")
    names = ["exchange", "market", "symbol", "date"]
    return listed.groupBy(*[F.col("partition")[c].alias(c) for c in names], "commit_id", "snapshot_ms", "status").agg(
        F.sum("record_count").alias("record_count"), (F.min("file_size") > 0).alias("sized")
    )


@query
def snapshot_log(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.snapshot_log(_manifest(spark, sf))


@query
def read_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """The table between its two commits."""
    place = _committed(spark, fx.oi_messages(spark, sf), "foi", cuts=HALVES)
    rows = catalog.read_as_of(spark, f"{place}/table", f"{place}/manifest", AS_OF_MS + clock.HOUR_MS)
    return rows.withColumns({"event_time": _ms("event_time"), "received_time": _ms("received_time")})


TABLES = ["snapshot", "delta", "liquidation", "open_interest", "premium_index"]
CODECS = ["snappy", "gzip", "GZIP", "", "zstd", "lzo", "none"]


@query
def codec_select(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("k")
    asked = fx.event_rows(spark, sf).select(fx.pick(k % 5, TABLES).alias("table"), fx.pick(k % 7, CODECS).alias("configured"))
    chosen = asked.withColumn("codec", F.coalesce(tables.codec_of(F.col("table"), F.col("configured")), F.lit("unavailable")))
    return chosen.groupBy("table", "configured", "codec").agg(F.count(F.lit(1)).alias("writes"))


@query
def catalog_entry(spark: SparkSession, sf: str) -> DataFrame:
    manifest = fx.event_rows(spark, sf).select(F.concat_ws("_", F.col("exchange"), fx.pick(F.col("k") % 5, TABLES)).alias("table"))
    return catalog.catalog_entries(manifest, "lake", "tables/")


@query
def upload_stats(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_id")
    writes = fx.header_rows(spark, sf).select(
        k.alias("write_id"), (k * 100).alias("bytes"), (k % 50).alias("records"), (k % 5 * 20).alias("duration_ms")
    )
    stats = telemetry.upload_stats(writes)
    return stats.withColumn("bytes_per_sec", F.coalesce("bytes_per_sec", F.lit(-1.0)))


# --- documented views ---------------------------------------------------------------


@query
def nested_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    rows = books.nested_snapshot(fx.book_messages(spark, sf))
    return rows.select(
        "exchange", "market_type", "symbol", "timestamp_ms", "last_update_id", _typed_text("bids"), _typed_text("asks")
    )


@query
def nested_delta(spark: SparkSession, sf: str) -> DataFrame:
    rows = deltas.nested_delta(fx.delta_messages(spark, sf))
    return rows.select(
        "exchange", "market_type", "symbol", "timestamp_ms", "update_id", _typed_text("bid_updates"), _typed_text("ask_updates")
    )


@query
def liquidation_slim(spark: SparkSession, sf: str) -> DataFrame:
    return liquidations.liquidation_slim(_liq(spark, sf))


@query
def open_interest_slim(spark: SparkSession, sf: str) -> DataFrame:
    return indicators.open_interest_slim(_oi(spark, sf))


@query
def funding_rate(spark: SparkSession, sf: str) -> DataFrame:
    return indicators.funding_rate(_pi(spark, sf)).withColumn("funding_time", _ms("funding_time"))


# --- telemetry --------------------------------------------------------------------------


@query
def metric_events(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.metric_rows(spark, sf)
    kept = telemetry.metric_events(rows).select("event_id", "name", "type", F.lit("on").alias("switches"))
    gated = telemetry.metric_events(rows, used_weight=False, channel_size=False)
    return kept.unionByName(gated.select("event_id", "name", "type", F.lit("off").alias("switches")))


@query
def metric_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry.metric_numeric(telemetry.metric_events(fx.metric_rows(spark, sf))).select("event_id", "name", "number")


def _datums(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry.metric_datums(telemetry.metric_events(fx.metric_rows(spark, sf)))


@query
def metric_dimensions(spark: SparkSession, sf: str) -> DataFrame:
    return _datums(spark, sf).select("event_id", telemetry.render_dimensions(F.col("dimensions")).alias("dimensions"))


@query
def metric_unit(spark: SparkSession, sf: str) -> DataFrame:
    return _datums(spark, sf).groupBy("unit").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("id_sum"))


@query
def metric_series_key(spark: SparkSession, sf: str) -> DataFrame:
    return _datums(spark, sf).groupBy("series").agg(F.count(F.lit(1)).alias("n"))


@query
def metric_throttle(spark: SparkSession, sf: str) -> DataFrame:
    events = _datums(spark, sf).select(F.col("series").alias("key"), "ts_ms", F.col("event_id").alias("id"))
    return batching.throttle(events).select(F.col("key").alias("series"), "ts_ms", F.col("id").alias("event_id"))


@query
def metric_rollup_60s(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry.rollup_60s(telemetry.metric_events(fx.metric_rows(spark, sf)))


@query
def drop_events(spark: SparkSession, sf: str) -> DataFrame:
    rows = telemetry.drop_events(fx.stage_rows(spark, sf))
    return rows.withColumn("fields", telemetry.render_dimensions(F.col("fields")))


@query
def drop_summary(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry.drop_summary(telemetry.drop_events(fx.stage_rows(spark, sf)))


@query
def channel_stats(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry.channel_stats(fx.stage_rows(spark, sf))


@query
def buffer_occupancy(spark: SparkSession, sf: str) -> DataFrame:
    flow = telemetry.buffer_flow(fx.stage_rows(spark, sf), fx.taken_rows(spark, sf))
    reports = telemetry.buffer_capacities(telemetry.metric_events(fx.metric_rows(spark, sf)))
    return telemetry.buffer_occupancy(flow, reports)


@query
def latest_metrics(spark: SparkSession, sf: str) -> DataFrame:
    rows = telemetry.metric_events(fx.metric_rows(spark, sf)).select("event_id", "ts_ms", "component", "name", "value")
    return telemetry.latest(rows)


@query
def latest_per_series(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry.latest_per_series(telemetry.metric_events(fx.metric_rows(spark, sf)))


@query
def latest_capacity(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry.latest_capacity(telemetry.metric_events(fx.metric_rows(spark, sf)))


@query
def log_records(spark: SparkSession, sf: str) -> DataFrame:
    rows = telemetry.latest(telemetry.log_records(fx.log_rows(spark, sf)))
    return rows.withColumn("fields", telemetry.render_dimensions(F.col("fields")))


@query
def resource_latest(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry.resource_latest(fx.resource_rows(spark, sf))


# --- API usage --------------------------------------------------------------------------


def _responses(spark: SparkSession, sf: str, venue: str) -> DataFrame:
    return fx.header_rows(spark, sf).filter(F.col("exchange") == venue)


@query
def used_weight_binance(spark: SparkSession, sf: str) -> DataFrame:
    return usage.used_weight_binance(_responses(spark, sf, "binance")).select("event_id", "ip", "used", "used_weight")


@query
def used_weight_bybit(spark: SparkSession, sf: str) -> DataFrame:
    rows = usage.used_weight_bybit(_responses(spark, sf, "bybit"))
    return rows.select("event_id", "quota", "remaining", F.coalesce("used_weight", F.lit(-1.0)).alias("used_weight"))


@query
def used_weight_kucoin(spark: SparkSession, sf: str) -> DataFrame:
    return usage.used_weight_kucoin(_responses(spark, sf, "kucoin"), 4000).select("event_id", "quota", "used_weight")


@query
def used_weight_okx(spark: SparkSession, sf: str) -> DataFrame:
    return usage.used_weight_okx(_responses(spark, sf, "okx")).select(
        "event_id", "quota", "remaining", "reset_ms", "window_s", "used_weight"
    )


@query
def weight_estimates(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_id")
    settings = fx.header_rows(spark, sf).select(
        "event_id", (k % 40).alias("symbols"), (k % 5 * 250).alias("interval_ms"), (k % 3).alias("connections")
    )
    return usage.weight_estimates(settings)
