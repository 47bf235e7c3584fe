"""Open interest and premium index: venue payloads to one row per reading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mdlake.functions import clock
from mdlake.functions.parsing import (
    decode_json,
    is_clean,
    long_or_zero,
    parse_long,
    parse_or_zero,
    parse_strict,
    text_or_blank,
    unnest,
)
from mdlake.functions.symbols import canonical_symbol

TICKERS = (
    "ts BIGINT, data ARRAY<STRUCT<symbol: STRING, markPrice: STRING, indexPrice: STRING, "
    "openInterest: STRING, fundingRate: STRING, nextFundingTime: STRING>>"
)
OI_SINGLE = "openInterest STRING, time BIGINT"
OI_OKX = "data ARRAY<STRUCT<instId: STRING, oi: STRING, oiCcy: STRING, ts: STRING>>"
PI_BINANCE = "E BIGINT, p STRING, i STRING, P STRING, r STRING, T BIGINT"
PI_BINANCE_RENAMED = (
    "event_time BIGINT, mark STRING, index STRING, settle STRING, funding STRING, next_funding BIGINT"
)
PI_OKX = "data ARRAY<STRUCT<instId: STRING, markPx: STRING, idxPx: STRING, ts: STRING>>"
PI_KUCOIN = "dataList ARRAY<STRUCT<symbol: STRING, timePoint: BIGINT, value: DOUBLE>>"

OI_ENTRY = "ARRAY<STRUCT<symbol: STRING, oi_text: STRING, payload_time: BIGINT, message_ms: BIGINT>>"


def _present(ms: Column) -> Column:
    return F.when(ms > 0, ms)


def decode_oi(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Raw open-interest messages to one row per reading.

    ``message_ms`` is the time the message carries, or its arrival;
    ``payload_time`` is 0 where the payload has none.
    """
    venue, data = F.col("exchange"), F.col("data")
    parsed = raw.filter(venue.isin("binance", "bybit", "kucoin", "okx")).select(
        "exchange",
        "symbol",
        "market",
        clock.epoch_ms(F.col("ts")).alias("arrival_ms"),
        *keep,
        F.when(venue.isin("binance", "kucoin"), decode_json(data, OI_SINGLE)).alias("_single"),
        F.when(venue == "bybit", decode_json(data, TICKERS)).alias("_tickers"),
        F.when(venue == "okx", decode_json(data, OI_OKX)).alias("_okx"),
    )
    single, tickers, okx = F.col("_single"), F.col("_tickers"), F.col("_okx")
    arrival = F.col("arrival_ms")

    def entry(symbol: Column, oi: Column, payload_time: Column, message_ms: Column) -> Column:
        return F.struct(
            symbol.alias("symbol"),
            text_or_blank(oi).alias("oi_text"),
            payload_time.alias("payload_time"),
            message_ms.alias("message_ms"),
        )

    ticker_ms = F.coalesce(_present(tickers["ts"]), arrival)
    entries = (
        F.when(
            is_clean(single),
            F.array(entry(F.col("symbol"), single["openInterest"], long_or_zero(single["time"]), arrival)),
        )
        .when(
            is_clean(tickers),
            F.transform(
                tickers["data"],
                lambda d: entry(
                    F.upper(text_or_blank(d["symbol"])), d["openInterest"], long_or_zero(tickers["ts"]), ticker_ms
                ),
            ),
        )
        .when(
            is_clean(okx),
            F.transform(
                okx["data"],
                lambda d: entry(
                    F.upper(text_or_blank(d["instId"])),
                    d["oi"],
                    F.coalesce(parse_long(d["ts"]), arrival),
                    F.coalesce(parse_long(d["ts"]), arrival),
                ),
            ),
        )
    )
    return unnest(parsed, ["exchange", "market", *keep], entries.cast(OI_ENTRY))


def oi_normalize(readings: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Readings whose value parses, on the common schema."""
    payload = F.col("payload_time")
    event = F.when((F.col("exchange") != "okx") & (payload == 0), F.col("message_ms")).otherwise(payload)
    return (
        readings.select(
            "exchange",
            "market",
            canonical_symbol(F.col("exchange"), F.col("symbol")).alias("symbol"),
            event.alias("event_time"),
            parse_strict(F.col("oi_text")).alias("open_interest"),
            F.col("message_ms").alias("received_time"),
            *keep,
        )
        .filter(F.col("open_interest").isNotNull())
    )


PI_ENTRY = (
    "ARRAY<STRUCT<symbol: STRING, mark: STRING, index: STRING, settle: STRING, funding: STRING, "
    "next_funding: STRING, premium: DOUBLE, source: STRING, message_ms: BIGINT>>"
)


def decode_pi(raw: DataFrame, bybit_category: str = "linear", keep: Sequence[str] = ()) -> DataFrame:
    """Raw premium-index messages to one row per reading.

    ``next_funding_time`` is NULL where the payload carries none.  Numbers stay
    text until the rows are unnested, so they are parsed in compiled code.
    """
    venue, data = F.col("exchange"), F.col("data")
    parsed = raw.select(
        "exchange",
        "symbol",
        "market",
        clock.epoch_ms(F.col("ts")).alias("arrival_ms"),
        *keep,
        F.when(venue == "binance", decode_json(data, PI_BINANCE, PI_BINANCE_RENAMED)).alias("_binance"),
        F.when(venue == "bybit", decode_json(data, TICKERS)).alias("_tickers"),
        F.when(venue == "okx", decode_json(data, PI_OKX)).alias("_okx"),
        F.when(venue == "kucoin", decode_json(data, PI_KUCOIN)).alias("_kucoin"),
    )
    binance, tickers, okx, kucoin = (F.col(c) for c in ("_binance", "_tickers", "_okx", "_kucoin"))
    arrival = F.col("arrival_ms")

    def entry(symbol: Column, source: str, message_ms: Column, **sent: Column) -> Column:
        absent = F.lit(None).cast("string")
        texts = [sent.get(f, absent).alias(f) for f in ("mark", "index", "settle", "funding", "next_funding")]
        premium = sent.get("premium", F.lit(None).cast("double")).alias("premium")
        return F.struct(symbol.alias("symbol"), *texts, premium, F.lit(source).alias("source"), message_ms.alias("message_ms"))

    datum = F.get(kucoin["dataList"], F.lit(0))
    entries = (
        F.when(
            is_clean(binance),
            F.array(
                entry(
                    F.col("symbol"),
                    "binance_ws",
                    long_or_zero(binance["event_time"]),
                    mark=binance["mark"],
                    index=binance["index"],
                    settle=binance["settle"],
                    funding=binance["funding"],
                    next_funding=_present(binance["next_funding"]).cast("string"),
                )
            ).cast(PI_ENTRY),
        )
        .when(
            is_clean(tickers),
            F.transform(
                tickers["data"],
                lambda d: entry(
                    F.upper(text_or_blank(d["symbol"])),
                    f"bybit_{bybit_category}_ws",
                    F.coalesce(_present(tickers["ts"]), arrival),
                    mark=d["markPrice"],
                    index=d["indexPrice"],
                    funding=d["fundingRate"],
                    next_funding=d["nextFundingTime"],
                ),
            ).cast(PI_ENTRY),
        )
        .when(
            is_clean(okx),
            F.transform(
                okx["data"],
                lambda d: entry(
                    F.upper(text_or_blank(d["instId"])),
                    "okx_ws",
                    F.coalesce(parse_long(d["ts"]), arrival),
                    mark=d["markPx"],
                    index=d["idxPx"],
                ),
            ).cast(PI_ENTRY),
        )
        .when(
            is_clean(kucoin) & datum.isNotNull(),
            F.array(
                entry(
                    F.col("symbol"),
                    "kucoin_rest",
                    long_or_zero(datum["timePoint"]),
                    premium=F.coalesce(datum["value"], F.lit(0.0)),
                )
            ).cast(PI_ENTRY),
        )
    )
    rows = unnest(parsed, ["exchange", "market", "arrival_ms", *keep], entries)
    numbers = rows.withColumns(
        {
            "mark_price": parse_or_zero(F.col("mark")),
            "index_price": parse_or_zero(F.col("index")),
            "estimated_settle_price": parse_or_zero(F.col("settle")),
            "funding_rate": parse_or_zero(F.col("funding")),
            "next_funding_time": parse_long(F.col("next_funding")),
        }
    )
    premium = F.coalesce(F.col("premium"), F.col("mark_price") - F.col("index_price"))
    return numbers.select(
        "exchange", "market", "arrival_ms", *keep, "symbol", "mark_price", "index_price", "estimated_settle_price",
        "funding_rate", "next_funding_time", premium.alias("premium_index"), "source", "message_ms",
    )


def pi_normalize(readings: DataFrame, received: str = "arrival_ms", keep: Sequence[str] = ()) -> DataFrame:
    """Readings on the common schema; a message time of 0 takes the clock column."""
    message, clock_ms = F.col("message_ms"), F.col(received)
    return readings.select(
        "exchange",
        "market",
        canonical_symbol(F.col("exchange"), F.col("symbol")).alias("symbol"),
        F.when(message == 0, clock_ms).otherwise(message).alias("event_time"),
        "mark_price",
        "index_price",
        "estimated_settle_price",
        "funding_rate",
        "next_funding_time",
        "premium_index",
        clock_ms.alias("received_time"),
        *keep,
    )


def funding_rate(normalised: DataFrame) -> DataFrame:
    """Funding view: readings that announce a next funding time."""
    return normalised.filter(F.col("next_funding_time").isNotNull()).select(
        "exchange",
        "symbol",
        "funding_rate",
        F.timestamp_millis(F.col("next_funding_time")).alias("funding_time"),
        F.col("event_time").alias("timestamp_ms"),
    )


def open_interest_slim(normalised: DataFrame) -> DataFrame:
    return normalised.select("exchange", "symbol", "open_interest", F.col("event_time").alias("timestamp_ms"))
