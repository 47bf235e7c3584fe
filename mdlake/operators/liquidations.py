"""Forced orders: venue payloads to one wide row per liquidation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mdlake.functions import clock
from mdlake.functions.parsing import decode_json, is_clean, long_or_zero, parse_long, parse_or_zero, text_or_blank, unnest
from mdlake.sources.universe import keep_tickers

BINANCE = (
    "E BIGINT, o STRUCT<s: STRING, S: STRING, o: STRING, q: STRING, p: STRING, ap: STRING, l: STRING, "
    "T: BIGINT, L: STRING, t: BIGINT, m: BOOLEAN, R: BOOLEAN, wt: STRING, ot: STRING, ps: STRING, "
    "cp: BOOLEAN, rp: STRING>"
)
BINANCE_RENAMED = (
    "event_time BIGINT, order STRUCT<symbol: STRING, side: STRING, order_type: STRING, quantity: STRING, "
    "price: STRING, avg_price: STRING, last_qty: STRING, trade_time: BIGINT, last_price: STRING, "
    "trade_id: BIGINT, is_maker: BOOLEAN, is_reduce_only: BOOLEAN, working_type: STRING, "
    "original_type: STRING, position_side: STRING, close_all: BOOLEAN, realized_pnl: STRING>"
)
BYBIT = "data ARRAY<STRUCT<T: BIGINT, s: STRING, S: STRING, v: STRING, p: STRING>>"
BYBIT_RENAMED = "data ARRAY<STRUCT<ms: BIGINT, symbol: STRING, side: STRING, quantity: STRING, price: STRING>>"
OKX = (
    "data ARRAY<STRUCT<details: ARRAY<STRUCT<bkPx: STRING, posSide: STRING, side: STRING, sz: STRING, "
    "ts: STRING>>, instFamily: STRING, uly: STRING>>"
)
KUCOIN = "topic STRING, subject STRING, data STRUCT<symbol: STRING, side: STRING, size: STRING, price: STRING, ts: BIGINT>"

# One forced order as sent; numbers stay text until the rows are unnested.
SENT = (
    "ARRAY<STRUCT<symbol: STRING, side: STRING, position_side: STRING, order_type: STRING, time_ms: BIGINT, "
    "quantity: STRING, price: STRING, avg_price: STRING, last_qty: STRING, last_price: STRING, trade_id: BIGINT, "
    "is_maker: BOOLEAN, is_reduce_only: BOOLEAN, working_type: STRING, original_type: STRING, close_all: BOOLEAN, "
    "realized_pnl: STRING>>"
)
TEXTS = ["symbol", "side", "position_side", "order_type", "working_type", "original_type"]
NUMBERS = ["quantity", "price", "avg_price", "last_qty", "last_price", "realized_pnl"]
FLAGS = ["is_maker", "is_reduce_only", "close_all"]
COLUMNS = [f.split(":")[0] for f in SENT[len("ARRAY<STRUCT<"):-2].split(", ")]
FORCED = "LIQUIDATION"


def side_norm(side: Column) -> Column:
    """Buy/sell and long/short words, like any other, in upper case."""
    return F.upper(text_or_blank(side))


def _sent(**fields: Column) -> Column:
    """A forced order; fields the venue does not send stay NULL."""
    types = dict(f.split(": ") for f in SENT[len("ARRAY<STRUCT<"):-2].split(", "))
    return F.struct(*[fields.get(c, F.lit(None)).cast(types[c]).alias(c) for c in COLUMNS])


def liq_normalize(raw: DataFrame, okx_allowed: list[str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Raw liquidation messages to the unified table.

    Venues without a normaliser are ignored.  ``okx_allowed`` restricts okx to
    the listed instrument families (blank entries ignored, empty keeps all);
    symbols are never canonicalised here.  Fields a venue does not send hold the
    type's zero value.  ``keep`` names raw columns to carry along.
    """
    venue, data = F.col("exchange"), F.col("data")
    parsed = raw.filter(venue.isin("binance", "bybit", "okx")).select(
        "exchange",
        *keep,
        F.when(venue == "binance", decode_json(data, BINANCE, BINANCE_RENAMED)).alias("_binance"),
        F.when(venue == "bybit", decode_json(data, BYBIT, BYBIT_RENAMED)).alias("_bybit"),
        F.when(venue == "okx", decode_json(data, OKX)).alias("_okx"),
    )
    binance, bybit, okx = F.col("_binance"), F.col("_bybit"), F.col("_okx")
    order, event = binance["order"], long_or_zero(binance["event_time"])
    copied = {c: order[c] for c in COLUMNS if c != "time_ms"}
    single = _sent(**copied, time_ms=F.when(event == 0, order["trade_time"]).otherwise(event))

    def bybit_row(d: Column) -> Column:
        return _sent(
            symbol=d["symbol"], side=side_norm(d["side"]), order_type=F.lit(FORCED), time_ms=d["ms"],
            quantity=d["quantity"], price=d["price"],
        )

    def family(block: Column) -> Column:
        named = text_or_blank(block["instFamily"])
        return F.upper(F.when(named != "", named).otherwise(text_or_blank(block["uly"])))

    def okx_row(block: Column, d: Column) -> Column:
        return _sent(
            symbol=family(block), side=side_norm(d["side"]), position_side=side_norm(d["posSide"]),
            order_type=F.lit(FORCED), time_ms=parse_long(d["ts"]), quantity=d["sz"], price=d["bkPx"],
        )

    blocks = okx["data"]
    wanted = sorted({s.strip().upper() for s in (okx_allowed or []) if s.strip()})
    if wanted:
        blocks = F.filter(blocks, lambda b: family(b).isin(wanted))
    details = F.transform(
        blocks, lambda b: F.transform(b["details"], lambda d: okx_row(b, d))
    )
    rows = (
        F.when(is_clean(binance), F.array(single).cast(SENT))
        .when(is_clean(bybit), F.transform(bybit["data"], bybit_row).cast(SENT))
        .when(is_clean(okx), F.flatten(F.filter(details, lambda x: x.isNotNull())).cast(SENT))
    )
    sent = unnest(parsed, ["exchange", *keep], rows)
    typed = {c: text_or_blank(F.col(c)) for c in TEXTS}
    typed |= {c: parse_or_zero(F.col(c)) for c in NUMBERS}
    typed |= {c: long_or_zero(F.col(c)) for c in ("time_ms", "trade_id")}
    typed |= {c: F.coalesce(F.col(c), F.lit(False)) for c in FLAGS}
    return sent.select("exchange", *keep, *[typed[c].alias(c) for c in COLUMNS])


def kucoin_liquidations(raw: DataFrame, configured: DataFrame | None = None) -> DataFrame:
    """kucoin executions whose subject marks a liquidation, as raw rows.

    Only symbols of ``configured`` (column ``symbol``, any case) are kept; an
    empty list, or none, keeps all.  No normaliser exists for this venue, so the
    payload is kept as it is.
    """
    parsed = raw.filter(F.col("exchange") == "kucoin").select(
        "data", clock.epoch_ms(F.col("ts")).alias("arrival_ms"), decode_json(F.col("data"), KUCOIN).alias("_p")
    )
    p = F.col("_p")
    row = F.struct(
        text_or_blank(p["data"]["symbol"]).alias("symbol"),
        text_or_blank(p["topic"]).alias("topic"),
        p["subject"].alias("subject"),
        long_or_zero(p["data"]["ts"]).alias("stamp"),
    )
    marked = is_clean(p) & F.lower(p["subject"]).contains("liquid")
    rows = unnest(parsed, ["data", "arrival_ms"], F.when(marked, F.array(row))).select(
        F.lit("kucoin").alias("exchange"),
        F.upper("symbol").alias("symbol"),
        F.lit("liquidation").alias("market"),
        "topic",
        "subject",
        "data",
        clock.infer_epoch_ms(F.col("stamp"), F.col("arrival_ms")).alias("ts_ms"),
    )
    return rows if configured is None else keep_tickers(rows, configured)


def liquidation_slim(normalised: DataFrame) -> DataFrame:
    return normalised.select(
        "exchange",
        F.lit("liquidation").alias("market_type"),
        "symbol",
        "side",
        "price",
        "quantity",
        F.col("time_ms").alias("timestamp_ms"),
    )
