"""Order-book deltas: venue payloads to price updates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mdlake.functions import clock
from mdlake.functions.parsing import decode_json, is_clean, long_or_zero, parse_long, parse_strict, text_or_blank, unnest
from mdlake.functions.symbols import canonical_symbol, kucoin_symbol
from mdlake.operators.books import TEXT_LEVELS, explode_sides, nest_sides, no_levels
from mdlake.sources.frames import topic_symbol

# Either letter case of the level keys is accepted, as the payload may be
# re-serialised on the way.
NAMED_LEVELS = "ARRAY<STRUCT<price: STRING, quantity: STRING, Price: STRING, Quantity: STRING>>"
BINANCE = f"E BIGINT, s STRING, U BIGINT, u BIGINT, pu BIGINT, b {NAMED_LEVELS}, a {NAMED_LEVELS}"
RENAMED_LEVELS = "ARRAY<STRUCT<price: STRING, quantity: STRING, price2: STRING, quantity2: STRING>>"
BINANCE_RENAMED = (
    "event_time BIGINT, symbol STRING, first BIGINT, last BIGINT, prev BIGINT, "
    f"bids {RENAMED_LEVELS}, asks {RENAMED_LEVELS}"
)
BYBIT = f"topic STRING, ts BIGINT, data STRUCT<s: STRING, b: {TEXT_LEVELS}, a: {TEXT_LEVELS}, u: BIGINT, seq: BIGINT>"
KUCOIN = "topic STRING, data STRUCT<sequence: BIGINT, change: STRING, timestamp: BIGINT>"
OKX = (
    "arg STRUCT<instId: STRING>, action STRING, "
    f"data ARRAY<STRUCT<bids: {TEXT_LEVELS}, asks: {TEXT_LEVELS}, ts: STRING>>"
)


def _named(values: Column) -> Column:
    pairs = F.transform(
        values,
        lambda v: F.array(
            text_or_blank(F.coalesce(v["price"], v["price2"])),
            text_or_blank(F.coalesce(v["quantity"], v["quantity2"])),
        ),
    )
    return F.coalesce(pairs, no_levels())


def parse_change(change: Column) -> Column:
    """``price,side,quantity`` text to STRUCT<side, price, quantity>.

    The side word may stand anywhere; fewer than three parts give blanks.
    """
    parts = F.transform(F.split(change, ","), lambda p: F.trim(p))
    enough = F.size(parts) >= 3
    sides = F.filter(parts, lambda p: p.isin("buy", "sell"))
    # A blank part can only fill a slot that a later part then overwrites.
    others = F.filter(parts, lambda p: ~p.isin("buy", "sell") & (p != ""))

    def pick(values: Column, at: Column) -> Column:
        return text_or_blank(F.when(enough, F.get(values, at)))

    return F.struct(
        pick(sides, F.size(sides) - 1).alias("side"),
        pick(others, F.lit(0)).alias("price"),
        pick(others, F.lit(1)).alias("quantity"),
    )


def _one_level(change: Column, side: str) -> Column:
    level = F.array(F.array(change["price"], change["quantity"]))
    return F.when(change["side"] == side, level).otherwise(no_levels())


def _delta(symbol: Column, event: Column, ids: tuple[Column, Column, Column], bids: Column, asks: Column) -> Column:
    update, prev, first = ids
    return F.struct(
        text_or_blank(symbol).alias("symbol"),
        event.alias("event_time"),
        update.alias("update_id"),
        prev.alias("prev_update_id"),
        first.alias("first_update_id"),
        F.coalesce(bids, no_levels()).alias("bids"),
        F.coalesce(asks, no_levels()).alias("asks"),
    )


def parse_deltas(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Good messages with both sides as sent, each payload parsed once."""
    venue, data = F.col("exchange"), F.col("data")
    known = venue.isin("bybit", "kucoin", "okx")
    parsed = raw.select(
        "exchange",
        "market",
        clock.epoch_ms(F.col("ts")).alias("received_time"),
        *keep,
        F.when(~known, decode_json(data, BINANCE, BINANCE_RENAMED)).alias("_plain"),
        F.when(venue == "bybit", decode_json(data, BYBIT)).alias("_bybit"),
        F.when(venue == "kucoin", decode_json(data, KUCOIN)).alias("_kucoin"),
        F.when(venue == "okx", decode_json(data, OKX)).alias("_okx"),
    )
    plain, bybit, kucoin, okx = (F.col(c) for c in ("_plain", "_bybit", "_kucoin", "_okx"))
    change_text = text_or_blank(kucoin["data"]["change"])
    parsed = parsed.withColumn("_change", F.when(is_clean(kucoin), parse_change(change_text)))
    change = F.col("_change")
    first = F.get(okx["data"], F.lit(0))
    okx_time = long_or_zero(parse_long(first["ts"]))
    seq, step = long_or_zero(bybit["data"]["seq"]), long_or_zero(kucoin["data"]["sequence"])
    plain_ids = (long_or_zero(plain["last"]), long_or_zero(plain["prev"]), long_or_zero(plain["first"]))
    delta = (
        F.when(
            is_clean(plain),
            _delta(
                plain["symbol"], long_or_zero(plain["event_time"]), plain_ids, _named(plain["bids"]), _named(plain["asks"])
            ),
        )
        .when(
            is_clean(bybit),
            _delta(
                topic_symbol(venue, text_or_blank(bybit["topic"])),
                long_or_zero(bybit["ts"]),
                (seq, seq - 1, seq),
                bybit["data"]["b"],
                bybit["data"]["a"],
            ),
        )
        .when(
            is_clean(kucoin),
            _delta(
                kucoin_symbol(topic_symbol(venue, text_or_blank(kucoin["topic"]))),
                long_or_zero(kucoin["data"]["timestamp"]),
                (step, step - 1, step),
                _one_level(change, "buy"),
                _one_level(change, "sell"),
            ),
        )
        .when(
            is_clean(okx) & first.isNotNull(),
            _delta(okx["arg"]["instId"], okx_time, (okx_time, okx_time, okx_time), first["bids"], first["asks"]),
        )
    )
    return unnest(parsed, ["exchange", "market", "received_time", *keep], F.array(delta))


def decode_deltas(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Raw delta messages of all venues in one common form.

    bybit and okx levels keep their first two items; shorter ones are dropped.
    """

    def common(side: str) -> Column:
        long_enough = F.filter(F.col(side), lambda v: F.size(v) >= 2)
        pairs = F.transform(long_enough, lambda v: F.slice(v, 1, 2))
        return F.when(F.col("exchange").isin("bybit", "okx"), pairs).otherwise(F.col(side))

    return parse_deltas(raw, keep).withColumns({"bids": common("bids"), "asks": common("asks")})


def flatten_deltas(deltas: DataFrame) -> DataFrame:
    """Parsed deltas to updates; zero price or quantity is kept (a removal)."""
    named = deltas.withColumn("symbol", canonical_symbol(F.col("exchange"), F.col("symbol")))
    return (
        explode_sides(named)
        .withColumns(
            {
                "price": parse_strict(F.col("price_text")),
                "quantity": parse_strict(F.col("quantity_text")),
            }
        )
        .filter(F.col("price").isNotNull() & F.col("quantity").isNotNull())
        .select(
            "exchange",
            "market",
            "symbol",
            "event_time",
            "update_id",
            "prev_update_id",
            "first_update_id",
            "side",
            "price",
            "quantity",
            "received_time",
        )
    )


def delta_flatten(raw: DataFrame) -> DataFrame:
    """Raw delta messages to the normalised update table."""
    return flatten_deltas(parse_deltas(raw))


def nested_delta(raw: DataFrame) -> DataFrame:
    """One row per message with typed update arrays, built without a shuffle."""
    messages = parse_deltas(raw).select(
        "exchange",
        F.col("market").alias("market_type"),
        canonical_symbol(F.col("exchange"), F.col("symbol")).alias("symbol"),
        F.col("event_time").alias("timestamp_ms"),
        "update_id",
        "bids",
        "asks",
    )
    return nest_sides(messages, "bid_updates", "ask_updates", keep_zero=True)
