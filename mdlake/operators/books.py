"""Order-book snapshots: venue payloads to price levels.

A message is decoded once, by its own venue's schema, in a single pass over the
landing table; both sides are exploded together so the payload is never read
twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mdlake.functions import clock
from mdlake.functions.parsing import decode_json, is_clean, long_or_zero, parse_long, parse_strict, plain_decimal, unnest
from mdlake.functions.symbols import canonical_symbol, kucoin_symbol

TEXT_LEVELS = "ARRAY<ARRAY<STRING>>"
BINANCE = f"lastUpdateId BIGINT, bids {TEXT_LEVELS}, asks {TEXT_LEVELS}"
BYBIT = f"result STRUCT<u: BIGINT, b: {TEXT_LEVELS}, a: {TEXT_LEVELS}>"
KUCOIN = "sequence BIGINT, bids ARRAY<ARRAY<DOUBLE>>, asks ARRAY<ARRAY<DOUBLE>>"
OKX = f"data ARRAY<STRUCT<bids: {TEXT_LEVELS}, asks: {TEXT_LEVELS}, ts: STRING>>"


def no_levels() -> Column:
    return F.array().cast(TEXT_LEVELS)


def _levels(values: Column) -> Column:
    return F.coalesce(values.cast(TEXT_LEVELS), no_levels())


def _book(update_id: Column, bids: Column, asks: Column) -> Column:
    return F.struct(
        long_or_zero(update_id).alias("last_update_id"), _levels(bids).alias("bids"), _levels(asks).alias("asks")
    )


def parse_books(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Good messages with both sides as sent, each payload parsed once.

    ``keep`` names raw columns to carry along.
    """
    venue, data = F.col("exchange"), F.col("data")
    known = venue.isin("bybit", "kucoin", "okx")
    parsed = raw.select(
        "exchange",
        "symbol",
        "market",
        clock.epoch_ms(F.col("ts")).alias("ts_ms"),
        *keep,
        F.when(~known, decode_json(data, BINANCE)).alias("_plain"),
        F.when(venue == "bybit", decode_json(data, BYBIT)).alias("_bybit"),
        F.when(venue == "kucoin", decode_json(data, KUCOIN)).alias("_kucoin"),
        F.when(venue == "okx", decode_json(data, OKX)).alias("_okx"),
    )
    plain, bybit, kucoin, okx = (F.col(c) for c in ("_plain", "_bybit", "_kucoin", "_okx"))
    first = F.get(okx["data"], F.lit(0))
    some = F.size(_levels(first["bids"])) + F.size(_levels(first["asks"])) > 0
    book = (
        F.when(is_clean(plain), _book(plain["lastUpdateId"], plain["bids"], plain["asks"]))
        .when(is_clean(bybit), _book(bybit["result"]["u"], bybit["result"]["b"], bybit["result"]["a"]))
        .when(is_clean(kucoin), _book(kucoin["sequence"], kucoin["bids"], kucoin["asks"]))
        .when(is_clean(okx) & some, _book(parse_long(first["ts"]), first["bids"], first["asks"]))
    )
    symbol = F.when(venue == "kucoin", kucoin_symbol(F.col("symbol"))).otherwise(F.col("symbol"))
    return unnest(parsed, ["exchange", symbol.alias("symbol"), "market", "ts_ms", *keep], F.array(book))


def decode_books(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Raw snapshot messages of all venues in one common form.

    okx and kucoin levels keep their first two items and become empty when
    shorter; kucoin numbers become plain decimal text.
    """

    def pair(v: Column) -> Column:
        return F.when(F.size(v) >= 2, F.slice(v, 1, 2)).otherwise(F.array().cast("ARRAY<STRING>"))

    def plain_text(x: Column) -> Column:
        return plain_decimal(x.cast("double").cast("string"))

    def common(side: str) -> Column:
        values, venue = F.col(side), F.col("exchange")
        return (
            F.when(venue == "okx", F.transform(values, pair))
            .when(venue == "kucoin", F.transform(values, lambda v: F.transform(pair(v), plain_text)))
            .otherwise(values)
        )

    return parse_books(raw, keep).withColumns({"bids": common("bids"), "asks": common("asks")})


def explode_sides(messages: DataFrame) -> DataFrame:
    """One row per level of both sides, numbered from 1 in payload order.

    Plain explodes only: no lambda runs per level.
    """
    kept = [c for c in messages.columns if c not in ("bids", "asks")]
    sides = F.array(
        F.struct(F.lit("bid").alias("side"), F.col("bids").alias("levels")),
        F.struct(F.lit("ask").alias("side"), F.col("asks").alias("levels")),
    )
    return (
        messages.select(*kept, F.explode(sides).alias("_side"))
        .select(*kept, F.col("_side.side"), F.posexplode("_side.levels").alias("_at", "_level"))
        .select(
            *kept,
            "side",
            (F.col("_at") + 1).alias("level"),
            F.get("_level", F.lit(0)).alias("price_text"),
            F.get("_level", F.lit(1)).alias("quantity_text"),
        )
    )


def flatten_books(books: DataFrame) -> DataFrame:
    """Parsed books to valid levels.

    A level that is too short or does not parse, or whose price or quantity is
    zero, is dropped without renumbering the others.
    """
    named = books.withColumn("symbol", canonical_symbol(F.col("exchange"), F.col("symbol")))
    return (
        explode_sides(named)
        .withColumns(
            {
                "price": parse_strict(F.col("price_text")),
                "quantity": parse_strict(F.col("quantity_text")),
            }
        )
        .filter((F.col("price") != 0) & (F.col("quantity") != 0))
        .select(
            "exchange", "symbol", "market", "ts_ms", "last_update_id", "side", "price", "quantity", "level"
        )
    )


def book_flatten(raw: DataFrame) -> DataFrame:
    """Raw snapshot messages to the normalised level table."""
    return flatten_books(parse_books(raw))


def poll_grid(raw: DataFrame, interval_ms: int, order: str = "message_id") -> DataFrame:
    """Last snapshot of each (exchange, symbol) in every polling interval.

    Only the message's identity travels through the shuffle, not its payload;
    partial aggregation runs before it.
    """
    ms = clock.epoch_ms(F.col("ts"))
    return (
        raw.select("exchange", "symbol", ms.alias("ts_ms"), F.col(order).alias("message_id"))
        .groupBy("exchange", "symbol", clock.bucket_ms(F.col("ts_ms"), interval_ms).alias("bucket_ms"))
        .agg(
            F.max(F.struct("ts_ms", "message_id")).alias("_last"),
            F.count(F.lit(1)).alias("polls"),
        )
        .select("exchange", "symbol", "bucket_ms", "polls", "_last.ts_ms", "_last.message_id")
    )


def poll_snapshots(raw: DataFrame, interval_ms: int, order: str = "message_id") -> DataFrame:
    """The messages that ``poll_grid`` picks, payload and all, with ``bucket_ms`` and ``polls``.

    Payloads are read again for the picked messages alone, and only those are
    worth decoding.  ``order`` is unique within (exchange, symbol).
    """
    last = poll_grid(raw, interval_ms, order).select(
        "exchange", "symbol", "bucket_ms", "polls", F.col("message_id").alias(order)
    )
    return raw.join(last, ["exchange", "symbol", order])


def typed_levels(values: Column, keep_zero: bool = False) -> Column:
    """Text levels to ``ARRAY<STRUCT<price, quantity>>`` of the valid ones."""
    typed = F.transform(
        values,
        lambda v: F.struct(
            parse_strict(F.get(v, F.lit(0))).alias("price"), parse_strict(F.get(v, F.lit(1))).alias("quantity")
        ),
    )
    if keep_zero:
        return F.filter(typed, lambda x: x["price"].isNotNull() & x["quantity"].isNotNull())
    return F.filter(typed, lambda x: (x["price"] != 0) & (x["quantity"] != 0))


def nest_sides(messages: DataFrame, bids: str, asks: str, keep_zero: bool = False) -> DataFrame:
    """Typed arrays of both sides under new names; a message without any valid
    level gives no row.
    """
    kept = [c for c in messages.columns if c not in ("bids", "asks")]
    both = F.array(
        F.struct(
            typed_levels(F.col("bids"), keep_zero).alias(bids), typed_levels(F.col("asks"), keep_zero).alias(asks)
        )
    )
    return unnest(messages, kept, both).filter(F.size(bids) + F.size(asks) > 0)


def nested_snapshot(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per message with typed level arrays, built without a shuffle."""
    books = parse_books(raw, keep).select(
        *keep,
        "exchange",
        F.col("market").alias("market_type"),
        canonical_symbol(F.col("exchange"), F.col("symbol")).alias("symbol"),
        F.col("ts_ms").alias("timestamp_ms"),
        "last_update_id",
        "bids",
        "asks",
    )
    return nest_sides(books, "bids", "asks")
