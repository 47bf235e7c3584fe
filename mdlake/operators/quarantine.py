"""Messages whose payload cannot be decoded, of every feed.

A payload that is no JSON, or has a field of the wrong type, drops its whole
message; here such messages are kept as they came.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mdlake.functions.parsing import decode_json, is_clean, let, unnest
from mdlake.operators import books, deltas, indicators, liquidations

# The schema each feed decodes a venue's payload by; ``None`` stands for any other venue.
SCHEMAS: dict[str, dict[str | None, str]] = {
    "fobs": {"bybit": books.BYBIT, "kucoin": books.KUCOIN, "okx": books.OKX, None: books.BINANCE},
    "fobd": {"bybit": deltas.BYBIT, "kucoin": deltas.KUCOIN, "okx": deltas.OKX, None: deltas.BINANCE},
    "foi": {"binance": indicators.OI_SINGLE, "kucoin": indicators.OI_SINGLE, "bybit": indicators.TICKERS, "okx": indicators.OI_OKX},
    "pi": {"binance": indicators.PI_BINANCE, "kucoin": indicators.PI_KUCOIN, "bybit": indicators.TICKERS, "okx": indicators.PI_OKX},
    "liq": {"binance": liquidations.BINANCE, "kucoin": liquidations.KUCOIN, "bybit": liquidations.BYBIT, "okx": liquidations.OKX},
}


def _cases(key: Column, results: dict[str | None, Column]) -> Column:
    named = [(k, v) for k, v in results.items() if k is not None]
    picked = F.when(key == named[0][0], named[0][1])
    for name, value in named[1:]:
        picked = picked.when(key == name, value)
    return picked.otherwise(results[None]) if None in results else picked


def is_broken(feed: Column, exchange: Column, data: Column) -> Column:
    """Whether the payload fails its feed's decode; NULL where nothing decodes it."""

    def fails(ddl: str) -> Column:
        return let(decode_json(data, ddl), lambda parsed: ~is_clean(parsed))

    by_feed: dict[str | None, Column] = {
        name: _cases(exchange, {venue: fails(ddl) for venue, ddl in venues.items()}) for name, venues in SCHEMAS.items()
    }
    return _cases(feed, by_feed)


def rejects(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Broken messages with their payload and arrival time, in one narrow pass.

    Each payload is decoded once, by its own venue's schema.  ``keep`` names
    further raw columns to carry along.
    """
    bad = is_broken(F.col("feed"), F.col("exchange"), F.col("data"))
    message = F.struct("symbol", "market", "data", "ts", *keep)
    return unnest(raw, ["feed", "exchange"], F.when(bad, F.array(message)))


def reject_counts(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("feed", "exchange", "symbol").agg(F.count(F.lit(1)).alias("messages"))
