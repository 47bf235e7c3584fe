"""Instrument symbol canonicalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scaled contracts and the plain symbol they stand for.
BINANCE_SCALED = {
    "1000BONKUSDT": "BONKUSDT",
    "1000PEPEUSDT": "PEPEUSDT",
    "1000SHIBUSDT": "SHIBUSDT",
}
BYBIT_SCALED = {
    "1000BONKUSDT": "BONKUSDT",
    "1000PEPEUSDT": "PEPEUSDT",
    "SHIB1000USDT": "SHIBUSDT",
}


def _remap(symbol: Column, table: dict[str, str]) -> Column:
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.coalesce(F.element_at(F.create_map(*pairs), symbol), symbol)


def kucoin_symbol(symbol: Column) -> Column:
    dashless = F.replace(symbol, F.lit("-"), F.lit(""))
    return F.regexp_replace(F.regexp_replace(dashless, "M$", ""), "^XBT", "BTC")


def canonical_symbol(exchange: Column, symbol: Column) -> Column:
    """The common spelling of a venue's native symbol.

    Venue names match in any letter case; symbols of other venues pass through.
    Letter case of the symbol itself is never changed.
    """
    venue = F.lower(exchange)
    dashless = F.replace(symbol, F.lit("-"), F.lit(""))
    usdc = F.replace(symbol, F.lit("PERP"), F.lit("USDC"))
    okx = F.replace(F.regexp_replace(symbol, "-SWAP$", ""), F.lit("-"), F.lit(""))
    return (
        F.when(venue == "binance", _remap(symbol, BINANCE_SCALED))
        .when(venue == "bybit", _remap(usdc, BYBIT_SCALED))
        .when(venue == "kucoin", kucoin_symbol(symbol))
        .when(venue == "okx", okx)
        .when(venue == "coinbase", dashless)
        .when(venue == "kraken", F.replace(dashless, F.lit("/"), F.lit("")))
        .otherwise(symbol)
    )
