"""Partition paths and logical file names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from mdlake.functions import clock

# Default partition keys and the default time template.
DEFAULT_KEYS = ("exchange", "market", "symbol")
DEFAULT_TIME_TEMPLATE = "date={year}-{month}-{day}"


def time_path(ms: Column, template: str) -> Column:
    day = clock.utc_date(ms).cast("string")
    parts = {
        "{year}": F.substring(day, 1, 4),
        "{month}": F.substring(day, 6, 2),
        "{day}": F.substring(day, 9, 2),
        "{hour}": clock.utc_hour(ms),
    }
    path = F.lit(template)
    for mark, value in parts.items():
        if mark in template:
            path = F.replace(path, F.lit(mark), value)
    return path


def time_folders(template: str) -> dict[str, str]:
    """Folder names of a time template and the pattern of each one's value."""
    named = [part.partition("=") for part in (template or DEFAULT_TIME_TEMPLATE).split("/")]
    if any(not sign for _, sign, _ in named):
        raise ValueError(f"every folder of the template needs a name: {template}")
    return {name: pattern for name, _, pattern in named}


def partition_path(
    exchange: Column,
    market: Column,
    symbol: Column,
    ms: Column,
    keys: Sequence[str] = DEFAULT_KEYS,
    template: str = DEFAULT_TIME_TEMPLATE,
    lower_exchange: bool = False,
    upper_symbol: bool = False,
) -> Column:
    """``key=value`` folders in the configured order, then the time template.

    A key with an empty value adds no folder.
    """
    values = {
        "exchange": F.lower(exchange) if lower_exchange else exchange,
        "market": market,
        "symbol": F.upper(symbol) if upper_symbol else symbol,
    }
    folders = [
        F.when(values[k] != "", F.concat(F.lit(f"{k}="), values[k])) for k in keys if k in values
    ]
    return F.concat_ws("/", *folders, time_path(ms, template or DEFAULT_TIME_TEMPLATE))


def liquidation_path(exchange: Column, ms: Column, prefix: str = "") -> Column:
    return F.concat(F.lit(prefix), exchange, F.lit("/"), time_path(ms, "{year}/{month}/{day}/{hour}"))


def file_name(exchange: Column, feed: str, symbol: Column, ms: Column, unique: Column | None = None) -> Column:
    """``<exchange>_<feed>_<symbol>_<UTC stamp>[unique].parquet``."""
    tail = [unique] if unique is not None else []
    return F.concat(
        exchange, F.lit(f"_{feed}_"), symbol, F.lit("_"), clock.utc_stamp(ms), *tail, F.lit(".parquet")
    )
