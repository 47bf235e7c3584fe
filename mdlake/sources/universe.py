"""The configured symbol lists and the filters built from them.

The symbol lists are small, but no join here forces a broadcast: Spark picks it
from the measured size and falls back to a shuffled semi join beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mdlake.functions.symbols import canonical_symbol


def symbol_universe(allocation: DataFrame) -> DataFrame:
    """Allocation rows to distinct (exchange, stream, symbol).

    okx lists snapshot and delta symbols apart; its ``all`` stream is their
    union and its ``liquidation`` stream is the snapshot list only.
    """
    entries = F.array(
        F.struct(F.lit("binance").alias("exchange"), F.lit("all").alias("stream"), F.col("binance").alias("symbols")),
        F.struct(F.lit("bybit").alias("exchange"), F.lit("all").alias("stream"), F.col("bybit").alias("symbols")),
        F.struct(F.lit("kucoin").alias("exchange"), F.lit("all").alias("stream"), F.col("kucoin").alias("symbols")),
        F.struct(
            F.lit("okx").alias("exchange"),
            F.lit("all").alias("stream"),
            F.concat(F.col("okx.snapshot"), F.col("okx.delta")).alias("symbols"),
        ),
        F.struct(
            F.lit("okx").alias("exchange"), F.lit("liquidation").alias("stream"), F.col("okx.snapshot").alias("symbols")
        ),
    )
    lists = allocation.select(F.explode(entries).alias("e")).select("e.exchange", "e.stream", "e.symbols")
    return lists.select("exchange", "stream", F.explode("symbols").alias("symbol")).distinct()


def allow_list(universe: DataFrame) -> DataFrame:
    """Canonical symbols of every venue, as one distinct list."""
    canonical = canonical_symbol(F.col("exchange"), F.col("symbol"))
    return universe.filter(F.col("stream") == "all").select(canonical.alias("canonical")).distinct()


def keep_allowed(raw: DataFrame, allowed: DataFrame) -> DataFrame:
    """Messages whose canonical symbol is listed; an empty list keeps all.

    Runs before any payload is decoded.
    """
    keyed = raw.withColumn("_canonical", canonical_symbol(F.col("exchange"), F.col("symbol")))
    return _keep_listed(keyed, "_canonical", allowed.select("canonical")).drop("_canonical")


def _keep_listed(rows: DataFrame, column: str, listed: DataFrame) -> DataFrame:
    """Rows whose ``column`` is in the one-column list; an empty list keeps all.

    Whether the list is empty is asked when the rows are read, not before.
    """
    (name,) = listed.columns
    known = listed.select(F.col(name).alias("_listed")).distinct()
    none = listed.agg(F.count(F.lit(1)).alias("n")).scalar() == 0
    return rows.join(known, F.col(column) == F.col("_listed"), "left").filter(F.col("_listed").isNotNull() | none).drop("_listed")


def keep_tickers(rows: DataFrame, configured: DataFrame) -> DataFrame:
    """Upper-case the ticker symbol and keep configured ones; empty keeps all."""
    upper = rows.withColumn("symbol", F.upper("symbol"))
    return _keep_listed(upper, "symbol", configured.select(F.upper("symbol").alias("wanted")))


def validate_instruments(requested: DataFrame, instruments: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Split requested (exchange, symbol) rows into listed and unlisted ones.

    Without an instrument list every request counts as listed.
    """
    flagged = flag_instruments(requested, instruments)
    return flagged.filter("listed").drop("listed"), flagged.filter("NOT listed").drop("listed")


def flag_instruments(requested: DataFrame, instruments: DataFrame | None) -> DataFrame:
    """Requested (exchange, symbol) rows with ``listed``, each input read once."""
    if instruments is None:
        return requested.withColumn("listed", F.lit(True))
    known = instruments.select("exchange", F.col("inst_id").alias("symbol")).distinct().withColumn("_known", F.lit(True))
    joined = requested.join(known, ["exchange", "symbol"], "left")
    return joined.withColumn("listed", F.col("_known").isNotNull()).drop("_known")
