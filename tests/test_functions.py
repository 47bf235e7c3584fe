import datetime as dt

import pytest
from pyspark.sql import functions as F

from mdlake.functions import clock, paths
from mdlake.functions.parsing import leading_number, parse_long, parse_or_zero, parse_strict
from mdlake.functions.symbols import canonical_symbol
from mdlake.plans.fixtures import NATIVE_SYMBOLS


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "exchange, given, expected",
    [
        ("kucoin", "XBT-USDTM", "BTCUSDT"),
        ("coinbase", "BTC-USD", "BTCUSD"),
        ("kraken", "BTC/USD", "BTCUSD"),
        ("binance", "ETHUSDT", "ETHUSDT"),
        ("binance", "1000BONKUSDT", "BONKUSDT"),
        ("binance", "1000PEPEUSDT", "PEPEUSDT"),
        ("binance", "1000SHIBUSDT", "SHIBUSDT"),
        ("bybit", "SHIB1000USDT", "SHIBUSDT"),
        ("bybit", "1000BONKUSDT", "BONKUSDT"),
        ("bybit", "1000PEPEUSDT", "PEPEUSDT"),
        ("BYBIT", "ETHPERP", "ETHUSDC"),
        ("okx", "BTC-USDT-SWAP", "BTCUSDT"),
        ("other", "a-b", "a-b"),
    ],
)
def test_canonical_symbol(spark, exchange, given, expected):
    assert one(spark, canonical_symbol(F.col("e"), F.col("s")), e=exchange, s=given) == expected


def test_canonical_symbol_is_idempotent_on_configured_symbols(spark):
    rows = [(v, s) for v, symbols in NATIVE_SYMBOLS.items() for s in symbols]
    once = canonical_symbol(F.col("e"), F.col("s"))
    df = spark.createDataFrame(rows, ["e", "s"]).select("e", once.alias("s"))
    assert df.filter(once != F.col("s")).count() == 0


@pytest.mark.parametrize(
    "given, expected",
    [
        ("1", 1.0), ("-1.5", -1.5), ("+2", 2.0), (".5", 0.5), ("5.", 5.0), ("1e3", 1000.0), ("1e-400", 0.0),
        ("inf", float("inf")), ("-Infinity", float("-inf")),
        ("", None), ("abc", None), ("1.5d", None), ("2f", None), (" 3", None), ("3 ", None), ("1e400", None),
        ("1,5", None), ("--1", None), (".", None), ("\t4", None), ("+nan", None),
    ],
)
def test_parse_strict(spark, given, expected):
    assert one(spark, parse_strict(F.col("t")), t=given) == expected
    assert one(spark, parse_or_zero(F.col("t")), t=given) == (expected or 0.0)


@pytest.mark.parametrize("given, expected", [("17", 17), ("-3", -3), ("1.0", None), (" 1", None), ("", None), ("9" * 30, None)])
def test_parse_long(spark, given, expected):
    assert one(spark, parse_long(F.col("t")), t=given) == expected


@pytest.mark.parametrize(
    "given, expected",
    [("120", 120.0), ("120-110", 120.0), ("110-108-0", 110.0), ("\t98 remaining", 98.0), ("+72", 72.0), ("abc", None), ("", None)],
)
def test_leading_number(spark, given, expected):
    assert one(spark, leading_number(F.col("t")), t=given) == expected


def test_epoch_ms_ignores_the_session_zone(spark):
    # 02:30 does not exist in the test session's zone on this day.
    ts = dt.datetime(2024, 3, 10, 2, 30, 1, 999_999)
    literal = F.lit("2024-03-10 02:30:01.999999").cast("timestamp_ntz")
    assert one(spark, clock.epoch_ms(literal)) == int(ts.replace(tzinfo=dt.timezone.utc).timestamp()) * 1000 + 999


@pytest.mark.parametrize(
    "value, expected",
    [(0, 77), (-5, 77), (1_700_000_000, 1_700_000_000_000), (1_700_000_000_123, 1_700_000_000_123), (1_700_000_000_123_999_999, 1_700_000_000_123)],
)
def test_infer_epoch_ms(spark, value, expected):
    assert one(spark, clock.infer_epoch_ms(F.col("v"), F.lit(77).cast("bigint")), v=value) == expected


def test_paths(spark):
    ms = F.lit(1_754_400_305_000).cast("bigint")  # 2025-08-05 13:25:05 UTC
    assert one(spark, paths.partition_path(F.lit("okx"), F.lit("pi"), F.lit("BTCUSDT"), ms)) == "exchange=okx/market=pi/symbol=BTCUSDT/date=2025-08-05"
    assert one(
        spark,
        paths.partition_path(F.lit("OKX"), F.lit(""), F.lit("btcusdt"), ms, template="year={year}/month={month}/day={day}/hour={hour}", lower_exchange=True, upper_symbol=True),
    ) == "exchange=okx/symbol=BTCUSDT/year=2025/month=08/day=05/hour=13"
    assert one(spark, paths.file_name(F.lit("okx"), "fobs", F.lit("BTCUSDT"), ms)) == "okx_fobs_BTCUSDT_20250805132505.parquet"
    assert one(spark, paths.liquidation_path(F.lit("bybit"), ms, "liq/")) == "liq/bybit/2025/08/05/13"
