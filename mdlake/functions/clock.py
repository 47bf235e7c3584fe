"""Time arithmetic on epoch milliseconds, independent of the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86_400_000
HOUR_MS = 3_600_000

# Fixed value: epoch ms of year 1, stored where a funding time is absent.
ABSENT_TIME_MS = -62135596800000


def epoch_ms(ts: Column) -> Column:
    """TIMESTAMP_NTZ to epoch ms, truncating below one millisecond."""
    days = F.unix_date(ts.cast("date")).cast("bigint")
    second_ms = F.floor(F.extract(F.lit("SECOND"), ts) * 1000).cast("bigint")
    return (
        days * DAY_MS
        + F.hour(ts).cast("bigint") * HOUR_MS
        + F.minute(ts).cast("bigint") * 60_000
        + second_ms
    )


def infer_epoch_ms(value: Column, fallback_ms: Column) -> Column:
    """Epoch ms from an integer whose unit is told by its size.

    Not positive: the fallback; below 1e12: seconds; below 1e15:
    milliseconds; else nanoseconds.
    """
    return (
        F.when(value <= 0, fallback_ms)
        .when(value < 1_000_000_000_000, value * 1000)
        .when(value < 1_000_000_000_000_000, value)
        .otherwise(F.call_function("div", value, F.lit(1_000_000)))
    )


def bucket_ms(ms: Column, width_ms: int) -> Column:
    """Start of the fixed interval that holds ``ms``."""
    return ms - F.pmod(ms, F.lit(width_ms).cast("bigint"))


def utc_date(ms: Column) -> Column:
    return F.date_from_unix_date(F.floor(ms / DAY_MS).cast("int"))


def _two(value: Column) -> Column:
    return F.lpad(value.cast("string"), 2, "0")


def utc_hour(ms: Column) -> Column:
    return _two((F.pmod(ms, F.lit(DAY_MS).cast("bigint")) / HOUR_MS).cast("int"))


def utc_stamp(ms: Column) -> Column:
    """``yyyyMMddHHmmss`` in UTC."""
    in_day = F.pmod(ms, F.lit(DAY_MS).cast("bigint"))
    date = F.replace(utc_date(ms).cast("string"), F.lit("-"), F.lit(""))
    minute = _two(((in_day / 60_000).cast("int")) % 60)
    second = _two(((in_day / 1000).cast("int")) % 60)
    return F.concat(date, utc_hour(ms), minute, second)
