"""API-usage accounting from response headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mdlake.functions.parsing import leading_number, parse_or_zero, parse_strict

# Documented limits, windows and request weights.
BINANCE_HEADERS = ["X-MBX-USED-WEIGHT-1M", "X-MBX-USED-WEIGHT", "X-MBX-USED-WEIGHT-1S"]
KUCOIN_SNAPSHOT_WEIGHT = 3.0
KUCOIN_DEPTH_WEIGHT = 5.0
OKX_LIMIT = 10.0
OKX_WINDOW_SECONDS = 2.0
OKX_SNAPSHOT_WEIGHT = 1.0
OKX_CONNECTIONS_PER_SECOND = 3.0


def _header(name: str) -> Column:
    return F.coalesce(F.element_at("headers", name), F.lit(""))


def _floor_zero(value: Column) -> Column:
    return F.greatest(value, F.lit(0.0))


def _extra(extra: Column) -> Column:
    return F.when(extra > 0, extra).otherwise(0.0)


def used_weight_binance(responses: DataFrame, extra: str = "extra") -> DataFrame:
    """First header that parses, plus the estimated stream load."""
    used = F.coalesce(*[parse_strict(_header(h)) for h in BINANCE_HEADERS])
    return (
        responses.withColumn("used", used)
        .filter(F.col("used").isNotNull())
        .withColumn("used_weight", F.col("used") + _extra(F.col(extra)))
    )


def used_weight_bybit(responses: DataFrame) -> DataFrame:
    """Limit, remaining and usage; needs an ip and at least one header.

    ``used_weight`` is NULL where the headers give no positive limit.
    """
    limit_text, left_text = _header("X-Bapi-Limit"), _header("X-Bapi-Limit-Status")
    limit = F.coalesce(leading_number(limit_text), F.lit(0.0))
    left = F.coalesce(leading_number(left_text), F.lit(0.0))
    return (
        responses.filter((F.trim("ip") != "") & ((limit_text != "") | (left_text != "")))
        .withColumns({"quota": limit, "remaining": left})
        .withColumn(
            "used_weight",
            F.when((F.col("quota") > 0) & (F.col("remaining") >= 0), _floor_zero(F.col("quota") - F.col("remaining"))),
        )
    )


def used_weight_kucoin(
    responses: DataFrame, configured_limit: int, weight: float = KUCOIN_SNAPSHOT_WEIGHT, extra: str = "extra"
) -> DataFrame:
    """Weighted usage; nothing without a limit or with an unknown remainder."""
    quota = F.coalesce(F.when(F.col("limit") > 0, F.col("limit")), F.lit(configured_limit).cast("bigint"))
    left = F.coalesce(F.col("remaining"), F.lit(-1).cast("bigint"))
    return (
        responses.withColumns({"quota": quota, "left": left})
        .filter((F.col("quota") > 0) & (F.col("left") >= 0) & F.lit(weight > 0))
        .withColumn(
            "used_weight",
            _floor_zero((F.col("quota") - F.col("left")).cast("double")) * weight + _extra(F.col(extra)),
        )
        .drop("left")
    )


def okx_interval_seconds(text: Column) -> Column:
    """``500ms``, ``2s`` or a bare number of seconds; 0 when malformed."""
    word = F.lower(F.trim(text))
    millis = parse_strict(F.regexp_extract(word, "^(.*)ms$", 1)) / 1000
    seconds = parse_strict(F.regexp_extract(word, "^(.*)s$", 1))
    return F.when(word.endswith("ms") & millis.isNotNull(), millis).when(
        word.endswith("s") & seconds.isNotNull(), seconds
    ).otherwise(parse_or_zero(word))


def okx_rate_limit(responses: DataFrame) -> DataFrame:
    """Rate-limit columns with the documented defaults for missing headers."""
    limit_text, reset_text = _header("Rate-Limit-Limit"), _header("Rate-Limit-Reset")
    reset = parse_or_zero(reset_text)
    window = okx_interval_seconds(_header("Rate-Limit-Interval"))
    return responses.withColumns(
        {
            "quota": F.coalesce(parse_strict(limit_text), F.lit(OKX_LIMIT)),
            "remaining": parse_or_zero(_header("Rate-Limit-Remaining")),
            "reset_ms": F.when((reset > 0) & (reset < 1e12), reset * 1000).otherwise(reset),
            "window_s": F.when(window > 0, window).otherwise(OKX_WINDOW_SECONDS),
        }
    )


def used_weight_okx(responses: DataFrame, weight: float = OKX_SNAPSHOT_WEIGHT, extra: str = "extra") -> DataFrame:
    """Weighted usage plus stream load; the load alone is enough."""
    known = (F.col("quota") > 0) & (F.col("remaining") >= 0) & F.lit(weight > 0)
    used = F.when(known, _floor_zero(F.col("quota") - F.col("remaining")) * weight)
    return (
        okx_rate_limit(responses)
        .filter(known | (F.col(extra) > 0))
        .withColumn("used_weight", F.coalesce(used, F.lit(0.0)) + _extra(F.col(extra)))
    )


# --- estimates ------------------------------------------------------------------


def per_minute(symbols: Column, interval_ms: Column, weight: float = 1.0) -> Column:
    """Weight per minute of polling or streaming ``symbols`` every interval."""
    ok = (symbols > 0) & (interval_ms > 0) & F.lit(weight > 0)
    return F.when(ok, F.lit(1000.0) / interval_ms * symbols * 60 * weight).otherwise(0.0)


def connection_budget(connections: Column) -> Column:
    """okx connection budget per minute and active connection."""
    return F.when(connections > 0, F.lit(OKX_CONNECTIONS_PER_SECOND * 60) / connections).otherwise(0.0)


def per_symbol(total: Column, symbols: Column) -> Column:
    return F.when((symbols > 0) & (total > 0), total / symbols).otherwise(0.0)


def weight_estimates(settings: DataFrame) -> DataFrame:
    """Estimates per (symbols, interval_ms, connections) setting."""
    n, interval = F.col("symbols"), F.col("interval_ms")
    rows = settings.withColumns(
        {
            "binance": per_minute(n, interval),
            "kucoin": per_minute(n, interval, KUCOIN_DEPTH_WEIGHT),
            "okx_rest": per_minute(n, interval, OKX_SNAPSHOT_WEIGHT),
            "okx_ws": connection_budget(F.col("connections")),
        }
    )
    return rows.withColumns(
        {f"{c}_share": per_symbol(F.col(c), n) for c in ("binance", "kucoin", "okx_ws")}
    )
