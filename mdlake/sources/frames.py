"""Routing of text frames before the full payload is parsed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mdlake.functions.parsing import decode_json, is_clean, let, text_or_blank, unnest

# The channel each okx feed listens to, the topic prefix each
# bybit feed listens to, and the topic prefix of kucoin deltas.
OKX_CHANNEL = {"pi": "mark-price", "foi": "open-interest", "liq": "liquidation-orders"}
BYBIT_TOPIC = {"pi": "tickers", "foi": "tickers", "fobd": "orderbook.", "liq": "allLiquidation."}
KUCOIN_DELTA_TOPIC = "/contractMarket/level2:"

PROBE = "topic STRING, op STRING, event STRING, arg STRUCT<channel: STRING, instType: STRING>"


def _lookup(key: Column, table: dict[str, str]) -> Column:
    picked = F.lit(None).cast("string")
    for name, value in table.items():
        picked = F.when(key == name, F.lit(value)).otherwise(picked)
    return picked


def _wanted(probe: Column) -> Column:
    """Whether a frame, by its few top-level fields, holds data of its feed."""
    feed, venue = F.col("feed"), F.col("exchange")
    topic, channel = text_or_blank(probe["topic"]), text_or_blank(probe["arg"]["channel"])
    keys = F.json_object_keys(F.col("data"))
    okx_delta = ~(F.array_contains(keys, "event") | F.array_contains(keys, "ping"))
    okx_other = (text_or_blank(probe["event"]) == "") & (channel == _lookup(feed, OKX_CHANNEL))
    okx_liq = okx_other & (text_or_blank(probe["arg"]["instType"]) == "SWAP")
    okx = F.when(feed == "fobd", okx_delta).when(feed == "liq", okx_liq).otherwise(okx_other)
    topic_ok = topic.startswith(_lookup(feed, BYBIT_TOPIC))
    no_reply = text_or_blank(probe["op"]) == ""
    bybit = F.when(feed.isin("pi", "foi"), no_reply & topic_ok).otherwise(topic_ok)
    return is_clean(probe) & F.when(venue == "okx", okx).when(venue == "bybit", bybit).otherwise(F.lit(True))


def keep_data_frames(frames: DataFrame) -> DataFrame:
    """Drop acknowledgements, pings, broken text and frames of other channels.

    Only a few top-level fields are parsed here, so the full decode downstream
    never sees control traffic.  The verdict is filtered after an explode: a
    plain filter would be pushed below whatever makes ``data`` and repeat it.
    """
    names = frames.columns
    judged = frames.select("*", decode_json(F.col("data"), PROBE).alias("_probe"))
    judged = judged.select(*names, F.when(_wanted(F.col("_probe")), F.array(F.lit(True))).alias("_verdict"))
    return judged.select(*names, F.explode_outer("_verdict").alias("_wanted")).filter(F.col("_wanted")).select(*names)


def data_topics(frames: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The frames that ``keep_data_frames`` keeps, with ``topic`` from the same probe."""

    def topic(probe: Column) -> Column:
        return F.when(_wanted(probe), F.array(F.struct(text_or_blank(probe["topic"]).alias("topic"))))

    return unnest(frames, ["feed", "exchange", *keep], let(decode_json(F.col("data"), PROBE), topic))


def topic_symbol(exchange: Column, topic: Column) -> Column:
    """Symbol named by a delta topic."""
    third = F.coalesce(F.get(F.split(topic, r"\."), F.lit(2)), F.lit(""))
    after_prefix = F.when(
        topic.startswith(KUCOIN_DELTA_TOPIC), F.right(topic, F.length(topic) - len(KUCOIN_DELTA_TOPIC))
    ).otherwise(topic)
    return F.when(exchange == "bybit", third).when(exchange == "kucoin", after_prefix)


def poll_overrun(polls: DataFrame) -> DataFrame:
    """Fetches that took strictly longer than their polling interval."""
    return polls.filter(F.col("duration_ms") > F.col("interval_ms"))
