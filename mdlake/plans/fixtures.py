"""Raw venue messages derived from the given tables.

Every view turns whole tables into messages in the venues' own formats, with
some broken ones mixed in (see FIXTURES.md).  Integer keys drive all choices,
numbers become text through ``decimal(18,2)``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mdlake.functions.clock import epoch_ms
from mdlake.functions.parsing import let
from mdlake.sources.landing import VENUES, market_tag

# The native symbols of each venue, in list order.
NATIVE_SYMBOLS = {
    "binance": ["BTCUSDT", "ETHUSDC", "1000BONKUSDT", "1000SHIBUSDT"],
    "bybit": ["BTCUSDT", "ETHPERP", "1000PEPEUSDT", "SHIB1000USDT"],
    "kucoin": ["XBTUSDTM", "ETHUSDCM", "SOLUSDTM", "XRPUSDTM"],
    "okx": ["BTC-USDT-SWAP", "ETH-USDT-SWAP", "SOL-USDT-SWAP", "XRP-USDT-SWAP"],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Views that have been written once, as a landing job would: (tables, view) to path.
LANDED: dict[tuple[str, str], str] = {}
VIEWS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def view(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A view over the given tables, read from where it has landed if it has."""
    VIEWS[build.__name__] = build

    @wraps(build)
    def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = LANDED.get((sf_dir, build.__name__))
        return spark.read.parquet(path) if path else build(spark, sf_dir)

    return rows


def land(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Write every view under ``folder``, dealt over the session's shuffle partitions."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name, build in VIEWS.items():
        build(spark, sf_dir).repartition(parts).write.mode("overwrite").parquet(f"{folder}/{name}")
        LANDED[sf_dir, name] = f"{folder}/{name}"


def pick(index: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def venue_of(key: Column) -> Column:
    return pick(key % 4, list(VENUES))


def native_symbol(exchange: Column, index: Column) -> Column:
    every = [s for v in VENUES for s in NATIVE_SYMBOLS[v]]
    base = F.when(exchange == "binance", 0).when(exchange == "bybit", 4).when(exchange == "kucoin", 8).otherwise(12)
    return pick(base + index % 4, every)


def dec(value: Column) -> Column:
    return value.cast("decimal(18,2)").cast("string")


def quoted(value: Column) -> Column:
    return F.concat(F.lit('"'), value, F.lit('"'))


def text(*parts: Column | str) -> Column:
    """Concatenate literals and columns, the columns as text."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def broken(messages: DataFrame) -> DataFrame:
    """Cut off the end of the text of every 97th message.

    A projection of its own: the text is put together once, in compiled code.
    """
    data = F.col("data")
    cut = F.when(F.col("message_id") % 97 == 0, F.substring(data, F.lit(1), F.length(data) - 5)).otherwise(data)
    return messages.select(*[cut.alias(c) if c == "data" else c for c in messages.columns])


def _headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message head per order: key, venue, native symbol and arrival."""
    key = F.col("o_orderkey")
    exchange = venue_of(key)
    return table(spark, sf_dir, "orders").select(
        key.alias("k"),
        F.col("o_custkey").alias("c"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
        exchange.alias("exchange"),
        native_symbol(exchange, F.col("o_custkey")).alias("symbol"),
        (F.col("o_orderdate") + F.make_dt_interval(secs=(key % 86400).cast("decimal(18,6)"))).alias("ts"),
    )


def _money(cents: Column) -> Column:
    return text(F.call_function("div", cents, F.lit(100)), ".", F.lpad((cents % 100).cast("string"), 2, "0"))


def _level(side: str, i: Column) -> Column:
    """The i-th level of a side, from the order's total and customer."""
    mark = F.col("k") * 7 + i * 3 + (0 if side == "bid" else 1)
    rule = (
        F.when(mark % 10 == 0, "zero")
        .when(mark % 17 == 0, "word")
        .when(mark % 19 == 0, "suffix")
        .when(mark % 23 == 0, "short")
        .otherwise("ok")
    )
    cents = F.col("cents") + i * (-7 if side == "bid" else 7)

    def render(rule: Column) -> Column:
        price = F.when(rule == "word", "abc").when(rule == "suffix", "1.5d").otherwise(_money(cents))
        quantity = F.when(rule == "zero", "0.00").otherwise(text((F.col("c") + i) % 50 + 1, ".00"))
        return F.struct(rule.alias("rule"), price.alias("p"), quantity.alias("q"))

    return let(rule, render)


def _levels(side: str) -> Column:
    """Up to five levels; some sides are empty."""
    depth = (F.col("k") + 1) % 6 if side == "bid" else F.col("c") % 5
    numbers = F.filter(F.sequence(F.lit(1), F.lit(5)), lambda i: i <= depth)
    return F.transform(numbers, lambda i: _level(side, i.cast("bigint")))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message heads with the levels of both sides, one row per order."""
    return _headers(spark, sf_dir).select(
        "*", epoch_ms(F.col("ts")).alias("ms"), _levels("bid").alias("bid"), _levels("ask").alias("ask")
    )


def _side(side: str, render) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(F.col(side), render), ","), F.lit("]"))


def _text_level(x: Column) -> Column:
    return F.when(x["rule"] == "short", text('["', x["p"], '"]')).otherwise(text('["', x["p"], '","', x["q"], '"]'))


def _deep_level(x: Column) -> Column:
    return F.when(x["rule"] == "short", text('["', x["p"], '"]')).otherwise(
        text('["', x["p"], '","', x["q"], '","0","1"]')
    )


def _number_level(x: Column) -> Column:
    price = F.when(x["rule"].isin("word", "suffix"), "0").otherwise(x["p"])
    return F.when(x["rule"] == "short", text("[", price, "]")).otherwise(text("[", price, ",", x["q"], "]"))


def _named_level(lower: bool):
    price, quantity = ("price", "quantity") if lower else ("Price", "Quantity")

    def render(x: Column) -> Column:
        return F.when(x["rule"] == "short", text(f'{{"{price}":"', x["p"], '"}')).otherwise(
            text(f'{{"{price}":"', x["p"], f'","{quantity}":"', x["q"], '"}')
        )

    return render


def _typed_id(key: Column) -> Column:
    """The update id, as text (a type error) in every 89th message."""
    return F.when(F.col("k") % 89 == 0, quoted(text("x", key))).otherwise(key.cast("string"))


def _okx_ts(ms: Column) -> Column:
    return quoted(F.when(F.col("k") % 89 == 0, "x").otherwise(ms.cast("string")))


@view
def book_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_book``: one raw snapshot per order."""
    k, ms, venue = F.col("k"), F.col("ms"), F.col("exchange")
    second = F.when(k % 5 == 0, ',{"bids":[["9","9"]],"asks":[],"ts":"1"}').otherwise("")
    bids, asks = _side("bid", _text_level), _side("ask", _text_level)
    data = (
        F.when(venue == "binance", text('{"lastUpdateId":', _typed_id(k), ',"bids":', bids, ',"asks":', asks, "}"))
        .when(venue == "bybit", text('{"result":{"s":"X","u":', _typed_id(k), ',"b":', bids, ',"a":', asks, "}}"))
        .when(
            venue == "kucoin",
            text(
                '{"sequence":', _typed_id(k), ',"bids":', _side("bid", _number_level),
                ',"asks":', _side("ask", _number_level), "}",
            ),
        )
        .otherwise(
            text(
                '{"code":"0","data":[{"bids":', _side("bid", _deep_level), ',"asks":', _side("ask", _deep_level),
                ',"ts":', _okx_ts(ms), "}", second, "]}",
            )
        )
    )
    sent = _messages(spark, sf_dir).select(
        F.lit("fobs").alias("feed"),
        "exchange",
        "symbol",
        market_tag(venue, F.lit("fobs")).alias("market"),
        data.alias("data"),
        "ts",
        F.lit("snapshot").alias("message_type"),
        k.alias("message_id"),
    )
    return broken(sent)


def _kucoin_delta() -> Column:
    """kucoin sends one change per message, so one level of one side."""
    k, c, ms = F.col("k"), F.col("c"), F.col("ms")
    is_bid = F.call_function("div", k, F.lit(4)) % 2 == 0
    word = F.when(is_bid, "buy").otherwise("sell")
    one = F.lit(1).cast("bigint")

    def part(name: str) -> Column:
        return F.when(is_bid, _level("bid", one)[name]).otherwise(_level("ask", one)[name])

    change = (
        F.when(k % 29 == 0, "")
        .when(part("rule") == "short", F.concat_ws(",", part("p"), word))
        .when(c % 2 == 0, F.concat_ws(" , ", word, part("p"), part("q")))
        .otherwise(F.concat_ws(",", part("p"), word, part("q")))
    )
    return text(
        '{"topic":"/contractMarket/level2:', F.col("symbol"), '","subject":"level2","data":{"sequence":',
        _typed_id(k * 10), ',"change":"', change, '","timestamp":', ms - 7, "}}",
    )


@view
def delta_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_delta``: one raw delta per order."""
    k, ms, venue, symbol = F.col("k"), F.col("ms"), F.col("exchange"), F.col("symbol")

    def binance(lower: bool) -> Column:
        level = _named_level(lower)
        return text(
            '{"e":"depthUpdate","E":', ms - 7, ',"T":', ms - 8, ',"s":"', symbol, '","U":', _typed_id(k), ',"u":', k + 1,
            ',"pu":', k - 1, ',"b":', _side("bid", level), ',"a":', _side("ask", level), "}",
        )

    data = (
        F.when((venue == "binance") & (k % 8 == 0), binance(True))
        .when(venue == "binance", binance(False))
        .when(
            venue == "bybit",
            text(
                '{"topic":"orderbook.50.', symbol, '","type":"delta","ts":', ms - 7, ',"data":{"s":"', symbol, '","b":',
                _side("bid", _text_level), ',"a":', _side("ask", _text_level), ',"u":', k, ',"seq":', _typed_id(k * 2), "}}",
            ),
        )
        .when(venue == "kucoin", _kucoin_delta())
        .otherwise(
            text(
                '{"arg":{"channel":"books","instId":"', symbol, '"},"action":"update","data":[{"bids":',
                _side("bid", _deep_level), ',"asks":', _side("ask", _deep_level), ',"ts":', _okx_ts(ms - 7), "}]}",
            )
        )
    )
    sent = _messages(spark, sf_dir).select(
        F.lit("fobd").alias("feed"),
        "exchange",
        "symbol",
        market_tag(venue, F.lit("fobd")).alias("market"),
        data.alias("data"),
        "ts",
        k.alias("message_id"),
    )
    return broken(sent)


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    exchange = venue_of(F.col("event_id"))
    return e.select(
        F.col("event_id").alias("k"),
        "ts",
        epoch_ms(F.col("ts")).alias("ms"),
        F.col("user_id").alias("u"),
        "event_type",
        "value",
        dec(F.col("value")).alias("v"),
        exchange.alias("exchange"),
        native_symbol(exchange, F.col("user_id")).alias("symbol"),
    )


@view
def frame_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_frames``: text frames of all kinds, data and control mixed."""
    # Fixed values: (exchange, feed, frame) by event_id % 17; S is the symbol.
    kinds = [
        ("okx", "fobd", '{"arg":{"channel":"books","instId":"S"},"action":"update","data":[]}'),
        ("okx", "fobd", '{"event":"subscribe","arg":{"channel":"books","instId":"S"}}'),
        ("okx", "fobd", '{"ping":123}'),
        ("okx", "pi", '{"arg":{"channel":"mark-price","instId":"S"},"data":[]}'),
        ("okx", "pi", '{"event":"subscribe","arg":{"channel":"mark-price","instId":"S"}}'),
        ("okx", "foi", '{"arg":{"channel":"open-interest","instId":"S"},"data":[]}'),
        ("okx", "foi", '{"arg":{"channel":"tickers","instId":"S"},"data":[]}'),
        ("okx", "liq", '{"arg":{"channel":"liquidation-orders","instType":"SWAP"},"data":[]}'),
        ("okx", "liq", '{"arg":{"channel":"liquidation-orders","instType":"FUTURES"},"data":[]}'),
        ("bybit", "pi", '{"topic":"tickers.S","data":[]}'),
        ("bybit", "foi", '{"op":"subscribe","success":true,"topic":"tickers.S"}'),
        ("bybit", "fobd", '{"topic":"orderbook.50.S","data":{}}'),
        ("bybit", "fobd", '{"topic":"publicTrade.S","data":{}}'),
        ("bybit", "liq", '{"topic":"allLiquidation.S","data":[]}'),
        ("bybit", "liq", '{"op":"ping"}'),
        ("bybit", "fobd", '{"topic":"orderbook.50","data":{}}'),
        ("kucoin", "fobd", '{"topic":"/contractMarket/level2:S","data":{}}'),
    ]
    kind = F.col("k") % 17
    exchange = pick(kind, [x[0] for x in kinds])
    frame = F.replace(pick(kind, [x[2] for x in kinds]), F.lit("S\""), F.concat("symbol", F.lit('"')))
    base = event_rows(spark, sf_dir).select("k", "ts", "ms", "u", exchange.alias("exchange"))
    return (
        base.withColumn("symbol", native_symbol(F.col("exchange"), F.col("u")))
        .select(
            F.col("k").alias("message_id"),
            "exchange",
            pick(kind, [x[1] for x in kinds]).alias("feed"),
            F.when(F.col("k") % 101 == 0, F.substring(frame, F.lit(1), F.length(frame) - 2)).otherwise(frame).alias("data"),
            "ts",
        )
    )


def _event_ms() -> Column:
    """Payload time: 5 ms before arrival, or absent in every 7th message."""
    return F.when(F.col("k") % 7 == 0, 0).otherwise(F.col("ms") - 5)


@view
def oi_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_oi``: one raw open-interest message per event."""
    k, venue, symbol = F.col("k"), F.col("exchange"), F.col("symbol")
    value = (
        F.when(k % 13 == 0, "abc")
        .when(k % 17 == 0, "1.5d")
        .when(k % 19 == 0, text(" ", F.col("v"), " "))
        .when(k % 23 == 0, "1e400")
        .when((k % 11 == 0) & (venue == "okx"), "")
        .otherwise(F.col("v"))
    )
    time = F.when(k % 89 == 0, quoted(_event_ms().cast("string"))).otherwise(_event_ms().cast("string"))
    more = F.when(k % 3 == 0, ',{"symbol":"solperp","openInterest":"7.25"}').otherwise("")
    okx_ts = F.when(k % 7 == 0, "").otherwise((F.col("ms") - 5).cast("string"))
    data = (
        F.when(venue == "bybit", text('{"topic":"tickers.', symbol, '","type":"snapshot","ts":', time, ',"data":[{"symbol":"', F.lower(symbol), '","openInterest":"', value, '"}', more, "]}"))
        .when(venue == "okx", text('{"arg":{"channel":"open-interest","instId":"', symbol, '"},"data":[{"instId":"', F.lower(symbol), '","oi":"', value, '","oiCcy":"1","ts":"', okx_ts, '"}]}'))
        .otherwise(text('{"symbol":"', symbol, '","openInterest":"', value, '","time":', time, "}"))
    )
    sent = event_rows(spark, sf_dir).select(
        F.lit("foi").alias("feed"),
        "exchange",
        "symbol",
        market_tag(venue, F.lit("foi")).alias("market"),
        data.alias("data"),
        "ts",
        k.alias("message_id"),
    )
    return broken(sent)


@view
def pi_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_pi``: one raw premium-index message per event."""
    k, ms, venue, symbol = F.col("k"), F.col("ms"), F.col("exchange"), F.col("symbol")
    mark = F.when(k % 13 == 0, "abc").when(k % 17 == 0, "").otherwise(F.col("v"))
    index = dec(F.col("value") - 1)
    rate = text("0.000", F.lpad((k % 1000).cast("string"), 3, "0"))
    when = F.when(k % 89 == 0, quoted(_event_ms().cast("string"))).otherwise(_event_ms().cast("string"))
    next_ms = F.when(k % 3 == 0, 0).otherwise(ms + 3_600_000)
    next_text = F.when(k % 3 == 0, "").when(k % 5 == 0, "soon").otherwise((ms + 3_600_000).cast("string"))
    okx_ts = F.when(k % 7 == 0, "").otherwise((ms - 5).cast("string"))
    empty = k % 31 == 0
    data = (
        F.when(venue == "binance", text('{"e":"markPriceUpdate","E":', when, ',"s":"', symbol, '","p":"', mark, '","i":"', index, '","P":"', F.col("v"), '","r":"', rate, '","T":', next_ms, "}"))
        .when(venue == "bybit", text('{"topic":"tickers.', symbol, '","ts":', when, ',"data":[{"symbol":"', F.lower(symbol), '","markPrice":"', mark, '","indexPrice":"', index, '","fundingRate":"', rate, '","nextFundingTime":"', next_text, '"}]}'))
        .when(venue == "okx", text('{"arg":{"channel":"mark-price","instId":"', symbol, '"},"data":[{"instId":"', F.lower(symbol), '","markPx":"', mark, '","idxPx":"', index, '","ts":"', okx_ts, '"}]}'))
        .when(empty, '{"dataList":[]}')
        .otherwise(text('{"dataList":[{"symbol":"', symbol, '","timePoint":', when, ',"value":', rate, '},{"symbol":"OLD","timePoint":1,"value":9}]}'))
    )
    sent = event_rows(spark, sf_dir).select(
        F.lit("pi").alias("feed"),
        "exchange",
        "symbol",
        market_tag(venue, F.lit("pi")).alias("market"),
        data.alias("data"),
        "ts",
        k.alias("message_id"),
    )
    return broken(sent)


@view
def liq_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_liq``: one forced-order message per line, nested for bybit and okx."""
    key, part, flag = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_returnflag")
    venue = venue_of(key)
    price = F.when(part % 17 == 0, "abc").when(part % 19 == 0, "1.5d").otherwise(dec(F.col("l_extendedprice")))
    heads = table(spark, sf_dir, "lineitem").select(
        key.alias("k"),
        part.alias("part"),
        flag.alias("flag"),
        F.col("l_linenumber").alias("number"),
        venue.alias("exchange"),
        native_symbol(venue, F.col("l_suppkey")).alias("symbol"),
        (F.col("l_shipdate") + F.make_dt_interval(secs=(key % 86400).cast("decimal(18,6)"))).alias("ts"),
        price.alias("p"),
        F.when(part % 10 == 0, "0.00").otherwise(dec(F.col("l_quantity"))).alias("q"),
    )
    lines = heads.select("*", epoch_ms(F.col("ts")).alias("ms"))

    k, ms, venue, symbol, number, p, q = (F.col(c) for c in ("k", "ms", "exchange", "symbol", "number", "p", "q"))
    flag = F.col("flag")
    trade = F.when(k % 7 == 0, 0).otherwise(ms + number)
    sent = F.when(k % 5 == 0, 0).otherwise(ms)
    boolean = F.when(number % 2 == 0, "true").otherwise("false")
    binance = text(
        '{"e":"forceOrder","E":', sent, ',"o":{"s":"', symbol, '","S":"', F.when(flag == "R", "SELL").otherwise("BUY"),
        '","o":"LIMIT","f":"IOC","q":"', q, '","p":"', p, '","ap":"', F.when(flag == "A", "").otherwise(q),
        '","X":"FILLED","l":"', q, '","z":"', q, '","T":', trade, ',"L":"', p, '","t":', F.col("part"),
        ',"b":"0","a":"0","m":', boolean, ',"R":false,"wt":"CONTRACT_PRICE","ot":"LIMIT","ps":"LONG","cp":', boolean,
        ',"rp":"-', q, '"}}',
    )
    stamp = F.when(number == 2, 0).when(number == 4, F.floor(ms / 1000)).when(number == 6, ms).otherwise(ms * 1_000_000)
    kucoin = text(
        '{"topic":"/contractMarket/execution:', symbol, '","subject":"',
        F.when(k % 3 == 0, "match").otherwise("Liquidation"), '","data":{"symbol":"', F.lower(symbol),
        '","side":"sell","size":"', q, '","price":"1","ts":', stamp, "}}",
    )
    word = F.when(flag == "R", "Sell").when(flag == "A", "Buy").otherwise("None")

    def bybit_record(at: Column, size: Column | str) -> Column:
        return text('{"T":', at, ',"s":"', symbol, '","S":"', word, '","v":"', size, '","p":"', p, '"}')

    def okx_detail(at: Column, size: Column | str) -> Column:
        return text(
            '{"bkLoss":"0","bkPx":"', p, '","ccy":"","posSide":"', F.when(flag == "R", "long").otherwise("short"),
            '","side":"', F.lower(word), '","sz":"', size, '","ts":"', F.when(k % 11 == 0, "x").otherwise(at.cast("string")), '"}',
        )

    def pair(make) -> Column:
        """One record, or two.  A lambda also keeps the whole projection out of one method too large for the JVM to compile."""
        first = F.struct((ms + number).alias("at"), q.alias("size"))
        second = F.struct((ms + 1).alias("at"), F.lit("2.50").alias("size"))
        records = F.when(number % 2 == 0, F.array(first, second)).otherwise(F.array(first))
        return F.array_join(F.transform(records, lambda r: make(r["at"], r["size"])), ",")

    family = F.lower(F.replace(symbol, F.lit("-SWAP"), F.lit("")))
    extra = F.when(flag == "R", text(',{"details":[', okx_detail(ms, q), '],"uly":"doge-usdt"}')).otherwise("")
    okx = text(
        '{"arg":{"channel":"liquidation-orders","instType":"SWAP"},"data":[{"details":[', pair(okx_detail),
        '],"instFamily":"', F.when(k % 3 == 0, "").otherwise(family), '","instId":"', symbol, '","uly":"', family, '"}', extra, "]}",
    )
    bybit = text('{"topic":"allLiquidation.', symbol, '","type":"snapshot","ts":', ms, ',"data":[', pair(bybit_record), "]}")
    data = F.when(venue == "binance", binance).when(venue == "bybit", bybit).when(venue == "kucoin", kucoin).otherwise(okx)
    sent = lines.select(
        F.lit("liq").alias("feed"),
        "exchange",
        "symbol",
        market_tag(venue, F.lit("liq")).alias("market"),
        data.alias("data"),
        "ts",
        k.alias("message_id"),
    )
    return broken(sent)


# --- telemetry ------------------------------------------------------------------

METRIC_NAMES = [
    "fobs_raw_buffer_length", "fobs_norm_buffer_length", "fobd_raw_buffer_length", "fobd_norm_buffer_length",
    "liq_raw_buffer_length", "used_weight", "cpu_percent", "foi_raw_buffer_length", "",
]
STAGE_FEEDS = ["fobs", "fobd", "foi", "pi", "liq"]


def _present_map(*pairs: tuple[str, Column]) -> Column:
    """A map without the entries whose value is NULL."""
    flat = [x for name, value in pairs for x in (F.lit(name), value.cast("string"))]
    return F.map_filter(F.create_map(*flat), lambda _k, v: v.isNotNull())


@view
def metric_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_metric``: one metric event per event, with time run 1000 times faster."""
    k = F.col("k")
    unit = F.when(k % 4 == 0, "Percent").when(k % 4 == 1, "COUNT").when(k % 4 == 2, "Bytes")
    return event_rows(spark, sf_dir).select(
        k.alias("event_id"),
        F.call_function("div", F.col("ms"), F.lit(1000)).alias("ts_ms"),
        F.col("event_type").alias("component"),
        pick(k % 9, METRIC_NAMES).alias("name"),
        F.when(k % 10 == 0, "n/a").when(k % 10 == 1, "5").otherwise(F.col("v")).alias("value"),
        F.when(k % 10 > 1, F.col("v").cast("double")).alias("number"),
        F.when(k % 6 == 0, "").otherwise("gauge").alias("type"),
        _present_map(
            ("exchange", F.when(k % 2 == 0, "okx").otherwise("")),
            ("ip", F.when(F.col("u") % 2 == 0, "10.0.0.1").otherwise("10.0.0.2")),
            ("unit", unit),
            ("metric", F.when(k % 2 == 0, "reserved")),
        ).alias("fields"),
        F.when(k % 5 == 0, F.create_map(F.lit("capacity"), ((k % 9 + 1) * 1000).cast("double"))).alias("numbers"),
    )


@view
def stage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_stage``: one stage outcome per event."""
    k = F.col("k")
    return event_rows(spark, sf_dir).select(
        k.alias("event_id"),
        F.call_function("div", F.col("ms"), F.lit(1000)).alias("ts_ms"),
        pick(k % 5, STAGE_FEEDS).alias("feed"),
        F.when(F.col("u") % 2 == 0, "raw").otherwise("norm").alias("stage"),
        F.when(k % 7 == 0, "dropped").otherwise("sent").alias("outcome"),
        F.when(k % 3 == 0, "").otherwise(F.col("exchange")).alias("exchange"),
        F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(F.col("symbol")).alias("symbol"),
        market_tag(F.col("exchange"), pick(k % 5, STAGE_FEEDS)).alias("market"),
    )


@view
def taken_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_taken``: when a writer takes each norm message that was sent, up to ten seconds later."""
    sent = stage_rows(spark, sf_dir).filter((F.col("stage") == "norm") & (F.col("outcome") == "sent"))
    return sent.select("feed", (F.col("ts_ms") + F.col("event_id") % 40 * 250).alias("ts_ms"))


def header_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_headers``: one API response per event."""
    k, v, venue = F.col("k"), F.col("v"), F.col("exchange")

    whole = (k % 200).cast("string")
    binance = _present_map(
        ("X-MBX-USED-WEIGHT-1M", F.when(k % 3 == 0, v).when(k % 3 == 1, "")),
        ("X-MBX-USED-WEIGHT", F.when(k % 5 == 0, "bad").when(k % 5 < 3, whole)),
        ("X-MBX-USED-WEIGHT-1S", F.when(k % 7 < 4, "7.5")),
    )
    bybit = _present_map(
        ("X-Bapi-Limit", F.when(k % 3 == 0, "120-110").when(k % 3 == 1, "\t98 remaining").when(k % 7 == 0, "abc")),
        ("X-Bapi-Limit-Status", F.when(k % 5 < 3, text("+", whole)).when(k % 5 == 3, "-4")),
    )
    okx = _present_map(
        ("Rate-Limit-Limit", F.when(k % 3 == 0, "12").when(k % 3 == 1, "x")),
        ("Rate-Limit-Remaining", F.when(k % 5 < 3, (k % 20).cast("string")).when(k % 5 == 3, "-1")),
        ("Rate-Limit-Reset", F.when(F.col("u") % 2 == 0, "1737043200").when(k % 3 == 0, "1737043200000")),
        ("Rate-Limit-Interval", F.when(k % 7 == 0, "500ms").when(k % 7 == 1, " 3S ").when(k % 7 == 2, "4").when(k % 7 == 3, "xs")),
    )
    return event_rows(spark, sf_dir).select(
        k.alias("event_id"),
        "ms",
        "exchange",
        "symbol",
        F.when(k % 13 == 0, " ").otherwise("10.0.0.1").alias("ip"),
        F.when(venue == "binance", binance).when(venue == "bybit", bybit).when(venue == "okx", okx).alias("headers"),
        (k % 3 * 400).alias("limit"),
        F.when(k % 5 != 4, k % 500).alias("remaining"),
        ((F.col("u") % 4 - 1) * 5).cast("double").alias("extra"),
        (F.col("u") * 1000 % 20_000).cast("bigint").alias("duration_ms"),
        F.lit(10_000).cast("bigint").alias("interval_ms"),
    )


def log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    return event_rows(spark, sf_dir).select(
        k.alias("event_id"),
        F.col("ms").alias("ts_ms"),
        F.when(F.col("event_type") == "error", "error").otherwise("info").alias("level"),
        F.col("event_type").alias("message"),
        _present_map(
            ("component", F.when(k % 5 != 0, F.concat(F.col("exchange"), F.lit("_reader")))),
            ("symbol", F.col("symbol")),
            ("user", F.col("u")),
        ).alias("fields"),
    )


def resource_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_resource``: one host sample per event."""
    k = F.col("k")
    return event_rows(spark, sf_dir).select(
        k.alias("event_id"),
        F.col("ms").alias("ts_ms"),
        F.when(k % 13 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("cpu_percent"),
        (k * 1024).alias("memory_used"),
        F.lit(1 << 30).cast("bigint").alias("memory_total"),
        F.when(k % 11 == 0, F.lit(None).cast("double")).otherwise((k % 100).cast("double")).alias("memory_percent"),
        (k * 4096).alias("disk_used"),
        F.lit(1 << 40).cast("bigint").alias("disk_total"),
        ((k % 50) * 2).cast("double").alias("disk_percent"),
    )


# --- symbol lists -----------------------------------------------------------------


def allocation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_alloc``: the symbol allocation of one host per customer."""
    c = F.col("c_custkey")

    def listed(venue: str, *offsets: int) -> Column:
        return F.array(*[native_symbol(F.lit(venue), c + o) for o in offsets])

    return table(spark, sf_dir, "customer").select(
        listed("binance", 0, 1).alias("binance"),
        # The last two bybit and kucoin symbols are never allocated.
        F.array(native_symbol(F.lit("bybit"), c % 2)).alias("bybit"),
        F.array(native_symbol(F.lit("kucoin"), c % 2)).alias("kucoin"),
        F.struct(
            F.array(native_symbol(F.lit("okx"), c % 2)).alias("snapshot"),
            F.array(native_symbol(F.lit("okx"), c % 3)).alias("delta"),
        ).alias("okx"),
    )


def instrument_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_instruments``: instruments listed per supplier, the fourth never."""
    s = F.col("s_suppkey")
    exchange = venue_of(s)
    return table(spark, sf_dir, "supplier").select(
        exchange.alias("exchange"),
        native_symbol(exchange, F.call_function("div", s, F.lit(4)) % 3).alias("inst_id"),
    )


def requested_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _headers(spark, sf_dir).select("k", "exchange", "symbol")
