import datetime as dt
import json

from pyspark.sql import functions as F

from mdlake.operators import books, deltas, indicators, liquidations, quarantine
from mdlake.sources import frames
from mdlake.sources.landing import RAW_SCHEMA

ARRIVAL = dt.datetime(2024, 1, 1, 0, 0, 1)
ARRIVAL_MS = 1704067201000


def raw(spark, *messages):
    rows = [
        (m.get("feed"), m["exchange"], m.get("symbol", ""), m.get("market", ""), m["data"] if isinstance(m["data"], str) else json.dumps(m["data"]), ARRIVAL, None)
        for m in messages
    ]
    return spark.createDataFrame(rows, RAW_SCHEMA)


def dicts(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def test_binance_book(spark):
    message = {"exchange": "binance", "symbol": "1000BONKUSDT", "market": "future-orderbook-snapshot", "data": {"lastUpdateId": 1, "bids": [["1", "1"]], "asks": []}}
    (row,) = dicts(books.book_flatten(raw(spark, message)))
    assert row == {
        "exchange": "binance", "symbol": "BONKUSDT", "market": "future-orderbook-snapshot", "ts_ms": ARRIVAL_MS,
        "last_update_id": 1, "side": "bid", "price": 1.0, "quantity": 1.0, "level": 1,
    }


def test_bybit_book_and_holes_in_levels(spark):
    data = {"result": {"u": 1, "b": [["1", "1"], ["bad", "1"], ["2", "0"], ["3"], ["4", "5"]], "a": []}}
    rows = dicts(books.book_flatten(raw(spark, {"exchange": "bybit", "symbol": "BTCUSDT", "data": data})))
    assert sorted((r["level"], r["price"]) for r in rows) == [(1, 1.0), (5, 4.0)]


def test_kucoin_and_okx_books(spark):
    kucoin = {"exchange": "kucoin", "symbol": "XBTUSDTM", "data": {"sequence": 9, "bids": [[0.0000001, 100000000], [1]], "asks": [[3, 4, 5]]}}
    okx = {"exchange": "okx", "symbol": "BTC-USDT-SWAP", "data": {"data": [{"bids": [["1", "2", "0", "1"]], "asks": [["x"]], "ts": "bad"}, {"bids": [["9", "9"]], "asks": [], "ts": "1"}]}}
    empty = {"exchange": "okx", "symbol": "BTC-USDT-SWAP", "data": {"data": [{"bids": [], "asks": [], "ts": "1"}]}}
    rows = {r["exchange"]: r for r in dicts(books.decode_books(raw(spark, kucoin, okx, empty)))}
    assert rows["kucoin"]["symbol"] == "BTCUSDT"
    assert rows["kucoin"]["bids"] == [["0.0000001", "100000000"], []] and rows["kucoin"]["asks"] == [["3", "4"]]
    assert rows["okx"]["bids"] == [["1", "2"]] and rows["okx"]["asks"] == [[]] and rows["okx"]["last_update_id"] == 0


def test_broken_messages_are_quarantined_whole(spark):
    bad = [
        {"exchange": "binance", "data": '{"lastUpdateId":1,"bids":[["1","1"]]'},
        {"exchange": "binance", "data": {"lastUpdateId": "1", "bids": [["1", "1"]]}},
        {"exchange": "kucoin", "data": {"sequence": 1, "bids": [["1", "1"]]}},
    ]
    good = {"exchange": "bybit", "data": {"result": {}}}
    frame = raw(spark, *[{**m, "feed": "fobs"} for m in (*bad, good)])
    assert books.book_flatten(frame).count() == 0
    assert quarantine.rejects(frame).count() == 3


def test_every_feed_reports_what_it_cannot_decode(spark):
    wrong = {
        "fobd": {"binance": {"E": "x"}, "bybit": {"data": 5}, "kucoin": {"data": {"sequence": "x"}}, "okx": {"data": [{"bids": 1}]}},
        "foi": {"binance": {"time": "x"}, "bybit": {"ts": "x"}, "kucoin": {"time": []}, "okx": {"data": "x"}},
        "pi": {"binance": {"T": "x"}, "bybit": {"ts": "x"}, "kucoin": {"dataList": [{"value": "x"}]}, "okx": {"data": 1}},
        "liq": {"binance": {"o": {"t": "x"}}, "bybit": {"data": [{"T": "x"}]}, "kucoin": {"data": {"ts": "x"}}, "okx": {"data": {}}},
    }
    bad = [{"feed": f, "exchange": v, "data": d} for f, venues in wrong.items() for v, d in venues.items()]
    cut = [{**m, "data": json.dumps(m["data"])[:-1]} for m in bad]
    good = [{**m, "data": {}} for m in bad]
    unknown = [{"feed": "foi", "exchange": "kraken", "data": "?"}, {"feed": "other", "exchange": "okx", "data": "?"}, {"exchange": "okx", "data": "?"}]
    frame = raw(spark, *bad, *cut, *good, *unknown)
    rejected = quarantine.rejects(frame)
    assert rejected.count() == len(bad) + len(cut)
    assert {tuple(r) for r in quarantine.reject_counts(rejected).select("feed", "exchange", "messages").collect()} == {
        (m["feed"], m["exchange"], 2) for m in bad
    }


def test_binance_delta_in_either_letter_case(spark):
    for price, quantity in (("price", "quantity"), ("Price", "Quantity")):
        data = {"E": 1, "U": 5, "u": 1, "pu": 0, "s": "1000BONKUSDT", "b": [{price: "1", quantity: "0"}], "a": []}
        (row,) = dicts(deltas.delta_flatten(raw(spark, {"exchange": "binance", "market": "fobd", "data": data})))
        assert (row["symbol"], row["price"], row["quantity"], row["first_update_id"], row["update_id"]) == ("BONKUSDT", 1.0, 0.0, 5, 1)


def test_bybit_delta(spark):
    data = {"topic": "orderbook.50.BTCUSDT", "ts": 1, "data": {"s": "BTCUSDT", "b": [["1", "1"], ["2"]], "seq": 1}}
    (row,) = dicts(deltas.delta_flatten(raw(spark, {"exchange": "bybit", "data": data})))
    assert (row["symbol"], row["event_time"], row["update_id"], row["prev_update_id"], row["received_time"]) == ("BTCUSDT", 1, 1, 0, ARRIVAL_MS)


def test_okx_delta(spark):
    data = {
        "arg": {"channel": "books", "instType": "SWAP", "instId": "BTC-USDT"}, "action": "snapshot",
        "data": [{"bids": [["1", "2"]], "asks": [["3", "4"]], "ts": "1700000000000"}],
    }
    rows = dicts(deltas.delta_flatten(raw(spark, {"exchange": "okx", "data": data})))
    assert {(r["side"], r["price"], r["quantity"], r["update_id"]) for r in rows} == {("bid", 1.0, 2.0, 1700000000000), ("ask", 3.0, 4.0, 1700000000000)}


def test_kucoin_changes(spark):
    expected = {
        "1.5,buy,2": ("bid", 1.5, 2.0), "sell , 1.5 , 2": ("ask", 1.5, 2.0), "1.5,2,buy,7": ("bid", 1.5, 2.0),
        "1.5,buy": None, "": None, "1.5,2,hold": None, "buy,,1,2": ("bid", 1.0, 2.0),
    }
    for change, want in expected.items():
        data = {"topic": "/contractMarket/level2:XBTUSDTM", "data": {"sequence": 5, "change": change, "timestamp": 9}}
        rows = dicts(deltas.delta_flatten(raw(spark, {"exchange": "kucoin", "data": data})))
        assert [(r["side"], r["price"], r["quantity"]) for r in rows] == ([want] if want else []), change


def test_open_interest_falls_back_to_arrival(spark):
    messages = [
        {"exchange": "binance", "symbol": "BTCUSDT", "data": {"openInterest": "7", "time": 0}},
        {"exchange": "okx", "data": {"data": [{"instId": "btc-usdt-swap", "oi": "8", "ts": "x"}, {"instId": "eth-usdt-swap", "oi": "", "ts": "5"}]}},
        {"exchange": "mars", "data": {"openInterest": "7", "time": 0}},
    ]
    rows = dicts(indicators.oi_normalize(indicators.decode_oi(raw(spark, *messages))))
    assert {(r["exchange"], r["symbol"], r["event_time"], r["open_interest"]) for r in rows} == {
        ("binance", "BTCUSDT", ARRIVAL_MS, 7.0), ("okx", "BTCUSDT", ARRIVAL_MS, 8.0),
    }


def test_premium_index(spark):
    messages = [
        {"exchange": "binance", "symbol": "BTCUSDT", "data": {"E": 5, "p": "10.5", "i": "10", "P": "", "r": "x", "T": 0}},
        {"exchange": "kucoin", "symbol": "XBTUSDTM", "data": {"dataList": [{"timePoint": 7, "value": 0.25}, {"timePoint": 8, "value": 1}]}},
    ]
    rows = {r["exchange"]: r for r in dicts(indicators.pi_normalize(indicators.decode_pi(raw(spark, *messages))))}
    assert (rows["binance"]["premium_index"], rows["binance"]["funding_rate"], rows["binance"]["next_funding_time"]) == (0.5, 0.0, None)
    assert (rows["kucoin"]["premium_index"], rows["kucoin"]["event_time"], rows["kucoin"]["symbol"]) == (0.25, 7, "BTCUSDT")


def test_liquidations(spark):
    bybit = {"topic": "allLiquidation.ROSEUSDT", "type": "snapshot", "ts": 1739502303204, "data": [{"T": 1739502302929, "s": "ROSEUSDT", "S": "Sell", "v": "20000", "p": "0.04499"}]}
    detail = {"bkLoss": "0", "bkPx": "1.057", "ccy": "", "posSide": "long", "side": "sell", "sz": "768", "ts": "1723892524781"}
    okx = {"arg": {"channel": "liquidation-orders", "instType": "SWAP"}, "data": [{"details": [detail], "instFamily": "DYDX-USDT", "uly": "DYDX-USDT"}, {"instFamily": "A"}]}
    frame = raw(spark, {"exchange": "bybit", "data": bybit}, {"exchange": "okx", "data": okx}, {"exchange": "kucoin", "data": bybit})
    rows = {r["exchange"]: r for r in dicts(liquidations.liq_normalize(frame))}
    assert set(rows) == {"bybit", "okx"}
    b, o = rows["bybit"], rows["okx"]
    assert (b["side"], b["quantity"], b["price"], b["time_ms"], b["order_type"], b["is_maker"]) == ("SELL", 20000.0, 0.04499, 1739502302929, "LIQUIDATION", False)
    assert (o["symbol"], o["side"], o["position_side"], o["quantity"], o["price"]) == ("DYDX-USDT", "SELL", "LONG", 768.0, 1.057)
    assert liquidations.liq_normalize(frame, ["btc-usdt"]).filter("exchange = 'okx'").count() == 0


def test_control_frames(spark):
    kept = {"exchange": "okx", "feed": "fobd", "data": {"arg": {"instId": "A"}, "data": []}}
    dropped = [
        {"exchange": "okx", "feed": "fobd", "data": {"event": None}},
        {"exchange": "okx", "feed": "fobd", "data": {"ping": 1}},
        {"exchange": "okx", "feed": "pi", "data": {"arg": {"channel": "open-interest"}}},
        {"exchange": "bybit", "feed": "pi", "data": {"op": "ping", "topic": "tickers.A"}},
        {"exchange": "bybit", "feed": "fobd", "data": {"topic": "orderbook"}},
        {"exchange": "bybit", "feed": "liq", "data": "not json"},
    ]
    (row,) = dicts(frames.keep_data_frames(raw(spark, kept, *dropped)))
    assert row["exchange"] == "okx"


def test_plain_decimal_of_any_size(spark):
    from pyspark.sql import functions as F

    from mdlake.functions.parsing import plain_decimal

    cases = {
        "1e21": "1" + "0" * 21, "1.5e-19": "0.00000000000000000015", "123456789012345680000": "123456789012345680000",
        "0": "0", "10": "10", "1.50": "1.5", "-2.5e-3": "-0.0025", "100.25": "100.25", "1e-1": "0.1", "0.001": "0.001",
    }
    rows = spark.createDataFrame([(k,) for k in cases], "x STRING").select("x", plain_decimal(F.col("x").cast("double").cast("string")).alias("p"))
    assert {r["x"]: r["p"] for r in rows.collect()} == cases


def test_kucoin_executions_of_configured_symbols(spark):
    """Subjects in any case; broken payloads and other symbols go; an empty list keeps all."""
    def sent(symbol, subject):
        return f'{{"topic":"/t:{symbol}","subject":"{subject}","data":{{"symbol":"{symbol}","side":"buy","size":"1","price":"2","ts":1700000000000}}}}'

    bodies = [sent("xbtusdtm", "LIQUIDation.order"), sent("ETHUSDTM", "liquidation"), sent("XBTUSDTM", "match"), '{"topic":', "", None]
    raw = spark.createDataFrame([("kucoin", b) for b in bodies] + [("okx", bodies[0])], "exchange STRING, data STRING")
    raw = raw.withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp"))

    def left(symbols):
        configured = None if symbols is None else spark.createDataFrame([(s,) for s in symbols], "symbol STRING")
        return sorted(r.symbol for r in liquidations.kucoin_liquidations(raw, configured).collect())

    assert left(None) == left([]) == ["ETHUSDTM", "XBTUSDTM"]
    assert left(["xbtusdtm"]) == ["XBTUSDTM"] and left(["SOLUSDTM"]) == []


def test_frames_are_put_together_once(spark):
    """A filter pushed below the projection that makes the text would make it twice."""
    made = F.concat(F.lit('{"topic":"tickers.marker","n":'), F.col("id").cast("string"), F.when(F.col("id") % 2 == 0, "}").otherwise("]"))
    raw = spark.range(10).select(F.lit("pi").alias("feed"), F.lit("bybit").alias("exchange"), made.alias("data"), F.col("id").alias("message_id"))
    kept = frames.keep_data_frames(raw)
    assert kept.columns == raw.columns
    assert sorted(r.message_id for r in kept.collect()) == [0, 2, 4, 6, 8]
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("tickers.marker") == 1
