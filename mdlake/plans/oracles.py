"""The SQL each named query is checked against.

Every statement computes the expected result straight from the given tables,
without building or parsing a single message.
"""

from __future__ import annotations

VENUES = "['binance','bybit','kucoin','okx']"
NATIVE = (
    "['BTCUSDT','ETHUSDC','1000BONKUSDT','1000SHIBUSDT','BTCUSDT','ETHPERP','1000PEPEUSDT','SHIB1000USDT',"
    "'XBTUSDTM','ETHUSDCM','SOLUSDTM','XRPUSDTM','BTC-USDT-SWAP','ETH-USDT-SWAP','SOL-USDT-SWAP','XRP-USDT-SWAP']"
)
CANONICAL = (
    "['BTCUSDT','ETHUSDC','BONKUSDT','SHIBUSDT','BTCUSDT','ETHUSDC','PEPEUSDT','SHIBUSDT',"
    "'BTCUSDT','ETHUSDC','SOLUSDT','XRPUSDT','BTCUSDT','ETHUSDT','SOLUSDT','XRPUSDT']"
)
BOOK_MARKET = "CASE WHEN exchange = 'okx' THEN 'swap-orderbook-snapshot' ELSE 'future-orderbook-snapshot' END"
DELTA_MARKET = "CASE WHEN exchange = 'okx' THEN 'swap-orderbook-delta' ELSE 'future-orderbook-delta' END"
ABSENT = "CAST(-62135596800000 AS BIGINT)"
HOUR = 3_600_000
WEEK = 168 * HOUR

# --- building blocks -----------------------------------------------------------

HDR = f"""hdr AS (
  SELECT o_orderkey AS k, o_custkey AS c, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, {VENUES}[o_orderkey % 4 + 1] AS exchange,
         {NATIVE}[(o_orderkey % 4) * 4 + o_custkey % 4 + 1] AS native,
         {CANONICAL}[(o_orderkey % 4) * 4 + o_custkey % 4 + 1] AS symbol,
         epoch_us(o_orderdate) // 1000 + (o_orderkey % 86400) * 1000 AS ms
  FROM orders)"""

LIN = """lv0 AS (
  SELECT hdr.*, side, i AS level, k * 7 + i * 3 + CASE side WHEN 'bid' THEN 0 ELSE 1 END AS mark,
         cents + i * CASE side WHEN 'bid' THEN -7 ELSE 7 END AS pc, (c + i) % 50 + 1 AS qi
  FROM hdr, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS i) n, (VALUES ('bid'), ('ask')) s(side)),
lv AS (
  SELECT * REPLACE (CASE WHEN rule = 'word' THEN 'abc' WHEN rule = 'suffix' THEN '1.5d' ELSE pt END AS pt),
         CASE WHEN rule IN ('word', 'suffix') THEN NULL ELSE CAST(pc AS DOUBLE) / 100 END AS price,
         CASE WHEN rule = 'zero' THEN '0.00' ELSE qi || '.00' END AS qt,
         CASE WHEN rule = 'zero' THEN 0.0::DOUBLE ELSE CAST(qi AS DOUBLE) END AS quantity,
         CAST(pc AS DECIMAL(18,2)) / 100 AS dp
  FROM (SELECT *, CASE WHEN mark % 10 = 0 THEN 'zero' WHEN mark % 17 = 0 THEN 'word' WHEN mark % 19 = 0 THEN 'suffix'
                       WHEN mark % 23 = 0 THEN 'short' ELSE 'ok' END AS rule,
               (pc // 100) || '.' || lpad(CAST(pc % 100 AS VARCHAR), 2, '0') AS pt FROM lv0))"""

MSG = f"""{HDR}, {LIN},
lines AS (SELECT * FROM lv WHERE level <= CASE side WHEN 'bid' THEN (k + 1) % 6 ELSE c % 5 END),
heads AS (SELECT * FROM hdr WHERE k % 97 <> 0 AND (k % 89 <> 0 OR exchange = 'okx')),
good AS (SELECT * FROM lines WHERE k % 97 <> 0 AND (k % 89 <> 0 OR exchange = 'okx')),
changes AS (SELECT * FROM lv WHERE exchange = 'kucoin' AND level = 1 AND side = CASE WHEN k // 4 % 2 = 0 THEN 'bid' ELSE 'ask' END
            AND k % 97 <> 0 AND k % 89 <> 0)"""

BOOK = f"""{MSG}, book AS (
  SELECT k, exchange, symbol, {BOOK_MARKET} AS market, ms AS ts_ms,
         CASE WHEN exchange <> 'okx' THEN k WHEN k % 89 = 0 THEN 0 ELSE ms END AS last_update_id,
         side, price, quantity, level
  FROM good WHERE rule <> 'short' AND price <> 0 AND quantity <> 0)"""

DELTA = f"""{MSG}, delta AS (
  SELECT k, exchange, {DELTA_MARKET} AS market, symbol,
         CASE WHEN exchange = 'okx' AND k % 89 = 0 THEN 0 ELSE ms - 7 END AS event_time,
         CASE exchange WHEN 'binance' THEN k + 1 WHEN 'bybit' THEN k * 2 WHEN 'kucoin' THEN k * 10
              ELSE CASE WHEN k % 89 = 0 THEN 0 ELSE ms - 7 END END AS update_id,
         CASE exchange WHEN 'binance' THEN k - 1 WHEN 'bybit' THEN k * 2 - 1 WHEN 'kucoin' THEN k * 10 - 1
              ELSE CASE WHEN k % 89 = 0 THEN 0 ELSE ms - 7 END END AS prev_update_id,
         CASE exchange WHEN 'binance' THEN k WHEN 'bybit' THEN k * 2 WHEN 'kucoin' THEN k * 10
              ELSE CASE WHEN k % 89 = 0 THEN 0 ELSE ms - 7 END END AS first_update_id,
         side, price, quantity, ms AS received_time, level
  FROM (SELECT * FROM good WHERE exchange <> 'kucoin' UNION ALL SELECT * FROM changes WHERE k % 29 <> 0)
  WHERE rule <> 'short' AND price IS NOT NULL)"""

EV = f"""ev AS (
  SELECT event_id AS k, epoch_us(ts) // 1000 AS ms, user_id AS u, event_type, value,
         CAST(value AS DECIMAL(18,2)) AS dv, {VENUES}[event_id % 4 + 1] AS exchange,
         {NATIVE}[(event_id % 4) * 4 + user_id % 4 + 1] AS native,
         {CANONICAL}[(event_id % 4) * 4 + user_id % 4 + 1] AS symbol
  FROM events)"""

OI = f"""{EV}, oim AS (
  SELECT *, CASE WHEN k % 13 = 0 THEN 'abc' WHEN k % 17 = 0 THEN '1.5d' WHEN k % 19 = 0 THEN ' ' || dv || ' '
                 WHEN k % 23 = 0 THEN '1e400' WHEN k % 11 = 0 AND exchange = 'okx' THEN '' ELSE CAST(dv AS VARCHAR) END AS oi_text,
         CASE WHEN k % 13 = 0 OR k % 17 = 0 OR k % 19 = 0 OR k % 23 = 0 OR (k % 11 = 0 AND exchange = 'okx') THEN NULL
              ELSE CAST(dv AS DOUBLE) END AS oi,
         CASE WHEN k % 7 = 0 THEN 0 ELSE ms - 5 END AS sent
  FROM ev WHERE k % 97 <> 0 AND (k % 89 <> 0 OR exchange = 'okx')),
oie AS (
  SELECT k, exchange, native, symbol, oi_text, oi, ms, sent FROM oim
  UNION ALL
  SELECT k, exchange, 'SOLPERP', 'SOLUSDC', '7.25', 7.25, ms, sent FROM oim WHERE exchange = 'bybit' AND k % 3 = 0),
oid AS (
  SELECT k, exchange, 'future-openinterest' AS market, native, symbol, oi_text, oi,
         CASE WHEN exchange = 'okx' AND sent = 0 THEN ms ELSE sent END AS payload_time,
         CASE WHEN exchange IN ('bybit', 'okx') AND sent > 0 THEN sent ELSE ms END AS message_ms
  FROM oie),
oin AS (
  SELECT k, exchange, market, symbol, CASE WHEN payload_time = 0 THEN message_ms ELSE payload_time END AS event_time,
         oi AS open_interest, message_ms AS received_time
  FROM oid WHERE oi IS NOT NULL)"""

PI = f"""{EV}, pid AS (
  SELECT k, exchange, native, symbol, ms AS arrival_ms,
         CASE WHEN exchange = 'kucoin' OR k % 13 = 0 OR k % 17 = 0 THEN 0.0::DOUBLE ELSE CAST(dv AS DOUBLE) END AS mark_price,
         CASE WHEN exchange = 'kucoin' THEN 0.0::DOUBLE ELSE CAST(CAST(value - 1 AS DECIMAL(18,2)) AS DOUBLE) END AS index_price,
         CASE WHEN exchange = 'binance' THEN CAST(dv AS DOUBLE) ELSE 0.0::DOUBLE END AS estimated_settle_price,
         CASE WHEN exchange IN ('binance', 'bybit') THEN CAST('0.000' || lpad(CAST(k % 1000 AS VARCHAR), 3, '0') AS DOUBLE)
              ELSE 0.0::DOUBLE END AS funding_rate,
         CASE WHEN k % 3 = 0 THEN NULL WHEN exchange = 'binance' THEN ms + 3600000
              WHEN exchange = 'bybit' AND k % 5 <> 0 THEN ms + 3600000 END AS next_funding_time,
         CASE WHEN k % 7 <> 0 THEN ms - 5 WHEN exchange IN ('bybit', 'okx') THEN ms ELSE 0 END AS message_ms,
         CASE exchange WHEN 'binance' THEN 'binance_ws' WHEN 'bybit' THEN 'bybit_linear_ws' WHEN 'okx' THEN 'okx_ws'
              ELSE 'kucoin_rest' END AS source
  FROM ev
  WHERE k % 97 <> 0 AND (k % 89 <> 0 OR exchange = 'okx') AND NOT (exchange = 'kucoin' AND k % 31 = 0)),
pie AS (
  SELECT *, 'pi' AS market, CASE WHEN exchange = 'kucoin'
           THEN CAST('0.000' || lpad(CAST(k % 1000 AS VARCHAR), 3, '0') AS DOUBLE)
           ELSE mark_price - index_price END AS premium_index
  FROM pid),
pin AS (
  SELECT exchange, market, symbol, CASE WHEN message_ms = 0 THEN arrival_ms ELSE message_ms END AS event_time, mark_price,
         index_price, estimated_settle_price, funding_rate, next_funding_time, premium_index, arrival_ms AS received_time
  FROM pie)"""

FORCED = f"""fl AS (
  SELECT l_orderkey AS k, l_partkey AS pk, l_returnflag AS flag, l_linenumber AS ln, {VENUES}[l_orderkey % 4 + 1] AS exchange,
         {NATIVE}[(l_orderkey % 4) * 4 + l_suppkey % 4 + 1] AS native,
         epoch_us(l_shipdate) // 1000 + (l_orderkey % 86400) * 1000 AS ms,
         CASE WHEN l_partkey % 17 = 0 OR l_partkey % 19 = 0 THEN 0.0::DOUBLE ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) END AS price,
         CASE WHEN l_partkey % 10 = 0 THEN '0.00' ELSE CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) END AS qt
  FROM lineitem)"""

KUCOIN_LIQ = f"""{FORCED}, x AS (
  SELECT *, CASE ln WHEN 2 THEN 0 WHEN 4 THEN ms // 1000 WHEN 6 THEN ms ELSE ms * 1000000 END AS stamp FROM fl
  WHERE exchange = 'kucoin' AND k % 3 <> 0 AND k % 97 <> 0),
kl AS (SELECT exchange, native,
       CASE WHEN stamp <= 0 THEN ms WHEN stamp < 1000000000000 THEN stamp * 1000 WHEN stamp < 1000000000000000 THEN stamp
            ELSE stamp // 1000000 END AS ts_ms FROM x)"""

LIQ = f"""{FORCED},
parts AS (
  SELECT *, CAST(qt AS DOUBLE) AS quantity, ms + ln AS made, 'own' AS part FROM fl
  UNION ALL SELECT *, 2.5::DOUBLE, ms + 1, 'own' FROM fl WHERE exchange IN ('bybit', 'okx') AND ln % 2 = 0
  UNION ALL SELECT *, CAST(qt AS DOUBLE), ms, 'extra' FROM fl WHERE exchange = 'okx' AND flag = 'R'),
liq AS (
  SELECT exchange,
         CASE WHEN part = 'extra' THEN 'DOGE-USDT' WHEN exchange = 'okx' THEN replace(native, '-SWAP', '') ELSE native END AS symbol,
         CASE WHEN exchange = 'binance' THEN CASE WHEN flag = 'R' THEN 'SELL' ELSE 'BUY' END
              ELSE CASE flag WHEN 'R' THEN 'SELL' WHEN 'A' THEN 'BUY' ELSE 'NONE' END END AS side,
         CASE exchange WHEN 'binance' THEN 'LONG' WHEN 'bybit' THEN '' ELSE CASE WHEN flag = 'R' THEN 'LONG' ELSE 'SHORT' END END AS position_side,
         CASE WHEN exchange = 'binance' THEN 'LIMIT' ELSE 'LIQUIDATION' END AS order_type,
         CASE exchange WHEN 'binance' THEN CASE WHEN k % 5 <> 0 THEN ms WHEN k % 7 = 0 THEN 0 ELSE ms + ln END
              WHEN 'bybit' THEN made ELSE CASE WHEN k % 11 = 0 THEN 0 ELSE made END END AS time_ms,
         quantity, price,
         CASE WHEN exchange = 'binance' AND flag <> 'A' THEN quantity ELSE 0 END AS avg_price,
         CASE WHEN exchange = 'binance' THEN quantity ELSE 0 END AS last_qty,
         CASE WHEN exchange = 'binance' THEN price ELSE 0 END AS last_price,
         CASE WHEN exchange = 'binance' THEN pk ELSE 0 END AS trade_id,
         exchange = 'binance' AND ln % 2 = 0 AS is_maker, false AS is_reduce_only,
         CASE WHEN exchange = 'binance' THEN 'CONTRACT_PRICE' ELSE '' END AS working_type,
         CASE WHEN exchange = 'binance' THEN 'LIMIT' ELSE '' END AS original_type,
         exchange = 'binance' AND ln % 2 = 0 AS close_all,
         CASE WHEN exchange = 'binance' THEN CAST('-' || qt AS DOUBLE) ELSE 0 END AS realized_pnl
  FROM parts WHERE exchange <> 'kucoin' AND k % 97 <> 0)"""

MET = f"""{EV}, met AS (
  SELECT k AS event_id, ms // 1000 AS ts_ms, event_type AS component,
         ['fobs_raw_buffer_length','fobs_norm_buffer_length','fobd_raw_buffer_length','fobd_norm_buffer_length',
          'liq_raw_buffer_length','used_weight','cpu_percent','foi_raw_buffer_length',''][k % 9 + 1] AS name,
         CASE WHEN k % 10 = 0 THEN 'n/a' WHEN k % 10 = 1 THEN '5' ELSE CAST(dv AS VARCHAR) END AS value,
         CASE WHEN k % 10 > 1 THEN CAST(dv AS DOUBLE) END AS number,
         CASE WHEN k % 6 = 0 THEN 'counter' ELSE 'gauge' END AS type,
         CASE WHEN k % 2 = 0 THEN 'okx' ELSE '' END AS exchange_field,
         CASE WHEN u % 2 = 0 THEN '10.0.0.1' ELSE '10.0.0.2' END AS ip,
         CASE WHEN k % 4 = 0 THEN 'Percent' ELSE 'Count' END AS unit,
         CASE WHEN k % 5 = 0 THEN CAST((k % 9 + 1) * 1000 AS DOUBLE) END AS capacity
  FROM ev),
mok AS (SELECT * FROM met WHERE name <> ''),
mnum AS (SELECT *, concat_ws('|', 'component=' || component,
           CASE WHEN exchange_field <> '' THEN 'exchange=' || exchange_field END, 'ip=' || ip) AS dims
         FROM mok WHERE number IS NOT NULL),
mser AS (SELECT *, component || '|' || name || '|' || dims || '|unit=' || unit AS series FROM mnum)"""

STG = f"""{EV}, stg AS (
  SELECT k AS event_id, ms // 1000 AS ts_ms, ['fobs','fobd','foi','pi','liq'][k % 5 + 1] AS feed,
         CASE WHEN u % 2 = 0 THEN 'raw' ELSE 'norm' END AS stage, CASE WHEN k % 7 = 0 THEN 'dropped' ELSE 'sent' END AS outcome,
         exchange AS venue, CASE WHEN k % 3 = 0 THEN '' ELSE exchange END AS exchange,
         CASE WHEN k % 11 = 0 THEN '' ELSE native END AS symbol
  FROM ev),
mkt AS (SELECT *, CASE feed WHEN 'fobs' THEN CASE WHEN venue = 'okx' THEN 'swap' ELSE 'future' END || '-orderbook-snapshot'
                  WHEN 'fobd' THEN CASE WHEN venue = 'okx' THEN 'swap' ELSE 'future' END || '-orderbook-delta'
                  WHEN 'foi' THEN 'future-openinterest' WHEN 'pi' THEN 'pi' ELSE 'liquidation' END AS market_seen FROM stg),
drp AS (SELECT ts_ms, CASE WHEN feed = 'fobs' AND stage = 'raw' THEN 'snapshot_messages_dropped'
               WHEN feed = 'fobd' AND stage = 'raw' THEN 'delta_messages_dropped'
               WHEN feed = 'fobd' AND stage = 'norm' THEN 'delta_norm_messages_dropped'
               WHEN feed = 'liq' AND stage = 'raw' THEN 'liquidation_messages_dropped'
               WHEN feed = 'foi' AND stage = 'raw' THEN 'open_interest_messages_dropped'
               WHEN feed = 'pi' AND stage = 'raw' THEN 'premium_index_messages_dropped'
               ELSE 'other_messages_dropped' END AS name, exchange, market_seen AS market, symbol, stage
        FROM mkt WHERE outcome = 'dropped')"""

# Message headers for batching: key, ts_ms, id, rows.
BOOK_MSGS = f"""{BOOK}, msgs AS (
  SELECT exchange || '_' || market || '_' || symbol AS key, ts_ms, k AS id, count(*) AS rows
  FROM book GROUP BY ALL)"""
OI_MSGS = f"""{OI}, msgs AS (
  SELECT exchange || '_' || market || '_' || symbol AS key, received_time AS ts_ms, k AS id, CAST(1 AS BIGINT) AS rows, open_interest
  FROM oin)"""


def greedy(rows: int | None = None, age_ms: int | None = None, idle_ms: int | None = None) -> str:
    """Sequential numbering of ``msgs`` per key, as CTE ``numbered``."""
    tests = []
    if rows is not None:
        tests.append(f"a.c >= {rows}")
    if age_ms is not None:
        tests.append(f"x.t - a.s >= {age_ms}")
    if idle_ms is not None:
        tests.append(f"x.t - a.t > {idle_ms}")
    return f"""runs AS (
  SELECT key, list(id ORDER BY ts_ms, id) AS ids, list(ts_ms ORDER BY ts_ms, id) AS times, list(rows ORDER BY ts_ms, id) AS sizes,
         list_reduce(list({{'c': rows, 's': ts_ms, 't': ts_ms, 'no': CAST(0 AS BIGINT), 'nos': [CAST(0 AS BIGINT)]}} ORDER BY ts_ms, id),
           lambda a, x: CASE WHEN {' OR '.join(tests)}
             THEN {{'c': x.c, 's': x.t, 't': x.t, 'no': a.no + 1, 'nos': list_append(a.nos, a.no + 1)}}
             ELSE {{'c': a.c + x.c, 's': a.s, 't': x.t, 'no': a.no, 'nos': list_append(a.nos, a.no)}} END) AS r
  FROM msgs GROUP BY key),
numbered AS (SELECT key, unnest(ids) AS id, unnest(times) AS ts_ms, unnest(sizes) AS rows, unnest(r.nos) AS batch_no FROM runs),
sizes AS (SELECT key, batch_no, count(*) AS messages, CAST(sum(rows) AS BIGINT) AS record_count,
                 min(ts_ms) AS first_ms, max(ts_ms) AS last_ms FROM numbered GROUP BY key, batch_no)"""


def utc_stamp(ms: str) -> str:
    return f"strftime(make_timestamp(({ms}) * 1000), '%Y%m%d%H%M%S')"


def utc(ms: str, form: str) -> str:
    return f"strftime(make_timestamp(({ms}) * 1000), '{form}')"


def side_text(level: str, side: str, kept: str = "true") -> str:
    """The levels of one side of message ``h`` as one text, and their number."""
    name = f"{side}s"
    shown = f"l.side = '{side}' AND {kept}"
    return f"""CAST(count(*) FILTER (WHERE {shown}) AS INTEGER) AS n_{name},
       coalesce(string_agg({level}, ';' ORDER BY l.level) FILTER (WHERE {shown}), '') AS {name}"""


def decode_book(venue: str) -> str:
    symbol = "h.symbol" if venue == "kucoin" else "h.native"
    update = "CASE WHEN h.k % 89 = 0 THEN 0 ELSE h.ms END" if venue == "okx" else "h.k"
    if venue == "kucoin":
        # Shortest decimal text: no trailing zeros.
        price = r"CASE WHEN rule IN ('word', 'suffix') THEN '0' ELSE regexp_replace(pt, '\.?0+$', '') END"
        level = f"CASE WHEN rule = 'short' THEN '' ELSE ({price}) || '@' || CASE WHEN rule = 'zero' THEN '0' ELSE CAST(qi AS VARCHAR) END END"
    else:
        level = f"CASE WHEN rule = 'short' THEN {chr(39) * 2 if venue == 'okx' else 'pt'} ELSE pt || '@' || qt END"
    # Only okx drops a message without any level.
    empty = "HAVING count(l.side) > 0" if venue == "okx" else ""
    market = BOOK_MARKET.replace("exchange", "h.exchange")
    return f"""WITH {MSG}
SELECT h.exchange, {symbol} AS symbol, {market} AS market, h.ms AS ts_ms, {update} AS last_update_id,
       {side_text(level, 'bid')}, {side_text(level, 'ask')}
FROM heads h LEFT JOIN good l USING (k) WHERE h.exchange = '{venue}' GROUP BY h.k, h.exchange, h.native, h.symbol, h.ms {empty}"""


def decode_delta(venue: str) -> str:
    event = "CASE WHEN h.k % 89 = 0 THEN 0 ELSE h.ms - 7 END" if venue == "okx" else "h.ms - 7"
    ids = {
        "binance": ("h.k + 1", "h.k - 1", "h.k"),
        "bybit": ("h.k * 2", "h.k * 2 - 1", "h.k * 2"),
        "kucoin": ("h.k * 10", "h.k * 10 - 1", "h.k * 10"),
        "okx": (event, event, event),
    }[venue]
    symbol = "h.symbol" if venue == "kucoin" else "h.native"
    lines = "changes" if venue == "kucoin" else "good"
    kept = {"binance": "true", "kucoin": "rule <> 'short' AND h.k % 29 <> 0"}.get(venue, "rule <> 'short'")
    level = "CASE WHEN rule = 'short' THEN pt || '@' ELSE pt || '@' || qt END"
    market = DELTA_MARKET.replace("exchange", "h.exchange")
    return f"""WITH {MSG}
SELECT h.exchange, {market} AS market, {symbol} AS symbol, h.ms AS received_time, {event} AS event_time,
       {ids[0]} AS update_id, {ids[1]} AS prev_update_id, {ids[2]} AS first_update_id,
       {side_text(level, 'bid', kept)}, {side_text(level, 'ask', kept)}
FROM heads h LEFT JOIN {lines} l USING (k) WHERE h.exchange = '{venue}' GROUP BY h.k, h.exchange, h.native, h.symbol, h.ms"""


def decode_oi(venue: str) -> str:
    return f"""WITH {OI}
SELECT exchange, market, native AS symbol, oi_text, payload_time, message_ms FROM oid WHERE exchange = '{venue}'"""


def decode_pi(venue: str) -> str:
    return f"""WITH {PI}
SELECT exchange, market, arrival_ms, native AS symbol, mark_price, index_price, estimated_settle_price, funding_rate,
       coalesce(next_funding_time, -1) AS next_funding_time, premium_index, source, message_ms
FROM pie WHERE exchange = '{venue}'"""


LIQ_COLUMNS = (
    "exchange, symbol, side, position_side, order_type, time_ms, quantity, price, avg_price, last_qty, last_price, trade_id, "
    "is_maker, is_reduce_only, working_type, original_type, close_all, realized_pnl"
)


def number_shape(column: str) -> str:
    """Value of the k-th number text, NULL where it is not a number."""
    return f"""CASE k % 17 WHEN 0 THEN CAST(dv AS DOUBLE) WHEN 1 THEN CAST(dv AS DOUBLE) WHEN 2 THEN CAST('-' || dv AS DOUBLE)
       WHEN 3 THEN CAST(dv || 'e2' AS DOUBLE) WHEN 4 THEN CAST('0.' || (k % 100) AS DOUBLE) WHEN 5 THEN CAST(k % 100 AS DOUBLE)
       WHEN 10 THEN 0.0 END AS {column}"""


ORACLES: dict[str, str] = {
    # sources and routing
    "raw_landing_scan": f"""WITH {HDR}, {FORCED}, {EV},
raw AS (
  SELECT 'fobs' AS feed, exchange, {BOOK_MARKET} AS market, ms FROM hdr
  UNION ALL SELECT 'fobd', exchange, {DELTA_MARKET}, ms FROM hdr
  UNION ALL SELECT 'foi', exchange, 'future-openinterest', ms FROM ev
  UNION ALL SELECT 'pi', exchange, 'pi', ms FROM ev
  UNION ALL SELECT 'liq', exchange, 'liquidation', ms FROM fl)
SELECT feed, exchange, market, count(*) AS messages, min(ms) AS first_ms, max(ms) AS last_ms FROM raw GROUP BY ALL""",
    "feed_fan_in": f"""WITH {EV}
SELECT exchange, native AS symbol, count(*) AS messages, CAST(sum(k) AS BIGINT) AS id_sum FROM ev GROUP BY ALL""",
    "market_tag": f"""WITH {STG}
SELECT venue AS exchange, feed, market_seen AS market, count(*) AS n FROM mkt GROUP BY ALL""",
    "control_frame_filter": f"""
SELECT event_id AS message_id, ['okx','okx','okx','okx','okx','okx','okx','okx','okx','bybit','bybit','bybit','bybit','bybit','bybit','bybit','kucoin'][event_id % 17 + 1] AS exchange,
       ['fobd','fobd','fobd','pi','pi','foi','foi','liq','liq','pi','foi','fobd','fobd','liq','liq','fobd','fobd'][event_id % 17 + 1] AS feed
FROM events WHERE event_id % 101 <> 0 AND event_id % 17 IN (0, 3, 5, 7, 9, 11, 13, 15, 16)""",
    "topic_symbol": f"""
SELECT event_id AS message_id, CASE WHEN event_id % 17 = 16 THEN 'kucoin' ELSE 'bybit' END AS exchange,
       CASE event_id % 17 WHEN 11 THEN {NATIVE}[4 + user_id % 4 + 1] WHEN 15 THEN '' ELSE {NATIVE}[8 + user_id % 4 + 1] END AS symbol
FROM events WHERE event_id % 101 <> 0 AND event_id % 17 IN (11, 15, 16)""",
    "instrument_validate": f"""WITH {HDR},
inst AS (SELECT DISTINCT {VENUES}[s_suppkey % 4 + 1] AS exchange, {NATIVE}[(s_suppkey % 4) * 4 + (s_suppkey // 4) % 3 + 1] AS native FROM supplier),
flagged AS (SELECT k, exchange, native AS symbol, EXISTS (SELECT 1 FROM inst i WHERE i.exchange = hdr.exchange AND i.native = hdr.native) AS listed FROM hdr)
SELECT exchange, symbol, listed, count(*) AS n, CAST(sum(k) AS BIGINT) AS k_sum FROM flagged GROUP BY ALL""",
    "ticker_symbol_filter": f"""WITH {OI}
SELECT k AS message_id, native AS symbol, oi_text FROM oid
WHERE exchange = 'bybit' AND native IN (SELECT {NATIVE}[4 + c_custkey % 2 + 1] FROM customer)""",
    "poll_overrun": f"""WITH {EV}
SELECT k AS event_id, exchange, (u * 1000) % 20000 AS duration_ms, CAST(10000 AS BIGINT) AS interval_ms FROM ev WHERE (u * 1000) % 20000 > 10000""",
    # decoders
    **{f"decode_book_{v}": decode_book(v) for v in ("binance", "bybit", "kucoin", "okx")},
    **{f"decode_delta_{v}": decode_delta(v) for v in ("binance", "bybit", "kucoin", "okx")},
    **{f"decode_oi_{v}": decode_oi(v) for v in ("binance", "bybit", "kucoin", "okx")},
    **{f"decode_pi_{v}": decode_pi(v) for v in ("binance", "bybit", "kucoin", "okx")},
    "decode_liq_kucoin": f"""WITH {KUCOIN_LIQ}
SELECT exchange, native AS symbol, 'liquidation' AS market, '/contractMarket/execution:' || native AS topic, 'Liquidation' AS subject, ts_ms FROM kl""",
    "liq_kucoin_filter": f"""WITH {KUCOIN_LIQ}
SELECT native AS symbol, '/contractMarket/execution:' || native AS topic, ts_ms FROM kl
WHERE native IN (SELECT {NATIVE}[8 + c_custkey % 2 + 1] FROM customer)""",
    "epoch_unit_infer": f"""WITH {EV}
SELECT k AS event_id, CASE k % 5 WHEN 0 THEN -(k % 2) WHEN 1 THEN ms // 1000 WHEN 2 THEN ms WHEN 3 THEN ms * 1000000 + 123456 ELSE ms * 1000 END AS raw,
       CASE k % 5 WHEN 0 THEN ms WHEN 1 THEN ms // 1000 * 1000 WHEN 2 THEN ms WHEN 3 THEN ms ELSE ms // 1000 END AS ts_ms FROM ev""",
    "payload_quarantine": f"""WITH {HDR}, {EV}, {FORCED}
SELECT f.feed, exchange, k AS message_id FROM hdr, (VALUES ('fobs'), ('fobd')) f(feed) WHERE k % 97 = 0 OR (k % 89 = 0 AND exchange <> 'okx')
UNION ALL SELECT 'foi', exchange, k FROM ev WHERE k % 97 = 0 OR (k % 89 = 0 AND exchange <> 'okx')
UNION ALL SELECT 'pi', exchange, k FROM ev WHERE k % 97 = 0 OR (k % 89 = 0 AND exchange <> 'okx' AND NOT (exchange = 'kucoin' AND k % 31 = 0))
UNION ALL SELECT 'liq', exchange, k FROM fl WHERE k % 97 = 0""",
    # normalisers
    "canonical_symbol": """WITH s AS (
  SELECT ['binance','BYBIT','kucoin','okx','coinbase','kraken','other'][event_id % 7 + 1] AS exchange,
         ['1000BONKUSDT','SHIB1000USDT','XBT-USDTM','BTC-USDT-SWAP','BTC/USD-PERP','ethPERPM','1000SHIBUSDT','SWAP-XBTMM'][event_id % 8 + 1] AS symbol FROM events),
c AS (SELECT exchange, symbol, CASE lower(exchange)
    WHEN 'binance' THEN CASE WHEN symbol IN ('1000BONKUSDT','1000PEPEUSDT','1000SHIBUSDT') THEN substr(symbol, 5) ELSE symbol END
    WHEN 'bybit' THEN CASE WHEN symbol IN ('1000BONKUSDT','1000PEPEUSDT') THEN substr(symbol, 5) WHEN symbol = 'SHIB1000USDT' THEN 'SHIBUSDT'
                           ELSE replace(symbol, 'PERP', 'USDC') END
    WHEN 'kucoin' THEN regexp_replace(regexp_replace(replace(symbol, '-', ''), 'M$', ''), '^XBT', 'BTC')
    WHEN 'okx' THEN replace(CASE WHEN ends_with(symbol, '-SWAP') THEN left(symbol, length(symbol) - 5) ELSE symbol END, '-', '')
    WHEN 'coinbase' THEN replace(symbol, '-', '')
    WHEN 'kraken' THEN replace(replace(symbol, '-', ''), '/', '') ELSE symbol END AS canonical FROM s)
SELECT exchange, symbol, canonical, count(*) AS n FROM c GROUP BY ALL""",
    "parse_strict": f"""WITH {EV}, n AS (SELECT k AS event_id, {number_shape('number')} FROM ev) SELECT event_id, number FROM n WHERE number IS NOT NULL""",
    "parse_or_zero": f"""WITH {EV}, n AS (SELECT k AS event_id, {number_shape('number')} FROM ev) SELECT event_id, coalesce(number, 0.0) AS number FROM n""",
    "book_flatten": f"""WITH {BOOK} SELECT exchange, symbol, market, ts_ms, last_update_id, side, price, quantity, level FROM book""",
    "delta_flatten": f"""WITH {DELTA}
SELECT exchange, market, symbol, event_time, update_id, prev_update_id, first_update_id, side, price, quantity, received_time FROM delta""",
    "oi_normalize": f"""WITH {OI} SELECT exchange, market, symbol, event_time, open_interest, received_time FROM oin""",
    "pi_normalize": f"""WITH {PI} SELECT * REPLACE (coalesce(next_funding_time, -1) AS next_funding_time) FROM pin""",
    "liq_binance": f"""WITH {LIQ} SELECT {LIQ_COLUMNS} FROM liq WHERE exchange = 'binance'""",
    "liq_bybit": f"""WITH {LIQ} SELECT exchange, symbol, side, time_ms, quantity, price FROM liq WHERE exchange = 'bybit'""",
    "liq_okx": f"""WITH {LIQ} SELECT exchange, symbol, side, position_side, time_ms, quantity, price FROM liq WHERE exchange = 'okx'""",
    "liq_unified": f"""WITH {LIQ} SELECT {LIQ_COLUMNS} FROM liq""",
    "liq_allow_filter": f"""WITH {LIQ}
SELECT symbol, side, count(*) AS n, max(time_ms) AS last_ms FROM liq WHERE exchange = 'okx' AND symbol IN ('BTC-USDT', 'SOL-USDT') GROUP BY ALL""",
    "side_norm": """WITH w AS (SELECT ['Buy','sell','LONG','Short','hold',''][event_id % 6 + 1] AS raw FROM events)
SELECT raw, upper(raw) AS side, count(*) AS n FROM w GROUP BY ALL""",
    "symbol_universe": f"""WITH a AS (
  SELECT 'binance' AS exchange, 'all' AS stream, {NATIVE}[c_custkey % 4 + 1] AS symbol FROM customer
  UNION SELECT 'binance', 'all', {NATIVE}[(c_custkey + 1) % 4 + 1] FROM customer
  UNION SELECT 'bybit', 'all', {NATIVE}[4 + c_custkey % 2 + 1] FROM customer
  UNION SELECT 'kucoin', 'all', {NATIVE}[8 + c_custkey % 2 + 1] FROM customer
  UNION SELECT 'okx', 'all', {NATIVE}[12 + c_custkey % 2 + 1] FROM customer
  UNION SELECT 'okx', 'all', {NATIVE}[12 + c_custkey % 3 + 1] FROM customer
  UNION SELECT 'okx', 'liquidation', {NATIVE}[12 + c_custkey % 2 + 1] FROM customer)
SELECT exchange, stream, symbol FROM a""",
    "symbol_allow_filter": f"""WITH {EV}, allowed AS (
  SELECT {CANONICAL}[c_custkey % 4 + 1] AS symbol FROM customer
  UNION SELECT {CANONICAL}[(c_custkey + 1) % 4 + 1] FROM customer
  UNION SELECT {CANONICAL}[4 + c_custkey % 2 + 1] FROM customer
  UNION SELECT {CANONICAL}[8 + c_custkey % 2 + 1] FROM customer
  UNION SELECT {CANONICAL}[12 + c_custkey % 3 + 1] FROM customer)
SELECT exchange, native AS symbol, count(*) AS n, CAST(sum(k) AS BIGINT) AS id_sum FROM ev
WHERE symbol IN (SELECT symbol FROM allowed) GROUP BY exchange, native""",
    "batch_key": f"""WITH {HDR}, m AS (SELECT *, {DELTA_MARKET} AS market FROM hdr)
SELECT exchange || '_' || market || '_' || symbol AS processor_key, exchange || '|' || market || '|' || native AS writer_key,
       exchange || '|' || market || '|' || native AS indicator_key, count(*) AS n FROM m GROUP BY ALL""",
    # batches
    "count_batches": f"""WITH {BOOK_MSGS}, {greedy(rows=40)} SELECT key, ts_ms, id, rows, batch_no FROM numbered""",
    "count_batches_single": f"""WITH {OI_MSGS}
SELECT key, ts_ms, id, (row_number() OVER (PARTITION BY key ORDER BY ts_ms, id) - 1) // 40 AS batch_no FROM msgs""",
    "batch_envelope": f"""WITH {OI_MSGS}, n AS (SELECT *, (row_number() OVER (PARTITION BY key ORDER BY ts_ms, id) - 1) // 40 AS batch_no FROM msgs)
SELECT sha256(key || '#' || batch_no) AS batch_id, key, batch_no, count(*) AS record_count, max(ts_ms) AS timestamp_ms,
       string_agg(CAST(id AS VARCHAR), ',' ORDER BY ts_ms, id) AS entry_ids FROM n GROUP BY key, batch_no""",
    "age_batches": f"""WITH {BOOK_MSGS}, {greedy(age_ms=2592000000)} SELECT key, batch_no, messages, record_count, first_ms, last_ms FROM sizes""",
    "gap_batches": f"""WITH {OI_MSGS}, g AS (
  SELECT *, CASE WHEN ts_ms - lag(ts_ms) OVER (PARTITION BY key ORDER BY ts_ms, id) > 3600000 THEN 1 ELSE 0 END AS opens FROM msgs),
s AS (SELECT *, CAST(sum(opens) OVER (PARTITION BY key ORDER BY ts_ms, id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS batch_no FROM g)
SELECT key, batch_no, count(*) AS messages, CAST(sum(rows) AS BIGINT) AS record_count, min(ts_ms) AS first_ms, max(ts_ms) AS last_ms FROM s GROUP BY key, batch_no""",
    "count_or_idle_batches": f"""WITH {OI_MSGS}, {greedy(rows=5, idle_ms=3600000)} SELECT * FROM sizes""",
    "interval_flush": f"""WITH {OI_MSGS}
SELECT key, ts_ms // 3600000 * 3600000 + 3600000 AS flush_ms, count(*) AS messages, CAST(sum(rows) AS BIGINT) AS record_count FROM msgs GROUP BY ALL""",
    "key_flush": f"""WITH {OI_MSGS}, {greedy(rows=10, age_ms=21600000)} SELECT * FROM sizes""",
    "liq_flush": f"""WITH {FORCED}, sent AS (
  SELECT exchange, ms, k FROM fl WHERE exchange <> 'kucoin' AND k % 97 <> 0
  UNION ALL SELECT exchange, ms, k FROM fl WHERE exchange IN ('bybit', 'okx') AND ln % 2 = 0 AND k % 97 <> 0
  UNION ALL SELECT exchange, ms, k FROM fl WHERE exchange = 'okx' AND flag = 'R' AND k % 97 <> 0),
placed AS (SELECT *, row_number() OVER (ORDER BY ms, k) AS p FROM sent),
run AS (
  SELECT list_reduce(list({{'held': CAST(1 AS BIGINT), 'due': (ms + 15 * {HOUR} + {HOUR} - 1) // {HOUR}, 'hour': ms // {HOUR}, 'begins': [p]}} ORDER BY p),
    lambda a, x: CASE WHEN a.held > 0 AND greatest(a.due, a.hour + 1) <= x.hour
      THEN {{'held': CAST(1 AS BIGINT), 'due': greatest(a.due, a.hour + 1) + 15, 'hour': x.hour, 'begins': list_concat(a.begins, x.begins)}}
      ELSE {{'held': CASE WHEN a.held = 9 THEN CAST(0 AS BIGINT) ELSE a.held + 1 END, 'due': CASE WHEN a.held = 9 THEN x.due ELSE a.due END,
             'hour': x.hour, 'begins': CASE WHEN a.held = 0 THEN list_concat(a.begins, x.begins) ELSE a.begins END}} END) AS r FROM placed),
begins AS (SELECT unnest(r.begins) AS p, unnest(range(len(r.begins))) AS batch_no FROM run)
SELECT b.batch_no, exchange, count(*) AS records, min(ms) AS first_ms, max(ms) AS last_ms
FROM placed ASOF JOIN begins b ON placed.p >= b.p GROUP BY ALL""",
    "drain": f"""WITH {BOOK_MSGS}, {greedy(rows=40)} SELECT * FROM sizes WHERE record_count < 40""",
    # published tables, layout, catalogue
    "snapshot_valid_filter": """
SELECT l_orderkey, epoch_us(l_shipdate) // 1000 AS ts_ms, l_extendedprice AS price, l_quantity AS quantity, 'bid' AS side, l_linenumber - 1 AS level
FROM lineitem WHERE l_partkey % 11 <> 0 AND l_partkey % 5 <> 0 AND l_partkey % 7 <> 0 AND l_partkey % 3 <> 0 AND l_linenumber > 1
  AND l_extendedprice <> 0 AND l_quantity <> 0""",
    "sink_snapshot": f"""WITH {BOOK} SELECT exchange, symbol, ts_ms AS timestamp, last_update_id, side, price, quantity, level FROM book""",
    "sink_delta": f"""WITH {DELTA}
SELECT symbol, event_time, update_id, prev_update_id, first_update_id, side, price, quantity, received_time FROM delta""",
    "sink_open_interest": f"""WITH {OI} SELECT exchange, market, symbol, event_time, open_interest, received_time FROM oin""",
    "sink_premium_index": f"""WITH {PI} SELECT * REPLACE (coalesce(next_funding_time, {ABSENT}) AS next_funding_time) FROM pin""",
    "sink_liquidation": f"""WITH {LIQ} SELECT {LIQ_COLUMNS.replace('time_ms', 'time_ms AS time_millis')} FROM liq""",
    "partition_layout": f"""WITH {DELTA}, {OI}
SELECT 'exchange=' || exchange || '/market=' || market || '/symbol=' || symbol || '/' || {utc('received_time', 'year=%Y/month=%m/day=%d/hour=%H')} AS folder, count(*) AS n
FROM delta GROUP BY ALL
UNION ALL
SELECT 'exchange=' || exchange || '/market=' || market || '/symbol=' || symbol || '/' || {utc('received_time', 'date=%Y-%m-%d')}, count(*) FROM oin GROUP BY ALL""",
    "liq_layout": f"""WITH {LIQ} SELECT 'exchange=' || exchange || '/' || {utc('time_ms', 'year=%Y/month=%m/day=%d/hour=%H')} AS folder, count(*) AS n FROM liq GROUP BY ALL""",
    "file_name": f"""WITH {PI}
SELECT exchange || '_pi_' || symbol || '_' || {utc_stamp('event_time')} || '.parquet' AS file, count(*) AS n FROM pin GROUP BY ALL""",
}

MANIFEST = f"""{OI}, c AS (SELECT *, received_time // 86400000 * 86400000 + 86400000 AS snapshot_ms FROM oin),
manifest AS (
  SELECT exchange, market, symbol,
         'exchange=' || exchange || '/market=' || market || '/symbol=' || symbol || '/date=' || {utc('snapshot_ms', '%Y-%m-%d')} AS folder,
         exchange || '_foi_' || symbol || '_' || {utc_stamp('snapshot_ms')} || '.parquet' AS file,
         count(*) AS record_count, snapshot_ms, 1 AS status
  FROM c GROUP BY ALL)"""


def nested(cte: str, columns: str, prefix: tuple[str, str]) -> str:
    def agg(side: str) -> str:
        level = "CAST(CAST(price AS DECIMAL(18,2)) AS VARCHAR) || '@' || CAST(CAST(quantity AS DECIMAL(18,2)) AS VARCHAR)"
        return f"coalesce(string_agg({level}, ';' ORDER BY level) FILTER (WHERE side = '{side}'), '')"

    return f"""SELECT {columns}, {agg('bid')} AS {prefix[0]}, {agg('ask')} AS {prefix[1]} FROM {cte}"""


ORACLES |= {
    "file_manifest": f"""WITH {OI}
SELECT exchange, market, symbol, {utc('received_time', '%Y-%m-%d')} AS date, k % 2 AS commit_id, 1705276800000 + k % 2 * 86400000 AS snapshot_ms,
       1 AS status, count(*) AS record_count, true AS sized FROM oin GROUP BY ALL""",
    "snapshot_log": f"""WITH {MANIFEST}
SELECT snapshot_ms * 1000000 AS snapshot_id, snapshot_ms AS timestamp_ms, count(*) AS files, CAST(sum(record_count) AS BIGINT) AS records FROM manifest GROUP BY snapshot_ms""",
    "read_as_of": f"""WITH {OI}
SELECT exchange, market, symbol, event_time, open_interest, received_time, {utc('received_time', '%Y-%m-%d')} AS date FROM oin WHERE k % 2 = 0""",
    "codec_select": f"""WITH {EV}, a AS (SELECT ['snapshot','delta','liquidation','open_interest','premium_index'][k % 5 + 1] AS t,
  ['snappy','gzip','GZIP','','zstd','lzo','none'][k % 7 + 1] AS configured FROM ev)
SELECT t AS "table", configured, CASE WHEN t IN ('delta','liquidation') THEN 'snappy'
  WHEN t = 'snapshot' THEN CASE configured WHEN 'snappy' THEN 'snappy' WHEN 'gzip' THEN 'gzip' WHEN 'lzo' THEN 'unavailable' ELSE 'none' END
  ELSE CASE lower(configured) WHEN 'gzip' THEN 'gzip' WHEN 'snappy' THEN 'snappy' WHEN '' THEN 'snappy' ELSE 'none' END END AS codec,
  count(*) AS writes FROM a GROUP BY ALL""",
    "catalog_entry": f"""WITH {EV} SELECT DISTINCT name, 's3://lake/tables/' || name || '/metadata/metadata.json' AS metadata_location FROM (
  SELECT exchange || '_' || ['snapshot','delta','liquidation','open_interest','premium_index'][k % 5 + 1] AS name FROM ev)""",
    "upload_stats": """SELECT event_id AS write_id, event_id * 100 AS bytes, event_id % 50 AS records, event_id % 5 * 20 AS duration_ms,
  CASE WHEN event_id % 5 = 0 THEN -1.0::DOUBLE ELSE round(CAST(event_id * 100 AS DOUBLE) / ((event_id % 5 * 20) / 1000.0::DOUBLE), 6) END AS bytes_per_sec FROM events""",
    # documented views
    "nested_snapshot": f"""WITH {BOOK}
{nested('book', 'exchange, market AS market_type, symbol, ts_ms AS timestamp_ms, last_update_id', ('bids', 'asks'))} GROUP BY k, exchange, market, symbol, ts_ms, last_update_id""",
    "poll_grid": f"""WITH {BOOK}, polled AS (
  SELECT k, ms // {WEEK} * {WEEK} AS bucket_ms, row_number() OVER (PARTITION BY exchange, native, ms // {WEEK} ORDER BY ms DESC, k DESC) AS rn,
         count(*) OVER (PARTITION BY exchange, native, ms // {WEEK}) AS polls FROM hdr)
{nested('book JOIN polled USING (k)', 'bucket_ms, polls, exchange, market AS market_type, symbol, ts_ms AS timestamp_ms, last_update_id', ('bids', 'asks'))}
WHERE rn = 1 GROUP BY k, bucket_ms, polls, exchange, market, symbol, ts_ms, last_update_id""",
    "nested_delta": f"""WITH {DELTA}
{nested('delta', 'exchange, market AS market_type, symbol, event_time AS timestamp_ms, update_id', ('bid_updates', 'ask_updates'))} GROUP BY k, exchange, market, symbol, event_time, update_id""",
    "liquidation_slim": f"""WITH {LIQ} SELECT exchange, 'liquidation' AS market_type, symbol, side, price, quantity, time_ms AS timestamp_ms FROM liq""",
    "open_interest_slim": f"""WITH {OI} SELECT exchange, symbol, open_interest, event_time AS timestamp_ms FROM oin""",
    "funding_rate": f"""WITH {PI}
SELECT exchange, symbol, funding_rate, next_funding_time AS funding_time, event_time AS timestamp_ms FROM pin WHERE next_funding_time IS NOT NULL""",
    # telemetry
    "metric_events": f"""WITH {MET}
SELECT event_id, name, type, 'on' AS switches FROM mok
UNION ALL SELECT event_id, name, type, 'off' FROM mok WHERE name NOT IN ('used_weight','fobs_raw_buffer_length','fobs_norm_buffer_length','fobd_raw_buffer_length','fobd_norm_buffer_length')""",
    "metric_numeric": f"WITH {MET} SELECT event_id, name, number FROM mnum",
    "metric_dimensions": f"WITH {MET} SELECT event_id, dims AS dimensions FROM mnum",
    "metric_unit": f"WITH {MET} SELECT unit, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum FROM mnum GROUP BY unit",
    "metric_series_key": f"WITH {MET} SELECT series, count(*) AS n FROM mser GROUP BY series",
    "metric_throttle": f"""WITH {MET}, msgs AS (SELECT series AS key, ts_ms, event_id AS id, CAST(1 AS BIGINT) AS rows FROM mser),
{greedy(age_ms=60000)}, firsts AS (SELECT *, row_number() OVER (PARTITION BY key, batch_no ORDER BY ts_ms, id) AS rn FROM numbered)
SELECT key AS series, ts_ms, id AS event_id FROM firsts WHERE rn = 1""",
    "metric_rollup_60s": f"""WITH {MET}, r AS (
  SELECT ts_ms // 60000 * 60000 AS minute_ms, component, name, ip,
         CASE WHEN name IN ('used_weight', 'cpu_percent') THEN 'max' ELSE 'avg' END AS stat, number
  FROM mnum WHERE name <> 'foi_raw_buffer_length')
SELECT minute_ms, component, name, ip, stat, round(CASE WHEN stat = 'avg' THEN avg(number) ELSE max(number) END, 6) AS value, count(*) AS samples
FROM r GROUP BY minute_ms, component, name, ip, stat""",
    "drop_events": f"""WITH {STG}
SELECT ts_ms, 'channel_drops' AS component, name, '1' AS value, 1.0::DOUBLE AS number, 'counter' AS type,
       concat_ws('|', CASE WHEN exchange <> '' THEN 'exchange=' || exchange END, 'market=' || market, 'stage=' || stage,
                 CASE WHEN symbol <> '' THEN 'symbol=' || symbol END) AS fields FROM drp""",
    "drop_summary": f"""WITH {STG}, d AS (
  SELECT CASE WHEN exchange = '' THEN 'unknown' ELSE exchange END AS exchange, name, 1.0::DOUBLE AS n FROM drp
  WHERE name IN ('snapshot_messages_dropped','delta_messages_dropped','delta_norm_messages_dropped','liquidation_messages_dropped'))
SELECT coalesce(exchange, 'ALL') AS exchange, coalesce(sum(n) FILTER (WHERE name = 'snapshot_messages_dropped'), 0.0::DOUBLE) AS snapshot,
       coalesce(sum(n) FILTER (WHERE name = 'delta_messages_dropped'), 0.0::DOUBLE) AS delta, coalesce(sum(n) FILTER (WHERE name = 'delta_norm_messages_dropped'), 0.0::DOUBLE) AS delta_norm,
       coalesce(sum(n) FILTER (WHERE name LIKE 'delta%'), 0.0::DOUBLE) AS delta_total,
       coalesce(sum(n) FILTER (WHERE name = 'liquidation_messages_dropped'), 0.0::DOUBLE) AS liquidation, coalesce(sum(n), 0.0::DOUBLE) AS total
FROM d GROUP BY ROLLUP (exchange)""",
    "channel_stats": f"""WITH {STG}
SELECT feed, count(*) FILTER (WHERE stage = 'raw' AND outcome = 'sent') AS raw_sent, count(*) FILTER (WHERE stage = 'norm' AND outcome = 'sent') AS norm_sent,
       count(*) FILTER (WHERE stage = 'raw' AND outcome = 'dropped') AS raw_dropped, count(*) FILTER (WHERE stage = 'norm' AND outcome = 'dropped') AS norm_dropped
FROM stg GROUP BY feed""",
    "buffer_occupancy": f"""WITH {MET}, {STG.removeprefix(EV + ', ')}, flow AS (
  SELECT feed, stage, ts_ms, 1 AS change FROM stg WHERE outcome = 'sent'
  UNION ALL SELECT feed, 'raw', ts_ms, -1 FROM stg WHERE stage = 'norm'
  UNION ALL SELECT feed, 'norm', ts_ms + event_id % 40 * 250, -1 FROM stg WHERE stage = 'norm' AND outcome = 'sent'),
s AS (SELECT feed, stage, ts_ms // 1000 * 1000 AS second_ms, sum(change) AS change FROM flow GROUP BY ALL),
b AS (SELECT feed, stage, second_ms, CAST(sum(change) OVER (PARTITION BY feed, stage ORDER BY second_ms ROWS UNBOUNDED PRECEDING) AS BIGINT) AS backlog FROM s),
caps AS (SELECT split_part(name, '_', 1) AS feed, split_part(name, '_', 2) AS stage, ts_ms, event_id, capacity FROM mok
         WHERE capacity IS NOT NULL AND name LIKE '%buffer_length')
SELECT feed, stage, second_ms, backlog, CAST(coalesce((SELECT c.capacity FROM caps c WHERE c.feed = b.feed AND c.stage = b.stage AND c.ts_ms < b.second_ms + 1000
         ORDER BY c.ts_ms DESC, c.event_id DESC LIMIT 1), CASE stage WHEN 'raw' THEN 10000 ELSE 2000 END) AS BIGINT) AS capacity FROM b""",
    "latest_metrics": f"WITH {MET} SELECT event_id, ts_ms, component, name, value FROM mok ORDER BY ts_ms DESC, event_id DESC LIMIT 200",
    "latest_per_series": f"""WITH {MET}, t AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY ts_ms DESC, event_id DESC) AS rn FROM mnum
  WHERE name NOT IN ('used_weight', 'cpu_percent', 'foi_raw_buffer_length'))
SELECT name, event_id, ts_ms, number AS value FROM t WHERE rn <= 150""",
    "latest_capacity": f"""WITH {MET}, t AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY ts_ms DESC, event_id DESC) AS rn FROM mnum
  WHERE capacity IS NOT NULL AND name NOT IN ('used_weight', 'cpu_percent', 'foi_raw_buffer_length'))
SELECT name, capacity FROM t WHERE rn = 1""",
    "log_records": f"""WITH {EV}
SELECT k AS event_id, ms AS ts_ms, CASE WHEN event_type = 'error' THEN 'error' ELSE 'info' END AS level,
       CASE WHEN k % 5 = 0 THEN '' ELSE exchange || '_reader' END AS component, event_type AS message,
       'symbol=' || native || '|user=' || u AS fields FROM ev ORDER BY ms DESC, k DESC LIMIT 200""",
    "resource_latest": f"""WITH {EV}, t AS (SELECT * FROM ev ORDER BY ms DESC, k DESC LIMIT 180)
SELECT k AS event_id, ms AS ts_ms, CASE WHEN k % 13 = 0 THEN 0.0::DOUBLE ELSE value END AS cpu_percent, k * 1024 AS memory_used,
       CAST(1073741824 AS BIGINT) AS memory_total, CASE WHEN k % 11 = 0 THEN 0.0::DOUBLE ELSE CAST(k % 100 AS DOUBLE) END AS memory_percent,
       k * 4096 AS disk_used, CAST(1099511627776 AS BIGINT) AS disk_total, CAST((k % 50) * 2 AS DOUBLE) AS disk_percent,
       row_number() OVER (ORDER BY ms DESC, k DESC) = 1 AS is_summary FROM t""",
    # API usage
    "used_weight_binance": f"""WITH {EV}, h AS (
  SELECT k, CASE WHEN k % 13 = 0 THEN ' ' ELSE '10.0.0.1' END AS ip, CAST((u % 4 - 1) * 5 AS DOUBLE) AS extra,
         coalesce(CASE WHEN k % 3 = 0 THEN CAST(dv AS DOUBLE) END, CASE WHEN k % 5 IN (1, 2) THEN CAST(k % 200 AS DOUBLE) END,
                  CASE WHEN k % 7 < 4 THEN 7.5::DOUBLE END) AS used FROM ev WHERE exchange = 'binance')
SELECT k AS event_id, ip, used, used + greatest(extra, 0) AS used_weight FROM h WHERE used IS NOT NULL""",
    "used_weight_bybit": f"""WITH {EV}, h AS (
  SELECT k, CASE k % 3 WHEN 0 THEN 120.0::DOUBLE WHEN 1 THEN 98.0::DOUBLE ELSE 0.0::DOUBLE END AS quota,
         CASE WHEN k % 5 < 3 THEN CAST(k % 200 AS DOUBLE) WHEN k % 5 = 3 THEN -4.0::DOUBLE ELSE 0.0::DOUBLE END AS remaining
  FROM ev WHERE exchange = 'bybit' AND k % 13 <> 0 AND (k % 3 < 2 OR k % 7 = 0 OR k % 5 < 4))
SELECT k AS event_id, quota, remaining, CASE WHEN quota > 0 AND remaining >= 0 THEN greatest(quota - remaining, 0.0::DOUBLE) ELSE -1.0::DOUBLE END AS used_weight FROM h""",
    "used_weight_kucoin": f"""WITH {EV}, h AS (SELECT k, CASE WHEN k % 3 = 0 THEN 4000 ELSE k % 3 * 400 END AS quota, k % 500 AS remaining, CAST((u % 4 - 1) * 5 AS DOUBLE) AS extra
  FROM ev WHERE exchange = 'kucoin' AND k % 5 <> 4)
SELECT k AS event_id, CAST(quota AS BIGINT) AS quota, CAST(greatest(quota - remaining, 0) AS DOUBLE) * 3 + greatest(extra, 0) AS used_weight FROM h""",
    "used_weight_okx": f"""WITH {EV}, h AS (
  SELECT k, CASE WHEN k % 3 = 0 THEN 12.0::DOUBLE ELSE 10.0::DOUBLE END AS quota,
         CASE WHEN k % 5 < 3 THEN CAST(k % 20 AS DOUBLE) WHEN k % 5 = 3 THEN -1.0::DOUBLE ELSE 0.0::DOUBLE END AS remaining,
         CASE WHEN u % 2 = 0 OR k % 3 = 0 THEN 1737043200000.0::DOUBLE ELSE 0.0::DOUBLE END AS reset_ms,
         CASE k % 7 WHEN 0 THEN 0.5::DOUBLE WHEN 1 THEN 3.0::DOUBLE WHEN 2 THEN 4.0::DOUBLE ELSE 2.0::DOUBLE END AS window_s,
         CAST((u % 4 - 1) * 5 AS DOUBLE) AS extra FROM ev WHERE exchange = 'okx')
SELECT k AS event_id, quota, remaining, reset_ms, window_s,
       CASE WHEN remaining >= 0 THEN greatest(quota - remaining, 0.0::DOUBLE) ELSE 0.0::DOUBLE END + greatest(extra, 0) AS used_weight
FROM h WHERE remaining >= 0 OR extra > 0""",
    "weight_estimates": """WITH s AS (SELECT event_id, event_id % 40 AS symbols, event_id % 5 * 250 AS interval_ms, event_id % 3 AS connections FROM events),
e AS (SELECT *, CASE WHEN symbols > 0 AND interval_ms > 0 THEN 1000.0::DOUBLE / interval_ms * symbols * 60 ELSE 0.0::DOUBLE END AS base,
             CASE WHEN connections > 0 THEN 180.0::DOUBLE / connections ELSE 0.0::DOUBLE END AS okx_ws FROM s)
SELECT event_id, symbols, interval_ms, connections, base AS binance, base * 5 AS kucoin, base AS okx_rest, okx_ws,
       CASE WHEN symbols > 0 AND base > 0 THEN base / symbols ELSE 0.0::DOUBLE END AS binance_share,
       CASE WHEN symbols > 0 AND base > 0 THEN base * 5 / symbols ELSE 0.0::DOUBLE END AS kucoin_share,
       CASE WHEN symbols > 0 AND okx_ws > 0 THEN okx_ws / symbols ELSE 0.0::DOUBLE END AS okx_ws_share FROM e""",
}
